"""Evaluation aggregates: accuracy, span accuracy, epoch tables, best-so-far
checkpoints, metric-log parsing, prefixed metric names, quality gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.common import with_row_index

# Metric prefix and the summarisation pass thresholds (strict >).
METRIC_PREFIX = "eval"
ROUGE_GATE = {"rouge1": 22.0, "rouge2": 8.5, "rougeL": 20.5}
# Keys read from a training-log line.
LOG_KEYS = ("rouge1", "rouge2", "rougeL", "rougeLsum", "train_loss", "epoch", "step")


def accuracy(df: DataFrame, pred: str, gold: str, by: str | None = None) -> DataFrame:
    hit = (F.col(pred) == F.col(gold)).cast("double")
    g = df.groupBy(by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def span_accuracy(df: DataFrame, ps: str, pe: str, gs: str, ge: str) -> DataFrame:
    hit = ((F.col(ps) == F.col(gs)) & (F.col(pe) == F.col(ge))).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("span_acc"))


def epoch_metrics(steps: DataFrame, epoch: str, loss: str) -> DataFrame:
    return steps.groupBy(epoch).agg(F.count(F.lit(1)).alias("n_steps"),
                                    F.sum(loss).alias("loss_sum"), F.avg(loss).alias("loss_mean"))


def best_so_far(metrics: DataFrame, run: list, order: str, value: str) -> DataFrame:
    """Flag rows whose value is strictly greater than every earlier value of
    the run (running best starts at 0), i.e. when a checkpoint is saved."""
    w = Window.partitionBy(*run).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.coalesce(F.max(value).over(w), F.lit(0.0))
    return metrics.withColumn("is_best", F.col(value) > prev)


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def round_scaled(df: DataFrame, cols: list, scale: float = 100.0, digits: int = 4) -> DataFrame:
    """Scores times ``scale``, rounded to ``digits`` (the form scores are logged in)."""
    return df.select(*[F.round(F.col(c) * scale, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def prefix_metrics(long_metrics: DataFrame, prefix: str = METRIC_PREFIX) -> DataFrame:
    """(metric, value): names get ``{prefix}_`` unless they already start with it."""
    p = prefix + "_"
    return long_metrics.select(
        F.when(F.col("metric").startswith(p), F.col("metric"))
        .otherwise(F.concat(F.lit(p), F.col("metric"))).alias("metric"), "value")


def quality_gate(wide: DataFrame, thresholds: dict = ROUGE_GATE) -> DataFrame:
    cond = None
    for k, t in thresholds.items():
        c = F.col(k) > F.lit(t)
        cond = c if cond is None else (cond & c)
    return wide.withColumn("passed", cond)


def parse_metric_log(lines: DataFrame, line_col: str = "line", order: list | None = None) -> DataFrame:
    """Pull each ``'key': number`` out of dict-literal log lines (no fixed
    width truncation); a key that is missing, nan or not a number is NULL, and a
    line counts if it names any of the keys.  ``row_no`` numbers the lines in
    ``order`` (epoch axis, since step counts may restart) without a
    single-partition window."""
    def number(k):
        v = F.regexp_extract(line_col, rf"'{k}': (-?[0-9.eE+-]+)", 1).try_cast("double")
        return F.when(~F.isnan(v), v).alias(k)

    known = F.col(line_col).rlike("'(" + "|".join(LOG_KEYS) + ")':")
    out = lines.where(known).select(*(order or []), *[number(k) for k in LOG_KEYS])
    return with_row_index(out, order, "row_no") if order else out
