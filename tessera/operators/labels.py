"""Label sets: dense sorted index, strict label<->id encoding, drift between
two label sets, B-/I- mapping, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_index(df: DataFrame, col: str, explode: bool = False) -> DataFrame:
    """Distinct labels -> dense 0-based index in sorted order.  The distinct
    runs as a partial/final aggregate; only the distinct set is numbered, in one
    task: it is meant for label sets (up to a few million labels)."""
    c = F.explode(col) if explode else F.col(col)
    labels = df.select(c.alias("label")).where(F.col("label").isNotNull()).distinct()
    return labels.select("label", (F.row_number().over(Window.orderBy("label")) - 1).alias("idx"))


def encode_labels(df: DataFrame, col: str, labels: DataFrame, out: str = "label_id",
                  strict: bool = True) -> DataFrame:
    """label -> id.  Unknown labels fail the job under ``strict`` (the
    reference raises KeyError); otherwise they come out as NULL ids.  Join
    strategy is left to AQE (broadcast when the label table is small)."""
    j = df.join(labels.select(F.col("label").alias(col), F.col("idx").alias(out)), col, "left")
    if strict:
        j = j.withColumn(out, F.when(F.col(out).isNull() & F.col(col).isNotNull(),
                                     F.raise_error(F.concat(F.lit("unknown label: "), F.col(col))))
                         .otherwise(F.col(out)))
    return j


def label_drift(model_labels: DataFrame, data_labels: DataFrame) -> DataFrame:
    """Full outer join of two label sets: status both / model_only / data_only."""
    m = model_labels.select(F.col("label")).distinct().withColumn("_m", F.lit(True))
    d = data_labels.select(F.col("label")).distinct().withColumn("_d", F.lit(True))
    return (m.join(d, "label", "full_outer")
            .select("label", F.when(F.col("_m") & F.col("_d"), "both")
                    .when(F.col("_m"), "model_only").otherwise("data_only").alias("status")))


def b_to_i_map(labels: DataFrame) -> DataFrame:
    """For every B- label whose I- form exists: (b_label, b_idx, i_label, i_idx)."""
    b = labels.where(F.col("label").startswith("B-")).select(
        F.col("label").alias("b_label"), F.col("idx").alias("b_idx"),
        F.replace(F.col("label"), F.lit("B-"), F.lit("I-")).alias("i_label"))
    i = labels.select(F.col("label").alias("i_label"), F.col("idx").alias("i_idx"))
    return b.join(i, "i_label", "inner").select("b_label", "b_idx", "i_label", "i_idx")


def dedupe(df: DataFrame, keys: list, keep_col: str, last: bool = False) -> DataFrame:
    """One row per key, keeping the row with the smallest (or, with ``last``,
    the largest) ``keep_col``.  Written as min_by/max_by aggregation so a key
    with very many copies is reduced map-side instead of landing whole in
    one window task."""
    others = [c for c in df.columns if c not in keys]
    pick = F.max_by if last else F.min_by
    row = F.struct(*[F.col(c) for c in others])
    return (df.groupBy(*keys).agg(pick(row, F.col(keep_col)).alias("_row"))
            .select(*keys, "_row.*"))
