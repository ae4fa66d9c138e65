"""Writers: prediction CSVs, JSONL with non-ASCII kept, wide quoted CSV,
QA result tables partitioned by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, quote_all: bool = False, mode: str = "overwrite") -> None:
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("quoteAll", quote_all).csv(path))


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``id,<label>`` CSV (tags already joined by spaces)."""
    write_csv(df, path, mode=mode)


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = False, mode: str = "overwrite") -> None:
    """JSON lines, UTF-8 (non-ASCII written as is)."""
    df.write.mode(mode).option("ignoreNullFields", not keep_nulls).json(path)


def write_wide_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Multiple-choice wide CSV: every cell quoted so commas/newlines survive."""
    write_csv(df, path, quote_all=True, mode=mode)


def write_concat_json(df: DataFrame, path: str, keys: list, order: str, mode: str = "overwrite") -> None:
    """One line per key with its rows as JSON objects back to back (``{..}{..}``), in ``order``."""
    body = [c for c in df.columns if c not in keys]
    rows = df.select(*keys, F.struct(F.col(order).alias("o"), F.to_json(F.struct(*body)).alias("j")).alias("x"))
    lines = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    lines.select(F.array_join("xs.j", "").alias("value")).write.mode(mode).text(path)


def write_qa_results(nbest: DataFrame, predictions: DataFrame, path: str, stage: str,
                     null_odds: DataFrame | None = None) -> None:
    """Three tables (predictions, nbest, null_odds) under ``path``, each
    partitioned by ``stage`` (the reference's optional file prefix).  The n-best
    list is nested, one row per example in rank order.  Writing a stage again
    replaces that stage and leaves the others."""
    others = [c for c in nbest.columns if c != "example_id"]
    ranked = F.array_sort(F.collect_list(F.struct("rank", *[c for c in others if c != "rank"])))
    nested = nbest.groupBy("example_id").agg(ranked.alias("nbest"))
    for name, df in (("predictions", predictions), ("nbest", nested), ("null_odds", null_odds)):
        if df is None:
            continue
        (df.withColumn("stage", F.lit(stage)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("stage").parquet(f"{path}/{name}"))
