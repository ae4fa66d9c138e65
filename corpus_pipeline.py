"""Corpus pipeline: toxicity, near-duplicates, repeated spans, contamination, mixture.

``STAGES`` lists (name, function) in order.  A function takes (spark, docs,
sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to the shared
folder that spark.checkpoint.dir names and rereads as the next one's ``docs``.
All but the last return the columns of ``documents``; the last adds the source's
weight, the document's block and how often it is drawn.

Defined cases, in every stage: null, empty and very long texts, repeated rows
and extra columns are handled as the operators' docstrings say; an empty table
passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import held_out, stored, table
from tessera.llm.decontam import find_contamination
from tessera.llm.minhash import near_duplicates
from tessera.llm.mixing import mix
from tessera.llm.spans import remove_repeats
from tessera.llm.toxicity import fit_toxicity, score_toxicity

TOXIC = 0.7       # a document at this toxicity or above goes
SIMILAR = 80      # per cent of shared word 5-shingles that make near-duplicates


def _same(docs: DataFrame, out: DataFrame) -> DataFrame:
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores under ``TOXIC``."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1))
    scored = score_toxicity(docs, fit_toxicity(docs, labels), out="__toxicity")
    return _same(docs, scored.where(F.col("__toxicity") < TOXIC))


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class; a row without id stays.

    Rows repeated under a kept id are copies of one document: one of them stays
    for each distinct text.
    """
    out = near_duplicates(docs, percent=SIMILAR)
    found = stored(out.groupBy("doc_id").agg(F.max(~F.col("kept")).alias("__gone"), F.count(F.lit(1)).alias("__n")))
    gone = found.where("doc_id is not null and __gone").select("doc_id")
    rest = docs.join(gone, "doc_id", "left_anti")
    again = found.where("doc_id is not null and __n > 1 and not __gone").select("doc_id")
    if again.isEmpty():
        return _same(docs, rest)
    once = rest.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return _same(docs, rest.join(again, "doc_id", "left_anti").unionByName(once.select(*rest.columns)))


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without sentences that repeat an earlier span; one that loses all its text goes."""
    out = remove_repeats(docs)
    out = out.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    return _same(docs, out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                                      .otherwise(F.col("n_chars"))))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    out = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return _same(docs, out.where(~F.col("contaminated")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their source's weight, their block and how often they are drawn."""
    return mix(docs)


STAGES = [("toxicity", toxicity), ("near_duplicate", near_duplicate), ("repeated_spans", repeated_spans),
          ("decontamination", decontamination), ("mixture", mixture)]

# Toxicity scores come from a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
