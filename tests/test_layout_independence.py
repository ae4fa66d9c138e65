"""Results must not depend on partitioning: same rows with 1 and 7 shuffle
partitions (SURVEY section 5, rule 5)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["vocabulary", "encode_tokens", "entity_f1_strict", "qa_nbest", "predictions_indexed",
         "padded_batches", "context_windows", "rouge_n_multiset", "dedupe_predictions", "shuffled_order"]


def snapshot(df):
    cols = sorted(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_result_any_partitioning(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = snapshot(E.queries()[name](spark, SF))
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        b = snapshot(E.queries()[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_repartitioned_input_same_vocabulary(spark):
    from tessera.operators import vocab as V
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = snapshot(V.vocabulary(V.word_count(docs, "text"), 500))
    b = snapshot(V.vocabulary(V.word_count(docs.repartition(13, "lang"), "text"), 500))
    assert a == b
