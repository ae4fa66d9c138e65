"""Lookups inside the row and by join give the same; no token is shuffled by the former."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import vocab as V


@pytest.fixture(scope="module")
def data(spark):
    df = spark.createDataFrame([(1, "a b  c a"), (2, ""), (3, None), (4, "zz"), (5, "c " + "y" * 3000)], "k int, t string")
    vocab = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4), ("", 5)], "token string, id int")
    return df, vocab


def rows(df, col):
    return sorted((r[0], r[1]) for r in df.select("k", col).collect())


@pytest.mark.parametrize("bound", [10, None])
def test_both_ways(spark, data, bound):
    df, vocab = data
    ids = V.encode(df, "k", "t", vocab, bound)
    assert rows(ids, "ids") == [(1, [2, 3, 5, 4, 2]), (2, [5]), (4, [1]), (5, [4, 1])]
    assert rows(V.encode(df, "k", "t", vocab, bound, to_len=2), "ids") == [(1, [2, 3]), (2, [5, 0]), (4, [1, 0]), (5, [4, 1])]
    assert rows(V.decode(ids, "k", "ids", vocab, bound), "tokens") == [(1, ["a", "b", "", "c", "a"]), (2, [""]), (4, []), (5, ["c"])]


def test_a_vocabulary_with_a_long_token_is_joined(spark, data):
    df, _ = data
    vocab = spark.createDataFrame([("y" * 3000, 2), ("c", 3)], "token string, id int")
    assert V.token_table(vocab, 10) is None and V.token_table(vocab, None) is None
    assert (5, [3, 2]) in rows(V.encode(df, "k", "t", vocab, 10), "ids")


def test_no_exchange_above_the_vocabulary(spark, data):
    df, vocab = data
    ids = V.encode(df, "k", "t", vocab, 10)
    for out in (ids, V.decode(ids, "k", "ids", vocab, 10), ids.select("k", F.size("ids"))):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
