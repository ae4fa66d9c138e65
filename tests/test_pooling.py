"""Max-pooled vectors against small Python models."""

import hashlib
import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators.common import md5_number, md5_numbers
from tessera.operators.ml import VECTOR_BLOCK, max_pool_vectors, pool_by_ids


def test_pooling_by_ids_matches_python(spark):
    rng = random.Random(3)
    known = sorted(rng.sample(range(3 * VECTOR_BLOCK), 60)) + [0]
    vectors = [(i, [rng.choice([None, -1.5, 0.25, float(i % 7)]) for _ in range(3)]) for i in known + known[:5]] + [(known[7], None)]
    rows = [(k, [rng.choice(known + [1, VECTOR_BLOCK + 1, None]) for _ in range(rng.randrange(8))]) for k in range(200)] + [(200, None)]
    want = {}
    for k, ids in rows:
        hits = [v or [None] * 3 for i in set(ids or []) for j, v in vectors if i == j]
        if hits:
            want[k] = [max((x for x in c if x is not None), default=None) for c in zip(*hits)]
    ids = spark.createDataFrame(rows, "k bigint, ids array<bigint>")
    vec = spark.createDataFrame(vectors, "vec_id bigint, vector array<float>")
    part = pool_by_ids(ids, vec, "k", dim=3)
    assert part.schema["vector"].dataType == vec.schema["vector"].dataType
    assert part.count() > len(want)  # a row for each block
    got = {r.k: r.pooled for r in max_pool_vectors(part, "k", dim=3).collect()}
    assert got == want


def test_hashes_of_words_are_the_sql_ones(spark):
    df = spark.createDataFrame([(1, ["a", "é", "a", "中"]), (2, []), (3, None)], "k int, w array<string>")
    got = {r.k: r.n for r in df.select("k", md5_numbers(F.col("w"), 1000).alias("n")).collect()}
    assert got[1] == sorted({int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 1000 for w in "aé中"}) and not got[2] and not got[3]
    plain = df.select("k", F.explode("w").alias("w")).select((md5_number("w") % 1000).alias("n")).distinct().collect()
    assert sorted(r.n for r in plain) == got[1]


def test_vectors_do_not_travel_to_each_token(spark):
    p = E.queries()["max_pool_vectors"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p
