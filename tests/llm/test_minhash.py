import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm.base import components, likely
from tessera.llm.minhash import estimate, near_duplicates, signatures


def sets(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, percent):
    ids = sorted({i for i, _ in rows if i is not None})
    s = [(i, sets(t)) for i, t in rows if i is not None]
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (a, x) in enumerate(s):
        for b, y in s[:n]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                up[q] = p
    return {i: find(i) for i in ids}


def variants(seed=1):
    """Groups around originals by single-word edits (chains of edits too), exact copies and a shared passage."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(2000)]
    shared = " ".join(rng.choice(vocab) for _ in range(14))
    rows = []
    for _ in range(12):
        w = [rng.choice(vocab) for _ in range(rng.choice([6, 40, 90, 200]))]
        rows.append(" ".join(w))
        for _ in range(rng.choice([0, 3, 12])):
            x = list(w)
            for _ in range(rng.choice([0, 1, 1, 2])):
                x[rng.randrange(len(x))] = rng.choice(vocab)
            rows.append(" ".join(x))
            if rng.random() < 0.3:
                w = x
    rows += [shared + " " + " ".join(rng.choice(vocab) for _ in range(9)) for _ in range(25)]
    rows += [None, "", "  ", "one two", "ONE Two", "one two three four five six"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("percent", [80, 85])
def test_classes_match_brute_force(spark, percent):
    rows = variants()
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), percent=percent).collect()
    want = brute(rows, percent)
    assert {r.doc_id: r.component_id for r in out} == want
    assert {r.doc_id: r.n_shingles for r in out} == {i: len(sets(t)) for i, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert len(set(want.values())) < len(want)


@pytest.mark.parametrize("hubs", [1, 2])
def test_many_rounds_of_few_hubs(spark, monkeypatch, hubs):
    from tessera.llm import minhash
    monkeypatch.setattr(minhash, "HUBS", hubs)
    rows = variants(7)
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=80).collect()
    assert {r.doc_id: r.component_id for r in out} == brute(rows, 80)


def test_one_id_with_several_texts(spark):
    rng = random.Random(2)
    x, y, z = ([f"{c}{rng.randrange(900)}" for _ in range(120)] for c in "xyz")

    def near(t, k):
        t = list(t)
        t[k] = "other"
        return " ".join(t)

    rows = [(1, " ".join(x)), (1, " ".join(y)), (2, near(x, 5)), (3, near(y, 100)), (4, " ".join(z)), (9, near(z, 50)),
            (9, " ".join(x)), (10, "a b c"), (10, "a b c d e f g"), (11, "a b c d e f g")]
    out = {(r.doc_id, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {(1, 1), (2, 1), (3, 1), (4, 1), (9, 1), (10, 10), (11, 10)}


def test_odd_rows(odd_docs, no_docs):
    out = near_duplicates(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = {r.doc_id: r for r in out}
    assert by[23].component_id == 0 and not by[23].kept
    assert by[20].n_shingles == by[21].n_shingles == by[22].n_shingles == 0 and by[20].kept
    assert by[26].n_shingles == 1 and by[24].n_shingles > 19_000
    assert by[None].kept and by[None].component_id is None
    assert [r.component_id for r in out if r.doc_id == 1] == [1, 1]
    assert near_duplicates(no_docs).count() == 0


def test_estimate_corrects_collisions(spark):
    words = [f"x{i}" for i in range(400)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:200] + [f"y{i}" for i in range(200)])), (2, " ".join(words[::-1]))]
    sig = signatures(spark.createDataFrame(rows, "id long, t string"), "id", "t").select("id", "sig")
    pairs = sig.alias("a").join(sig.alias("b"), F.col("a.id") < F.col("b.id")).select(
        F.col("a.id").alias("a"), F.col("b.id").alias("b"), estimate("a.sig", "b.sig", 336).alias("e")).collect()
    got = {(r.a, r.b): r.e for r in pairs}
    assert abs(got[0, 1] - 196 / (396 * 2 - 196)) < 0.1
    assert abs(got[0, 2]) < 0.08 and abs(got[1, 2]) < 0.08


def test_components_of_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 7), (3, 3)]
    got = {r.u: r.v for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 5 for i in range(200, 260)}, 7: 5}


def test_likely_keeps_all_wanted(spark):
    df = spark.range(5000)
    some = spark.range(0, 5000, 500)
    assert likely(df, "id", some).join(some, "id").count() == 10
    assert likely(df, "id", some).count() < 100
