import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import negatives
from tessera.llm.negatives import hard_negatives


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    ok = {}
    for i, v, label in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        e = [math.floor(256 * x) for x in v]
        if i not in ok or (label, v) < (ok[i][0], ok[i][2]):
            ok[i] = (label, e, v)

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    def cap(x):
        return max(-2**63, min(2**63 - 1, x))

    out = set()
    for a, (label, e, _) in ok.items():
        if not is_anchor(a):
            continue
        s = {i: dot(e, f) for i, (_, f, _) in ok.items() if len(f) == len(e) and i != a}
        pos = sorted((i for i in s if ok[i][0] == label), key=lambda i: (-s[i], i))[:positives]
        for p in pos:
            neg = sorted((i for i in s if ok[i][0] != label and low * s[p] <= 100 * s[i] <= high * s[p]), key=lambda i: (-s[i], i))
            out |= {(a, p, r, i, cap(s[p]), cap(s[i])) for r, i in enumerate(neg[:negatives], 1)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def mined(spark, rows, anchor="vec_id % 10 = 0", parts=4, **kw):
    out = hard_negatives(vectors(spark, rows).repartition(parts), F.expr(anchor), **kw).collect()
    assert len({(r.anchor_id, r.positive_id, r.rank) for r in out}) == len(out)
    return {tuple(r) for r in out}


def some_rows(n=300, dim=12, seed=0, scale=1.0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.2, 1) * scale for _ in range(dim)], rng.randrange(4)) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    rows = some_rows()
    want = brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows) == want and len(want) > 500
    monkeypatch.setattr(negatives, "CHUNK", 7)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "CELL_PAIRS", 200)
    assert mined(spark, rows, parts=2) == want


def test_large_components_and_long_vectors(spark):
    for dim, scale in [(200, 30.0), (5, 1e7), (4, 1e15), (3, 1e20)]:
        rows = some_rows(90, dim, dim, scale)
        want = brute(rows, lambda i: i % 10 == 0)
        assert mined(spark, rows) == want and want


def test_residue_products_are_exact():
    rng = np.random.default_rng(1)
    for dim, size in [(1, 3), (64, 300), (65, 300), (300, 1 << 20), (10, 1 << 40)]:
        a, b = (np.floor(rng.uniform(-size, size, (9, dim))) for _ in range(2))
        a[0], b[0] = -size, size
        primes = negatives.primes_for(dim * size * size)
        got = negatives.products(negatives.residues(a, primes), negatives.residues(b, primes), primes)
        want = [[sum(int(x) * int(y) for x, y in zip(r, q)) for q in b] for r in a]
        assert [[int(x) for x in r] for r in got] == want


def test_odd_rows(spark):
    rows = some_rows(60, 3) + [(100, None, 1), (110, [], 1), (120, [1.0, None, 2.0], 1), (130, [1.0, float("nan"), 1.0], 1),
                               (140, [float("inf"), 1.0, 1.0], 1), (150, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1),
                               (160, [1.0, 1.0], 1), (161, [1.0, 1.0], 1), (162, [0.7, 0.7], 2), (170, [0.0, 0.0, 0.0], 2)]
    rows += [(i, [1.0, 0.5, 0.25], i % 2) for i in range(200, 230)]  # ties
    rows += rows[:20] + [(5, [9.0, 9.0, 9.0], 3), (10, [0.1, 0.1, 0.1], 0)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows) == want
    assert any(a == 160 for a, *_ in want)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1), (3, [1.0], 1)], [(10, [1.0], 1)], [(10, None, 1)]])
def test_nothing_to_find(spark, rows):
    assert mined(spark, rows) == set()


def test_clashing_columns(spark):
    rows = some_rows(80, 4)
    wide = vectors(spark, rows).selectExpr("*", "1 as id", "'x' as v", "2 as asked", "3 as key", "4 as cell")
    out = {tuple(r) for r in hard_negatives(wide, F.col("vec_id") % 10 == 0).collect()}
    assert out == brute(rows, lambda i: i % 10 == 0)
