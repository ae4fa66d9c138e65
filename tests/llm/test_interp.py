import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.base import held_out
from tessera.llm.interp import BUCKETS, maximise, pack, pack_sorted, score_texts, unpack, unpack_sorted


def toks(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + [None]


def rem(i):
    return 5000 if i is None else zlib.crc32(str(i).encode()) % 10


def brute(rows, em=5):
    """The model in plain dictionaries."""
    train = [(i, toks(t)) for i, t in rows if rem(i) != 0]

    def count(some):
        c1, c2 = Counter(), Counter()
        for w in some:
            c1.update(w)
            c2.update(zip(["<s>", *w], w))
        return c1, c2, sum(c1.values()), len(c1), len(some)

    rest = count([w for i, w in train if rem(i) != em])

    def parts(model, h, w):
        c1, c2, n, v, starts = model
        ch = starts if h == "<s>" else c1[h]
        b = min(int(math.log2(ch)) + 1, BUCKETS - 1) if ch else 0
        return b, c2[h, w] / max(ch, 1), c1[w] / max(n, 1), 1 / (v + 1), ch

    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    weights[0] = [0, 0.9, 0.1]
    seen = [parts(rest, h, w) for i, x in train if rem(i) == em for h, w in zip(["<s>", *x], x)]
    for _ in range(60 if seen else 0):
        total = np.zeros((BUCKETS, 3))
        for b, p2, p1, p0, _ in seen:
            q = weights[b] * [p2, p1, p0]
            total[b] += q / q.sum()
        ok = total.sum(1) > 0
        weights[ok] = total[ok] / total[ok].sum(1, keepdims=True)
    weights[:, 2] = np.maximum(weights[:, 2], 1e-6)
    weights /= weights.sum(1, keepdims=True)
    full = count([w for _, w in train])
    out = {}
    for i, t in rows:
        x = toks(t)
        score = 0.0
        for h, w in zip(["<s>", *x], x):
            b, p2, p1, p0, ch = parts(full, h, w)
            a = weights[b]
            p = a @ [p2, p1, p0] / (1 if ch else a[1] + a[2])
            score += math.log10(p) if full[2] else 0.0
        c1, _, n, v, _ = full
        base = sum(math.log10((c1[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x)
        out[i] = (len(x), sum(c1[w] > 0 for w in x), n, base, score)
    return out


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    vocab = [f"W{i}" if i % 3 else f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        w = [rng.choice(vocab)]
        for _ in range(rng.randrange(0, 40)):
            w.append(vocab[(vocab.index(w[-1]) * 7 + rng.randrange(4)) % 60])
        rows.append((i, " ".join(w)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t"), (n + 3, "unseen words Only")]


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 700])
def test_matches_plain_model(spark, chunk_bytes):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in score_texts(df, ~held_out("doc_id", 10, 0), chunk_bytes=chunk_bytes).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for i, (n, known, total, base, score) in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert abs(r.base_score - base) < 1e-8 * max(1, abs(base))
        # ratios meet the maximisation in steps of an eighth of an octave, so weights differ slightly
        assert abs(r.score - score) < 0.02 * abs(score) + 0.1


def test_model_beats_base_on_held_out_text(spark):
    rows = corpus(400, seed=6)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    r = score_texts(df, ~held_out("doc_id", 10, 0)).where(held_out("doc_id", 10, 0)).agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b * 0.7


def test_pack_round_trip():
    x = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64))
    assert np.array_equal(unpack(pack(x)), x) and len(unpack(pack(x[:0]))) == 0
    assert np.array_equal(unpack_sorted(pack_sorted(x)), x) and len(unpack_sorted(pack_sorted(x[:0]))) == 0


def test_maximise_raises_likelihood():
    rng = np.random.default_rng(2)
    rows = [(3, int(s2), int(s1), int(n)) for s2, s1, n in zip(rng.integers(1010, 1090, 50), rng.integers(1010, 1070, 50),
                                                             rng.integers(1, 9, 50))]

    def like(w):
        return sum(n * math.log(w[b] @ [2 ** ((s2 - 1024) / 8), 2 ** ((s1 - 1024) / 8), 1]) for b, s2, s1, n in rows)

    assert like(maximise(rows)) >= like(maximise(rows, 3)) >= like(maximise([]))


def test_odd_rows(odd_docs, no_docs):
    out = score_texts(odd_docs, ~held_out("doc_id", 10, 0)).collect()
    assert len(out) == odd_docs.count() and all(r.n_tokens == 1 for r in out if r.doc_id in (20, 21, 22))
    assert len({r.score for r in out if r.doc_id == 1}) == 1
    assert score_texts(no_docs, ~held_out("doc_id", 10, 0)).count() == 0
    none = score_texts(odd_docs, F.lit(False)).collect()
    assert all(r.score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in none)
