import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import phrases
from tessera.llm.phrases import collocations


def brute(rows, longest=4, least=30, cover=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i:i + m])] += 1
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * a >= cover * c[p[i:i + m]]:
                        gone.add(p[i:i + m])
        scored = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["Über", "the", "naïve"]
    weight = [1 / (i + 1) for i in range(len(vocab))]
    fixed = ["new york city hall", "of the People", "machine  learning\tmodel", "a b"]
    rows = []
    for _ in range(260):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words.append(rng.choice(fixed) if rng.random() < 0.12 else rng.choices(vocab, weight)[0])
            if rng.random() < 0.1:
                words[-1] += rng.choice([".", ",", ";", "!", "?", ":", "\n", "\r\n", " . "])
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), " ".join(words)))
    rows += [("en", None), ("en", ""), ("fr", " \t.,"), (None, "x"), ("en", "the " * 5000), ("en", "q" * 30000)]
    return rows + rows[:5] * 3


def run(spark, rows, parts=3, **kw):
    out = collocations(spark.createDataFrame(rows, "lang string, text string").repartition(parts), **kw).collect()
    assert len({(r.lang, r.rank) for r in out}) == len(out)
    return {tuple(r) for r in out}


def test_matches_brute_force(spark):
    rows = corpus()
    want = brute(rows)
    assert run(spark, rows) == want and len(want) > 20
    assert any(p[2].count(" ") == 3 for p in want)


def test_bursts_and_spills_change_nothing(spark, monkeypatch):
    rows = corpus(4)
    want = brute(rows, least=5, top=40)
    monkeypatch.setattr(phrases, "BURST", 32)
    monkeypatch.setattr(phrases, "BUDGET", 200)
    monkeypatch.setattr(phrases, "SLOT_TOKENS", 500)
    monkeypatch.setattr(phrases, "WORD_ROWS", 20)
    monkeypatch.setattr(phrases, "BLOOM_BITS", 1 << 8)  # nearly everything passes the filter
    assert run(spark, rows, 1, least=5, top=40) == want
    assert run(spark, rows, 7, least=5, top=40) == want


def test_trie_bursts_and_spills_whole_subtrees():
    rng = np.random.default_rng(0)
    trie, want = phrases.HatTrie(64, 1000), Counter()
    for _ in range(40):
        a, b = rng.integers(0, 30, 300).astype(np.uint64), rng.integers(0, 30, 300).astype(np.uint64)
        want.update(zip(a.tolist(), b.tolist()))
        trie.add(phrases.add_up(phrases.phrase_id(a, b, 2), a, b, np.ones(300, np.int64)))
    assert any(isinstance(x, list) for x in trie.root)
    held = sum(trie.sizes())
    runs = list(trie.spill(held // 2))
    assert 0 < len(runs) < 16 and sum(trie.sizes()) <= held // 2
    runs += list(trie.spill(0))
    got = Counter()
    for ids, a, b, n in runs:
        assert (np.diff(ids.astype(object)) > 0).all()
        for batch in [phrases.pack((ids, a, b, n), 6)]:
            for slot, size, run in zip(*(batch.column(i).to_pylist() for i in range(3))):
                back, a2, b2, n2 = phrases.unpack(size, run, 2)
                assert set((back >> np.uint64(58)).tolist()) == {slot}
                for x, y, c in zip(a2.tolist(), b2.tolist(), n2.tolist()):
                    got[x, y] += c
    assert got == want and sum(trie.sizes()) == 0


def test_keys_of_one_id_stay_apart():
    ids = np.array([5, 5, 5, 7], np.uint64)
    a, b = np.array([1, 2, 1, 3], np.uint64), np.array([1, 1, 1, 3], np.uint64)
    got = phrases.add_up(ids, a, b, np.array([1, 10, 100, 1000]))
    assert sorted(zip(*(x.tolist() for x in got))) == [(5, 1, 1, 101), (5, 2, 1, 10), (7, 3, 3, 1000)]


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits in the score."""
    from pyspark.sql import functions as F

    a = 9 * 10**17
    got = spark.range(1).select(F.expr(f"(2000000 * cast({a}L as decimal(20,0))) div (cast({a}L as decimal(20,0)) + {a + 1}L)")
                                .alias("s")).first().s
    assert got == 2_000_000 * a // (2 * a + 1)


@pytest.mark.parametrize("rows", [[], [("en", None)], [(None, "a b c")]])
def test_nothing_to_find(spark, rows):
    assert run(spark, rows) == set()


def test_clashing_columns(spark, odd_docs):
    wide = odd_docs.selectExpr("*", "1 as id", "'x' as word", "2L as f", "'y' as phrase")
    assert collocations(wide, least=1).count() == collocations(odd_docs.select("text", "lang"), least=1).count() > 0
