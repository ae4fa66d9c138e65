"""Learnt dictionary and cheapest paths against plain models."""

import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tessera.operators import segment as SG


def cheapest(run, cost, unknown, longest):
    """Every way of cutting, by recursion on the last word: (cost, words), ties to the longer last word."""
    best = [(0, [])]
    for j in range(1, len(run) + 1):
        options = []
        for n in range(min(longest, j), 0, -1):
            w = run[j - n:j]
            c = cost.get(w, unknown if n == 1 else None)
            if c is not None:
                options.append((best[j - n][0] + c, -n, best[j - n][1] + [w]))
        c, _, words = min(options, key=lambda x: x[:2])
        best.append((c, words))
    return best[-1]


def test_paths_are_cheapest():
    rng = random.Random(1)
    for trial in range(30):
        letters = "abcß中😀"[:rng.randrange(2, 7)]
        words = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(0, 40))}
        cost = {w: rng.randrange(1, 9) for w in words}
        runs = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 30))) for _ in range(25)] + ["x", letters * 60]
        lattice = SG.Lattice(list(cost), list(cost.values()), 12, 4)
        for run, got in zip(runs, lattice.cut(runs)):
            assert "".join(got) == run
            assert got == cheapest(run, cost, 12, 4)[1]
    assert SG.Lattice([], [], 5, 4).cut([]) == []


def brute_dictionary(texts, longest=4, least=20, cohesion=1.0, freedom=0.5, size=20_000):
    f, nxt, prv = Counter(), defaultdict(Counter), defaultdict(Counter)
    for t in texts:
        for run in re.findall(r"[^\W\d_]+", t or ""):
            for i in range(len(run)):
                for n in range(1, min(longest, len(run) - i) + 1):
                    w = run[i:i + n]
                    f[w] += 1
                    nxt[w][run[i + n:i + n + 1]] += 1  # '' is the edge
                    prv[w][run[i - 1] if i else ""] += 1

    def entropy(c):
        total = sum(c.values())
        return -sum(x / total * math.log(x / total) for x in c.values())

    f = {w: c for w, c in f.items() if c >= least}
    letters = sum(c for w, c in f.items() if len(w) == 1)
    words = {}
    for w, c in f.items():
        held = min((math.log(c * letters / (f[w[:k]] * f[w[k:]])) for k in range(1, len(w))), default=None)
        free = min(entropy(nxt[w]), entropy(prv[w]))
        if held is None or held >= cohesion and free >= freedom:
            words[w] = c
    words = dict(sorted(words.items(), key=lambda x: (-x[1], x[0]))[:size])
    total = sum(words.values())
    return {w: (c, math.floor(math.log(total / c) * 1000 + 0.5)) for w, c in words.items()}


def unspaced(seed=3, n=400):
    """Texts of invented words written together; the words are known."""
    rng = random.Random(seed)
    vocab = ["miro", "tak", "zela", "pon", "vush", "ge", "lorn", "i"]
    true = [[rng.choice(vocab) for _ in range(rng.randrange(1, 25))] for _ in range(n)]
    return ["".join(w) for w in true], true


def test_dictionary_matches_plain_counts_at_any_layout(spark):
    texts, _ = unspaced()
    texts += [None, "", "12 3.4", "über naïve über", "miro tak. zela"] + texts[:30]
    want = brute_dictionary(texts)
    for parts in (1, 5):
        df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(parts)
        got = {r.word: (r.cnt, r.cost) for r in SG.learn_dictionary(df).collect()}
        assert got == want
    assert {"miro", "tak", "zela", "pon", "vush", "lorn"} <= set(want)


def test_segments_unspaced_text(spark):
    texts, true = unspaced(n=600)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    split = SG.segmenter(spark, SG.learn_dictionary(df))
    got = {r.id: r.words for r in df.select("id", split(F.col("text")).alias("words")).collect()}
    assert all("".join(got[i]) == t for i, t in enumerate(texts))

    def ends(words):
        out, at = set(), 0
        for w in words:
            at += len(w)
            out.add(at)
        return out

    hit = sum(len(ends(got[i]) & ends(w)) for i, w in enumerate(true))
    precision, recall = hit / sum(len(g) for g in got.values()), hit / sum(len(w) for w in true)
    assert precision > 0.95 and recall > 0.95


def test_pieces_keep_order_and_nulls(spark):
    df = spark.createDataFrame([(1, "ab, ab!?　x1 - ß"), (2, None), (3, ""), (4, " \t\n")], "id int, text string")
    split = SG.segmenter(spark, spark.createDataFrame([("ab", 5, 100)], "word string, cnt long, cost long"))
    got = {r.id: r.w for r in df.select("id", split(F.col("text")).alias("w")).collect()}
    assert got == {1: ["ab", ",", "ab", "!?", "x", "1", "-", "ß"], 2: None, 3: [], 4: []}


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(None,), ("",), ("rare words",)], "text string")
    words = SG.learn_dictionary(df)
    assert words.count() == 0
    split = SG.segmenter(spark, words)
    assert df.select(split(F.col("text")).alias("w")).where("w is not null").collect()[1].w == list("rare") + list("words")
