"""Plain models of what the vectorised code computes: machine logits, text figures, boosting steps, repeated spans."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import quality, spans, toxicity


def block(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)


def odd_texts(seed=0):
    rng = random.Random(seed)
    words = ["the", "The", "a", "I", "naïve", "x1", "--", "wow!!", "#$%", "|", "ÜBER", "longer-word,", "42", "same"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(30)]
    return texts + ["", " \n\t ", "one", "same same same", "a\nb\r\nc", "é" * 50, "z" * 300]


# ------------------------------------------------------------ toxicity
def test_logits_are_weights_and_all_pairs():
    rng = np.random.default_rng(3)
    n, k = 12, 4
    m = toxicity.FactorMachine(np.arange(n, dtype=np.uint64), rng.normal(size=n), rng.normal(size=(n, k)), 0.3)
    docs = [sorted(rng.choice(n, rng.integers(0, n), replace=False).tolist()) for _ in range(20)] + [[]]
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    got = m.logits(doc, np.array([i for d in docs for i in d], np.int64), len(docs))
    for z, d in zip(got, docs):
        want = 0.3 + sum(m.weight[i] for i in d) + sum(float(m.factor[i] @ m.factor[j]) for i, j in itertools.combinations(d, 2))
        assert abs(z - want) < 1e-9


# ------------------------------------------------------------- quality
def plain_figures(t):
    raw = t.encode()
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    n, size = len(w), len(raw)
    over = lambda x, y: x / max(y, 1)
    count = lambda chars: sum(c in chars for c in raw)
    high = sum(c >= 128 for c in raw)
    alpha = sum(97 <= c <= 122 for c in low)
    triples = [tuple(w[i:i + 3]) for i in range(n - 2)] or ([tuple(w)] if w else [])
    return [math.log1p(n), over(sum(map(len, w)), n), over(sum(65 <= c <= 90 for c in raw), alpha + high),
            over(count(b"0123456789"), size), over(count(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"), size), over(count(b"|"), n),
            over(count(b"#$%&*@^~=+<>{}[]\\_`"), n), over(count(b"!"), n), over(count(b"\n"), n), over(len(set(w)), n),
            over(sum(a == b for a, b in zip(w, w[1:])), n), over(max(Counter(w).values(), default=0), n),
            over(len(set(triples)), len(triples)), over(high, size), math.log1p(max(map(len, w), default=0)),
            over(sum(len(x) == 1 for x in w), n)]


def test_figures_equal_plain_counts():
    texts = odd_texts()
    got = quality.figures(*block(texts))
    assert np.allclose(got, [plain_figures(t) for t in texts], atol=1e-12) and got.shape[1] == len(quality.FIGURES)


@pytest.mark.parametrize("seed", range(6))
def test_trees_take_the_best_cuts(seed):
    """A tree of one cut and a crossed table against trying every cut."""
    rng = np.random.default_rng(seed)
    g, h = rng.normal(size=9), rng.uniform(0.1, 2, 9)
    loss = lambda gs, hs: -gs.sum() ** 2 / (hs.sum() + 3.0)
    cut = min(range(1, 9), key=lambda c: loss(g[:c], h[:c]) + loss(g[c:], h[c:]))
    want = np.concatenate([np.full(cut, -g[:cut].sum() / (h[:cut].sum() + 3.0)), np.full(9 - cut, -g[cut:].sum() / (h[cut:].sum() + 3.0))])
    assert np.allclose(quality._tree(g, h, 3.0, cuts=1), want)
    g2, h2 = rng.normal(size=(4, 5)), rng.uniform(0.1, 2, (4, 5))

    def parts(i, j):
        return [(slice(None, i), slice(None, j)), (slice(None, i), slice(j, None)), (slice(i, None), slice(None, j)), (slice(i, None), slice(j, None))]

    i, j = min(itertools.product(range(1, 4), range(1, 5)), key=lambda c: sum(loss(g2[p], h2[p]) for p in parts(*c)))
    win, values = quality._cross(g2, h2, 3.0)
    for p in parts(i, j):
        assert np.allclose(values[p], -g2[p].sum() / (h2[p].sum() + 3.0))
    assert abs(win - (sum(-loss(g2[p], h2[p]) for p in parts(i, j)) + loss(g2, h2))) < 1e-9


def test_boosting_steps_equal_a_plain_loop():
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.integers(0, 5, 200), rng.normal(size=200)]).astype(float)
    y = (x[:, 0] + x[:, 1] + rng.normal(size=200) > 2.5).astype(float)
    m = quality.fit_additive(x, y, bins=6, rounds=4, n_pairs=0, rate=0.2, l2=1.0)
    z = np.full(200, m.bias)
    tables = [np.zeros(len(e) + 1) for e in m.edges]
    for _ in range(4):
        for f in range(2):
            at = np.array([sum(v >= e for e in m.edges[f]) for v in x[:, f]])
            p = 1 / (1 + np.exp(-z))
            g = np.array([(p - y)[at == b].sum() for b in range(len(tables[f]))])
            h = np.array([(p * (1 - p))[at == b].sum() for b in range(len(tables[f]))])
            step = 0.2 * quality._tree(g, h, 1.0)
            tables[f] += step
            z += step[at]
    assert all(np.allclose(a, b) for a, b in zip(tables, m.tables)) and np.allclose(m.logits(x), z)


# --------------------------------------------------------------- spans
def plain_sentences(t):
    """(begin, end, words) by the stated rules but for the cuts inside long runs, which the texts below do not have."""
    out, begin, words, last = [], None, [], 0
    found = list(re.finditer(r"[^\x20\x09-\x0D]+", t))
    for i, w in enumerate(found):
        begin = w.start() if begin is None else begin
        words.append(w.group().lower())
        after = t[w.end():found[i + 1].start()] if i + 1 < len(found) else None
        if after is None or w.group()[-1] in ".!?" or after.count("\n") > 1:
            out.append([begin, len(t) if after is None else found[i + 1].start(), words])
            begin, words = None, []
    return out


def test_removal_equals_a_plain_model(spark):
    rng = random.Random(12)
    pool = [" ".join(f"w{rng.randrange(800)}" for _ in range(rng.randrange(1, 12))) + rng.choice([".", "!", "?", "\n\n"]) for _ in range(60)]
    rows = []
    for i in range(40):
        start = rng.randrange(50)
        parts = pool[start:start + rng.randrange(3, 9)] if i % 3 else [rng.choice(pool) for _ in range(8)]
        rows.append((rng.randrange(1000) if i % 7 else i, rng.choice([" ", "\n", "  "]).join(parts)))
    rows = list(dict(rows).items())
    first, held = {}, {}
    for i, t in sorted(rows):
        s = plain_sentences(t)
        held[i] = (s, [])
        for a in range(len(s)):
            b, n = a, 0
            while b < len(s) and (b - a < 3 or n < 20):
                n += len(s[b][2])
                b += 1
            if b - a >= 3 and n >= 20:
                key = tuple(tuple(x[2]) for x in s[a:b])
                where = first.setdefault(key, (i, a))
                if where != (i, a):
                    held[i][1].append((a, b))
    out = {r.doc_id: r for r in spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    gone = 0
    for i, t in rows:
        s, bad = held[i]
        lost = {j for a, b in bad for j in range(a, b)}
        want = t[:s[0][0]] + "".join(t[x[0]:x[1]] for j, x in enumerate(s) if j not in lost)
        assert out[i].text == want and out[i].n_removed == len(lost) and out[i].n_sentences == len(s)
        gone += len(lost)
    assert gone > 20
