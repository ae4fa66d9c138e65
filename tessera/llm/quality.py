"""Quality scores by a generalised additive model with pairwise interactions.

Sixteen plain figures of a text (length, word length, shares of capitals,
digits, punctuation, separators, symbols, distinct words, repeated neighbours
and so on) are cut into quantile bins.  Shallow trees (two cuts) are boosted on
one feature after another, round by round, so that features share the credit;
each feature's trees add up to one lookup table.  Pairs that explain most of
what is left get tables of their own, boosted alike with one cut on either
side.  A score is the sigmoid of a bias and table entries: vectorised bin
lookups and additions, for whole texts in one narrow map.

Fitting uses a bounded, documented sample of labelled rows (``sample_rows``,
default 20000, those whose id hashes lowest); the driver receives sixteen
figures for each.

Defined cases: a null or empty text has all figures 0 and is scored like any
other; a repeated row scores like its copy; an empty table gives an empty
result; with no labelled row, or labels of one kind, the score is the smoothed
base rate; other columns pass through, one named like the result is replaced; a
very long text is measured whole, in a block of its own where it needs one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import apart, bounded_sample, held_out, map_text, table
from tessera.llm.textvec import Words, by_doc, distinct_pairs, lower_ascii, shingles

SAMPLE_ROWS = 20000
FIGURES = ("log words", "mean word bytes", "capitals of letters", "digits of bytes", "punctuation of bytes",
           "bars a word", "symbols a word", "exclamations a word", "lines a word", "distinct words",
           "equal neighbours", "commonest word", "distinct word triples", "non-ascii bytes", "log longest word",
           "one-byte words")


def _share(of: bytes) -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[list(of)] = 1
    return t


def figures(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(texts, figures) matrix of a block."""
    n = len(offs) - 1
    low = lower_ascii(buf)
    w = Words(low, offs)
    h = w.hashes()
    words = w.counts().astype(float)
    size = np.diff(offs).astype(float)

    def count(mask):
        c = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (c[offs[1:]] - c[offs[:-1]]).astype(float)

    def over(x, y):
        return x / np.maximum(y, 1)

    upper = count(buf != low)
    high = count(buf >= 128)
    alpha = count((low >= 97) & (low <= 122))
    symbol = _share(b"#$%&*@^~=+<>{}[]\\_`")
    punct = _share(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    same = np.bincount(w.doc[1:][(w.doc[1:] == w.doc[:-1]) & (h[1:] == h[:-1])], minlength=n) if len(h) else np.zeros(n)
    top, distinct = np.zeros(n), np.zeros(n)
    if len(h):
        order = by_doc(w.doc, h, n)
        d, k = w.doc[order], h[order]
        at = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]))
        np.maximum.at(top, d[at], np.diff(np.append(at, len(d))))
        distinct = np.bincount(d[at], minlength=n)
    sd, sh = shingles(w, h, 3)
    all3 = np.bincount(sd, minlength=n)
    some3 = np.bincount(distinct_pairs(sd, sh, n)[0], minlength=n)
    length = w.end - w.start
    longest = np.zeros(n)
    np.maximum.at(longest, w.doc, length)
    single = np.bincount(w.doc[length == 1], minlength=n)
    return np.column_stack([
        np.log1p(words), over(np.bincount(w.doc, weights=length, minlength=n), words), over(upper, alpha + high),
        over(count((buf >= 48) & (buf <= 57)), size), over(count(punct[buf]), size), over(count(buf == 124), words),
        over(count(symbol[buf]), words), over(count(buf == 33), words), over(count(buf == 10), words),
        over(distinct, words), over(same, words), over(top, words), over(some3, all3), over(high, size),
        np.log1p(longest), over(single, words)]) if n else np.zeros((0, len(FIGURES)))


@dataclass
class AdditiveModel:
    bias: float
    edges: list[np.ndarray]                  # inner bin edges of each feature
    tables: list[np.ndarray]                 # one value a bin
    coarse: list[np.ndarray]                 # bin edges for pairs
    pairs: list[tuple[int, int, np.ndarray]]  # (feature, feature, 2-d table)

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for f, (edges, values) in enumerate(zip(self.edges, self.tables)):
            z += values[np.searchsorted(edges, x[:, f], "right")]
        for f, g, values in self.pairs:
            z += values[np.searchsorted(self.coarse[f], x[:, f], "right"), np.searchsorted(self.coarse[g], x[:, g], "right")]
        return z


def _edges(col: np.ndarray, bins: int) -> np.ndarray:
    q = np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1]))
    values = np.unique(col)
    if len(values) <= 1:
        return np.zeros(0)
    # halfway between neighbouring values, so that a tie is never cut
    at = np.clip(np.searchsorted(values, q), 1, len(values) - 1)
    return np.unique((values[at - 1] + values[at]) / 2)


def _leaf(g, h, l2):
    return -g / (h + l2)


def _tree(g: np.ndarray, h: np.ndarray, l2: float, cuts: int = 2) -> np.ndarray:
    """Values of a tree of at most ``cuts`` cuts over ordered bins, from gradient and hessian sums."""
    parts = [(0, len(g))]
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])

    def gain(a, b):
        return (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + l2)

    for _ in range(cuts):
        best = (1e-9, None)
        for i, (a, b) in enumerate(parts):
            c = np.arange(a + 1, b)
            if len(c):
                win = gain(a, c) + gain(c, b) - gain(a, b)
                j = int(np.argmax(win))
                if win[j] > best[0]:
                    best = (win[j], (i, int(c[j])))
        if best[1] is None:
            break
        i, c = best[1]
        a, b = parts[i]
        parts[i:i + 1] = [(a, c), (c, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(cg[b] - cg[a], ch[b] - ch[a], l2)
    return out


def _cross(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """(gain, values) of the best four-cell split of a table, one cut on each side."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    right, down = (cg[:-1, -1:], ch[:-1, -1:]), (cg[-1:, :-1], ch[-1:, :-1])
    cells = [(a, b), (right[0] - a, right[1] - b), (down[0] - a, down[1] - b),
             (cg[-1, -1] - right[0] - down[0] + a, ch[-1, -1] - right[1] - down[1] + b)]
    win = sum(x * x / (y + l2) for x, y in cells) - cg[-1, -1] ** 2 / (ch[-1, -1] + l2)
    i, j = np.unravel_index(int(np.argmax(win)), win.shape)
    out = np.empty_like(g)
    v = [_leaf(x[i, j], y[i, j], l2) for x, y in cells]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = v
    return float(win[i, j]), out


def fit_additive(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse: int = 12, rounds: int = 150, n_pairs: int = 8,
                 pair_rounds: int = 80, rate: float = 0.15, l2: float = 3.0) -> AdditiveModel:
    """Cyclic boosting of shallow trees, then of tables of the pairs that explain most of the rest."""
    n, pos = len(y), float(y.sum())
    n_features = x.shape[1] if x.ndim == 2 else 0
    bias = float(np.log((pos + 0.5) / (n - pos + 0.5)))
    edges = [_edges(x[:, f], bins) if n else np.zeros(0) for f in range(n_features)]
    wide = [_edges(x[:, f], coarse) if n else np.zeros(0) for f in range(n_features)]
    model = AdditiveModel(bias, edges, [np.zeros(len(e) + 1) for e in edges], wide, [])
    if n == 0 or pos in (0, n):
        return model
    at = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    z = np.full(n, bias)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for f in range(n_features):
            if not len(edges[f]):
                continue
            g, h = slopes()
            size = len(edges[f]) + 1
            step = rate * _tree(np.bincount(at[f], g, size), np.bincount(at[f], h, size), l2)
            model.tables[f] += step
            z += step[at[f]]
    rough = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(wide)]

    def cell(f, g):
        return rough[f] * (len(wide[g]) + 1) + rough[g], (len(wide[f]) + 1, len(wide[g]) + 1)

    grad, hess = slopes()
    gains = []
    for f in range(n_features):
        for g in range(f + 1, n_features):
            c, shape = cell(f, g)
            m = shape[0] * shape[1]
            gains.append((_cross(np.bincount(c, grad, m).reshape(shape), np.bincount(c, hess, m).reshape(shape), l2)[0], f, g))
    chosen = [(f, g) for win, f, g in sorted(gains, reverse=True)[:n_pairs] if win > 1e-6]
    values = {p: np.zeros(cell(*p)[1]) for p in chosen}
    for _ in range(pair_rounds):
        for p in chosen:
            c, shape = cell(*p)
            m = shape[0] * shape[1]
            grad, hess = slopes()
            step = rate * _cross(np.bincount(c, grad, m).reshape(shape), np.bincount(c, hess, m).reshape(shape), l2)[1]
            values[p] += step
            z += step.ravel()[c]
    model.pairs = [(f, g, v) for (f, g), v in values.items()]
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, **fit) -> AdditiveModel:
    """Model fitted on at most ``sample_rows`` of the given labelled rows; of several labels the highest counts."""
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
           .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    some = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .join(F.broadcast(bounded_sample(lab, sample_rows, "id")), "id"))

    def measure(buf, offs):
        x = figures(buf, offs)
        return [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FIGURES)).cast(pa.list_(pa.float64()))]

    rows = sorted(map_text(some, measure, "x array<double>", ["id", "y"], "t").collect(), key=lambda r: (r["id"], r["x"]))
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FIGURES))
    return fit_additive(x, np.array([r["y"] for r in rows], float), **fit)


def score_quality(docs: DataFrame, model: AdditiveModel, text_col: str = "text", keep: list[str] | None = None,
                  out: str = "quality_score") -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, default all) with their quality in 0..1, by a narrow map."""
    shared = apart(docs.sparkSession, model)

    def score(buf, offs):
        return [1 / (1 + np.exp(-np.clip(shared.value.logits(figures(buf, offs)), -500, 500)))]

    return map_text(docs, score, f"`{out}` double", docs.columns if keep is None else keep, text_col)


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; learns from ids whose crc32 mod 4 is not 2."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels.where(~held_out("doc_id", 4, 2)))
    scored = score_quality(docs.select("doc_id", "text"), model, keep=["doc_id"], out="score")
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {"op7_quality_gam": op7_quality_gam}
ORACLE_SQL: dict[str, str] = {}
