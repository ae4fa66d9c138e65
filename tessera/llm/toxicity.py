"""Toxicity scores by a factorization machine over hashed terms.

Terms of a text are its words and the 4-, 5- and 6-byte beginnings of its
longer words, each a 64-bit hash (no folding into buckets, so no collisions
between common and rare terms).  The machine scores a text as

    sigmoid(b + sum_i w_i + sum_{i<j} <v_i, v_j>)

over the distinct terms it holds, so that a pair of terms (an insult beside a
group mention) has a weight of its own through the factors v.

Fitting uses a bounded, documented sample of labelled rows (``sample_rows``,
default 6000, those whose id hashes lowest).  Rows that share the smallest
shingle hash (near copies) count once.  Two kinds of terms take part: those that
the sample ties to a toxic label (G statistic of ``min_gain`` or more), and those
of a pair that is tied to it beyond what either term says, whatever the terms'
own counts.  All pairs of terms that ``PAIR_ROWS`` toxic rows hold are counted on
the executors, by matrix products of blocks of terms.  Other wording gets no
weight, so that it cannot hide an insult.  A term or pair too rare in the sample
to pass its test is not learnt, however large the corpus.  Scoring reads whole
texts of all rows in one narrow map: no shuffle.

Defined cases: a null or empty text holds no term and scores sigmoid(b); a
repeated row scores like its copy; an empty table gives an empty result; with
no labelled row, or labels of one kind, the machine is the smoothed base rate.
Extra columns pass through; one named like a result column is replaced.  A very
long text is scored whole: a block of text holds one at least, so it may take a
block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import apart, bounded_sample, forget, held_out, letters, map_text, stored, table
from tessera.llm.textvec import Words, distinct_pairs, mix, seg_sum, shingles

SAMPLE_ROWS = 6000
SCORE_BYTES = 1_000_000  # of text scored at once: a dozen arrays as long as that are held
PREFIXES = (4, 5, 6)
PAIR_ROWS = 5       # toxic rows of the sample that hold both terms of a pair
PAIR_BLOCK = 2048   # terms in a block of the pair counts


def terms(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
    """(doc, term hash) of every word and word beginning of a block of normalised texts."""
    w = Words(buf, offs)
    docs, out = [w.doc], [w.hashes()]
    size = w.end - w.start
    for n in PREFIXES:
        longer = size > n
        s = w.start[longer]
        docs.append(w.doc[longer])
        out.append(mix(w.gram(s, s + n) ^ np.uint64(0x5851F42D4C957F2D * n & (2**64 - 1))))
    return np.concatenate(docs), np.concatenate(out), w


@dataclass
class FactorMachine:
    term: np.ndarray    # sorted 64-bit term hashes
    weight: np.ndarray  # (n,)
    factor: np.ndarray  # (n, k)
    bias: float

    def logits(self, doc: np.ndarray, idx: np.ndarray, n_docs: int) -> np.ndarray:
        """Logit of each document from its (doc, term index) pairs, sorted by doc."""
        first = np.searchsorted(doc, np.arange(n_docs + 1))
        z = self.bias + seg_sum(self.weight[idx], first)
        for f in range(self.factor.shape[1]):
            v = self.factor[idx, f]
            z = z + 0.5 * (seg_sum(v, first) ** 2 - seg_sum(v * v, first))
        return z

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Index of each term, -1 for a term without weight."""
        if not len(self.term):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.term, h), len(self.term) - 1)
        return np.where(self.term[at] == h, at, -1)


def _gain(n11, n1, pos, total):
    """G statistic of the 2x2 table term x label."""
    a, b, c, d = n11, n1 - n11, pos - n11, total - n1 - pos + n11
    out = np.zeros(len(n11))
    for x, row, col in ((a, n1, pos), (b, n1, total - pos), (c, total - n1, pos), (d, total - n1, total - pos)):
        expect = np.maximum(row * col / total, 1e-12)
        out += 2 * np.where(x > 0, x * np.log(np.maximum(x, 1e-12) / expect), 0.0)
    return out


def _pair_gain(c11, c, x11, x, y11, y):
    """How much a pair says about the label beyond either of its terms.

    From the toxic and all rows that hold the pair, its first and its second
    term: among the rows of each term, the G statistic of the other one; the
    lesser of both, 0 where the pair is not the more toxic.
    """
    more = (c11 * x > x11 * c) & (c11 * y > y11 * c)
    return np.where(more, np.minimum(_gain(c11, c, x11, x), _gain(c11, c, y11, y)), 0.0)


def fit_machine(doc: np.ndarray, h: np.ndarray, label: np.ndarray, factors: int = 4, min_gain: float | None = None,
                paired: np.ndarray | None = None, epochs: int = 400, rate: float = 0.3, l2: float = 2e-4, seed: int = 7) -> FactorMachine:
    """Fit on distinct (doc, term) pairs of a bounded sample; doc indexes label.

    Terms tied to the label by at least ``min_gain`` take part (default twice
    the log of the number of terms tried, so that about none passes by chance),
    and the ``paired`` ones, which keeps the fit small.  Weights start at
    smoothed log odds ratios, those of the paired terms alone at 0, and are refined by full-batch AdaGrad on the logistic loss with L2.
    """
    n = len(label)
    pos = int(label.sum())
    base = float(np.log((pos + 0.5) / (n - pos + 0.5)))
    none = FactorMachine(np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, factors)), base)
    if n == 0 or pos == 0 or pos == n:
        return none
    term, inv = np.unique(h, return_inverse=True)
    n1 = np.bincount(inv, minlength=len(term)).astype(float)
    n11 = np.bincount(inv, weights=label[doc], minlength=len(term))
    if min_gain is None:
        min_gain = 2 * np.log(max(2, int((n1 >= 2).sum())))
    good = (_gain(n11, n1, pos, n) >= min_gain) & (n1 >= 2) & (n11 * n > n1 * pos)
    tied = good
    if paired is not None:
        good = good | np.isin(term, paired)
    if not good.any():
        return none
    new = np.cumsum(good) - 1
    keep = good[inv]
    order = np.argsort(doc[keep], kind="stable")
    d, i = doc[keep][order], new[inv[keep]][order]
    m = int(good.sum())
    rng = np.random.default_rng(seed)
    odds = np.where(tied, np.log((n11 + 0.5) / (n1 - n11 + 0.5)) - base, 0.0)[good]
    fm = FactorMachine(term[good], odds, rng.normal(0, 0.02, (m, factors)), base)
    gw, gv, gb = np.full(m, 1e-6), np.full((m, factors), 1e-6), 1e-6
    first = np.searchsorted(d, np.arange(n + 1))
    y = label.astype(float)
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-np.clip(fm.logits(d, i, n), -30, 30)))
        err = (p - y)
        g = np.bincount(i, weights=err[d], minlength=m) / np.sqrt(n) + l2 * fm.weight
        gw += g * g
        fm.weight -= rate * g / np.sqrt(gw)
        for f in range(factors):
            v = fm.factor[:, f]
            rest = seg_sum(v[i], first)[d] - v[i]
            g = np.bincount(i, weights=err[d] * rest, minlength=m) / np.sqrt(n) + 10 * l2 * v
            gv[:, f] += g * g
            fm.factor[:, f] -= 0.2 * rate * g / np.sqrt(gv[:, f])
        g = err.sum() / np.sqrt(n)
        gb += g * g
        fm.bias -= rate * g / np.sqrt(gb)
    return fm


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, **fit) -> FactorMachine:
    """Machine fitted on at most ``sample_rows`` of the given labelled rows.

    The sample's terms and pairs of terms are computed, counted and tested
    against the label on the executors; the driver receives the terms that pass, alone or in a pair, and at
    most ``sample_rows`` ids are broadcast to pick the sample's texts.  A row without id, or with a label
    other than 0 or 1, is not learnt from; an id labelled twice takes its
    higher label.
    """
    lab = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
           .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    some = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
            .join(F.broadcast(bounded_sample(lab, sample_rows, "id")), "id"))

    def pairs(buf, offs):
        doc, h, w = terms(buf, offs)
        doc, h = distinct_pairs(doc, h, len(offs) - 1)
        first = np.searchsorted(doc, np.arange(len(offs)))
        sd, sh = shingles(w, w.hashes(), 3)
        low = np.zeros(len(offs) - 1, np.uint64)
        if len(sd):
            at = np.flatnonzero(np.concatenate([[True], sd[1:] != sd[:-1]]))
            low[sd[at]] = np.minimum.reduceat(sh, at)
        return (pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64))), low.view(np.int64))

    rows = stored(map_text(some, pairs, "h array<long>, sketch long", ["id", "y"], letters("t")))
    # near copies share their smallest shingle hash and count once; texts without words have none
    alike = F.when(F.col("sketch") == 0, F.xxhash64("id")).otherwise(F.col("sketch"))
    firsts = rows.groupBy(alike.alias("_s"), "y").agg(F.min("id").alias("id")).select("id")
    rows = rows.join(F.broadcast(firsts), "id", "left_semi").dropDuplicates(["id"])  # at most sample_rows ids
    sample = sorted(rows.select("id", "y", F.xxhash64("id").alias("k")).collect(), key=lambda r: r["id"])
    label = {r["id"]: r["y"] for r in sample}
    n, pos = len(label), sum(label.values())
    held = rows.select("id", "y", F.explode("h").alias("h"))
    seen = stored(held.groupBy("h").agg(F.count(F.lit(1)).alias("n1"), F.sum("y").alias("n11")).where("n1 >= 2"))
    least = fit.pop("min_gain", None)
    if least is None:
        least = 2 * float(np.log(max(2, seen.count())))
    tied = seen.where((_gain_column(n, pos) >= least) & (F.col("n11") * n > F.col("n1") * pos)).select("h")
    tied = tied.withColumn("tied", F.lit(True))
    key, y = np.array([r["k"] for r in sample], np.int64), np.array([r["y"] for r in sample], float)
    paired = paired_terms(held.select(F.xxhash64("id").alias("k"), "h"), seen, key, y)
    picked = tied.unionByName(paired.select("h", F.lit(False).alias("tied"))).groupBy("h").agg(F.max("tied").alias("tied"))
    found = held.join(picked, "h").select(F.xxhash64("id").alias("k"), "h", "tied").toArrow()
    order = np.argsort(key)
    doc = order[np.searchsorted(key, np.asarray(found["k"]), sorter=order)] if n else np.zeros(0, int)
    h = np.asarray(found["h"]).astype(np.int64).view(np.uint64)
    lone = h[~found["tied"].to_numpy().astype(bool)]
    forget(seen, paired)
    return fit_machine(doc, h, y, min_gain=0.0, paired=np.unique(lone), **fit)


def paired_terms(held: DataFrame, seen: DataFrame, key: np.ndarray, y: np.ndarray) -> DataFrame:
    """h of the terms in a pair that is tied to the label beyond either of its terms.

    ``held`` has the (k, h) pairs of the sample's rows, ``key`` and ``y`` those
    rows' k and label.  Terms are dealt by hash to blocks of about
    ``PAIR_BLOCK``; a task counts all pairs of two blocks.  A pair passes at a
    gain of twice the log of the number of pairs.
    """
    some = seen.where(F.col("n11") >= PAIR_ROWS).select("h")
    size = some.count()
    blocks = max(1, -(-size // PAIR_BLOCK))
    least = 2 * float(np.log(max(2, size * (size - 1) // 2)))
    order = np.argsort(key)
    key, toxic = key[order], y[order] > 0
    packed = (held.join(some, "h").withColumn("b", F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int"))
              .groupBy("b").agg(F.collect_list(F.struct("k", "h")).alias("x")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = np.uint16 if len(key) <= 65536 else np.uint32
        for batch in batches:
            for b, k, h in zip(batch.column(0), batch.column(1), batch.column(2)):
                k, h = np.asarray(k.values), np.asarray(h.values)
                row = np.searchsorted(key, k)
                by = np.lexsort((row, h))
                term, size = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_pydict({"b": pa.array([b.as_py()], pa.int32()), "t": [term.tobytes()],
                                                  "n": [size.astype(np.uint32).tobytes()], "r": [row[by].astype(small).tobytes()]})

    packed = packed.select("b", F.col("x.k").alias("k"), F.col("x.h").alias("h")).mapInArrow(
        pack, "b int, t binary, n binary, r binary")
    packed = stored(packed)
    left = packed.select(F.col("b").alias("i"), F.explode(F.sequence("b", F.lit(blocks - 1))).alias("j"),
                         *[F.col(c).alias(f"{c}1") for c in "tnr"])
    right = packed.select(F.explode(F.sequence(F.lit(0), "b")).alias("i"), F.col("b").alias("j"),
                          *[F.col(c).alias(f"{c}2") for c in "tnr"])

    def table_of(t, n, r):
        small = np.uint16 if len(key) <= 65536 else np.uint32
        term = np.frombuffer(t, np.int64)
        held = np.zeros((len(key), len(term)), np.float32)
        held[np.frombuffer(r, small), np.repeat(np.arange(len(term)), np.frombuffer(n, np.uint32))] = 1
        return term, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = [batch.column(c)[at].as_py() for c in range(6)]
                (t1, a), (t2, b) = table_of(*one[:3]), table_of(*one[3:])
                c11 = a[toxic].T @ b[toxic]
                p, q = np.nonzero(c11 >= PAIR_ROWS)
                rest = a[~toxic].T @ b[~toxic]
                c11, c0 = c11[p, q].astype(float), rest[p, q].astype(float)
                a11, a1, b11, b1 = (x.sum(0, dtype=float) for x in (a[toxic], a, b[toxic], b))
                ok = _pair_gain(c11, c11 + c0, a11[p], a1[p], b11[q], b1[q]) >= least
                yield pa.RecordBatch.from_arrays([pa.array(np.union1d(t1[p[ok]], t2[q[ok]]))], names=["h"])

    both = left.join(right, ["i", "j"]).select("t1", "n1", "r1", "t2", "n2", "r2")
    found = stored(both.mapInArrow(run, "h long").distinct())
    forget(packed)
    return found


def _gain_column(n: int, pos: int):
    """G statistic of a term's table from its columns n1 (rows that hold it) and n11 (toxic ones)."""
    n1, n11 = F.col("n1"), F.col("n11")
    out = F.lit(0.0)
    for x, row, col in ((n11, n1, pos), (n1 - n11, n1, n - pos), (pos - n11, n - n1, pos), (n - n1 - pos + n11, n - n1, n - pos)):
        out = out + F.when((x > 0) & (row > 0) & F.lit(col > 0), 2 * x * F.log(x * n / (row * F.lit(max(col, 1))))).otherwise(0.0)
    return out


def score_toxicity(docs: DataFrame, machine: FactorMachine, text_col: str = "text", keep: list[str] | None = None,
                   out: str = "toxicity") -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, default all) with their toxicity in 0..1, by a narrow map."""
    shared = apart(docs.sparkSession, machine)

    def score(buf, offs):
        fm = shared.value
        doc, h, _ = terms(buf, offs)
        hit = fm.lookup(h) >= 0
        doc, h = distinct_pairs(doc[hit], h[hit], len(offs) - 1)
        z = fm.logits(doc, fm.lookup(h), len(offs) - 1)
        return [1 / (1 + np.exp(-np.clip(z, -500, 500)))]

    return map_text(docs, score, f"`{out}` double", docs.columns if keep is None else keep, letters(text_col),
                    block=SCORE_BYTES)


def op1_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; learns from ids whose crc32 mod 3 is not 1."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = fit_toxicity(docs, labels.where(~held_out("doc_id", 3, 1)))
    scored = score_toxicity(docs.select("doc_id", "text"), machine, keep=["doc_id"], out="score")
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {"op1_toxicity_fm": op1_toxicity_fm}
ORACLE_SQL: dict[str, str] = {}
