"""Bigram language model by deleted interpolation.

Tokens of a text are its lower-cased words and one end mark.  A token w after
the context h (the token before; a start mark at the beginning) has probability

    a2[b] * c(h, w) / c(h) + a1[b] * c(w) / N + a0[b] / (V + 1)

where b = floor(log2 c(h)) is the context's frequency bucket (unseen contexts
have their own).  Mixture weights are learned by expectation-maximisation on
held-out counts: a tenth of the training texts (``em_of_ten``) is set apart, the
others' counts give the three estimates of its tokens, and the weights of each
bucket maximise its likelihood.  The final model counts all training texts.

Texts are dealt by a hash of id and text to chunks of about ``chunk_bytes`` (5 MB)
of text, so a chunk fits a task and their number grows with the input.

1. Each chunk emits its distinct unigrams and bigrams as sorted 64-bit hashes
   with local counts, packed by hash range: one row for each range and chunk.
2. Each range adds up its chunks' counts and answers every chunk with the totals
   of its grams, in the order in which the chunk sent them, so that no hash
   travels back.  These rows are written once to the shared folder.
3. The texts meet their chunk's totals (a cogroup by chunk) and are scored, or,
   for the texts set apart, turned into a histogram of (bucket, bigram ratio,
   unigram ratio), ratios in steps of an eighth of an octave; the driver runs the
   maximisation on that histogram, whose size the steps bound.

No gram or document goes to the driver, and no count is dropped or sampled.

Defined cases: a null or empty text is the end mark alone; rows repeated under
one id each count; a row with a null id counts as training; without training
texts N = V = 0 and every token has probability 1; an empty table gives an empty
result; a very long text is read whole, in one chunk; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import apart, held_out, release, stored, table
from tessera.llm.textvec import Words, lower_ascii, mix, text_block

CHUNK_BYTES = 5_000_000
MAX_RANGES = 200_000
BLOCK = 1_500_000
BIG_BITS = 56  # of a bigram's hash; a unigram's has 64
BUCKETS = 48
UNI, BI, SUMS = 0, 1, 2
_START, _END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
STEP, ZERO, WIDE = 8, 1024, 4096  # histogram steps an octave, the step of a ratio of 1, steps in all


def tokens(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes, bigram hashes, first token of each text) of a column of texts; one end mark a text."""
    hs, firsts, base = [], [np.zeros(1, np.int64)], 0
    buf, offs = text_block(col)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + BLOCK, "right")) - 1)
        w = Words(lower_ascii(buf[offs[i]:offs[j]]), offs[i:j + 1] - offs[i])
        count = w.counts()
        out = np.full(len(w.start) + (j - i), _END, np.uint64)
        place = np.arange(len(w.start)) + w.doc
        out[place] = w.hashes()
        hs.append(out)
        ends = np.cumsum(count + 1)
        firsts.append(base + ends)
        base += int(ends[-1])
        i = j
    tok = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
    first = np.concatenate(firsts)
    ctx = np.empty_like(tok)
    ctx[1:] = tok[:-1]
    ctx[first[:-1]] = _START
    return tok, mix(ctx * np.uint64(0xD1342543DE82EF95) + tok) >> np.uint64(64 - BIG_BITS), first


def pack(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, which the shuffle's and Parquet's compression shrink well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending numbers as their differences."""
    return pack(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


def _local(h: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and how many of each are in counted texts."""
    order = np.argsort(h)
    s = h[order]
    at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    c = np.concatenate([[0], np.cumsum(counted[order])])
    return s[at], (c[np.append(at[1:], len(s))] - c[at]).astype(np.int64) if len(s) else np.zeros(0, np.int64)


def _ranges(h: np.ndarray, n: int, bits: int) -> np.ndarray:
    """First index of each of ``n`` equal ranges in sorted hashes of ``bits`` bits."""
    edges = ((np.arange(1, n, dtype=object) << bits) // n).astype(np.uint64) if n > 1 else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])


OUT = "part int, chunk long, em boolean, kind int, h binary, c binary"
BACK = "chunk long, kind int, part int, c binary, rest binary"


def emitted(rows: DataFrame, n_ranges: int) -> DataFrame:
    """One row for each chunk, kind and hash range: distinct hashes and training counts."""
    def emit(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        tok, big, first = tokens(t.column("t"))
        counted = np.repeat(np.asarray(t.column("train")), np.diff(first))
        out = []
        chunk, em = t.column("chunk")[0].as_py(), t.column("em")[0].as_py()
        for kind, x, bits in ((UNI, tok, 64), (BI, big, BIG_BITS)):
            h, c = _local(x, counted)
            at = _ranges(h, n_ranges, bits)
            out += [(r, chunk, em, kind, pack_sorted(h[a:b]), pack(c[a:b]))
                    for r, (a, b) in enumerate(zip(at[:-1], at[1:])) if b > a]
        return pa.Table.from_arrays([pa.array(x, y) for x, y in zip(zip(*out), kinds)], names=names)

    kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]
    names = ["part", "chunk", "em", "kind", "h", "c"]
    return rows.groupBy("chunk").applyInArrow(emit, OUT)


def totals(rows: DataFrame) -> DataFrame:
    """For each chunk and range the totals of the grams it sent, and each range's sums (chunk -1).

    ``rest`` holds totals without the texts set apart, for chunks of such texts.
    A sums row has (N, V) of all training texts in ``c`` and without those set
    apart in ``rest``.
    """
    def add(t: pa.Table) -> pa.Table:
        out = []
        n = np.zeros(2, np.int64)
        v = np.zeros(2, np.int64)
        part = t.column("part")[0].as_py()
        for kind in (UNI, BI):
            rows = [r for r in t.to_pylist() if r["kind"] == kind]
            if not rows:
                continue
            hs = [unpack_sorted(r["h"]) for r in rows]
            size = [len(x) for x in hs]
            c = np.concatenate([unpack(r["c"]) for r in rows]).astype(np.int64)
            uniq, inv = np.unique(np.concatenate(hs), return_inverse=True)
            em = np.repeat([r["em"] for r in rows], size)
            every = np.bincount(inv, weights=c, minlength=len(uniq)).astype(np.int64)
            rest = every - np.bincount(inv, weights=c * em, minlength=len(uniq)).astype(np.int64)
            if kind == UNI:
                n += [every.sum(), rest.sum()]
                v += [(every > 0).sum(), (rest > 0).sum()]
            ends = np.cumsum(size)
            for r, a, b in zip(rows, ends - size, ends):
                out.append((r["chunk"], kind, part, pack(every[inv[a:b]]), pack(rest[inv[a:b]]) if r["em"] else None))
        out.append((-1, SUMS, part, pack(np.array([n[0], v[0]])), pack(np.array([n[1], v[1]]))))
        return pa.Table.from_arrays([pa.array(x, y) for x, y in zip(zip(*out), kinds)], names=names)

    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["chunk", "kind", "part", "c", "rest"]
    return rows.groupBy("part").applyInArrow(add, BACK)


def counts(x: np.ndarray, back: pa.Table, kind: int, deleted: bool) -> np.ndarray:
    """Corpus count of each gram of a chunk; ``deleted`` leaves the texts set apart out."""
    uniq, inv = np.unique(x, return_inverse=True)
    got = sorted((r["part"], r["rest" if deleted else "c"]) for r in back.to_pylist() if r["kind"] == kind)
    total = np.concatenate([unpack(b) for _, b in got]) if got else np.zeros(0, np.uint64)
    if len(total) != len(uniq):
        raise ValueError(f"{len(total)} totals for {len(uniq)} grams")
    return total.astype(np.int64)[inv]


def context_counts(c1: np.ndarray, first: np.ndarray, starts: int) -> np.ndarray:
    """Count of the context of each token: the token before, or the start mark (as many as texts)."""
    out = np.empty_like(c1)
    out[1:] = c1[:-1]
    out[first[:-1]] = starts
    return out


def buckets(ch: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + floor(log2 count)."""
    return np.where(ch > 0, np.minimum(np.floor(np.log2(np.maximum(ch, 1))).astype(np.int64) + 1, BUCKETS - 1), 0)


def histogram(back: pa.Table, docs: pa.Table, n: int, v: int, starts: int):
    """(bucket, bigram step, unigram step, tokens) rows; a step of -1 stands for an estimate of 0."""
    tok, big, first = tokens(docs.column("t"))
    c1, c2 = counts(tok, back, UNI, True), counts(big, back, BI, True)
    ch = context_counts(c1, first, starts)

    def step(p):
        with np.errstate(divide="ignore"):
            return np.where(p > 0, np.maximum(np.rint(STEP * np.log2(np.maximum(p, 1e-300) * (v + 1))) + ZERO, 0), -1).astype(np.int64)

    s2, s1 = step(c2 / np.maximum(ch, 1)), step(c1 / max(n, 1))
    key, cnt = np.unique((buckets(ch) * WIDE + s2 + 1) * WIDE + s1 + 1, return_counts=True)
    return key // WIDE // WIDE, key // WIDE % WIDE - 1, key % WIDE - 1, cnt


def maximise(rows: list[tuple[int, int, int, int]], rounds: int = 60) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of each bucket from the histogram."""
    out = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    out[0] = [0.0, 0.9, 0.1]
    if rows:
        b, s2, s1, n = (np.array(x) for x in zip(*rows))
        r = np.stack([np.where(s >= 0, 2.0 ** ((s - ZERO) / STEP), 0.0) for s in (s2, s1)] + [np.ones(len(b))], 1)
        for _ in range(rounds):
            part = out[b] * r
            part *= (n / part.sum(1))[:, None]
            total = np.stack([np.bincount(b, part[:, i], BUCKETS) for i in range(3)], 1)
            seen = total.sum(1) > 0
            out[seen] = total[seen] / total[seen].sum(1, keepdims=True)
    # no estimate may be the only one: a bucket's uniform share never vanishes
    out[:, 2] = np.maximum(out[:, 2], 1e-6)
    return out / out.sum(1, keepdims=True)


def score_texts(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", em_of_ten: int = 5,
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score and score (log10) of every row; ``train`` marks training rows."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_chunks = max(1, -(-int(size) // chunk_bytes))
    apart_of = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == em_of_ten, F.lit(False)) & train
    spot = F.xxhash64("id", "t")  # rows of one id, or of none, spread by their texts
    chunk = F.when(F.col("em"), F.pmod(spot, F.lit(-(-n_chunks // 10))) + n_chunks).otherwise(F.pmod(spot, F.lit(n_chunks)))
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("t"), train.alias("train"),
                        apart_of.alias("em")).withColumn("chunk", chunk.cast("long")))
    back = stored(totals(emitted(rows, min(n_chunks, MAX_RANGES))))
    release(spark)
    sums = [(unpack(r["c"]), unpack(r["rest"])) for r in back.where("chunk = -1").select("c", "rest").collect()]
    (n, v), (n_rest, v_rest) = (np.sum([s[i] for s in sums], axis=0).astype(np.int64).tolist() if sums else (0, 0)
                                for i in (0, 1))
    tally = rows.agg(F.count_if("train"), F.count_if(F.expr("train and not em"))).first()
    starts, starts_rest = tally[0], tally[1]
    known = back.where("chunk >= 0")

    def hist(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64())] * 4, names=["b", "s2", "s1", "n"])
        got = histogram(right, left.combine_chunks(), n_rest, v_rest, starts_rest)
        return pa.Table.from_arrays([pa.array(x.astype(np.int64)) for x in got], names=["b", "s2", "s1", "n"])

    learn = (rows.where("em").groupBy("chunk").cogroup(known.where(F.col("chunk") >= n_chunks).groupBy("chunk"))
             .applyInArrow(hist, "b long, s2 long, s1 long, n long").groupBy("b", "s2", "s1").agg(F.sum("n").alias("n")))
    weights = maximise(sorted(tuple(r) for r in learn.collect()))
    shared = apart(spark, weights)

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        left = left.combine_chunks()
        if not left.num_rows:
            return pa.Table.from_arrays([pa.array([], x) for x in (left.schema.field("id").type, *[pa.int64()] * 3,
                                                                    *[pa.float64()] * 2)], names=names)
        tok, big, first = tokens(left.column("t"))
        c1, c2 = counts(tok, right, UNI, False), counts(big, right, BI, False)
        ch = context_counts(c1, first, starts)
        w = shared.value[buckets(ch)]
        if n:
            p = w[:, 0] * c2 / np.maximum(ch, 1) + w[:, 1] * c1 / n + w[:, 2] / (v + 1)
            # an unseen context gives its bigram share to the other two
            p = np.where(ch > 0, p, p / np.maximum(w[:, 1] + w[:, 2], 1e-12))
        else:
            p = np.ones(len(tok))
        base = np.log10((c1 + 0.1) / (n + 0.1 * (v + 1)))
        at = first[:-1]

        return pa.Table.from_arrays(
            [left.column("id"), pa.array(np.diff(first)), pa.array(np.add.reduceat((c1 > 0).astype(np.int64), at)),
             pa.array(np.full(len(at), n, np.int64)), pa.array(np.add.reduceat(base, at)),
             pa.array(np.add.reduceat(np.log10(p), at))], names=names)

    kind = dict(docs.dtypes)[id_col]
    return (rows.groupBy("chunk").cogroup(known.groupBy("chunk"))
            .applyInArrow(score, f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
            .withColumnRenamed("id", id_col))


def op10_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every whole document; learns from ids whose crc32 mod 10 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_texts(docs, ~held_out("doc_id", 10, 0))
    return out.select("doc_id", held_out("doc_id", 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


QUERIES = {"op10_interpolated_lm": op10_interpolated_lm}
ORACLE_SQL: dict[str, str] = {}
