"""Hard negatives by residue-number-system matrix products.

Components become integers, floor(256 * x).  A score is an exact inner product:
both matrices are reduced modulo several primes under 1024, the residues are
multiplied in float32 (64 products of centred residues stay below 2**24, where
float32 is exact; longer vectors are cut and their parts added as integers), and
the signed score is rebuilt by Chinese remaindering.  As many primes are taken
as the largest components ask for, so a score of any size is exact; beyond six
primes it is rebuilt in Python's integers.

Anchors, a stated query set, meet all rows in blocks: rows are packed, dealt to
``slices``, anchors to ``groups``, and each (group, slice) cell is one task's
stream, anchors first and then one block after another.  The grid has as many
cells as the work asks for, about square in rows moved, so what is copied grows
with the square root of the cells and does not depend on the partition setting.
A task keeps the best few of each anchor (of each window in the second round),
and a ranked window over those picks the final ones.

Round one finds an anchor's positives: the best other rows of its label (an
anchor is multiplied with blocks that hold its label alone).  Round two selects,
for each anchor and positive, the best rows of other labels whose score lies in
the window low * positive <= 100 * score <= high * positive.

Defined cases: rows without id, with a null label, a null or empty vector or a
null or non-finite component take no part, nor do rows with a component whose
256-fold is 2**600 or more in size; vectors meet only vectors of their own
length; rows repeated under one id are one row, that of the least (label,
vector); ties go to the smaller id; an anchor with fewer positives or negatives
gets all; scores outside 64 bits are ranked and windowed exactly and come out as
the nearest 64-bit value; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.base import forget, stored, table

BLOCK = 2048              # rows of a packed block
CHUNK = 256               # anchors multiplied at once
CELL_PAIRS = 1 << 34      # pairs of anchor and row for each task
TOO_LARGE = 2.0 ** 600
_NONE = np.iinfo(np.int64).min


def labelled(df: DataFrame, anchor: Column, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, v, asked) of the rows that take part, one row an id; ``asked`` says whether it is an anchor."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * 256) >= TOO_LARGE))
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("v"),
                      F.coalesce(anchor, F.lit(False)).alias("asked"), (~bad).alias("ok"))
            .where("id is not null and label is not null and v is not null and size(v) > 0 and ok").drop("ok"))
    again = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    if again.isEmpty():
        return rows
    least = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v", "asked")).alias("x"))
    return rows.join(again, "id", "left_anti").unionByName(least.select("id", "x.label", "x.v", "x.asked"))


def primes_for(bound: int) -> list[int]:
    """The largest primes under 1024 whose product exceeds 2 * bound + 1."""
    out, have = [], 1
    for p in range(1023, 1, -1):
        if have > 2 * bound + 1:
            break
        if all(p % q for q in range(2, math.isqrt(p) + 1)):
            out.append(p)
            have *= p
    return out


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Centred residues, one float32 matrix for each prime; the remainder of a double is exact."""
    out = []
    for p in primes:
        r = np.fmod(x, p)
        out.append((r - p * np.rint(r / p)).astype(np.float32))
    return out


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of a and b from their residues: int64, or Python integers beyond six primes."""
    total, x = 1, None
    for ra, rb, p in zip(a, b, primes):
        step = (1 << 24) // (p // 2) ** 2
        r = np.zeros((len(ra), len(rb)), np.int64)
        for i in range(0, ra.shape[1], step):
            r += (ra[:, i:i + step] @ rb[:, i:i + step].T).astype(np.int64)
        r %= p
        if x is None:
            x = r
        else:
            if total * p >= 1 << 62 and x.dtype != object:
                x = x.astype(object)
            x = x + total * (((r - x % p) * pow(total, -1, p)) % p)
        total *= p
    if x.dtype == object:
        return np.where(2 * x > total, x - total, x)
    return x - np.where(x > total // 2, total, 0)


def _vectors_out(x: np.ndarray) -> bytes:
    """Two bytes a component where that is exact, else eight; the first byte says which."""
    small = bool(np.abs(x).max(initial=0) < 32768)
    return bytes([2 if small else 8]) + x.astype("<i2" if small else "<f8").tobytes()


def _vectors_in(b: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(b, "<i2" if b[0] == 2 else "<f8", offset=1).astype(float).reshape(-1, dim)


def packed(rows: DataFrame, width: int = 0) -> DataFrame:
    """Blocks of rows of one vector length in id order: dim, n, top (largest component), ids, labels, vecs, windows.

    With a ``width``, rows also have pids and keys (sort keys of that many
    bytes); ``windows`` then holds the owners' places, the pids and the keys.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            dims = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                own = own[np.argsort(ids[own], kind="stable")]
                for i in range(0, len(own), BLOCK):
                    o = own[i:i + BLOCK]
                    x = np.floor(256 * batch.column(2).take(pa.array(o)).flatten().to_numpy()).reshape(len(o), dim)
                    windows = b""
                    if width:
                        some = batch.take(pa.array(o))
                        pids, keys = some.column(3), some.column(4)
                        count = pids.value_lengths().to_numpy(zero_copy_only=False)
                        windows = (np.repeat(np.arange(len(o)), count).astype("<i4").tobytes()
                                   + pids.flatten().to_numpy().astype("<i8").tobytes()
                                   + b"".join(keys.flatten().to_pylist()))
                    yield pa.RecordBatch.from_pydict({
                        "dim": pa.array([dim], pa.int32()), "n": pa.array([len(o)], pa.int64()),
                        "top": [float(np.abs(x).max())], "ids": [ids[o].astype("<i8").tobytes()],
                        "labels": [labels[o].astype("<i8").tobytes()], "vecs": [_vectors_out(x)],
                        "windows": pa.array([windows], pa.binary())})

    return rows.mapInArrow(run, "dim int, n long, top double, ids binary, labels binary, vecs binary, windows binary")


def best(s: np.ndarray, ok: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, id, valid), k columns: each line's k best allowed columns; ``ids`` ascend, so ties go to the left."""
    k = min(k, s.shape[1])
    if s.dtype != object and np.abs(s).max(initial=0) < 1 << 51:
        key = np.where(ok, s * BLOCK + (BLOCK - 1 - np.arange(s.shape[1])), _NONE)
        if k < s.shape[1]:
            key = np.partition(key, s.shape[1] - k, axis=1)[:, -k:]
        ok = key != _NONE
        return key // BLOCK, ids[np.where(ok, BLOCK - 1 - key % BLOCK, 0)], ok
    at = np.array([sorted(range(len(ids)), key=lambda j: (not g[j], -int(r[j]), ids[j]))[:k] for r, g in zip(s, ok)],
                  dtype=np.int64).reshape(len(s), k)
    return np.take_along_axis(s, at, 1), ids[at], np.take_along_axis(ok, at, 1)


def merged(a: tuple, b: tuple, k: int) -> tuple:
    """The k best of two results of ``best``, line by line; an id is in one of them alone."""
    s, i, ok = (np.concatenate(x, axis=1) for x in zip(a, b))
    if s.dtype == object:
        at = np.array([sorted(range(len(g)), key=lambda j: (not g[j], -int(r[j]), y[j]))[:k]
                       for r, y, g in zip(s, i, ok)], dtype=np.int64).reshape(len(s), -1)
    else:
        at = np.lexsort((i, -s, ~ok), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, at, 1) for x in (s, i, ok))


def sort_keys(scores: list[int], width: int) -> list[bytes]:
    """Scores as bytes that sort as they do."""
    return [(int(x) + (1 << (8 * width - 1))).to_bytes(width, "big") for x in scores]


def score_of(key: bytes) -> int:
    return int.from_bytes(key, "big") - (1 << (8 * len(key) - 1))


def _long(x: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(x)))


class Anchors:
    """The anchors of one cell: residues by vector length, and their windows in the second round."""

    def __init__(self, blocks: list[tuple], primes: list[int], width: int, low: int, high: int, windows: bool):
        self.parts: list[dict] = []
        for dim, ids, labels, vecs, wins in blocks:
            x, i, lab = _vectors_in(vecs, dim), np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
            owner = np.arange(len(i), dtype=np.int32)
            pid, score = i, [0] * len(i)
            if windows:
                n = len(wins) // (12 + width)
                owner = np.frombuffer(wins, "<i4", n)
                pid = np.frombuffer(wins, "<i8", n, offset=4 * n)
                score = [score_of(wins[12 * n + width * j:12 * n + width * (j + 1)]) for j in range(n)]
            for a in range(0, len(i), CHUNK):
                own = (owner >= a) & (owner < a + CHUNK)
                p = [score[j] for j in np.flatnonzero(own)]
                kind = np.int64 if all(abs(v) < 1 << 55 for v in p) else object
                self.parts.append({
                    "dim": dim, "ids": i[a:a + CHUNK], "labels": lab[a:a + CHUNK], "x": residues(x[a:a + CHUNK], primes),
                    "owner": owner[own] - a, "pid": pid[own], "p": p, "found": None,
                    "low": np.array([-(-low * v // 100) for v in p], kind), "high": np.array([high * v // 100 for v in p], kind)})


def search(anchors: DataFrame, blocks: DataFrame, primes: list[int], width: int, k: int, grid: tuple[int, int],
           low: int = 0, high: int = 0, windows: bool = False) -> DataFrame:
    """(anchor, pid, id, key, p, score): each cell's k best rows for each anchor, or for each of its windows."""
    groups, slices = grid

    def cell(df, group, at, side):
        return df.select((group * slices + at).cast("int").alias("cell"), F.lit(side).alias("side"), "dim", "ids", "labels",
                         "vecs", "windows")

    place = F.pmod(F.xxhash64("ids"), F.lit(1 << 30))
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    left = cell(anchors.select("*", (place % groups).alias("g"), every(slices, "s")), F.col("g"), F.col("s"), 0)
    right = cell(blocks.select("*", (place % slices).alias("s"), every(groups, "g")), F.col("g"), F.col("s"), 1)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, held = None, [], None

        def out():
            for part in held.parts if held else ():
                if part["found"] is None:
                    continue
                s, i, ok = part["found"]
                line, col = np.nonzero(ok)
                scores = s[line, col].tolist()
                p = [part["p"][j] for j in line]
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array(part["ids"][part["owner"][line]]), "pid": pa.array(part["pid"][line]),
                    "id": pa.array(i[line, col]), "key": pa.array(sort_keys(scores, width), pa.binary()),
                    "p": pa.array([_long(x) for x in p], pa.int64()), "score": pa.array([_long(x) for x in scores], pa.int64())})

        for batch in batches:
            for c, side, dim, ids, labels, vecs, wins in zip(*(x.to_pylist() for x in batch.columns)):
                if c != now:
                    yield from out()
                    now, waiting, held = c, [], None
                if side == 0:
                    waiting.append((dim, ids, labels, vecs, wins))
                    continue
                if held is None:
                    held, waiting = Anchors(waiting, primes, width, low, high, windows), []
                i, lab = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
                some = np.unique(lab)
                x = residues(_vectors_in(vecs, dim), primes) if any(p["dim"] == dim for p in held.parts) else None
                for part in held.parts:
                    owner = part["owner"]
                    if part["dim"] != dim or not len(owner) or not windows and not np.isin(part["labels"], some).any():
                        continue
                    s = products(part["x"], x, primes)[owner]
                    same = part["labels"][owner][:, None] == lab[None, :]
                    if windows:
                        ok = ~same & (s >= part["low"][:, None]) & (s <= part["high"][:, None])
                    else:
                        ok = same & (part["ids"][owner][:, None] != i[None, :])
                    ok = ok.astype(bool)
                    new = best(s, ok, i, k)
                    part["found"] = new if part["found"] is None else merged(part["found"], new, k)
        yield from out()

    dealt = (left.unionByName(right).repartition(groups * slices, "cell").sortWithinPartitions("cell", "side"))
    return dealt.mapInArrow(solve, "anchor long, pid long, id long, key binary, p long, score long")


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10,
                   window: tuple[int, int] = (30, 90), id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says of a row whether it is an anchor; ``window`` is in per cent
    of the positive's score.
    """
    spark = vectors.sparkSession
    rows = labelled(vectors, anchor, id_col, vec_col, label_col)
    asked = rows.where("asked").drop("asked")
    blocks, first = stored(packed(rows.drop("asked"))), stored(packed(asked))
    n, top, dim = blocks.agg(F.sum("n"), F.max("top"), F.max("dim")).first()
    n_asked = first.agg(F.sum("n")).first()[0]
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not n or not n_asked:
        return spark.createDataFrame([], schema)
    bound = dim * int(top) ** 2
    primes = primes_for(bound)
    width = max(8, bound.bit_length() // 8 + 1)
    cells = max(spark.sparkContext.defaultParallelism, -(-n * n_asked // CELL_PAIRS))
    groups = max(1, round(math.sqrt(cells * n_asked / n)))
    grid = groups, -(-cells // groups)

    def ranked(df, by, k):
        w = Window.partitionBy(*by).orderBy(F.desc("key"), "id")
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    found = search(first, blocks, primes, width, positives, grid)
    pos = stored(ranked(found, ["anchor"], positives).select(F.col("anchor").alias("id"), F.col("id").alias("pid"), "key"))
    lists = pos.groupBy("id").agg(F.collect_list(F.struct("pid", "key")).alias("x"))  # at most ``positives`` a group
    second = stored(packed(asked.join(lists, "id").select("id", "label", "v", F.col("x.pid").alias("pids"),
                                                          F.col("x.key").alias("keys")), width))
    found = search(second, blocks, primes, width, negatives, grid, *window, windows=True)
    forget(first, pos)
    return ranked(found, ["anchor", "pid"], negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("pid").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p").alias("positive_score"), F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten negatives for each of five positives of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
ORACLE_SQL = {"op12_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, list_dot_product(a.e, d.e)::BIGINT AS score
      FROM v a JOIN v d ON a.vec_id % 100 = 0 AND a.vec_id <> d.vec_id AND len(a.e) = len(d.e)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
        AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""}
