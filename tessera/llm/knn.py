"""Exact top-k by inner product through a Voronoi join.

Vectors become integers, floor(256 * x).  A bounded set of pivots (vectors whose
id hashes lowest, about one for each 4096 vectors and at most 256) parts data
and queries into cells.  A cell's summary is its pivot, its radius (largest
distance to the pivot) and its count of ids, an id with several vectors counting
in the cell of its least vector only, so that no cell counts copies.  For a query group g (pivot p, radius r) and a
data cell c (pivot s, radius t), every inner product lies within

    p.s +- (r |s| + (|p| + r) t)

so the cells with the highest lower bounds that together hold k + 1 ids (the
query's own does not count) give a floor for the k-th score of every query of
the group, and a cell whose upper bound is under that floor cannot matter.  The
rest, the necessary data, is replicated to the group, in packed blocks, and
solved there by matrix products; an id's rows of a block become its best score
before anything is cut, each task keeps k ids a query, and a ranked window picks
the final k.

Summaries (at most 256 x 256 numbers) are all that the driver sees.  A hot cell
is many blocks: blocks of a group are dealt to ``slices`` tasks, each of which
meets the group's queries, also in blocks.  Radii get a relative slack of 1e-9
for rounding, so bounds stay on the safe side.

A score outside 64 bits counts as the nearest 64-bit value.

Defined cases: vectors that are null, empty or hold a null or non-finite
component take no part, nor do rows without id; vectors meet only vectors of
their own length; rows repeated in full are dropped first, and different vectors
under one id count once in a result, with their best score; ties go to the smaller id; a query with fewer candidates gets all;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.base import stored, table

CELL_ROWS = 4096
QUERY_ROWS = 1024
MAX_PIVOTS = 256
EXACT = float(1 << 22)  # components under this multiply exactly in doubles, up to 512 of them


def integers(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, v): valid vectors as arrays of whole doubles."""
    v = F.col(vec_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * 256) == float("inf")))
    return (df.select(F.col(id_col).cast("long").alias("id"), v.alias("x"), (~bad).alias("ok"))
            .where("id is not null and x is not null and size(x) > 0 and ok")
            .select("id", F.size("x").alias("dim"), F.transform("x", lambda x: F.when(F.abs(x) < 2.0 ** 44, F.floor(x * 256).cast("double"))
                                                                .otherwise(x * 256)).alias("v")))  # whole numbers beyond 2**52


def _matrix(col: pa.Array) -> np.ndarray:
    n = len(col)
    return np.asarray(col.flatten()).reshape(n, -1) if n else np.zeros((0, 0))


def _pack(x: np.ndarray) -> bytes:
    """Two bytes a component where that is exact, else eight; a leading byte says which."""
    small = bool(len(x) == 0 or np.abs(x).max() < 32768)
    return bytes([2 if small else 8]) + (x.astype("<i2") if small else x.astype("<f8")).tobytes()


def _unpack(b: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(b, "<i2" if b[0] == 2 else "<f8", offset=1).astype(float).reshape(-1, dim)


def _products(d: np.ndarray, q: np.ndarray) -> np.ndarray:
    if max(np.abs(d).max(initial=0), np.abs(q).max(initial=0)) < EXACT and d.shape[1] <= 512:
        return (d @ q.T).astype(np.int64)
    low, high = -(1 << 63) + 1, (1 << 63) - 1
    whole = [[int(x) for x in row] for row in q.tolist()]
    return np.array([[max(low, min(high, sum(int(x) * y for x, y in zip(row, other)))) for other in whole] for row in d.tolist()],
                    dtype=np.int64).reshape(len(d), len(q))


def once(rows: DataFrame) -> DataFrame:
    """Distinct (id, dim, v), stored, with ``first``: true for one vector of each id and length."""
    rows = stored(rows.dropDuplicates(["id", "v"]))
    n, ids = rows.agg(F.count(F.lit(1)), F.count_distinct("id", "dim")).first()
    if n == ids:
        return rows.withColumn("first", F.lit(True))
    least = rows.groupBy("id", "dim").agg(F.min("v").alias("least"))
    return rows.join(least, ["id", "dim"]).select("id", "dim", "v", (F.col("v") == F.col("least")).alias("first"))


def in_cells(rows: DataFrame, pivots: dict[int, np.ndarray], block: int) -> DataFrame:
    """Packed blocks: dim, cell, n (firsts), radius, ids, vecs; a block's vectors share length and nearest pivot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            dims = np.asarray(batch.column(1))
            first = batch.column(3).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                pick = np.flatnonzero(dims == dim)
                x = _matrix(batch.column(2).take(pa.array(pick)))
                p = pivots.get(int(dim), np.zeros((1, int(dim))))
                far = (p * p).sum(1)[None, :] - 2 * (x @ p.T)
                cell = far.argmin(1)
                dist = np.sqrt(((x - p[cell]) ** 2).sum(1))
                for c in np.unique(cell):
                    own = np.flatnonzero(cell == c)
                    for a in range(0, len(own), block):
                        o = own[a:a + block]
                        yield pa.RecordBatch.from_pydict({
                            "dim": pa.array([dim], pa.int32()), "cell": pa.array([c], pa.int32()),
                            "n": pa.array([int(first[pick[o]].sum())], pa.int64()), "radius": [float(dist[o].max())],
                            "ids": [ids[pick[o]].astype("<i8").tobytes()], "vecs": [_pack(x[o])]})

    return rows.select("id", "dim", "v", "first").mapInArrow(
        run, "dim int, cell int, n long, radius double, ids binary, vecs binary")


def needed(data: list, queries: list, pivots: dict, q_pivots: dict, k: int) -> list[tuple[int, int, int]]:
    """(dim, group, cell) triples that the bounds cannot rule out, from the two sides' cell summaries."""
    out = []
    for g in queries:
        dim = g["dim"]
        cells = [c for c in data if c["dim"] == dim]
        zero = np.zeros((1, dim))
        p = q_pivots.get(dim, zero)[g["cell"]]
        r = g["radius"] * (1 + 1e-9)
        s = np.array([pivots.get(dim, zero)[c["cell"]] for c in cells])
        t = np.array([c["radius"] for c in cells]) * (1 + 1e-9)
        mid = s @ p
        room = r * np.sqrt((s * s).sum(1)) + (np.sqrt(p @ p) + r) * t + 1e-6 * (1 + np.abs(mid))
        order = np.argsort(-(mid - room))
        held = np.cumsum([cells[i]["n"] for i in order])
        at = int(np.searchsorted(held, k + 1))
        floor = (mid - room)[order[at]] if at < len(order) else -np.inf
        out += [(dim, g["cell"], cells[i]["cell"]) for i in np.flatnonzero(mid + room >= floor)]
    return out


def _pivots(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    some = rows.orderBy(F.xxhash64("id"), "id").select("dim", "v").limit(n).collect()
    out: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in some}:
        out[dim] = np.unique(np.array([r["v"] for r in some if r["dim"] == dim]), axis=0)
    return out


def voronoi_knn(vectors: DataFrame, query: Column, k: int = 5, id_col: str = "vec_id",
                vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score of the k best rows for every row of ``vectors`` where ``query`` holds."""
    spark = vectors.sparkSession
    rows = once(integers(vectors, id_col, vec_col))
    wanted = integers(vectors.where(query), id_col, vec_col).dropDuplicates(["id", "v"]).withColumn("first", F.lit(True))
    n_rows, n_queries = rows.count(), wanted.count()
    schema = f"query_id long, rank int, {id_col} long, score long"
    if not n_queries:
        return spark.createDataFrame([], schema)
    pivots = _pivots(rows, min(MAX_PIVOTS, max(4, n_rows // CELL_ROWS)))
    q_pivots = _pivots(rows, min(MAX_PIVOTS, -(-n_queries // QUERY_ROWS)))
    data = stored(in_cells(rows, pivots, CELL_ROWS))
    asked = stored(in_cells(wanted.repartition(max(1, -(-n_queries // QUERY_ROWS)), "id"), q_pivots, QUERY_ROWS))

    def summary(blocks):  # at most one row for each pivot and vector length
        return blocks.groupBy("dim", "cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).collect()

    triples = needed(summary(data), summary(asked), pivots, q_pivots, k)
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = spark.createDataFrame([tuple(int(x) for x in t) for t in triples], "dim int, grp int, cell int")
    left = (data.join(F.broadcast(pairs), ["dim", "cell"])  # at most 256 x 256 rows a vector length
            .withColumn("slice", F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int")))
    # a query block goes to the slices that hold a needed block, and to no other
    right = asked.select("dim", F.col("cell").alias("grp"), F.col("ids").alias("qids"), F.col("vecs").alias("qvecs")).join(
        left.select("dim", "grp", "slice").distinct(), ["dim", "grp"])
    met = left.join(right, ["dim", "grp", "slice"]).select("dim", "ids", "vecs", "qids", "qvecs")

    def best(q, ids, s):
        """k best (id, score) of one query, ids distinct, ties to the smaller id."""
        order = np.lexsort((ids, -s))
        _, first = np.unique(ids[order], return_index=True)
        order = order[np.sort(first)][:k]
        return ids[order], s[order]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}

        def flush():
            if kept:
                q = np.concatenate([np.full(len(i), x) for x, (i, _) in kept.items()])
                i = np.concatenate([i for i, _ in kept.values()])
                s = np.concatenate([s for _, s in kept.values()])
                kept.clear()
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s)], names=["query_id", "id", "score"])

        for batch in batches:
            for dim, ids, vecs, qids, qvecs in zip(*(c.to_pylist() for c in batch.columns)):
                di, qi = np.frombuffer(ids, "<i8"), np.frombuffer(qids, "<i8")
                s = _products(_unpack(vecs, dim), _unpack(qvecs, dim))
                order = np.argsort(di, kind="stable")
                start = np.flatnonzero(np.diff(di[order], prepend=di[order[0]] - 1))
                if len(start) < len(di):  # several vectors under one id
                    di, s = di[order[start]], np.maximum.reduceat(s[order], start, axis=0)
                top = min(k + 1, len(di))
                for j, q in enumerate(qi.tolist()):
                    col = s[:, j]
                    if len(di) > 4 * k:  # ties at the edge stay in
                        pick = np.flatnonzero(col >= np.partition(col, len(di) - top)[len(di) - top])
                    else:
                        pick = np.arange(len(di))
                    pick = pick[di[pick] != q]
                    i, v = di[pick], col[pick]
                    if q in kept:
                        i, v = np.concatenate([kept[q][0], i]), np.concatenate([kept[q][1], v])
                    kept[q] = best(q, i, v)
                if len(kept) > 100_000:
                    yield from flush()
        yield from flush()

    found = met.mapInArrow(solve, "query_id long, id long, score long")
    found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


def op5_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best rows for every vector whose id is divisible by 50, against all others."""
    return voronoi_knn(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {"op5_voronoi_knn": op5_voronoi_knn}
ORACLE_SQL = {"op5_voronoi_knn": """
WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.e::DOUBLE[], d.e::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id AND len(q.e) = len(d.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""}
