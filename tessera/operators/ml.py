"""Model-facing steps re-aimed at Spark: user batch functions over Arrow
batches, batch scoring with ``predict_batch_udf``, a ``pyspark.ml`` text
classifier, max-pooled document vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, RegexTokenizer, StringIndexer
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from tessera.operators.common import list_lengths, slices_of

VECTOR_BLOCK = 65_536  # vector ids that a task holds at once: 16 MB of 64 floats
POOL_TASKS = 96  # tasks that pool, at least, and groups of a block of vectors and a share of the keys


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Apply a column-batch function (may change the row count) per Arrow
    batch of each partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)
    return df.mapInPandas(run, schema)


def score(df: DataFrame, make_predict_fn, input_col: str, out_col: str = "logits",
          batch_size: int = 256, dim: int | None = None) -> DataFrame:
    """Rows -> logits with a model loaded once per Python worker
    (``make_predict_fn`` returns ``f(np.ndarray) -> np.ndarray``)."""
    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()), batch_size=batch_size,
                            input_tensor_shapes=[[dim]] if dim else None)
    return df.withColumn(out_col, udf(F.col(input_col)))


def linear_scorer(weights: np.ndarray, bias: np.ndarray):
    """A numpy linear model as a predict-fn factory (tests, stand-in model)."""
    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            return x @ weights + bias
        return predict
    return make


def fit_text_classifier(df: DataFrame, text_col: str, label_col: str, vocab_size: int = 10000,
                        max_iter: int = 50) -> PipelineModel:
    """Labels indexed alphabetically, words by whitespace, counts over a
    vocabulary of ``vocab_size``, multinomial logistic regression."""
    stages = [
        StringIndexer(inputCol=label_col, outputCol="label_idx", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"\s+", toLowercase=False),
        CountVectorizer(inputCol="_words", outputCol="_features", vocabSize=vocab_size),
        LogisticRegression(featuresCol="_features", labelCol="label_idx", maxIter=max_iter, family="multinomial"),
    ]
    return Pipeline(stages=stages).fit(df)


def max_pool_vectors(token_vec: DataFrame, key: str, vec_col: str = "vector", dim: int = 64) -> DataFrame:
    """(key, pooled): element-wise max over each key's vectors of ``dim`` numbers.
    One maximum per dimension in one grouping, combined map-side: no row per
    dimension crosses the shuffle."""
    pooled = token_vec.groupBy(key).agg(*[F.max(F.col(vec_col)[i]).alias(f"m{i}") for i in range(dim)])
    return pooled.select(key, F.array(*[f"m{i}" for i in range(dim)]).alias("pooled"))


def pool_by_ids(ids: DataFrame, vectors: DataFrame, key: str, dim: int = 64) -> DataFrame:
    """(key, vector): maxima of the vectors that a row's ids name, one row for each block of ``VECTOR_BLOCK`` ids that
    they fall into; ``max_pool_vectors`` of these rows is the maximum over all ids.  ``ids``: key, ids array<bigint>;
    ``vectors``: vec_id, vector.  Ids without a vector are left out.

    The ids travel to the vectors, not the vectors to the ids: a row's ids are cut by block, and each block meets the ids
    of a share of the keys in one task, which reads the block first and then pools row by row, whatever their number."""
    kind = vectors.schema["vector"].dataType
    last = vectors.agg(F.max("vec_id")).first()[0] or 0
    tasks = max(POOL_TASKS, int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = max(1, tasks // (last // VECTOR_BLOCK + 1))

    @F.arrow_udf("array<struct<block:bigint,ids:array<bigint>>>")
    def by_block(lists: pa.Array) -> pa.Array:
        done = [_cut_by_block(lists.slice(i, j - i)) for i, j in slices_of(list_lengths(lists))]
        return pa.concat_arrays(done) if done else _cut_by_block(lists)

    asked = (ids.select(key, F.explode(by_block("ids")).alias("x"))
             .select("x.block", F.pmod(F.xxhash64(key), F.lit(shares)).alias("share"), F.lit(1).alias("kind"), key, "x.ids",
                     F.lit(None).cast(kind).alias("vector")))
    held = vectors.select(F.floor(F.col("vec_id") / VECTOR_BLOCK).alias("block"),
                          F.explode(F.sequence(F.lit(0), F.lit(shares - 1)).cast("array<bigint>")).alias("share"), F.lit(0).alias("kind"),
                          F.lit(None).cast(ids.schema[key].dataType).alias(key), F.array(F.col("vec_id").cast("long")).alias("ids"),
                          F.slice("vector", 1, dim).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(dim)
        for b in batches:
            at = np.stack([b.column(i).to_numpy() for i in range(3)])
            cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1), b.num_rows]
            for i, j in zip(cuts[:-1], cuts[1:]):
                part = b.slice(i, j - i)
                if at[2, i] == 0:
                    block.add(tuple(at[:2, i]), part.column(4), part.column(5))
                elif block.begins(tuple(at[:2, i])):
                    for x, y in slices_of(list_lengths(part.column(4)), 50_000):
                        some, pooled = block.pool(part.column(4).slice(x, y - x))
                        yield pa.RecordBatch.from_arrays([part.column(3).slice(x, y - x).take(some), pooled], names=[key, "vector"])

    met = held.unionByName(asked).repartition(tasks, "block", "share").sortWithinPartitions("block", "share", "kind")
    return met.mapInArrow(run, StructType([ids.schema[key], vectors.schema["vector"]]))


def _cut_by_block(lists: pa.Array) -> pa.Array:
    """array<struct<block,ids>>: each list's distinct ids by block."""
    n = list_lengths(lists)
    flat = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(n)), n)[flat >= 0]
    flat = flat[flat >= 0]
    if not ((row[1:] > row[:-1]) | (flat[1:] >= flat[:-1])).all():
        order = np.lexsort((flat, row))
        row, flat = row[order], flat[order]
    new = np.ones(len(flat), bool)
    new[1:] = (row[1:] != row[:-1]) | (flat[1:] != flat[:-1])
    row, flat = row[new], flat[new]
    block = flat // VECTOR_BLOCK
    head = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (block[1:] != block[:-1])])) if len(flat) else np.zeros(0, np.int64)
    parts = pa.ListArray.from_arrays(pa.array(np.concatenate([head, [len(flat)]]).astype(np.int32)), pa.array(flat, pa.int64()))
    rows = pa.StructArray.from_arrays([pa.array(block[head], pa.int64()), parts], names=["block", "ids"])
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[head], minlength=len(n)))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), rows)


class _Block:
    """The vectors of one block, then the maxima of lists of their ids."""

    def __init__(self, dim: int):
        self.dim, self.name, self.parts, self.ready = dim, None, [], False

    def add(self, name: tuple, ids: pa.Array, vectors: pa.Array) -> None:
        if name != self.name:
            self.name, self.parts, self.ready = name, [], False
        n = list_lengths(vectors)
        if ((n != self.dim) & vectors.is_valid().to_numpy(zero_copy_only=False)).any():
            raise ValueError(f"a vector has fewer than {self.dim} numbers")
        flat = vectors.flatten()
        values = np.zeros((len(vectors), self.dim), flat.type.to_pandas_dtype())
        known = np.zeros((len(vectors), self.dim), bool)
        values[n > 0] = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).reshape(-1, self.dim)
        known[n > 0] = flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, self.dim)
        self.parts.append((ids.flatten().to_numpy(), np.where(known, values, -np.inf).astype(values.dtype), known, vectors.type))

    def begins(self, name: tuple) -> bool:
        """Whether the block called ``name`` has vectors; makes them one table, of one row for each id."""
        if name == self.name and not self.ready:
            ids = np.concatenate([p[0] for p in self.parts])
            order = np.argsort(ids, kind="stable")
            heads = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) != 0]))
            self.ids = ids[order][heads]
            self.values = np.maximum.reduceat(np.concatenate([p[1] for p in self.parts])[order], heads, axis=0)
            known = np.logical_or.reduceat(np.concatenate([p[2] for p in self.parts])[order], heads, axis=0)
            self.known = None if known.all() else known
            self.type, self.parts, self.ready = self.parts[0][3], [], True
        return name == self.name

    def pool(self, lists: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Numbers of the lists that name a vector, and the maxima of each."""
        n = list_lengths(lists)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(self.ids, flat), len(self.ids) - 1)
        found = self.ids[at] == flat
        row, at = np.repeat(np.arange(len(n)), n)[found], at[found]
        if not len(row):
            return pa.array([], pa.int64()), pa.array([], self.type)
        heads = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
        best = np.maximum.reduceat(self.values[at], heads, axis=0)
        gaps = None if self.known is None else ~np.logical_or.reduceat(self.known[at], heads, axis=0)
        flat = pa.array(best.ravel(), mask=None if gaps is None else gaps.ravel()).cast(self.type.value_type)
        ends = np.arange(len(heads) + 1, dtype=np.int32) * self.dim
        return pa.array(row[heads]), pa.ListArray.from_arrays(pa.array(ends), flat).cast(self.type)


def token_context_features(df: DataFrame, keys: list, tokens_col: str, tags_col: str | None = None) -> DataFrame:
    """One row per token with its neighbours as features (``w:``, ``p:``,
    ``n:`` words), built by zipping shifted copies of the token array."""
    t = F.col(tokens_col)
    prev = F.concat(F.array(F.lit("<s>")), F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))))
    nxt = F.concat(F.slice(t, 2, F.greatest(F.size(t), F.lit(1))), F.array(F.lit("</s>")))
    cols = [t.alias("w"), prev.alias("p"), nxt.alias("n")]
    if tags_col:
        cols.append(F.col(tags_col).alias("tag"))
    z = df.select(*keys, F.posexplode_outer(F.arrays_zip(*cols)).alias("pos", "x")).where(F.col("x").isNotNull())
    feats = F.array(F.concat(F.lit("w:"), F.col("x.w")), F.concat(F.lit("p:"), F.col("x.p")),
                    F.concat(F.lit("n:"), F.col("x.n")))
    out = [*keys, "pos", F.col("x.w").alias("token"), feats.alias("feats")]
    if tags_col:
        out.append(F.col("x.tag").alias("tag"))
    return z.select(*out)


def fit_tagger(tokens: DataFrame, vocab_size: int = 20000, max_iter: int = 30) -> PipelineModel:
    """Per-token multinomial logistic regression on word/neighbour features
    (the re-aimed sequence tagger); labels indexed alphabetically.  The model's
    features are the ``vocab_size`` most frequent ones; other words are
    unknown to it."""
    stages = [
        StringIndexer(inputCol="tag", outputCol="label_idx", stringOrderType="alphabetAsc"),
        CountVectorizer(inputCol="feats", outputCol="_features", vocabSize=vocab_size),
        LogisticRegression(featuresCol="_features", labelCol="label_idx", maxIter=max_iter, family="multinomial"),
    ]
    return Pipeline(stages=stages).fit(tokens)
