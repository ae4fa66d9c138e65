"""Shared plumbing of the operators: splits, text normalisation, Arrow maps, checkpoints."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.textvec import BLOCK_BYTES, cut, text_block
from tessera.session import ensure_checkpoint_dir, table

__all__ = ["apart", "bounded_sample", "components", "forget", "held_out", "letters", "likely", "map_text", "release",
           "stored", "table"]


def held_out(doc_id: str | Column, mod: int, rest: int) -> Column:
    """True where crc32(doc_id as text) mod ``mod`` is ``rest``; a null id is not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % mod == rest, F.lit(False))


def letters(text: str | Column) -> Column:
    """Lower-cased text with every run of non-letters as one space."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}]+", " ")


def map_text(df: DataFrame, fn: Callable, fields: str, keep: list[str], text: Column | str,
             block: int = BLOCK_BYTES) -> DataFrame:
    """Append the columns that ``fn(bytes, offsets)`` computes for each block of texts.

    ``fields`` is a DDL string of the new columns; ``fn`` returns one arrow
    array (or numpy array) for each, in that order.  Kept columns pass through;
    one whose name a new column takes is replaced.
    """
    new = T.StructType.fromDDL(fields)
    keep = [c for c in keep if c not in new.names]
    t = F.col(text) if isinstance(text, str) else text
    src = df.select(*[F.col(f"`{c}`") for c in keep], t.alias("__text"))
    schema = T.StructType([*src.schema.fields[:-1], *new.fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, "__text", block):
                buf, offs = text_block(part.column(len(keep)))
                made = [x if isinstance(x, pa.Array) else pa.array(x) for x in fn(buf, offs)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), *made], names=names)

    return src.mapInArrow(run, schema)


def bounded_sample(df: DataFrame, rows: int, key: str) -> DataFrame:
    """At most ``rows`` rows, those whose key hashes lowest: the same at every layout."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(rows)


def stored(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet to the shared folder that spark.checkpoint.dir names.

    Cuts the lineage: later jobs read files that outlive any executor.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(*dfs: DataFrame) -> None:
    """Delete the files of ``stored`` results that nothing reads any more."""
    for df in dfs:
        if path := getattr(df, "_stored_at", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished jobs.

    Its cleaner does so once the driver's collector has found the jobs' plans
    unreachable: one collection for the plans, one for what they held."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)


def likely(df: DataFrame, key: str, wanted: DataFrame, bits: int = 18) -> DataFrame:
    """Rows of ``df`` whose key may be in the one column of ``wanted`` (a superset: an exact join has to follow).

    Only hash slots are broadcast: at most 2**bits rows of one int whatever the
    size of ``wanted``, so that a join for few keys does not move all of ``df``.
    """
    slot = F.pmod(F.xxhash64(F.col(wanted.columns[0]).cast("long")), F.lit(1 << bits)).cast("int")
    slots = wanted.select(slot.alias("__slot")).distinct()
    mine = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(1 << bits)).cast("int")
    return df.withColumn("__slot", mine).join(F.broadcast(slots), "__slot", "left_semi").drop("__slot")


def _checksum(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, store=stored) -> DataFrame:
    """(u, v): v is the smallest node that u reaches, for every node u other than v.

    ``edges`` has two long columns.  Alternates large-star and small-star steps
    until nothing changes: the steps are grouped minima (combined before the
    shuffle) and equi-joins that Spark can split on a hot node, and each step's
    edges are written to the shared folder.
    """
    a, b = edges.columns
    cur = store(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    mark = _checksum(cur)
    while mark[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        new = store(small)
        forget(cur)
        cur, was, mark = new, mark, _checksum(new)
        if was == mark:
            break
    return cur


class Apart:
    """A broadcast model.

    Its parts (arrays, lists, numbers) are broadcast and shared by a worker's
    tasks; its class travels with the function that uses it, by value, so that
    executors need no copy of this package.
    """

    def __init__(self, kind: type, parts):
        self.kind, self.parts = kind, parts

    def __reduce__(self):
        return (Apart, (self.kind, self.parts))

    @property
    def value(self):
        out = self.kind.__new__(self.kind)
        out.__dict__.update(self.parts.value)
        return out


def apart(spark: SparkSession, obj):
    """A broadcast handle for a model of bounded size, an object or an array; ``value`` is the model."""
    if not hasattr(obj, "__dict__"):
        return spark.sparkContext.broadcast(obj)
    return Apart(type(obj), spark.sparkContext.broadcast(dict(obj.__dict__)))
