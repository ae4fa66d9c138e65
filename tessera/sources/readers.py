"""Readers with explicit schemas: JSON arrays, JSONL, CSV with embedded
newlines, JSON string-array context pools, word-vector text, label maps,
concatenated JSON objects, named splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.vocab import parse_word_vectors
from tessera.sources.json_ranges import RANGE_BYTES, read_json_array, split_objects

# Fixed value: file extensions accepted by the reference's loaders (we add
# jsonl and parquet).
ALLOWED_EXT = ("csv", "json", "jsonl", "parquet")


def read_any(spark: SparkSession, path: str, schema: StructType | str | None = None,
             fmt: str | None = None, multiline_json: bool | None = None) -> DataFrame:
    """Pick the reader by extension.  JSON that is one array of records is read
    with ``multiLine``, one task a file; ``read_records`` reads large ones in byte
    ranges.  JSONL is splittable.  CSV keeps quoted commas and newlines."""
    ext = (fmt or path.rsplit(".", 1)[-1]).lower()
    if ext not in ALLOWED_EXT:
        raise ValueError(f"unsupported extension {ext!r}; expected one of {ALLOWED_EXT}")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if ext == "csv":
        return r.csv(path, header=True, multiLine=True, escape='"')
    if ext == "parquet":
        return r.parquet(path)
    multi = (ext == "json") if multiline_json is None else multiline_json
    return r.option("multiLine", multi).json(path)


def read_splits(spark: SparkSession, paths: dict, schema=None, fmt: str | None = None) -> DataFrame:
    """Named splits in one DataFrame with a ``split`` column (union by name)."""
    out = None
    for split, p in paths.items():
        df = read_any(spark, p, schema, fmt).withColumn("split", F.lit(split))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_records(spark: SparkSession, path: str, schema: StructType | str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of JSON files that are one array each, in the array's order by (file, idx).

    A file is read in byte ranges by several tasks; ``schema`` is that of a record."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    names = StructType.fromDDL(ddl).names
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in StructType.fromDDL(ddl).fields)
    rows = read_json_array(spark, path, f"struct<{fields}>", range_bytes)
    return rows.select("file", "idx", *[F.col(f"value.`{n}`").alias(n) for n in names])


def read_contexts(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A JSON array of strings -> (ctx_id = position, text), read in byte ranges by several tasks."""
    return read_json_array(spark, path, "string", range_bytes).select(F.col("idx").alias("ctx_id"), F.col("value").alias("text"))


def read_word_vectors(spark: SparkSession, path: str, vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Word-vector text -> (vectors token/vector, rejected lines).  A line's
    order is its file, the block it was read from and its place in that block:
    the first line may be a header, and a repeated word keeps its last line."""
    lines = spark.read.text(path).select("value", F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_no"))
    return parse_word_vectors(lines, order_col="_no", vocab=vocab)


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """JSON object label -> id as rows (label, idx)."""
    whole = spark.read.text(path, wholetext=True)
    m = whole.select(F.from_json("value", "map<string,int>").alias("m"))
    return m.select(F.explode("m").alias("label", "idx"))


def split_concat_json(col: Column) -> Column:
    """Cut text holding JSON objects written back to back (``{..}{..}``) into
    one string per object; braces inside strings and nested objects cut nothing."""
    return split_objects(col)


def read_concat_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    lines = spark.read.text(path)
    objs = lines.select(F.explode(split_concat_json(F.col("value"))).alias("o"))
    return objs.select(F.from_json("o", schema).alias("r")).select("r.*")
