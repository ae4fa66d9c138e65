"""Ordinal indexes, first-n, deterministic sampling and shuffling, batches
padded to their own longest row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import PAD_ID, pad_array
from tessera.operators.common import md5_number, with_row_index


def first_n(df: DataFrame, order_by: list, n: int) -> DataFrame:
    """First n rows in key order (TakeOrderedAndProject: n rows per partition)."""
    return df.orderBy(*order_by).limit(n)


def sample_rows(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k rows picked by a seeded hash of the key: deterministic and
    independent of partitioning."""
    return df.orderBy(md5_number(F.concat_ws(":", F.lit(seed), F.col(key))), key).limit(k)


def shuffled(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Seeded, layout-independent shuffle order: range-partition on a hash
    of the key and sort inside partitions (no single-task sort)."""
    h = md5_number(F.concat_ws(":", F.lit(seed), F.col(key)))
    return (df.withColumn("shuffle_key", h).repartitionByRange("shuffle_key", key)
            .sortWithinPartitions("shuffle_key", key))


def padded_batches(df: DataFrame, order_by: list, ids_col: str, batch_size: int,
                   multiple_of: int | None = None, pad: int = PAD_ID) -> DataFrame:
    """Fixed-size batches in the order of the unique key ``order_by``, each
    padded to its longest row (rounded up to ``multiple_of``).  The batch max is a window per batch:
    groups are bounded by ``batch_size``."""
    # only keys and lengths are sorted and checkpointed; the arrays join once
    idx = with_row_index(df.select(*order_by, F.size(ids_col).alias("_n")), order_by)
    b = idx.withColumn("batch_id", (F.col("row_idx") / F.lit(batch_size)).cast("long"))
    longest = F.max("_n").over(Window.partitionBy("batch_id"))
    if multiple_of:
        longest = (F.ceil(longest / F.lit(multiple_of)) * multiple_of).cast("int")
    b = b.withColumn("_to", longest).drop("_n")
    return df.join(b, order_by).withColumn(ids_col, pad_array(ids_col, F.col("_to"), pad)).drop("_to")
