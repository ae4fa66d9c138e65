"""Join-strategy and ordering helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A side is hinted for broadcast only when it has at most this many rows by
# construction (a top-n) AND each row has a fixed width (numbers only), so that
# its size is proven: 2 M rows of a few longs stay under 100 MB.  Every other
# join is left to AQE, which broadcasts at runtime only what it has measured to
# be under spark.sql.autoBroadcastJoinThreshold.
BROADCAST_ROW_BOUND = 2_000_000
SLOT_BITS = 18


def bounded_broadcast(df: DataFrame, row_bound: int | None) -> DataFrame:
    """Broadcast hint for at most ``row_bound`` rows of numbers; strings have no proven size."""
    wide = [t for _, t in df.dtypes if t not in ("int", "bigint", "double", "float", "boolean", "smallint", "tinyint")]
    if row_bound is not None and row_bound <= BROADCAST_ROW_BOUND and not wide:
        return F.broadcast(df)
    return df


def fingerprint(col) -> list:
    """Two 64-bit hashes that stand for a string of any length in a join."""
    c = F.col(col) if isinstance(col, str) else col
    return [F.xxhash64(c), F.xxhash64(c, F.lit(1))]


def md5_number(col) -> Column:
    """The first 32 bits of a string's MD5 as a number: a hash every SQL engine has."""
    return F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("long")


def md5_numbers(words: Column, n: int) -> Column:
    """``md5_number`` modulo ``n`` of an array's words, without repeats; each distinct word of a slice of rows is hashed once."""
    import hashlib

    def of_slice(lists: pa.Array) -> pa.Array:
        coded = lists.flatten().dictionary_encode()
        each = np.array([int.from_bytes(hashlib.md5(w.encode()).digest()[:4], "big") % n for w in coded.dictionary.to_pylist()], np.int64)
        sizes = list_lengths(lists)
        pairs = np.unique(np.repeat(np.arange(len(sizes)), sizes) * n + each[coded.indices.to_numpy()])  # row and number in one
        ends = np.concatenate([[0], np.cumsum(np.bincount(pairs // n, minlength=len(sizes)))])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(pairs % n))

    @F.arrow_udf("array<bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            done = [of_slice(b.slice(i, j - i)) for i, j in slices_of(list_lengths(b))]
            yield pa.concat_arrays(done) if done else of_slice(b)

    return run(words)


def list_lengths(lists: pa.Array) -> np.ndarray:
    """Elements of each list; none in a null one."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices_of(lengths: np.ndarray, limit: int = 200_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows that hold at most ``limit`` elements together, one row at least."""
    ends = np.cumsum(lengths, dtype=np.int64)
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + limit, "right")))
        yield i, j
        i = j


def by_slices(lists: Iterator[pa.Array], fn: Callable[[pa.Array], pa.Array], limit: int = 200_000) -> Iterator[pa.Array]:
    """``fn`` of slices of list arrays that hold at most ``limit`` elements together, one row at least.

    An Arrow batch has a stated number of rows, but not of words; results of a whole batch need not be held at once."""
    for batch in lists:
        for i, j in slices_of(list_lengths(batch), limit):
            yield fn(batch.slice(i, j - i))


def likely_keys(df: DataFrame, hash_col: str, probes: DataFrame) -> DataFrame:
    """Rows whose long ``hash_col`` may be in the one column of ``probes``.

    A semi join on 2**18 hash slots, all that is broadcast however many probes
    there are; drops most rows before an exact join moves them."""
    def slot(c):
        return F.pmod(F.xxhash64(F.col(c)), F.lit(1 << SLOT_BITS)).cast("int")

    slots = probes.select(slot(probes.columns[0]).alias("_slot")).distinct()
    return df.withColumn("_slot", slot(hash_col)).join(F.broadcast(slots), "_slot", "left_semi").drop("_slot")


def with_row_index(df: DataFrame, order_by: list, index_col: str = "row_idx") -> DataFrame:
    """Dense 0-based ordinal in ``order_by`` order without a single-partition
    window: sort (range-partitioned), checkpoint so partition contents are
    fixed, count rows per partition, turn the counts into offsets (one row
    per partition, broadcast) and add the in-partition position.  All columns
    of ``df`` are checkpointed: index the keys alone and join wide columns to
    the result."""
    from tessera.session import cut_lineage

    sorted_df = cut_lineage(
        df.orderBy(*order_by)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id()))
    sizes = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    pos_in_part = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (sorted_df.join(F.broadcast(offsets), "_pid")
            .withColumn(index_col, F.coalesce(F.col("_off"), F.lit(0)) + pos_in_part)
            .drop("_pid", "_mid", "_off"))


def ordered_collect(df: DataFrame, keys: list, pos: str, value: str, out: str) -> DataFrame:
    """Regroup exploded ``(keys, pos, value)`` rows into ``value`` arrays in
    ``pos`` order.  collect_list is combined map-side, so the shuffle moves
    about one partial array per key and partition, not one row per element."""
    return (df.groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))))
                 .alias("_pairs"))
            .select(*keys, F.col("_pairs.v").alias(out)))
