"""Word counts, top-n vocabulary, id encoding/decoding, word vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.arrays import PAD_ID, UNK_ID, pad_array
from tessera.functions.text import split_space, split_ws
from tessera.operators.common import bounded_broadcast, by_slices, fingerprint, md5_number, ordered_collect

# Reserved vocabulary entries and their ids.
PAD_TOKEN, UNK_TOKEN = "[PAD]", "[UNK]"
FIRST_WORD_ID = 2
# A vocabulary within both bounds (50 MB at most) goes to every task.
NARROW_ROWS, NARROW_TOKEN = 50_000, 1024


def word_count(df: DataFrame, text_col: str = "text", tokens_col: str | None = None) -> DataFrame:
    """(token, cnt) over all rows. Text is split on any whitespace; a slot
    table passes its token array via ``tokens_col``.  Partial + final hash
    aggregation absorbs frequent (skewed) words map-side."""
    toks = F.col(tokens_col) if tokens_col else split_ws(text_col)
    return (df.select(F.explode_outer(toks).alias("token")).where(F.col("token").isNotNull())
            .groupBy("token").agg(F.count(F.lit(1)).alias("cnt")))


def vocabulary(counts: DataFrame, n: int = 10000) -> DataFrame:
    """Top-n tokens by (count desc, token asc); ids start at 2 (0 = PAD, 1 = UNK).
    orderBy+limit plans as TakeOrderedAndProject (n rows per partition), the
    numbering window then runs over at most n rows."""
    top = counts.orderBy(F.desc("cnt"), F.asc("token")).limit(n)
    return top.select(
        "token", "cnt",
        (F.row_number().over(Window.orderBy(F.desc("cnt"), F.asc("token"))) + (FIRST_WORD_ID - 1))
        .cast("int").alias("id"))


def token_table(vocab: DataFrame, vocab_size: int | None) -> pa.Table | None:
    """(token, id) of a vocabulary that is proven small enough to be sent to every task: at most ``NARROW_ROWS``
    rows, no token over ``NARROW_TOKEN`` bytes.  Otherwise None."""
    if vocab_size is None or vocab_size > NARROW_ROWS:
        return None
    short = F.when(F.octet_length("token") <= NARROW_TOKEN, F.col("token")).alias("token")
    rows = vocab.select(short, F.col("id").cast("int").alias("id")).limit(vocab_size).toArrow().combine_chunks()
    return None if rows.column("token").null_count else rows


def _per_list(lists: pa.Array, values: pa.Array) -> pa.Array:
    """``values`` cut like ``lists``."""
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values, mask=lists.is_null() if lists.null_count else None)


def encode(df: DataFrame, key: str, text_col: str, vocab: DataFrame, vocab_size: int | None,
           to_len: int | None = None, out: str = "ids") -> DataFrame:
    """(key, ids): token -> id with UNK default.  Tokens come from a one-space
    split (so an empty token is UNK, as at inference); a null text has no row.

    A vocabulary of proven size is looked up inside the row, by a hash table
    that each task holds: nothing is shuffled.  Any other one meets the tokens
    in a join on two 64-bit hashes."""
    known = token_table(vocab, vocab_size)
    if known is None:
        res = _encode_by_join(df, key, text_col, vocab, out)
    else:
        sent = df.sparkSession.sparkContext.broadcast((known.column("token").to_pylist(), known.column("id").to_numpy()))

        @F.arrow_udf("array<int>")
        def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            words, ids = pa.array(sent.value[0], pa.string()), np.append(sent.value[1], UNK_ID).astype(np.int32)

            def part(tokens: pa.Array) -> pa.Array:
                at = pc.index_in(tokens.flatten(), value_set=words)
                return _per_list(tokens, pa.array(ids[pc.fill_null(at, len(ids) - 1).to_numpy(zero_copy_only=False)]))

            return by_slices(batches, part)

        res = df.where(F.col(text_col).isNotNull()).select(key, lookup(split_space(text_col)).alias(out))
    if to_len is not None:
        res = res.withColumn(out, pad_array(out, to_len, PAD_ID))
    return res


def _encode_by_join(df: DataFrame, key: str, text_col: str, vocab: DataFrame, out: str) -> DataFrame:
    h = fingerprint("token")
    v = vocab.select(h[0].alias("_h"), h[1].alias("_i"), "id")
    exploded = (df.select(key, F.posexplode_outer(split_space(text_col)).alias("pos", "token"))
                .where(F.col("pos").isNotNull()).select(key, "pos", h[0].alias("_h"), h[1].alias("_i")))
    joined = exploded.join(v, ["_h", "_i"], "left").select(key, "pos", F.coalesce("id", F.lit(UNK_ID)).alias("id"))
    return ordered_collect(joined, [key], "pos", "id", out)


def decode(df: DataFrame, key: str, ids_col: str, vocab: DataFrame, vocab_size: int | None,
           out: str = "tokens") -> DataFrame:
    """(key, tokens): id -> token, special ids (PAD/UNK and anything < 2) and unknown ids dropped.

    As in ``encode``, a vocabulary of proven size is looked up inside the row."""
    known = token_table(vocab.where(F.col("id") >= FIRST_WORD_ID), vocab_size)
    if known is None:
        exploded = df.select(key, F.posexplode(ids_col).alias("pos", "id"))
        joined = exploded.join(vocab.select("token", "id").where(F.col("id") >= FIRST_WORD_ID), "id", "left")
        kept = F.when(F.col("token").isNotNull(), F.struct(F.col("pos").alias("p"), F.col("token").alias("v")))
        return (joined.groupBy(key).agg(F.sort_array(F.collect_list(kept)).alias("_pairs"))
                .select(key, F.col("_pairs.v").alias(out)))
    sent = df.sparkSession.sparkContext.broadcast((known.column("token").to_pylist(), known.column("id").to_pylist()))

    @F.arrow_udf("array<string>")
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, known_ids = pa.array(sent.value[0], pa.string()), pa.array(sent.value[1], pa.int32())

        def part(ids: pa.Array) -> pa.Array:
            return _per_list(ids, words.take(pc.index_in(ids.flatten().cast(pa.int32()), value_set=known_ids)))

        return by_slices(batches, part)

    tokens = F.filter(lookup(F.col(ids_col).cast("array<int>")), lambda t: t.isNotNull())
    return df.where(F.size(ids_col) > 0).select(key, tokens.alias(out))


def oov_tokens(counts: DataFrame, vocab: DataFrame, vocab_size: int | None) -> DataFrame:
    """Tokens (with counts) that are not in the vocabulary (anti join)."""
    return counts.join(bounded_broadcast(vocab.select("token"), vocab_size), "token", "left_anti")


def vocab_coverage(vocab: DataFrame, vectors: DataFrame) -> DataFrame:
    """matched / total where total counts PAD and UNK too (as the reference)."""
    have = vectors.select("token").distinct().withColumn("_hit", F.lit(1))
    return (vocab.select("token").join(have, "token", "left")
            .agg((F.count(F.lit(1)) + 2).alias("n_total"), F.count("_hit").alias("n_matched"))
            .select("n_total", "n_matched",
                    (F.col("n_matched") / F.col("n_total")).alias("coverage")))


def parse_word_vectors(lines: DataFrame, value_col: str = "value", order_col: str | None = None,
                       vocab: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Word-vector text lines -> (vectors, rejects).

    With ``order_col`` (line order) the FIRST line is skipped if it is a header
    ``N d``; any other line of that shape is a vector of one dimension.  Without
    it the lines are taken to have no header.  Fields are split on one space; a
    field that is not a float routes the line to the reject table instead of
    aborting the job.  A repeated word keeps its last line, and with ``vocab``
    only words of the vocabulary stay (semi join)."""
    body = lines.select(F.col(value_col).alias("line"), (F.col(order_col) if order_col else F.lit(0)).alias("_no"))
    if order_col:
        head = body.select(F.min("_no")).scalar()
        body = body.where(~((F.col("_no") == head) & F.col("line").rlike(r"^[0-9]+ [0-9]+\s*$")))
    parts = body.select(F.split(F.regexp_replace("line", r"\s+$", ""), " ", -1).alias("f"), "line", "_no")
    parsed = parts.select(
        F.col("f")[0].alias("token"),
        F.transform(F.slice("f", 2, F.size("f")), lambda x: x.try_cast("float")).alias("vector"),
        "line", "_no")
    bad = F.exists("vector", lambda x: x.isNull())
    good = parsed.where(~bad)
    if vocab is not None:
        good = good.join(vocab.select("token"), "token", "left_semi")
    good = good.groupBy("token").agg(F.max_by("vector", "_no").alias("vector"))
    return good, parsed.where(bad).select("line")


def check_dims(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """Data-quality aggregate: rows, distinct dims, rows off the expected dim."""
    size = F.size("vector")
    expected = F.lit(dim) if dim is not None else None
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.min(size).alias("min_dim"), F.max(size).alias("max_dim")]
    if expected is not None:
        aggs.append(F.count_if(size != expected).alias("n_bad"))
    return vectors.agg(*aggs)


def embedding_matrix(vocab: DataFrame, vectors: DataFrame, dim: int, seed: int = 13,
                     vocab_size: int | None = None) -> DataFrame:
    """One vector per vocabulary id (PAD and UNK included): the word's vector
    when present, else a deterministic pseudo-random vector in [-1, 1)
    derived from (token, dimension, seed) - partition-independent."""
    specials = vocab.sparkSession.createDataFrame(
        [(PAD_TOKEN, PAD_ID), (UNK_TOKEN, UNK_ID)], "token string, id int")
    ids = vocab.select("token", "id").unionByName(specials)
    joined = ids.join(vectors.select("token", "vector"), "token", "left")
    rand_vec = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda d: ((md5_number(F.concat_ws(":", F.lit(seed), "token", d)) % 1048576).cast("double")
                   / F.lit(1048576.0) * F.lit(2.0) - F.lit(1.0)).cast("float"))
    return joined.select("id", "token", F.coalesce("vector", rand_vec).alias("vector"),
                         F.col("vector").isNotNull().alias("matched"))
