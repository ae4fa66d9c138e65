"""Token offsets, overlapping context windows and answer token spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tessera.functions.arrays import index_range
from tessera.functions.text import split_ws
from tessera.operators.common import list_lengths, slices_of

# The characters of Unicode's White_Space property.
WHITESPACE = [*"\t\n\x0b\x0c\r \x85\xa0\u1680", *(chr(c) for c in range(0x2000, 0x200B)),
              *"\u2028\u2029\u202f\u205f\u3000"]


def whitespace_bytes(buf: np.ndarray) -> np.ndarray:
    """Which bytes of a UTF-8 buffer belong to a whitespace character."""
    table = np.zeros(256, bool)
    table[[ord(c) for c in WHITESPACE if ord(c) < 128]] = True
    out = table[buf]
    for c in (c.encode() for c in WHITESPACE if ord(c) >= 128):
        at = np.flatnonzero(buf[:len(buf) - len(c) + 1] == c[0]) if len(buf) >= len(c) else np.zeros(0, np.int64)
        for i, b in enumerate(c[1:], 1):
            at = at[buf[at + i] == b]
        for i in range(len(c)):
            out[at + i] = True
    return out


BLOCK_BYTES = 1_000_000  # text bytes scanned at once: a pass over them needs some 50 bytes for each


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of a string array of at most ``limit`` bytes, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + limit, "right")))
        yield texts.slice(i, j - i)
        i = j


def scan_tokens(texts: pa.Array, limit: int = BLOCK_BYTES) -> pa.Array:
    """Whitespace tokens' code-point offsets, list<struct<s, e>> for each text, block by block."""
    done = [_scan_block(x) for x in blocks(texts, limit)]
    return pa.concat_arrays(done) if done else _scan_block(texts)


def _scan_block(texts: pa.Array) -> pa.Array:
    """A few passes over the bytes."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offs = np.frombuffer(texts.buffers()[1], np.int64, n + 1, offset=8 * texts.offset) if n else np.zeros(1, np.int64)
    data = texts.buffers()[2] if n else None
    buf = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]] if data is not None else np.zeros(0, np.uint8)
    offs = offs - offs[0]
    word = ~whitespace_bytes(buf)
    edge = offs[:-1][np.diff(offs) > 0]
    before = np.concatenate([[False], word[:-1]]) if len(buf) else word
    before[edge] = False
    after = np.concatenate([word[1:], [False]]) if len(buf) else word
    after[edge[1:] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])  # characters before each byte
    first = np.searchsorted(starts, offs)
    base = np.repeat(chars[offs[:-1]], np.diff(first))
    pairs = pa.StructArray.from_arrays([pa.array((chars[x] - base).astype(np.int32)) for x in (starts, ends)], names=["s", "e"])
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pairs, mask=texts.is_null() if texts.null_count else None)


def offsets_of(text: Column) -> Column:
    """array<struct<s,e>> of a text's whitespace tokens, by an Arrow-batched byte scan."""
    @F.arrow_udf("array<struct<s:int,e:int>>")
    def scan(t: pa.Array) -> pa.Array:
        return scan_tokens(t)

    return scan(text)


def token_offsets(df: DataFrame, key: str, text_col: str = "text", tokens: bool = True) -> DataFrame:
    """(key, tokens array<string>, offsets array<struct<s,e>>): whitespace tokens
    with code-point offsets, all inside the row: no shuffle, no window, and
    linear in the text's bytes.  Without ``tokens`` only the offsets, block by
    block: a column function keeps the rows of its whole Arrow batches, on disk
    where memory is short."""
    if tokens:
        return df.select(key, split_ws(text_col).alias("tokens"), offsets_of(F.col(text_col)).alias("offsets"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for texts in blocks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(done, len(texts)), _scan_block(texts)], names=[key, "offsets"])
                done += len(texts)

    spans = StructType([StructField(c, IntegerType()) for c in ("s", "e")])
    return df.select(key, F.col(text_col).alias("_text")).mapInArrow(
        scan, StructType([df.select(key).schema[0], StructField("offsets", ArrayType(spans))]))


def token_rows(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """One row per whitespace token: (key, pos, token, s, e) with code-point offsets."""
    tok = token_offsets(df, key, text_col)
    return (tok.select(key, F.posexplode_outer(F.arrays_zip("tokens", "offsets")).alias("pos", "x"))
            .where(F.col("pos").isNotNull())
            .select(key, "pos", F.col("x.tokens").alias("token"), F.col("x.offsets.s").alias("s"),
                    F.col("x.offsets.e").alias("e")))


def context_windows(tok: DataFrame, key: str, w: int, overlap: int, keep: tuple = (),
                    finish: tuple[list[StructField], Callable] | None = None) -> DataFrame:
    """Overlapping windows of ``w`` tokens sharing ``overlap`` tokens:
    (key, window, first_tok, n_tok, start_char, end_char); an empty context
    gives one empty window [0, 0).  Each window is cut out of the row's arrays,
    so a window row carries its own tokens only; ``keep`` names the arrays
    (``offsets``, ``tokens``) whose slices come along.  Cut in an Arrow map, some
    texts at a time: a slice inside a lambda would copy the whole text's array
    for each window, and a column function keeps all its rows' arrays until the
    batch returns.  ``finish``: fields and a function that makes them from a
    dict of the window columns, in the same pass."""
    if not 0 <= overlap < w:
        raise ValueError("need 0 <= overlap < w")
    spans = tok.schema["offsets"].dataType
    kept = [StructField(c, tok.schema[c].dataType) for c in keep]
    window = [tok.select(key).schema[0], *(StructField(c, IntegerType()) for c in ("win", "first_tok", "n_tok")),
              StructField("start_char", spans.elementType["s"].dataType),
              StructField("end_char", spans.elementType["e"].dataType), *kept]
    fields, made = finish or (window, None)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = dict(zip(read, b.columns))
            for i, j in slices_of(list_lengths(cols["offsets"])):
                rows = _cut_windows({c: x.slice(i, j - i) for c, x in cols.items()}, key, w, overlap, keep)
                rows = made(rows) if made else rows
                yield pa.RecordBatch.from_arrays([rows[f.name] for f in fields], names=[f.name for f in fields])

    read = [key, "offsets", *(c for c in keep if c != "offsets")]
    return tok.select(*read).mapInArrow(cut, StructType(fields))


def _cut_windows(cols: dict[str, pa.Array], key: str, w: int, overlap: int, keep: tuple) -> dict[str, pa.Array]:
    """The windows of all rows, linear in their tokens."""
    offsets, step = cols["offsets"], w - overlap
    n = list_lengths(offsets)
    count = 1 + (np.maximum(n - w, 0) + step - 1) // step
    row = np.repeat(np.arange(len(n)), count)
    win = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = win * step
    size = np.clip(n[row] - first, 0, w)
    bounds = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))

    def edge(field, at):
        ends = pc.struct_field(offsets.values, field)
        return pc.fill_null(ends.take(pa.array(offsets.offsets.to_numpy()[:-1][row] + at, mask=size == 0)), 0)

    def part(c):
        lists = cols[c]
        at = np.repeat(lists.offsets.to_numpy()[:-1].astype(np.int64)[row] + first - bounds.to_numpy()[:-1], size) + np.arange(size.sum())
        return pa.ListArray.from_arrays(bounds, lists.values.take(pa.array(at)))

    out = {key: cols[key].take(pa.array(row))}
    out |= {c: pa.array(x.astype(np.int32)) for c, x in (("win", win), ("first_tok", first), ("n_tok", size))}
    return out | {"start_char": edge("s", first), "end_char": edge("e", first + size - 1)} | {c: part(c) for c in keep}


def answer_token_span(tok: DataFrame, answers: DataFrame, key: str, w: int, overlap: int) -> DataFrame:
    """Label each window with the answer's token span (CLS = index 0, window
    tokens from 1).  Window tokens covering [start_char, end_char) must fully
    contain the answer, else (0, 0).  ``answers``: key, a_start, a_end."""
    j = context_windows(tok, key, w, overlap, keep=("offsets",)).join(answers, key)
    span = F.col("offsets")
    inside = (F.col("n_tok") > 0) & (F.col("start_char") <= F.col("a_start")) & (F.col("end_char") >= F.col("a_end"))
    idx = index_range(F.size(span))
    st = F.array_max(F.filter(idx, lambda i: span[i]["s"] <= F.col("a_start")))
    en = F.array_min(F.filter(idx, lambda i: span[i]["e"] >= F.col("a_end")))
    return j.select(key, "win", F.when(inside, st + 1).otherwise(F.lit(0)).alias("start_position"),
                    F.when(inside, en + 1).otherwise(F.lit(0)).alias("end_position"))
