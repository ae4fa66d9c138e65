"""Sub-word pieces of words by greedy longest match against a piece table.

The table is a public vocabulary file (its path is a parameter; tokenizers are
not trained here): one base64 piece and its id a line.  A piece that begins with
a space starts a word, the others continue one.  From a word's beginning the
longest matching piece is taken, then the longest from there on; a character
that no piece matches is a piece of its own, without id.  The pieces of a word
joined are the word.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tessera.operators.common import by_slices

TABLE_ROWS = 300_000  # that a piece table may have at most: it is broadcast
KNOWN_WORDS = 50_000  # remembered by a task before it starts afresh


def read_pieces(path: str) -> tuple[dict[str, int], dict[str, int]]:
    """(pieces that start a word, pieces that continue one) with their ids; pieces that are no UTF-8 text are left out."""
    first, later = {}, {}
    with open(path, "rb") as f:
        for n, line in enumerate(f):
            if n >= TABLE_ROWS:
                raise ValueError(f"a piece table of more than {TABLE_ROWS} rows is not broadcast")
            raw, nr = line.split()
            try:
                piece = base64.b64decode(raw).decode()
            except UnicodeDecodeError:
                continue
            if piece[:1] != " ":
                later[piece] = int(nr)
            elif len(piece) > 1:
                first[piece[1:]] = int(nr)
    return first, later


def cut_word(word: str, first: dict[str, int], later: dict[str, int], longest: int) -> list[tuple[str, int | None]]:
    """The word's pieces with their ids."""
    out, at, table = [], 0, first
    while at < len(word):
        n = next((n for n in range(min(longest, len(word) - at), 0, -1) if word[at:at + n] in table), 0)
        out.append((word[at:at + max(n, 1)], table[word[at:at + n]] if n else None))
        at, table = at + max(n, 1), later
    return out


def piece_splitter(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A function from an array of words to array<array<struct<piece,id>>>; a batch's distinct words are cut once."""
    tables = read_pieces(path)
    sent = spark.sparkContext.broadcast((*tables, max((len(x) for t in tables for x in t), default=1)))
    kind = pa.list_(pa.struct([("piece", pa.string()), ("id", pa.int32())]))

    @F.arrow_udf("array<array<struct<piece:string,id:int>>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str | None, list | None] = {None: None}

        def part(words: pa.Array) -> pa.Array:
            if len(known) > KNOWN_WORDS:
                known.clear()
                known[None] = None
            flat = words.flatten().dictionary_encode()
            found = flat.dictionary.to_pylist()
            for w in found:
                if w not in known:
                    known[w] = [{"piece": p, "id": i} for p, i in cut_word(w, *sent.value)]
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))])
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array([known[w] for w in found], kind).take(flat.indices),
                                            mask=words.is_null() if words.null_count else None)

        return by_slices(batches, part)

    return cut
