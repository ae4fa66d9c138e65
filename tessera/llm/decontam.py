"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and items are lower-cased and runs of whitespace become one space.  An
item of m bytes occurs in a text with at most k = floor(rate * m) edits only if
the two share at least t = m + 1 - q - k * q of the item's q-grams on diagonals (text position minus item position) that lie within 2k + 1 of one another.  q is
8 bytes or, for short items, as many as leave t at 1 or more (min(8, m // (k +
1)); the whole item where no edit is allowed and it has up to 8 bytes); items of
one q have an index of their own.  Items of up to 8 bytes have to stand as words,
not inside longer ones.  So a text is filtered in three steps, each sure to keep every
occurrence:

1. its q-grams are looked up in the items' q-grams (read as 64-bit words, first
   through a bitmap), and pairs (text, item) with fewer than t hits go;
2. hits are counted in diagonal bands of width 2(2k + 1) that overlap by half,
   an item position once a band, and bands with fewer than t go;
3. each remaining region is verified by an alignment confined to the band;
   items with at most k edits are contamination.

The texts are only mapped over, whole and without a shuffle.  The items are
shipped in shards of at most ``SHARD_BYTES`` of text (a documented bound; one
pass of the map chain for each shard), so that what is broadcast stays bounded
however many items there are.

Defined cases: a null or empty text is clean; items that are null, empty or
without id match nothing; very long texts are read whole, a block of text holds
one at least; repeated items are each reported;
repeated rows get equal results; an empty table on either side gives clean
rows; other columns pass through, and one named like a result is replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import apart, map_text, table

Q = 8
RATE = 0.1
SHARD_BYTES = 4_000_000
BLOCK = 1_000_000  # text bytes worked on at once
MAP_BITS = 22
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def folded(col):
    """Lower-cased text with runs of whitespace as one space."""
    return F.regexp_replace(F.lower(col), r"\s+", " ")


def qgrams(buf: np.ndarray, q: int = Q) -> np.ndarray:
    """The q bytes from every position, as little-endian words."""
    n = len(buf) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    own = np.concatenate([buf, np.zeros(Q - q, np.uint8)]) if q < Q else np.ascontiguousarray(buf)
    words = np.ndarray((n,), dtype="<u8", buffer=own.data, strides=(1,))
    return words if q == Q else words & np.uint64((1 << (8 * q)) - 1)


def gram_size(m: int, rate: float) -> int:
    """Bytes of the q-grams that find every occurrence of an item of m bytes."""
    return min(Q, m // (int(np.floor(m * rate)) + 1))


class ItemIndex:
    """q-grams of those items of a shard that take grams of q bytes."""

    def __init__(self, items: list[tuple[int, bytes]], rate: float, q: int = Q):
        self.q = q
        items = [(i, b) for i, b in sorted(items) if b and gram_size(len(b), rate) == q]
        self.ids = np.array([i for i, _ in items], np.int64)
        self.text = [b for _, b in items]
        size = np.array([len(b) for b in self.text], np.int64)
        self.size = size
        self.edits = np.floor(size * rate).astype(np.int64)
        self.need = size + 1 - q - self.edits * q
        grams = [qgrams(np.frombuffer(b, np.uint8), q) for b in self.text]
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.place = item[order], place[order]
        self.gram, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        self.map = np.zeros(1 << MAP_BITS, bool)
        self.map[(self.gram * _SPREAD) >> np.uint64(64 - MAP_BITS)] = True

    def hits(self, buf: np.ndarray, offs: np.ndarray):
        """(doc, item, text position in its doc, item position) of all shared q-grams."""
        x = qgrams(buf, self.q)
        at = np.flatnonzero(self.map[(x * _SPREAD) >> np.uint64(64 - MAP_BITS)]) if len(self.gram) else np.zeros(0, int)
        g = np.minimum(np.searchsorted(self.gram, x[at]), max(len(self.gram) - 1, 0))
        real = self.gram[g] == x[at] if len(at) else np.zeros(0, bool)
        at, g = at[real], g[real]
        doc = np.searchsorted(offs, at, "right") - 1
        inside = at + self.q <= offs[doc + 1]
        at, g, doc = at[inside], g[inside], doc[inside]
        times = self.first[g + 1] - self.first[g]
        src = np.repeat(self.first[g] - np.cumsum(times) + times, times) + np.arange(times.sum())
        at, doc = np.repeat(at, times), np.repeat(doc, times)
        return doc, self.item[src], at - offs[doc], self.place[src]

    def regions(self, buf: np.ndarray, offs: np.ndarray):
        """(doc, item, first diagonal) of every band that reaches the item's count."""
        doc, item, dpos, ipos = self.hits(buf, offs)
        n = len(self.ids)
        pair, inv, cnt = np.unique(doc * n + item, return_inverse=True, return_counts=True)
        ok = (cnt >= self.need[pair % n])[inv] if len(pair) else np.zeros(0, bool)
        doc, item, dpos, ipos = doc[ok], item[ok], dpos[ok], ipos[ok]
        step = 2 * self.edits[item] + 1
        band = (dpos - ipos) // step
        doc, item, ipos = (np.concatenate([v, v]) for v in (doc, item, ipos))
        band = np.concatenate([band, band - 1])
        order = np.lexsort((ipos, band, item, doc))
        key = np.stack([doc, item, band, ipos])[:, order]
        new = np.ones(key.shape[1], bool)
        new[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        key = key[:3, new]
        if not key.shape[1]:
            return key
        head = np.ones(key.shape[1], bool)
        head[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
        at = np.flatnonzero(head)
        cnt = np.diff(np.append(at, key.shape[1]))
        key = key[:, at]
        return key[:, cnt >= self.need[key[1]]]


def banded_edits(item: np.ndarray, text: np.ndarray, low: int, width: int) -> int:
    """Fewest edits that turn ``item`` into a substring of ``text`` within diagonals [low, low + width)."""
    m, n = len(item), len(text)
    far = m + 1
    diag = np.arange(low, low + width)
    cur = np.where((diag >= 0) & (diag <= n), 0, far)
    ramp = np.arange(width)
    padded = np.full(n + m + 2 * width + abs(low) + 2, 256, np.int64)
    shift = width + max(0, -low) + 1
    padded[shift:shift + n] = text
    for i in range(m):
        same = padded[shift + low + i:shift + low + i + width] != item[i]
        new = cur + same
        new[:-1] = np.minimum(new[:-1], cur[1:] + 1)
        new = np.minimum.accumulate(new - ramp) + ramp
        end = diag + i + 1
        new[(end < 0) | (end > n)] = far
        cur = np.minimum(new, far)
    return int(cur.min())


def matches(index: ItemIndex, buf: np.ndarray, offs: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
    """(doc, item) -> (edits, region start in the folded text) of verified contamination."""
    found: dict[tuple[int, int], tuple[int, int]] = {}
    tried: set[tuple[int, int]] = set()
    doc, item, band = index.regions(buf, offs)
    for d, i, b in zip(doc.tolist(), item.tolist(), band.tolist()):
        if found.get((d, i), (1, 0))[0] == 0:
            continue
        k, m = int(index.edits[i]), int(index.size[i])
        if m <= Q and not k:  # a short item counts as words of its own, not inside longer ones
            if (d, i) not in tried:
                tried.add((d, i))
                word = rb"(?<![0-9a-z_\x80-\xff])" + re.escape(index.text[i]) + rb"(?![0-9a-z_\x80-\xff])"
                if at := re.search(word, buf[offs[d]:offs[d + 1]].tobytes()):
                    found[d, i] = (0, at.start())
            continue
        step = 2 * k + 1
        lo = max(0, b * step - k)
        hi = min(int(offs[d + 1] - offs[d]), (b + 2) * step + m + k)
        text = buf[offs[d] + lo:offs[d] + hi]
        at = text.tobytes().find(index.text[i])
        if at >= 0:
            found[d, i] = (0, lo + at)
            continue
        low = b * step - k - lo
        e = banded_edits(np.frombuffer(index.text[i], np.uint8), text, low, 2 * step + 2 * k)
        if e <= k and e < found.get((d, i), (k + 1, 0))[0]:
            found[d, i] = (e, lo)
    return found


def shards(items: DataFrame, id_col: str, text_col: str, rate: float, shard_bytes: int):
    """For disjoint parts of the items, each of about ``shard_bytes`` of text, the indexes by gram size."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), folded(F.col(text_col)).alias("t")).where(
        "id is not null and t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-int(total) // shard_bytes))
    for s in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(n)) == s).collect()
        part = [(r["id"], r["t"].encode()) for r in part]
        yield [x for x in (ItemIndex(part, rate, q) for q in range(1, Q + 1)) if len(x.ids)]


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                       item_text: str = "text", rate: float = RATE, shard_bytes: int = SHARD_BYTES,
                       keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with ``contaminated``, ``items`` (ascending ids), ``edits`` and ``starts`` (as items)."""
    names = ("contaminated", "items", "edits", "starts")
    cols = [c for c in (docs.columns if keep is None else keep) if c not in names]
    out = docs.select(*[F.col(f"`{c}`") for c in cols], F.col(text_col).alias("__t"))
    parts = []
    for s, indexes in enumerate(shards(items, item_id, item_text, rate, shard_bytes)):
        shared = [apart(docs.sparkSession, x) for x in indexes]

        def find(buf, offs, shared=shared):
            rows: list[list] = [[] for _ in range(len(offs) - 1)]
            for index in (x.value for x in shared):
                for (d, i), (e, at) in matches(index, buf, offs).items():
                    rows[d].append({"item": int(index.ids[i]), "edits": e, "start": at})
            kind = pa.list_(pa.struct([("item", pa.int64()), ("edits", pa.int32()), ("start", pa.int64())]))
            return [pa.array(rows, kind)]

        parts.append(f"__m{s}")
        out = map_text(out, find, f"__m{s} array<struct<item:long,edits:int,start:long>>", out.columns,
                       folded(F.col("__t")), BLOCK)
    every = F.array_sort(F.concat(*parts))
    return out.select(*[F.col(f"`{c}`") for c in cols], every.alias("__m")).select(
        *[F.col(f"`{c}`") for c in cols], (F.size("__m") > 0).alias("contaminated"), F.col("__m.item").alias("items"),
        F.col("__m.edits").alias("edits"), F.col("__m.start").alias("starts"))


def op8_qgram_lemma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in each whole document, with their edits."""
    return find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                              table(spark, sf_dir, "benchmark"), keep=["doc_id"]).select(
        "doc_id", "contaminated", F.size("items").alias("n_items"), "items", "edits")


QUERIES = {"op8_qgram_lemma": op8_qgram_lemma}
ORACLE_SQL: dict[str, str] = {}
