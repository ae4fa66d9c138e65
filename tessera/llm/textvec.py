"""Vectorised text primitives used inside Arrow map tasks.

A block is one UTF-8 byte buffer holding several texts plus their offsets.
Words, word hashes, shingles and character n-grams of a whole block come from
a handful of numpy passes, with no Python object per word.  Blocks are cut by
bytes, never inside a text, so a text is always seen whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 3_000_000
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _byte_table() -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def _space_table() -> np.ndarray:
    t = np.ones(256, dtype=bool)
    t[[32, 9, 10, 11, 12, 13]] = False
    return t


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Scratch(dict):
    """Tables of one process; travels empty when a function is sent to a task."""

    def __reduce__(self):
        return (_Scratch, ())


_CACHE = _Scratch()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of them."""
    have = _CACHE.get("pow")
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 20)  # as much as the blocks at hand need: the tables stay with the worker
        inv = pow(_BASE, -1, 1 << 64)
        out = []
        for base in (_BASE, inv):
            a = np.full(size, base & _MASK, dtype=np.uint64)
            a[0] = 1
            out.append(np.cumprod(a, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 4 * BLOCK_BYTES:
            _CACHE["pow"] = have
    return have


def text_block(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null is an empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8)[offs[0]:offs[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def cut(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES):
    """Slices of a batch of at most ``limit`` text bytes (one row at least)."""
    col = batch.column(batch.schema.get_field_index(text))
    size = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    i, n = 0, batch.num_rows
    while i < n:
        base = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(i, j - i)
        i = j


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    if "low" not in _CACHE:
        _CACHE["low"] = _lower_table()
    return _CACHE["low"][buf]


class Words:
    """Words (runs of bytes other than ASCII whitespace) of a block.

    ``start``/``end`` are byte positions, ``doc`` the text each word is in,
    ``first`` the index of each text's first word (one more entry than texts).
    """

    def __init__(self, buf: np.ndarray, offs: np.ndarray, hashed: bool = True):
        if "ws" not in _CACHE:
            _CACHE["ws"], _CACHE["byte"] = _space_table(), _byte_table()
        self.buf, self.offs, n = buf, offs, len(buf)
        inside = _CACHE["ws"][buf]
        if n:
            before = np.empty(n, bool)
            before[0] = False
            before[1:] = inside[:-1]
            edge = offs[:-1][np.diff(offs) > 0]
            before[edge] = False
            self.start = np.flatnonzero(inside & ~before)
            after = np.empty(n, bool)
            after[-1] = False
            after[:-1] = inside[1:]
            after[edge[1:] - 1] = False
            self.end = np.flatnonzero(inside & ~after) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, offs)
        self.doc = np.repeat(np.arange(len(offs) - 1), np.diff(self.first))
        if hashed:
            self.pow, self.inv = powers(n + 1)
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_CACHE["byte"][buf] * self.pow[:n], out=sums[1:])
            self.sums = sums

    def gram(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed hash of the byte ranges [start, end)."""
        return (self.sums[end] - self.sums[start]) * self.inv[start] + (end - start).astype(np.uint64)

    def hashes(self) -> np.ndarray:
        return mix(self.gram(self.start, self.end))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def shingles(words: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of every run of k words; a text of fewer words is one run; a text without words has none."""
    n = len(h)
    cnt = words.counts()
    out_doc, out = [], []
    if n >= k:
        acc = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            acc = acc * np.uint64(0xD1342543DE82EF95) + h[j:n - k + 1 + j]
        ok = words.doc[:n - k + 1] == words.doc[k - 1:]
        out_doc.append(words.doc[:n - k + 1][ok])
        out.append(mix(acc[ok]))
    few = np.flatnonzero((cnt > 0) & (cnt < k))
    if len(few):
        acc = np.zeros(len(few), np.uint64)
        for j in range(k - 1):
            has = cnt[few] > j
            acc[has] = acc[has] * np.uint64(0xD1342543DE82EF95) + h[words.first[few][has] + j]
        out_doc.append(few)
        out.append(mix(acc + cnt[few].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, hs = np.concatenate(out_doc), np.concatenate(out)
    if len(out) > 1:
        order = np.argsort(doc, kind="stable")
        doc, hs = doc[order], hs[order]
    return doc, hs


def by_doc(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """Order that puts equal (doc, hash) pairs side by side, documents ascending.

    One sort of a packed key: the document above the hash's upper 44 bits.
    """
    if n_docs < 1 << 20:
        return np.argsort((doc.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    return np.lexsort((h, doc))


def distinct_pairs(doc: np.ndarray, h: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, hash) pairs, documents ascending."""
    order = by_doc(doc, h, n_docs)
    doc, h = doc[order], h[order]
    if len(doc):
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
        doc, h = doc[new], h[new]
    return doc, h


def seg_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive entries of ``first`` (empty ranges give 0)."""
    c = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return c[first[1:]] - c[first[:-1]]
