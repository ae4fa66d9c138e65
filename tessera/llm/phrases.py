"""Phrases of two to four words by HAT-trie counting.

A phrase is a path of word ids; its id is a 64-bit hash of the ids of its first
and last parts (all words but the last, all but the first), so every level's
table names a phrase by two phrases of the level below.  The upper 20 bits of an
id come from the first two words: they are the prefix that data is dealt by.

1. Words are counted for each language; a narrow map counts a task's words
   before anything is shuffled.
2. Level by level, two to four words: only phrases whose both parts were counted
   often enough can be, so the ids of the level below go out as a Bloom filter
   of at most ``BLOOM_BITS`` bits (16 MB, whatever their number; a false
   positive costs work, never a result).  A task counts the rest in a trie over
   the id's upper bits whose leaves are hash containers: arrays of keys and
   counts, merged by hash when they grow, that burst into sixteen children beyond
   ``BURST`` keys.  When the trie holds ``BUDGET`` keys its largest subtrees are
   spilled whole, each as one sorted run a prefix partition.
3. Runs meet by prefix partition and are merged there; a partition is about a
   million words of text, and a run holds a key once, so that a hot word, phrase
   or passage is a key a task and not a row an occurrence.  At most one row a
   key crosses the shuffle, fewer where runs hold many.
4. Words, part counts and parts of the frequent phrases come from the tables of
   the level below by joins on the two part ids.

Keys are compared on both part ids (128 bits) when runs are merged.

Defined cases: a null text is empty, a null language is ``und``; texts are read
whole, whatever their length (a block of text holds one at least); repeated rows
count as often as they stand there; ties in score and count go to the phrase of
smaller UTF-8 bytes; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.base import stored, table
from tessera.llm.textvec import Words, cut, mix, text_block

BURST = 1 << 16          # keys of a container before it bursts
BUDGET = 1 << 21         # keys of a task's trie before subtrees are spilled
FAN = 4                  # id bits a trie level
PREFIX_BITS = 20         # of an id that come from the first two words
SLOT_TOKENS = 1 << 20    # words of text for each prefix partition
BLOOM_BITS = 1 << 27
WORD_ROWS = 1 << 19      # distinct words a task holds before it passes them on

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _byte_map() -> np.ndarray:
    """Lower case for A-Z; every byte that ends a piece becomes a line feed."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    t[[*b".,;:!?", 11, 12, 13]] = 10
    return t


def _lang_hash(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    each = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
            for x in coded.dictionary.to_pylist()]
    return np.array(each, np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]


def words_of(part: pa.RecordBatch, letters: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of a block (columns lang, text), their ids, and which word is followed by one of its own piece."""
    buf, offs = text_block(part.column(1))
    buf = letters[buf]
    w = Words(buf, offs)
    ids = mix(w.hashes() + _lang_hash(part.column(0))[w.doc]) if len(w.start) else np.zeros(0, np.uint64)
    breaks = np.cumsum(buf == 10, dtype=np.int32)[w.start] if len(buf) else np.zeros(0, np.int32)
    joined = (w.doc[1:] == w.doc[:-1]) & (breaks[1:] == breaks[:-1])
    return w, ids, joined


def phrase_id(first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    h = mix(first * _STEP + mix(last))
    if length == 2:
        return h
    keep = np.uint64(((1 << PREFIX_BITS) - 1) << (64 - PREFIX_BITS))
    return (first & keep) | (h >> np.uint64(PREFIX_BITS))


def _among(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the Bloom filter has both bits of each id."""
    mask = np.uint64(len(bits) * 64 - 1)

    def has(p):
        p = p & mask
        return (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) > 0

    return has(ids) & has(ids >> np.uint64(32))


def occurrences(ids: np.ndarray, joined: np.ndarray, filters: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(id, first, last) of every phrase of ``len(filters) + 1`` words whose parts may all be frequent."""
    at = np.arange(len(ids))
    for length, bits in enumerate(filters, start=2):
        ok = _among(ids, bits)
        at, ids = at[ok], ids[ok]
        next_to = at[1:] == at[:-1] + 1
        if length == 2:
            next_to &= joined[at[:-1]] if len(joined) else False
        pick = np.flatnonzero(next_to)
        first, last = ids[pick], ids[pick + 1]
        at, ids = at[pick], phrase_id(first, last, length)
    return ids, first, last


def add_up(ids, first, last, n) -> tuple[np.ndarray, ...]:
    """Distinct keys in id order with their counts."""
    order = np.argsort(ids, kind="stable")  # merges what is sorted already
    ids, first, last, n = ids[order], first[order], last[order], n[order]
    if not len(ids):
        return ids, first, last, n
    new_id = np.ones(len(ids), bool)
    new_id[1:] = ids[1:] != ids[:-1]
    new = new_id.copy()
    new[1:] |= (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    if new.sum() != new_id.sum():  # two keys of one id
        order = np.lexsort((last, first, ids))
        ids, first, last, n = ids[order], first[order], last[order], n[order]
        new[1:] = (ids[1:] != ids[:-1]) | (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    at = np.flatnonzero(new)
    return ids[at], first[at], last[at], np.add.reduceat(n, at)


class Container:
    """A leaf of the trie: keys with counts, added up by hash whenever they have doubled."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.size = self.tidy = 0

    def add(self, keys: tuple) -> None:
        self.parts.append(keys)
        self.size += len(keys[0])
        if self.size > 2 * max(self.tidy, 256):
            self.merge()

    def merge(self) -> tuple:
        if len(self.parts) > 1:
            self.parts = [add_up(*(np.concatenate(x) for x in zip(*self.parts)))]
        self.size = self.tidy = len(self.parts[0][0])
        return self.parts[0]


class HatTrie:
    """Phrase counts under the upper bits of their ids; inner nodes are lists of children, leaves containers."""

    def __init__(self, burst: int, budget: int):
        self.burst, self.budget = burst, budget
        self.root: list = [Container() for _ in range(1 << FAN)]

    def add(self, keys: tuple) -> None:
        """Keys distinct and in id order."""
        self._down(self.root, keys, 64 - FAN)

    def _down(self, node: list, keys: tuple, shift: int) -> None:
        child = (keys[0] >> np.uint64(shift)) & np.uint64((1 << FAN) - 1)
        ends = np.searchsorted(child, np.arange(len(node) + 1))
        for i in np.flatnonzero(np.diff(ends)):
            part = tuple(x[ends[i]:ends[i + 1]] for x in keys)
            if isinstance(node[i], list):
                self._down(node[i], part, shift - FAN)
                continue
            node[i].add(part)
            if node[i].size > self.burst and shift > 64 - PREFIX_BITS:
                whole = node[i].merge()
                if len(whole[0]) > self.burst:
                    node[i] = [Container() for _ in range(1 << FAN)]
                    self._down(node[i], whole, shift - FAN)

    def leaves(self, node) -> Iterator[Container]:
        if isinstance(node, Container):
            yield node
        else:
            for child in node:
                yield from self.leaves(child)

    def sizes(self) -> list[int]:
        return [sum(x.size for x in self.leaves(child)) for child in self.root]

    def spill(self, left: int) -> Iterator[tuple]:
        """Whole subtrees, largest first, as sorted keys until at most ``left`` keys stay."""
        sizes = self.sizes()
        for i in np.argsort(sizes)[::-1]:
            if sum(sizes) <= left or not sizes[i]:
                break
            parts = [x.merge() for x in self.leaves(self.root[i]) if x.size]
            sizes[i], self.root[i] = 0, Container()
            yield tuple(np.concatenate(x) for x in zip(*parts))


def _counts_out(n: np.ndarray) -> bytes:
    width = next(w for w in (1, 2, 4, 8) if w == 8 or n.max(initial=0) < 1 << (8 * w))
    return bytes([width]) + n.astype(f"<u{width}").tobytes()


def pack(keys: tuple, slot_bits: int) -> pa.RecordBatch:
    """One row for each prefix partition: its part of a sorted run."""
    ids, first, last, n = keys
    slot = (ids >> np.uint64(64 - slot_bits)).astype(np.int64) if slot_bits else np.zeros(len(ids), np.int64)
    at = np.flatnonzero(np.diff(slot, prepend=-1))
    ends = np.append(at[1:], len(ids))
    runs = [first[a:b].astype("<u8").tobytes() + last[a:b].astype("<u8").tobytes() + _counts_out(n[a:b])
            for a, b in zip(at, ends)]
    return pa.RecordBatch.from_arrays([pa.array(slot[at].astype(np.int32)), pa.array((ends - at).astype(np.int32)),
                                       pa.array(runs, pa.binary())], names=["slot", "n", "run"])


def unpack(n: int, run: bytes, length: int) -> tuple[np.ndarray, ...]:
    first, last = np.frombuffer(run, "<u8", n), np.frombuffer(run, "<u8", n, offset=8 * n)
    count = np.frombuffer(run, f"<u{run[16 * n]}", n, offset=16 * n + 1).astype(np.int64)
    return phrase_id(first, last, length), first, last, count


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, id, f), stored; ``docs`` has lang and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _byte_map()
        held: list[tuple] = []
        size = 0

        def out():
            ids = np.concatenate([x[0] for x in held])
            n = np.concatenate([x[1] for x in held])
            order = np.argsort(ids, kind="stable")
            at = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] ^ np.uint64(1)))
            total = np.add.reduceat(n[order], at)
            pick = pa.array(order[at])
            lang = pa.concat_arrays([x[2] for x in held]).take(pick)
            word = pa.concat_arrays([x[3] for x in held]).take(pick)
            held.clear()
            return pa.RecordBatch.from_arrays([lang, word, pa.array(ids[order[at]].view(np.int64)), pa.array(total)],
                                              names=["lang", "word", "id", "n"])

        for batch in batches:
            for part in cut(batch, "text"):
                w, ids, _ = words_of(part, letters)
                if not len(ids):
                    continue
                _, at, n = np.unique(ids, return_index=True, return_counts=True)
                long = w.end[at] - w.start[at]
                offs = np.concatenate([[0], np.cumsum(long)])
                data = w.buf[np.repeat(w.start[at] - offs[:-1], long) + np.arange(offs[-1])]
                word = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offs.astype(np.int64).tobytes()),
                                                                          pa.py_buffer(data.tobytes())]).cast(pa.string())
                held.append((ids[at], n, part.column(0).take(pa.array(w.doc[at])), word))
                size += len(at)
                if size > WORD_ROWS:
                    yield out()
                    size = 0
        if held:
            yield out()

    rows = docs.mapInArrow(run, "lang string, word string, id long, n long")
    return stored(rows.groupBy("lang", "word", "id").agg(F.sum("n").alias("f")))


def bloom(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of the long column ``id``: two bits an id, at most ``BLOOM_BITS`` in all."""
    bits = 1 << 16
    n = ids.count()
    while bits < 16 * n and bits < BLOOM_BITS:
        bits *= 2
    at = ids.select(F.explode(F.array(F.col("id"), F.shiftrightunsigned("id", 32))).alias("p"))
    at = at.select(F.col("p").bitwiseAND(F.lit(bits - 1)).alias("p"))
    cells = (at.select(F.shiftright("p", 6).alias("cell"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bits"))).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out.view(np.uint64)


def phrase_counts(docs: DataFrame, filters: list, slot_bits: int, least: int) -> DataFrame:
    """(id, first, last, f) of the phrases of ``len(filters) + 1`` words that occur at least ``least`` times."""
    length, burst, budget = len(filters) + 1, BURST, BUDGET

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, bits = _byte_map(), [x.value for x in filters]
        trie = HatTrie(burst, budget)
        size = 0
        for batch in batches:
            for part in cut(batch, "text"):
                _, ids, joined = words_of(part, letters)
                ids, first, last = occurrences(ids, joined, bits)
                keys = add_up(ids, first, last, np.ones(len(ids), np.int64))
                trie.add(keys)
                size += len(keys[0])
                if size > budget:
                    size = sum(trie.sizes())
                    if size > budget:
                        for run in trie.spill(budget // 2):
                            yield pack(run, slot_bits)
                        size = sum(trie.sizes())
        for run in trie.spill(0):
            yield pack(run, slot_bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, tidy = None, [], 0, 0

        def out():
            ids, first, last, n = add_up(*(np.concatenate(x) for x in zip(*held)))
            ok = n >= least
            return pa.RecordBatch.from_arrays([*(pa.array(x[ok].view(np.int64)) for x in (ids, first, last)), pa.array(n[ok])],
                                              names=["id", "first", "last", "f"])

        for batch in batches:
            for slot, n, run in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if slot != now and held:
                    yield out()
                    held, size, tidy = [], 0, 0
                now = slot
                held.append(unpack(n, run, length))
                size += n
                if size > 2 * max(tidy, budget):
                    held = [add_up(*(np.concatenate(x) for x in zip(*held)))]
                    size = tidy = len(held[0][0])
        if held:
            yield out()

    runs = docs.mapInArrow(count, "slot int, n int, run binary")
    return runs.repartition("slot").sortWithinPartitions("slot").mapInArrow(merge, "id long, first long, last long, f long")


def _named(found: DataFrame, below: DataFrame, length: int) -> DataFrame:
    """id, lang, f, words, lefts and rights (counts of the parts from either end, by length), subs (ids of parts)."""
    p = below.select(F.col("id").alias("first"), "lang", F.col("words").alias("pw"), F.col("lefts").alias("pl"),
                     F.col("subs").alias("ps"))
    s = below.select(F.col("id").alias("last"), F.col("words").alias("sw"), F.col("rights").alias("sr"),
                     F.col("subs").alias("ss"))
    subs = F.array().cast("array<long>") if length == 2 else F.array_distinct(
        F.concat(F.array("first", "last"), "ps", "ss"))
    return (found.join(p, "first").join(s, "last")
            .select("id", "lang", "f", F.concat("pw", F.slice("sw", -1, 1)).alias("words"),
                    F.concat("pl", F.array("f")).alias("lefts"), F.concat("sr", F.array("f")).alias("rights"),
                    subs.alias("subs")))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 4, least: int = 30,
                 cover: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases.

    A candidate occurs ``least`` times or more; its score is that of its weakest
    cut; one that stands in a longer candidate ``cover`` per cent of the time is left out.
    """
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    words = word_counts(src)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    tokens = sum(r["n"] for r in totals.collect()) if longest > 1 else 0  # a row a language
    slot_bits = min(PREFIX_BITS, max(0, -(-tokens // SLOT_TOKENS) - 1).bit_length())
    level = words.where(F.col("f") >= least).select(
        "id", "lang", "f", F.array("word").alias("words"), F.array("f").alias("lefts"), F.array("f").alias("rights"),
        F.array().cast("array<long>").alias("subs"))
    filters, found = [], None
    for length in range(2, longest + 1):
        filters.append(spark.sparkContext.broadcast(bloom(level.select("id"))))
        level = stored(_named(phrase_counts(src, filters, slot_bits, least), level, length))
        found = level if found is None else found.unionByName(level)
    covered = (found.select(F.explode("subs").alias("id"), F.col("f").alias("g")).groupBy("id")
               .agg(F.max("g").alias("g")))
    big = "decimal(38,0)"
    left = (found.join(covered, "id", "left")
            .where(F.col("g").isNull() | (F.lit(100).cast(big) * F.col("g").cast("decimal(20,0)")
                                          < F.lit(cover).cast(big) * F.col("f").cast("decimal(20,0)"))))
    cuts = F.array_min(F.expr("""transform(sequence(1, size(words) - 1), k -> named_struct(
        'score', (2000000 * cast(f as decimal(20,0))) div (cast(lefts[k - 1] as decimal(20,0)) + rights[size(words) - k - 1]),
        'k', k, 'l', lefts[k - 1], 'r', rights[size(words) - k - 1]))"""))
    scored = (left.withColumn("cut", cuts)
              .select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), F.col("cut.l").alias("l"),
                      F.col("cut.r").alias("r"), F.col("cut.score").alias("score")))
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are ranked in parts first, so that one task sees at most 64 * top of them
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = (scored.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
            .where(F.col("rank") <= top).drop("part"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    return (ranked.where(F.col("rank") <= top).join(F.broadcast(totals), "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op11_phrases": op11_phrases}
ORACLE_SQL = {"op11_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM pieces),
g AS (
  SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(ws) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY 1),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 30),
parts AS (
  SELECT lang, phrase, a, k, lang || chr(10) || array_to_string(ws[1:k], ' ') AS head,
    lang || chr(10) || array_to_string(ws[k + 1:], ' ') AS tail FROM c, (SELECT unnest([1, 2, 3]) AS k) WHERE k < m),
keyed AS MATERIALIZED (SELECT lang || chr(10) || phrase AS key, f FROM f WHERE f >= 30),
heads AS MATERIALIZED (SELECT p.*, x.f AS l FROM parts p JOIN keyed x ON x.key = p.head),
cuts AS (
  SELECT h.lang, h.phrase, h.a, k, l, y.f AS r, (2000000::HUGEINT * h.a // (l + y.f))::BIGINT AS score
  FROM heads h JOIN keyed y ON y.key = h.tail),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sub AS (
  SELECT lang, a, array_to_string(ws[i:i + s - 1], ' ') AS phrase
  FROM c, (SELECT unnest([2, 3]) AS s), (SELECT unnest([1, 2, 3]) AS i) WHERE s < m AND i + s - 1 <= m),
gone AS (SELECT lang, phrase, max(a) AS g FROM sub GROUP BY 1, 2),
r AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM worst w LEFT JOIN gone USING (lang, phrase) WHERE g IS NULL OR 100 * g < 80 * a)
SELECT r.lang, rank::INTEGER AS rank, r.phrase, a, l, r.r, n.n, score FROM r JOIN n USING (lang) WHERE rank <= 2000"""}
