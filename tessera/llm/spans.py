"""Substring dedup by sliding sentence spans.

A text is cut into sentences: after ``.``, ``!`` or ``?`` before whitespace, at
blank lines (a single line break is whitespace, so that a passage wrapped at
another width is cut alike) and, within runs of over 12 words without either, after words picked
by their own hash (one in four) that stand four words or more from both ends,
and every 12 words where no word is picked.  These rules look at the words
alone, so the same passage is cut alike wherever it stands.  From every sentence
starts one span: the next ``span`` (3) sentences, or as many more as it takes to
hold ``min_words`` (20) words.  Spans are hashed from their lower-cased words.

A span's first occurrence is the one with the smallest id, and in that text the
leftmost.  All other occurrences are repeats, and a sentence that any of them
covers is removed; everything else, with its own whitespace, stays.

Shuffles: one (hash, id) row for each distinct span of a text; counts and
smallest ids are combined before the shuffle, and the join back is an equi-join
that Spark can split when a third of all texts share one passage.  Hits go back
to their texts as one array per id, bounded by that text's own length.

Defined cases: a null text stays null with 0 sentences; an empty or blank text
stays as it is; rows repeated under one id count as one text and are cleaned
alike; rows with a null id are returned unchanged and are nobody's first
occurrence; an empty table gives an empty result; other columns pass through,
and one named like a result column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.base import map_text, stored, table
from tessera.llm.textvec import Words, by_doc, cut, lower_ascii, mix, powers, text_block

SPAN, MIN_WORDS, PIECE = 3, 20, 4
BLOCK = 1_000_000  # text bytes worked on at once


def sentences(buf: np.ndarray, offs: np.ndarray):
    """Sentences of a block: their byte ranges, document, hash and number of words.

    A sentence's range runs from its first word to the next sentence's first
    word (or the end of the text), so that ranges of a text join up.
    """
    w = Words(lower_ascii(buf), offs)
    n = len(w.start)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64), z
    h = w.hashes()
    stop = np.isin(buf[w.end - 1], np.frombuffer(b".!?", np.uint8))
    breaks = np.concatenate([[0], np.cumsum(buf == 10)])
    stop[:-1] |= breaks[w.start[1:]] > breaks[w.end[:-1]] + 1
    last = np.ones(n, bool)
    last[:-1] = w.doc[1:] != w.doc[:-1]
    stop |= last
    head = np.ones(n, bool)
    head[1:] = stop[:-1]
    sid = np.cumsum(head) - 1
    place = np.arange(n) - np.flatnonzero(head)[sid]
    size = np.bincount(sid)[sid]
    left = size - place
    # long runs: cut after words picked by hash, at least PIECE words from both ends
    stop |= (size > 3 * PIECE) & (place >= PIECE - 1) & (left > PIECE) & (h >> np.uint64(62) == 0)
    head[1:] = stop[:-1]
    at = np.flatnonzero(head)
    place = np.arange(n) - at[np.cumsum(head) - 1]
    head |= place % (3 * PIECE) == 0
    at = np.flatnonzero(head)
    place = (np.arange(n) - at[np.cumsum(head) - 1]).astype(np.uint64)
    key = np.add.reduceat(mix(h + place * np.uint64(0x9E3779B97F4A7C15)), at)
    count = np.diff(np.append(at, n))
    doc = w.doc[at]
    begin = w.start[at]
    end = np.append(begin[1:], 0)
    final = np.append(doc[1:] != doc[:-1], True)
    end[final] = offs[doc[final] + 1]
    return begin, end, doc, mix(key + count.astype(np.uint64)), count


def spans(doc: np.ndarray, key: np.ndarray, count: np.ndarray, span: int, min_words: int):
    """(first sentence, sentence after the last, hash) of the span that starts at each sentence, where its text holds one."""
    m = len(doc)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    words = np.concatenate([[0], np.cumsum(count)])
    end = np.maximum(np.arange(m) + span, np.searchsorted(words, words[:-1] + min_words))
    at = np.flatnonzero(end <= np.searchsorted(doc, doc, "right"))
    end = end[at]
    up, down = powers(m + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(key * up[:m], dtype=np.uint64)])
    return at, end, mix((sums[end] - sums[at]) * down[at] + (end - at).astype(np.uint64))


def _first_of(doc, h):
    """Mask of the leftmost occurrence of each (doc, hash); doc ascends."""
    if not len(h):
        return np.zeros(0, bool)
    order = by_doc(doc, h, int(doc[-1]) + 1)
    d, k = doc[order], h[order]
    at = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])]))
    out = np.zeros(len(h), bool)
    out[np.minimum.reduceat(order, at)] = True
    return out


def span_rows(docs: DataFrame, span: int, min_words: int) -> DataFrame:
    """(id, h): each text's distinct span hashes; docs has id and t."""
    def run(buf, offs):
        _, _, doc, key, count = sentences(buf, offs)
        at, _, h = spans(doc, key, count, span, min_words)
        d = doc[at]
        keep = _first_of(d, h)
        d, h = d[keep], h[keep]
        first = np.searchsorted(d, np.arange(len(offs)))
        return [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64)))]

    return map_text(docs, run, "hs array<long>", ["id"], "t", BLOCK).select("id", F.explode("hs").alias("h"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of ``docs``, text cleaned, with n_sentences and n_removed appended."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).where("id is not null")
    rows = span_rows(src, span, min_words)
    shared = (rows.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
              .select("h", "lo"))
    hits = stored(rows.join(shared, "h").where("id > lo").groupBy("id").agg(F.collect_set("h").alias("__hits")))
    cols = [c for c in docs.columns if c not in ("n_sentences", "n_removed", "__hits", "__key")]
    base = docs.select(*[F.col(f"`{c}`") for c in cols], F.col(id_col).cast("long").alias("__key"))
    return _clean(base, hits, cols, text_col, span, min_words)


def _clean(base: DataFrame, hits: DataFrame, cols: list[str], text_col: str, span: int, min_words: int) -> DataFrame:
    where = cols.index(text_col)
    out = T.StructType([*base.select(*[F.col(f"`{c}`") for c in cols]).schema.fields,
                        T.StructField("n_sentences", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = out.names
    joined = (base.join(hits.withColumnRenamed("id", "__key"), "__key", "left")
              .select(*[F.col(f"`{c}`") for c in cols], "__hits", F.col("__key").isNull().alias("__none")))

    def rebuilt(raw, offs, begin, end, doc, gone, lost):
        for i in range(len(offs) - 1):
            if not lost[i]:
                yield raw[offs[i]:offs[i + 1]]
                continue
            a, b = np.searchsorted(doc, [i, i + 1])
            yield b"".join([raw[offs[i]:begin[a]], *(raw[begin[j]:end[j]] for j in range(a, b) if not gone[j])])

    def run(batches):
        for batch in batches:
            for part in cut(batch, text_col, BLOCK):
                col, hit = part.column(where), part.column(len(cols))
                buf, offs = text_block(col)
                begin, end, doc, key, count = sentences(buf, offs)
                at, after, h = spans(doc, key, count, span, min_words)
                d = doc[at]
                bad = ~_first_of(d, h)
                for i in np.flatnonzero(hit.is_valid().to_numpy(zero_copy_only=False)):
                    a, b = np.searchsorted(d, [i, i + 1])
                    known = hit[int(i)].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    bad[a:b] |= np.isin(h[a:b], known)
                bad &= ~part.column(len(cols) + 1).to_numpy(zero_copy_only=False)[d]  # a row without id stays as it is
                cover = np.zeros(len(doc) + 1, np.int64)
                np.add.at(cover, at[bad], 1)
                np.add.at(cover, after[bad], -1)
                gone = np.cumsum(cover)[:-1] > 0
                n = len(offs) - 1
                total, lost = np.bincount(doc, minlength=n), np.bincount(doc[gone], minlength=n)
                new = pa.array(list(rebuilt(buf.tobytes(), offs, begin, end, doc, gone, lost)), pa.binary())
                arrays = [part.column(c) for c in range(len(cols))]
                arrays[where] = pc.if_else(col.is_valid(), new.cast(pa.string()), pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(total), pa.array(lost)], names=names)

    return joined.mapInArrow(run, out)


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its sentences, how many were removed as repeats, and a digest of what stays."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_sentences", "n_removed", F.length("text").cast("long").alias("n_chars_kept"),
                      F.md5("text").alias("text_md5"))


QUERIES = {"op6_sentence_spans": op6_sentence_spans}
ORACLE_SQL: dict[str, str] = {}
