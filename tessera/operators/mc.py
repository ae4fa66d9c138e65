"""Question -> context data: locating passages, multiple-choice rows
(4-way positional lookup into a context pool), SQuAD rows, choice pairs,
context choice by TF-IDF cosine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import argmax
from tessera.functions.text import split_ws
from tessera.operators.common import likely_keys
from tessera.session import cut_lineage

ENDING_COLS = ["ending0", "ending1", "ending2", "ending3"]
# Wide multiple-choice CSV header and the constant gold source.
WIDE_COLS = ["video-id", "fold-ind", "startphrase", "sent1", "sent2", "gold-source",
             "ending0", "ending1", "ending2", "ending3", "labels"]
GOLD_SOURCE = "gold"
GRAM_SLOT_BITS = 20


def _word_grams(buf: np.ndarray, offs: np.ndarray, first: np.ndarray, inner: bool) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the grams of texts whose word i is buf[offs[i]:offs[i + 1]] and whose words begin at ``first``.

    Grams are what a text that holds these words whole must hold: every word
    between two others with the last byte before and the first byte after it,
    and every word 3-gram.  ``inner``: the first and the last word may be parts
    of longer ones, so a 3-gram has to lie between them."""
    n, mult = len(buf), np.uint64(0x9E3779B97F4A7C15)

    def mix(h):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))

    up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]), dtype=np.uint64)
                for x in (int(mult), pow(int(mult), -1, 1 << 64)))
    code = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * mult)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code[buf] * up[:n], dtype=np.uint64)])
    word = mix((sums[offs[1:]] - sums[offs[:-1]]) * down[offs[:-1]] + np.diff(offs).astype(np.uint64))
    size = np.diff(first)
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(word)) - first[:-1][text]
    mid = np.flatnonzero((place > 0) & (place < size[text] - 1))
    sides = buf[offs[mid] - 1].astype(np.uint64) << np.uint64(8) | buf[offs[mid + 1]].astype(np.uint64)
    edges = mix(word[mid] + (sides + np.uint64(1)) * mult)
    whole = mid[(place[mid] > 1) & (place[mid] < size[text[mid]] - 2)] if inner else mid
    threes = mix((word[whole - 1] * mult + word[whole]) * mult + word[whole + 1])
    return np.concatenate([text[mid], text[whole]]), np.concatenate([edges, threes]).view(np.int64)


def word_grams(words: pa.Array, inner: bool, wanted: np.ndarray | None = None, limit: int = 1_000_000) -> pa.Array:
    """list<int64>: distinct grams of each list of words, those alone whose slot is ``wanted``; a block of bytes at a time."""
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat = words.flatten().cast(pa.large_string())
    offs = (np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1] if len(flat)
            else np.zeros(1, np.int64))
    buf = np.frombuffer(flat.buffers()[2], np.uint8) if len(flat) else np.zeros(0, np.uint8)
    found, counts, i = [np.zeros(0, np.int64)], np.zeros(len(words), np.int64), 0
    while i < len(words):
        j = max(i + 1, int(np.searchsorted(offs[ends], offs[ends[i]] + limit, "right")) - 1)
        at = offs[ends[i]:ends[j] + 1]
        text, h = _word_grams(buf[at[0]:at[-1]], at - at[0], ends[i:j + 1] - ends[i], inner)
        if wanted is not None:
            some = wanted[h & (len(wanted) - 1)]
            text, h = text[some], h[some]
        order = np.lexsort((h, text))
        text, h = text[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
        found.append(h[new])
        counts[i:j] = np.bincount(text[new], minlength=j - i)
        i = j
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(np.concatenate(found)))


def _gram_rows(df: DataFrame, key: str, words: str, inner: bool, among: DataFrame | None = None) -> DataFrame:
    """(key, h): distinct grams of each row's words, by an Arrow map; with ``among`` those whose hash slot is one of its
    column's: at most 2**GRAM_SLOT_BITS numbers that travel as flags, however many grams there are."""
    sent = None
    if among is not None:
        slots = among.select(F.col(among.columns[0]).bitwiseAND(F.lit((1 << GRAM_SLOT_BITS) - 1)).cast("int").alias("s")).distinct()
        flags = np.zeros(1 << GRAM_SLOT_BITS, bool)
        flags[slots.toArrow().column("s").to_numpy()] = True
        sent = df.sparkSession.sparkContext.broadcast(np.packbits(flags))

    @F.arrow_udf("array<long>")
    def grams(w: pa.Array) -> pa.Array:
        return word_grams(w, inner, None if sent is None else np.unpackbits(sent.value).view(bool))

    return df.select(key, F.explode_outer(grams(F.col(words))).alias("h")).where(F.col("h").isNotNull())


def rare_gram_pairs(words: DataFrame, toks: DataFrame, pkey: str, dkey: str) -> DataFrame:
    """(passage, document) candidates: the documents that hold the rarest gram of a passage of three words or more.

    ``words``: passages as pt, ``toks``: documents as dt, arrays of words.  A
    first pass counts in how many documents each of the passages' grams occurs."""
    probes = cut_lineage(_gram_rows(words.where("size(pt) >= 3"), pkey, "pt", inner=True))
    seen = _gram_rows(toks, dkey, "dt", False, probes.select("h")).groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h")).alias("m")
    long = cut_lineage(probes.join(seen, "h", "left").groupBy(pkey).agg(rarest).where("m.df > 0").select(pkey, "m.h"))
    return _gram_rows(toks, dkey, "dt", False, long.select("h")).join(long, "h").select(pkey, dkey)


def _substrings(word: Column, sizes: Column) -> Column:
    """All substrings of a word with the lengths in an array."""
    return F.array_distinct(F.flatten(F.transform(
        F.filter(sizes, lambda n: n <= F.length(word)),
        lambda n: F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.substring(word, i, n)))))


def containing_docs(passages: DataFrame, docs: DataFrame, pkey: str = "item_id",
                    dkey: str = "doc_id") -> DataFrame:
    """Every (passage, document) pair where the document text contains the
    passage verbatim, without a cross join or a cap.

    Candidates come from equi-joins on something the document must hold, and
    ``instr`` confirms each one, so the result is exact:

    - three words or more: the rarest of its grams (see ``_word_grams``), which any
      containing document holds; a first pass counts in how many documents each
      of the passages' grams occurs, so that a passage with a common word in the
      middle meets only documents that share something rare with it;
    - one word: it lies inside a single document word; two words: the first is
      the end of one.  Distinct corpus words are matched first (by substrings
      of the probes' lengths), then the documents that hold such a word.

    A semi join on bounded hash slots drops grams without a probe before any
    shuffle; the short-passage branch lets no document through where no passage
    is short.  A blank passage
    matches nothing."""
    pt = F.col("pt")
    n = F.size(pt)
    words = passages.select(pkey, split_ws("text").alias("pt")).where(F.size("pt") > 0)
    toks = docs.select(dkey, split_ws("text").alias("dt"))
    cand = rare_gram_pairs(words, toks, pkey, dkey)

    short = words.where(n <= 2).select(pkey, pt[0].alias("probe"), (n == 1).alias("single"))
    # no document goes on below where no passage is short: a semi join on a constant with at most one row
    always = F.pmod(F.xxhash64(F.col(pkey)), F.lit(1)).alias("_any")
    toks_s = (toks.withColumn("_any", F.pmod(F.xxhash64(F.col(dkey)), F.lit(1)))
              .join(F.broadcast(short.select(always).limit(1)), "_any", "left_semi"))
    vocab = toks_s.select(F.explode_outer("dt").alias("word")).where(F.col("word").isNotNull()).distinct()
    parts = vocab.withColumn("sizes", short.select(F.collect_set(F.length("probe"))).scalar())
    parts = parts.select("word", F.explode_outer(_substrings(F.col("word"), F.col("sizes"))).alias("probe")).where(F.col("probe").isNotNull())
    words_hit = parts.join(short, "probe").where(F.col("single") | F.col("word").endswith(F.col("probe"))).select(pkey, "word")
    by_word = words_hit.select(pkey, F.xxhash64("word").alias("h"))
    one = toks_s.select(dkey, F.explode_outer(F.transform(F.array_distinct("dt"), lambda t: F.xxhash64(t))).alias("h"))
    cand_short = likely_keys(one.where(F.col("h").isNotNull()), "h", by_word.select("h")).join(by_word, "h").select(pkey, dkey)

    cand = cand.unionByName(cand_short).distinct()
    ptxt = passages.select(pkey, F.col("text").alias("ptext"))
    dtxt = docs.select(dkey, F.col("text").alias("dtext"))
    return (cand.join(ptxt, pkey).join(dtxt, dkey)
            .where(F.instr("dtext", F.col("ptext")) > 0)
            .select(pkey, dkey, (F.instr("dtext", F.col("ptext")) - 1).alias("char_start")))


def mc_rows(questions: DataFrame, contexts: DataFrame, labeled: bool = True,
            k: int = 4) -> tuple[DataFrame, DataFrame]:
    """(good, rejects).  Each question's ``paragraphs`` (context ids) are
    looked up by position in the pool -> ``ending0..3``; ``labels`` is the
    index of ``relevant`` in ``paragraphs`` (0 for an unlabeled split).  A
    row with the wrong number of paragraphs, a relevant id not listed, or an
    id missing from the pool goes to ``rejects``."""
    q = questions
    ex = q.select("id", F.posexplode("paragraphs").alias("pos", "ctx_id"))
    looked = ex.join(contexts.select("ctx_id", F.col("text").alias("ctx_text")), "ctx_id", "left")
    grouped = (looked.groupBy("id")
               .agg(F.sort_array(F.collect_list(F.struct("pos", "ctx_text"))).alias("e"),
                    F.count_if(F.col("ctx_text").isNull()).alias("n_missing")))
    j = q.join(grouped, "id", "left")
    label = (F.array_position("paragraphs", F.col("relevant")) - 1) if labeled else F.lit(0)
    bad = ((F.size("paragraphs") != k) | (F.col("n_missing") > 0) | F.col("n_missing").isNull()
           | F.exists("paragraphs", lambda x: x < 0))
    if labeled:
        bad = bad | (label < 0)
    j = j.withColumn("_bad", bad).withColumn("_label", label.cast("int"))
    good = j.where(~F.col("_bad")).select(
        F.col("id").alias("video-id"), F.col("id").alias("fold-ind"),
        F.col("question").alias("startphrase"), F.col("question").alias("sent1"),
        F.col("question").alias("sent2"), F.lit(GOLD_SOURCE).alias("gold-source"),
        *[F.col("e")[i]["ctx_text"].alias(c) for i, c in enumerate(ENDING_COLS)],
        F.col("_label").alias("labels"))
    rejects = j.where(F.col("_bad")).select("id", "paragraphs")
    return good, rejects


def squad_rows(questions: DataFrame, contexts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects).  Single lookup of the relevant context; nested answers;
    title := id.  A question whose context is not in the pool, or whose answer
    has no start, goes to ``rejects`` with the reason."""
    j = questions.join(contexts.select(F.col("ctx_id").alias("relevant"), F.col("text").alias("context")),
                       "relevant", "left")
    issue = (F.when(F.col("context").isNull(), F.lit("missing_context"))
             .when(F.col("answer.start").isNull(), F.lit("no_answer")))
    j = j.withColumn("issue", issue)
    good = j.where(F.col("issue").isNull()).select(
        "id", F.col("id").alias("title"), "question", "context",
        F.struct(F.array(F.col("answer.text")).alias("text"),
                 F.array(F.col("answer.start")).alias("answer_start")).alias("answers"))
    return good, j.where(F.col("issue").isNotNull()).select("id", "relevant", "issue")


def choice_pairs(mc: DataFrame) -> DataFrame:
    """Flatten k choices to rows: first = context sentence, second =
    "{header} {ending}"."""
    endings = F.array(*[F.col(c) for c in ENDING_COLS])
    return mc.select(F.col("video-id").alias("id"), "sent1", "sent2", "labels",
                     F.posexplode(endings).alias("choice", "ending")).select(
        "id", "choice", F.col("sent1").alias("first"),
        F.concat_ws(" ", F.col("sent2"), F.col("ending")).alias("second"), "labels")


def regroup_choices(rows: DataFrame, k: int = 4, value: str = "score") -> DataFrame:
    """Scored choices (id, choice, value) back to one row a question: (id, values in choice order, pred).

    ``pred`` is the first choice of the largest value.  A question without
    exactly the choices 0 .. k-1 has no row; a group has at most its own k."""
    per = rows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("choice", value))).alias("c"))
    per = per.where((F.size("c") == k) & F.forall(F.transform("c", lambda x, i: x["choice"] == i), lambda x: x))
    values = F.col(f"c.{value}")
    return per.select("id", values.alias("values"), argmax(values).alias("pred"))


def choice_scores(mc: DataFrame) -> DataFrame:
    """(id, choice, score): TF-IDF cosine of every ending with its question.

    A text is one ending of one question; idf = ln((1 + N) / (1 + df)) + 1 over
    the N endings, term weight = count * idf.  Words meet in an equi-join on
    (id, word), so nothing is paired beyond a question's own endings."""
    ends = (mc.select(F.col("video-id").alias("id"), F.posexplode(F.array(*[F.col(c) for c in ENDING_COLS]))
                      .alias("choice", "ending")))
    e = (ends.select("id", "choice", F.explode(split_ws("ending")).alias("word"))
         .groupBy("id", "choice", "word").agg(F.count(F.lit(1)).alias("tf")))
    q = (mc.select(F.col("video-id").alias("id"), F.explode(split_ws("sent1")).alias("word"))
         .groupBy("id", "word").agg(F.count(F.lit(1)).alias("qtf")))
    total = ends.select(F.count(F.lit(1))).scalar()
    df = e.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((1 + total) / (1 + F.coalesce("df", F.lit(0)))) + 1
    we = e.join(df, "word").select("id", "choice", "word", (F.col("tf") * idf).alias("w"))
    wq = q.join(df, "word", "left").select("id", "word", (F.col("qtf") * idf).alias("qw"))
    dot = we.join(wq, ["id", "word"]).groupBy("id", "choice").agg(F.sum(F.col("w") * F.col("qw")).alias("dot"))
    norm = we.groupBy("id", "choice").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    qnorm = wq.groupBy("id").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qnorm"))
    scored = (ends.select("id", "choice").join(dot, ["id", "choice"], "left").join(norm, ["id", "choice"], "left")
              .join(qnorm, "id", "left")
              .select("id", "choice", F.round(F.coalesce(F.col("dot") / (F.col("norm") * F.col("qnorm")), F.lit(0.0)), 9)
                      .alias("score")))
    return scored


def choose_context(mc: DataFrame) -> DataFrame:
    """(id, pred, score): the ending of the largest score (ties -> lowest choice)."""
    best = F.max(F.struct("score", (-F.col("choice")).alias("nc"))).alias("b")
    return choice_scores(mc).groupBy("id").agg(best).select("id", (-F.col("b.nc")).alias("pred"), F.col("b.score").alias("score"))


def selected_context(mc: DataFrame, preds: DataFrame) -> DataFrame:
    """The ending named by the predicted index (``ending{pred}``)."""
    endings = F.array(*[F.col(c) for c in ENDING_COLS])
    return (mc.join(preds.withColumnRenamed("id", "video-id"), "video-id")
            .select(F.col("video-id").alias("id"), "pred", F.get(endings, F.col("pred")).alias("context")))
