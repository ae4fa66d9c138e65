"""Sentence boundaries with abbreviations and sentence starters learnt from the corpus.

No labels: a word is an abbreviation if it stands before a period far more often
than chance (a log-likelihood ratio against words that always do, damped for
long words and for every occurrence without the period, raised by inner periods;
the measure and its threshold are those of Kiss and Strunk, Computational
Linguistics 32, 2006).  A word starts sentences if it follows a sure sentence end
more often than its frequency explains (a log-likelihood ratio of at least 30).

A token that ends in . ! or ? (closing quotes and brackets aside) ends a
sentence, but for two: after an abbreviation or a single letter the next token
has to be a learnt starter with a capital, after a number it has to have a
capital.  Periods inside a token (3.5, U.S.A) end nothing.  The full-width marks
end a sentence wherever they stand.  Blanks inside a sentence become one space.

Counts are grouped in Spark; the ``size`` best-attested abbreviations and
starters are the model, and a narrow map applies it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import let
from tessera.functions.text import split_ws
from tessera.session import cut_lineage

SIZE = 20_000           # abbreviations and starters that a model may have each
ABBREVIATION, STARTER = 0.3, 30.0
# Marks that may open or close around a word.
OPENERS = "\"'([{«“„‘"
CLOSERS = "\"')]}»”’,;:"
WIDE_MARKS = "。！？"
_STRIP = f"^[{re.escape(OPENERS)}]+|[{re.escape(CLOSERS)}]+$"
_WORD = r"^\p{L}+([.'-]\p{L}+)*$"


def tokens_of(text: Column) -> Column:
    return split_ws(F.regexp_replace(text, f"([{WIDE_MARKS}])", "$1 "))


def _bare(token: Column) -> Column:
    return F.regexp_replace(F.lower(token), _STRIP, "")


def _kind(bare: Column) -> Column:
    """The word without its period."""
    return F.regexp_replace(bare, r"\.$", "")


def period_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(word, n, dotted): how often each word stands there, and before a period."""
    # counted as they stand first: a token is taken apart once, however often it occurs
    t = (df.select(F.explode_outer(tokens_of(F.col(text_col))).alias("token")).where(F.col("token").isNotNull())
         .groupBy("token").agg(F.count(F.lit(1)).alias("c")).select(_bare(F.col("token")).alias("bare"), "c"))
    return (t.groupBy("bare").agg(F.sum("c").alias("c"))
            .select(_kind(F.col("bare")).alias("word"), "c", F.when(F.col("bare").endswith("."), F.col("c")).otherwise(0).alias("d"))
            .groupBy("word").agg(F.sum("c").alias("n"), F.sum("d").alias("dotted")))


def abbreviations(counts: DataFrame, size: int = SIZE) -> DataFrame:
    """(word, n, dotted, score) of the learnt abbreviations."""
    total = counts.agg(F.sum("n").alias("n"), F.sum("dotted").alias("d")).first()
    n, d = total["n"] or 0, total["d"] or 0
    if not 0 < d < n:
        return counts.select("word", "n", "dotted", F.lit(0.0).alias("score")).limit(0)
    p = d / n
    rest = F.col("n") - F.col("dotted")
    ratio = 2 * (F.col("dotted") * F.log(F.lit(0.99 / p)) + rest * F.log(F.lit(0.01 / (1 - p))))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    score = ratio * F.exp(-letters) * (F.length("word") - letters + 1) * F.pow(letters.cast("double"), -rest)
    return (counts.where((F.col("dotted") > 0) & F.col("word").rlike(_WORD)).withColumn("score", F.round(score, 6))
            .where(F.col("score") >= ABBREVIATION).orderBy(F.desc("dotted"), "word").limit(size))


def starters(df: DataFrame, text_col: str, counts: DataFrame, known: DataFrame, size: int = SIZE) -> DataFrame:
    """(word, n, after, score): words that follow sentence ends; ``after`` counts the ends before them."""
    t = tokens_of(F.col(text_col))
    zipped = let(t, lambda x: F.arrays_zip(x.alias("x"), F.slice(x, 2, F.greatest(F.size(x), F.lit(1))).alias("y")))
    # a token without a period ends nothing: most fall away before a row is made of them
    ended = F.filter(zipped, lambda p: p["x"].contains(".") & p["y"].isNotNull())
    pairs = (df.select(F.explode_outer(ended).alias("p")).where(F.col("p").isNotNull())
             .groupBy(F.col("p.x").alias("x"), F.col("p.y").alias("y")).agg(F.count(F.lit(1)).alias("c")))
    ends = (pairs.select(_bare(F.col("x")).alias("bare"), "y", "c").where(F.col("bare").endswith("."))
            .select(_kind(F.col("bare")).alias("word"), "y", "c")
            .where(~F.col("word").rlike("^[0-9]") & ~F.col("word").rlike(r"^\p{L}$")))
    # the words of the learnt abbreviations are few: a size of at most ``size`` rows
    ends = ends.join(known.select("word"), "word", "left_anti").select(_bare(F.col("y")).alias("bare"), "c")
    # stored: its sum and its rows are read
    after = cut_lineage(ends.select(_kind(F.col("bare")).alias("word"), "c").groupBy("word").agg(F.sum("c").alias("after")))
    a = after.agg(F.sum("after").alias("a")).first()["a"] or 0
    n = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    if not 0 < a < n:
        return counts.select("word", "n", F.lit(0).cast("long").alias("after"), F.lit(0.0).alias("score")).limit(0)

    def likely(k, of, x):
        return F.when(k > 0, k * F.log(x)).otherwise(0.0) + F.when(of - k > 0, (of - k) * F.log(1 - x)).otherwise(0.0)

    k, b = F.col("after"), F.col("n")
    both, here, there = b / n, k / a, (b - k) / (n - a)
    score = 2 * (likely(k, F.lit(a), here) + likely(b - k, F.lit(n - a), there) - likely(k, F.lit(a), both)
                 - likely(b - k, F.lit(n - a), both))
    return (after.join(counts.select("word", "n"), "word").where(F.col("word").rlike(r"\p{L}") & (k * n > b * a))
            .withColumn("score", F.round(score, 6)).where(F.col("score") >= STARTER)
            .select("word", "n", "after", "score").orderBy(F.desc("after"), "word").limit(size))


def _word(token: str) -> str:
    return re.sub(_STRIP, "", token.lower())


def ending(token: str, known: set) -> int:
    """0: ends nothing, 1: ends a sentence, 2: does before a starter with a capital, 3: does before a capital."""
    if token[-1] in WIDE_MARKS:
        return 1
    bare = token.rstrip(CLOSERS)
    if not bare or bare[-1] not in ".!?":
        return 0
    if bare[-1] != ".":
        return 1
    word = _word(bare)[:-1]
    if word in known or len(word) == 1 and word.isalpha():
        return 2
    return 3 if word[:1].isdigit() and word[:1].isascii() else 1


def opening(token: str, known: set) -> int:
    """Bit 1: begins with a capital, bit 2: is a learnt starter."""
    word = _word(token)
    return int(token.lstrip(OPENERS)[:1].isupper()) + 2 * (word.removesuffix(".") in known)


def sentence_splitter(spark: SparkSession, abbreviations: DataFrame, starters: DataFrame,
                      size: int = SIZE) -> Callable[[Column], Column]:
    """A function from a text to its array of sentences."""
    sent = spark.sparkContext.broadcast(tuple({r["word"] for r in x.select("word").limit(size).collect()}
                                              for x in (abbreviations, starters)))

    @F.arrow_udf("array<string>")
    def split(lists: pa.Array) -> pa.Array:
        short, first = sent.value
        coded = lists.flatten().dictionary_encode()
        found = coded.dictionary.to_pylist()
        at = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.array([ending(x, short) for x in found], np.int8)[at] if found else np.zeros(0, np.int8)
        opens = np.array([opening(x, first) for x in found], np.int8)[at] if found else np.zeros(0, np.int8)
        after = np.append(opens[1:], 0)
        cut = (ends == 1) | (ends == 2) & (after == 3) | (ends == 3) & (after % 2 == 1)
        bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        cut[bounds[1:][np.diff(bounds) > 0] - 1] = True  # a text's last token
        stops = np.flatnonzero(cut) + 1
        tokens = lists.flatten()
        groups = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]).astype(np.int32)), tokens)
        lines = pc.binary_join(groups, " ")
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(stops, bounds, "right").astype(np.int32)), lines,
                                        mask=lists.is_null() if lists.null_count else None)

    return lambda text: split(tokens_of(text))
