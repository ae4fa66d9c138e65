"""Scores for extractive answers: the span of a passage where a question's rare words stand closest together.

A word of the question is worth its inverse document frequency over the context
pool, every other word of a span costs ``gap``.  A span's score is the sum over
its words, which prefix sums split into a start and an end part: start logit =
minus the sum before the token, end logit = the sum up to and with it.  So the
usual n-best search over start and end logits finds the best span of a window.
Values are whole thousandths, and add up exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import split_ws

NO_TOKEN = -1e9  # logits of the position before the first token


def question_weights(questions: DataFrame, contexts: DataFrame, key: str, question_col: str, text_col: str) -> DataFrame:
    """(key, weights map<string,long>): the thousandfold ln((1 + N) / (1 + df)) of each word of a question.

    Document frequencies are counted for the questions' words alone: other
    words of the contexts are dropped before anything is shuffled, where the
    questions' words are few.
    """
    asked = questions.select(key, F.explode(F.array_distinct(split_ws(question_col))).alias("word"))
    seen = contexts.select(F.explode(F.array_distinct(split_ws(text_col))).alias("word"))
    df = seen.join(asked.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    total = contexts.select(F.count(F.lit(1))).scalar()
    weight = F.round(F.log((1 + total) / (1 + F.coalesce("df", F.lit(0)))) * 1000).cast("long")
    return (asked.join(df, "word", "left").select(key, "word", weight.alias("w"))
            .groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias("weights")))


def span_logits(windows: DataFrame, key: str, gap: int = 1000) -> DataFrame:
    """``windows`` (key, win, offsets, tokens, weights) as features of the n-best search.

    A window's sums are running totals over its own tokens: windows have a fixed
    length, so carrying them along as an array costs no more than the window.
    """
    worth = F.transform("tokens", lambda t: F.coalesce(F.try_element_at(F.col("weights"), t), F.lit(-gap).cast("long")))
    sums = F.aggregate(worth, F.array(F.lit(0).cast("long")), lambda s, x: F.concat(s, F.array(F.try_element_at(s, F.lit(-1)) + x)))
    w = windows.withColumn("_s", sums)
    before = F.transform(F.slice("_s", 1, F.size("_s") - 1), lambda x: -x.cast("double") / 1000)
    until = F.transform(F.slice("_s", 2, F.size("_s")), lambda x: x.cast("double") / 1000)
    none = F.array(F.lit(None).cast("struct<s:int,e:int>"))
    return w.select(F.col(key).alias("example_id"), F.col("win").alias("feature_id"),
                    F.concat(none, F.col("offsets").cast("array<struct<s:int,e:int>>")).alias("offsets"),
                    F.concat(F.array(F.lit(NO_TOKEN)), before).alias("start_logits"),
                    F.concat(F.array(F.lit(NO_TOKEN)), until).alias("end_logits"))
