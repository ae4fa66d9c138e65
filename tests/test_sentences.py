"""Learnt sentence boundaries against plain counts and planted abbreviations."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tessera.operators import sentences as ST


def corpus(seed=1):
    rng = random.Random(seed)
    names, verbs, nouns = ["Smith", "Jones", "Lee", "Kaur"], ["saw", "met", "left", "found"], ["river", "house", "treaty", "market"]
    texts = []
    for _ in range(300):
        s = []
        for _ in range(rng.randrange(1, 6)):
            who = rng.choice(["Dr. ", "Prof. ", ""]) + rng.choice(names)
            tail = rng.choice(["", " in the U.S. army", " at 3.5 percent", " near St. Ives", " in 1999"])
            s.append(f"{rng.choice(['The people', 'However he', who])} {rng.choice(verbs)} the {rng.choice(nouns)}{tail}{rng.choice(['.', '.', '.', '!', '?'])}")
        texts.append(" ".join(s))
    return texts


def plain_counts(texts):
    n, dotted = Counter(), Counter()
    for t in texts:
        for token in re.sub("([。！？])", r"\1 ", t or "").split():
            bare = re.sub(ST._STRIP, "", token.lower())
            word = bare.removesuffix(".")
            n[word] += 1
            dotted[word] += bare.endswith(".")
    return n, dotted


def test_counts_and_scores_equal_a_plain_model(spark):
    texts = corpus() + [None, "", "(Dr.) dr, \"dr.\" ...", "中文。很好！ x"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    n, dotted = plain_counts(texts)
    counts = ST.period_counts(df, "text")
    assert {r.word: (r.n, r.dotted) for r in counts.collect()} == {w: (n[w], dotted[w]) for w in n}
    total, periods = sum(n.values()), sum(dotted.values())
    want = {}
    for w in n:
        if dotted[w] and re.fullmatch(r"[^\W\d_]+([.'-][^\W\d_]+)*", w):
            p, rest, letters = periods / total, n[w] - dotted[w], len(w.replace(".", ""))
            ratio = 2 * (dotted[w] * math.log(0.99 / p) + rest * math.log(0.01 / (1 - p)))
            score = ratio * math.exp(-letters) * (len(w) - letters + 1) * float(letters) ** -rest
            if score >= 0.3:
                want[w] = score
    got = {r.word: r.score for r in ST.abbreviations(counts).collect()}
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-5 for w in got)
    assert {"dr", "prof", "st", "u.s"} <= got.keys() and not {"river", "house", "treaty"} & got.keys()


def split_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = ST.period_counts(df, "text")
    short = ST.abbreviations(counts)
    return ST.sentence_splitter(spark, short, ST.starters(df, "text", counts, short))


def test_planted_abbreviations_stay_whole(spark):
    split = split_of(spark, corpus())
    cases = {
        "Dr. Lee saw the river. The people left!": ["Dr. Lee saw the river.", "The people left!"],
        "He met Prof. Kaur at 3.5 percent. However he left": ["He met Prof. Kaur at 3.5 percent.", "However he left"],
        "the U.S. army left. (It met him.) \"Why?\" he": ["the U.S. army left.", "(It met him.)", "\"Why?\"", "he"],
        "in the U.S. However he left.": ["in the U.S.", "However he left."], "in the U.S. however he": ["in the U.S. however he"],
        "found in 1999. the rest": ["found in 1999. the rest"],
        "found in 1999. The rest": ["found in 1999.", "The rest"],
        "J. Smith  left\n\nthe house.Done": ["J. Smith left the house.Done"],
        "中文。很好！是": ["中文。", "很好！", "是"],
        "": [], " \n": [], "...": ["..."],
    }
    rows = [(i, t) for i, t in enumerate(cases)] + [(99, None)]
    got = {r.i: r.s for r in spark.createDataFrame(rows, "i int, t string").select("i", split(F.col("t")).alias("s")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values()) and got[99] is None


def test_nothing_to_learn_from(spark):
    split = split_of(spark, [None, ""])
    assert spark.createDataFrame([("a. b",)], "t string").select(split(F.col("t"))).first()[0] == ["a. b"]


def test_starters_take_the_texts_apart_once(spark):
    from pyspark.sql import functions as F
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        made.add(1)
        return x

    texts = ["He went home. The dog ran. The cat sat on the mat."] * 30 + [None, "", "No end"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = ST.period_counts(docs, "text")
    got = {r.word: r.after for r in ST.starters(docs.select(seen("text").alias("text")), "text", counts, counts.limit(0)).collect()}
    assert got == {"the": 60} and made.value <= len(texts)
