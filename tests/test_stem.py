"""Hand-worked words of the five steps."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.stem import stem, stems

WORDS = {
    # plurals, past, gerunds
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
    "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
    "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky",
    # double and single suffixes
    "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit",
    "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
    "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good",
    # longest endings and tidying
    "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "communism": "commun", "activate": "activ", "angulariti": "angular",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "generalizations": "gener", "oscillators": "oscil",
}


@pytest.mark.parametrize("word", WORDS)
def test_word(word):
    assert stem(word) == WORDS[word]


def test_column(spark):
    df = spark.createDataFrame([(1, ["running", "ran", "the", "ties", "running"]), (2, []), (3, None)], "k int, w array<string>")
    got = {r.k: r.s for r in df.select("k", stems(F.col("w")).alias("s")).collect()}
    assert got == {1: ["run", "ran", "the", "ti", "run"], 2: [], 3: None}
