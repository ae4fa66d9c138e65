"""Hand-made edge rows (FIXTURES.md section 2) for the scalar helpers."""

import random

from pyspark.sql import functions as F

from tessera.functions.arrays import argmax, mask_pad, pad_array, unmask
from tessera.functions.text import (char_span, repair_answer, rouge_words, sentence_lines, split_space,
                                    split_ws, strip_ws)
from tessera.operators.rouge import lcs_length


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_split_variants(spark):
    assert one(spark, split_space("x"), " a  b") == ["", "a", "", "b"]
    assert one(spark, split_space("x"), "") == [""]
    assert one(spark, split_ws("x"), " a  b") == ["a", "b"]
    assert one(spark, split_ws("x"), "") == []
    assert one(spark, split_ws("x"), "　中 文 ") == ["中", "文"]


def test_strip_matches_python(spark):
    for s in [" a ", "　x ", "\n\tq r\n", "", "   "]:
        assert one(spark, strip_ws("x"), s) == s.strip()


def test_pad_and_mask(spark):
    sch = "x array<int>"
    assert one(spark, pad_array("x", 5, 0), [7, 8, 9], sch) == [7, 8, 9, 0, 0]
    assert one(spark, pad_array("x", 2, 0), [7, 8, 9], sch) == [7, 8]
    assert one(spark, mask_pad("x"), [5, 0, 0], sch) == [5, -100, -100]
    assert one(spark, unmask("x"), [5, -100], sch) == [5, 0]
    assert one(spark, argmax("x"), [1, 3, 3], sch) == 1


def test_char_span_code_points(spark):
    df = spark.createDataFrame([("a😀中b",)], "t string")
    assert df.select(char_span("t", F.lit(3), F.lit(4))).first()[0] == "b"
    assert df.select(char_span("t", F.lit(1), F.lit(3))).first()[0] == "😀中"


def test_repair_answer_first_rule_wins(spark):
    cases = {"《x": "《x》", "x》": "《x》", "「y": "「y」", "y」": "「y」", "《x,1": "《x1", "plain": "plain"}
    for raw, want in cases.items():
        assert one(spark, repair_answer("x"), raw) == want


def test_sentence_lines(spark):
    assert one(spark, sentence_lines("x"), "A b. C d! 中文。 e") == ["A b.", "C d!", "中文。", "e"]


def test_rouge_words_like_package(spark):
    def model(t):
        out = []
        for piece in [p for p in t.split(".") if len(p) > 0]:
            out.extend(" ".join(piece.split()).split(" "))
        return out
    for t in ["a b. c", "a. . b", "x..y", " q  r ", "end."]:
        assert one(spark, rouge_words("x"), t) == model(t)


def test_lcs_bit_parallel_vs_dp():
    def dp(a, b):
        m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                m[i + 1][j + 1] = m[i][j] + 1 if a[i] == b[j] else max(m[i][j + 1], m[i + 1][j])
        return m[-1][-1]
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        b = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        assert lcs_length(a, b) == dp(a, b)
