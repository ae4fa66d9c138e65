"""The n-best queries' features pass through Python in maps of batches.

A column function in Arrow batches (ArrowEvalPython) keeps the rows of its whole
batches until their results return, in files where memory is short: with the
windows' offsets in them that was some fifteen times the input.
"""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField

import __spark_entry__ as E
from tessera.operators import spans as SP

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["qa_nbest", "qa_beam_null_odds", "qa_nbest_max_context", "qa_null_odds", "qa_beam_nbest",
                                  "qa_nbest_negative", "qa_predictions"])
def test_no_column_function_keeps_the_windows(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_offsets_alone_are_those_of_the_tokens(spark):
    rows = [(1, "a  bc\n d"), (2, ""), (3, None), (None, "x y"), (4, " 　é "), (5, "w " * 700_000), (6, "z"), (6, "zz z")]
    df = spark.createDataFrame(rows, "k int, t string")
    both = [SP.token_offsets(df, "k", "t", tokens=x).select("k", "offsets") for x in (True, False)]
    assert both[0].dtypes == both[1].dtypes
    plain, maps = ([(r.k, r.offsets and [(o.s, o.e) for o in r.offsets]) for r in x.collect()] for x in both)
    assert sorted(plain, key=str) == sorted(maps, key=str) and len(maps) == len(rows)
    assert (3, None) in maps and (6, [(0, 2), (3, 4)]) in maps


def test_windows_are_finished_in_the_same_pass(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (2, None), (None, "f g")], "k int, t string")
    tok = SP.token_offsets(df, "k", "t", tokens=False)

    def double(cols):
        import pyarrow.compute as pc
        return {"k": cols["k"], "twice": pc.multiply(cols["n_tok"], 2).cast("int32")}

    out = SP.context_windows(tok, "k", 4, 2, finish=([df.schema["k"], StructField("twice", IntegerType())], double))
    assert sorted(out.collect(), key=str) == sorted(SP.context_windows(tok, "k", 4, 2).select("k", (F.col("n_tok") * 2).alias("twice")).collect(), key=str)
    assert out.where("k = 2").first().twice == 0 and out.where("k = 1").count() == 2


def test_features_of_rows_without_id_or_text(spark, tmp_path):
    from tessera.plans import standins as S
    d = spark.createDataFrame([(5, "a b"), (None, "c"), (7, None), (8, "")], "doc_id long, text string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.example_id: r for r in S.qa_features(spark, str(tmp_path)).collect()}
    assert [o and (o.s, o.e) for o in got[5].offsets] == [None, (0, 1), (2, 3)] and got[5].start_logits[0] == 65 / 100
    assert got[None].feature_id is None and got[None].start_logits is None and len(got[None].offsets) == 2
    assert [len(got[k].offsets) for k in (7, 8)] == [1, 1] and got[8].end_logits == [88 / 100 - 2]
