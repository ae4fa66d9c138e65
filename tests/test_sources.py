"""Source / sink round trips on small hand-made files."""

import json
import os
import tempfile

from tessera.sources import readers as RD
from tessera.sources import writers as WR


def tmpdir():
    return tempfile.mkdtemp(prefix="tessera-src-")


def test_csv_with_newlines_and_quotes(spark):
    d = tmpdir()
    df = spark.createDataFrame([("1", 'a "q"\nb, c')], "id string, text string")
    WR.write_wide_csv(df, f"{d}/out")
    back = RD.read_any(spark, f"{d}/out", "id string, text string", fmt="csv").collect()
    assert [(r.id, r.text) for r in back] == [("1", 'a "q"\nb, c')]


def test_context_pool_and_label_map(spark):
    d = tmpdir()
    with open(f"{d}/ctx.json", "w", encoding="utf-8") as f:
        json.dump(["x,y", "line1\nline2"], f, ensure_ascii=False)
    rows = RD.read_contexts(spark, f"{d}/ctx.json").orderBy("ctx_id").collect()
    assert [(r.ctx_id, r.text) for r in rows] == [(0, "x,y"), (1, "line1\nline2")]
    with open(f"{d}/m.json", "w") as f:
        json.dump({"b": 1, "a": 0}, f)
    assert sorted((r.label, r.idx) for r in RD.read_label_map(spark, f"{d}/m.json").collect()) == [("a", 0), ("b", 1)]


def test_word_vectors(spark):
    d = tmpdir()
    with open(f"{d}/v.txt", "w") as f:
        f.write("2 3\nfoo 1 2 3\nbar 1 x 3\n")
    vec, rej = RD.read_word_vectors(spark, f"{d}/v.txt")
    assert [(r.token, r.vector) for r in vec.collect()] == [("foo", [1.0, 2.0, 3.0])]
    assert rej.count() == 1


def test_concat_json_and_jsonl(spark):
    d = tmpdir()
    with open(f"{d}/c.json", "w") as f:
        f.write('{"a":1}{"a":2}\n')
    assert sorted(r.a for r in RD.read_concat_json(spark, f"{d}/c.json", "a int").collect()) == [1, 2]
    df = spark.createDataFrame([("21710", "標題")], "id string, title string")
    WR.write_jsonl(df, f"{d}/j")
    text = "".join(open(f"{d}/j/{p}", encoding="utf-8").read() for p in os.listdir(f"{d}/j") if p.endswith(".json"))
    assert "標題" in text
    back = RD.read_any(spark, f"{d}/j", "id string, title string", fmt="jsonl").first()
    assert back.id == "21710"


def test_json_array_of_records_and_unknown_extension(spark):
    import pytest
    d = tmpdir()
    with open(f"{d}/a.json", "w", encoding="utf-8") as f:
        json.dump([{"id": "1", "t": "é"}, {"id": "2", "t": None}], f)
    rows = RD.read_any(spark, f"{d}/a.json", "id string, t string").orderBy("id").collect()
    assert [(r.id, r.t) for r in rows] == [("1", "é"), ("2", None)]
    with pytest.raises(ValueError):
        RD.read_any(spark, f"{d}/a.txt")


def test_named_splits(spark):
    d = tmpdir()
    spark.createDataFrame([("1", "a")], "id string, intent string").write.parquet(f"{d}/train.parquet")
    spark.createDataFrame([("2",)], "id string").write.parquet(f"{d}/test.parquet")
    out = RD.read_splits(spark, {"train": f"{d}/train.parquet", "test": f"{d}/test.parquet"})
    assert sorted((r.split, r.id, r.intent) for r in out.collect()) == [("test", "2", None), ("train", "1", "a")]


def test_word_vector_header_last_line_and_vocabulary(spark):
    d = tmpdir()
    with open(f"{d}/v.txt", "w") as f:
        f.write("4 1\nfoo 1\n7 3\nfoo 2\nbar 5\n")
    vec, rej = RD.read_word_vectors(spark, f"{d}/v.txt")
    assert sorted((r.token, r.vector) for r in vec.collect()) == [("7", [3.0]), ("bar", [5.0]), ("foo", [2.0])]
    assert rej.count() == 0
    vocab = spark.createDataFrame([("foo",)], "token string")
    assert [r.token for r in RD.read_word_vectors(spark, f"{d}/v.txt", vocab)[0].collect()] == ["foo"]


def test_predictions_round_trip(spark):
    d = tmpdir()
    df = spark.createDataFrame([("test-0", "B-date I-date O"), ("test-1", "a,b")], "id string, tags string")
    WR.write_predictions(df, f"{d}/p")
    back = RD.read_any(spark, f"{d}/p", "id string, tags string", fmt="csv")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_concat_json_round_trip(spark):
    d = tmpdir()
    df = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (2, 0, 7)], "k int, n int, a int")
    WR.write_concat_json(df, f"{d}/c", ["k"], "n")
    lines = sorted(r.value for r in spark.read.text(f"{d}/c").collect())
    assert lines == ['{"n":0,"a":5}{"n":1,"a":6}', '{"n":0,"a":7}']
    back = RD.read_concat_json(spark, f"{d}/c", "n int, a int")
    assert sorted(tuple(r) for r in back.collect()) == [(0, 5), (0, 7), (1, 6)]


def test_qa_results_can_be_written_again(spark):
    d = tmpdir()
    nb = spark.createDataFrame([(1, 2, "b", 0.1), (1, 1, "a", 0.9)], "example_id int, rank int, text string, probability double")
    pr = spark.createDataFrame([(1, "a")], "example_id int, prediction string")
    for stage in ("eval", "test", "eval"):
        WR.write_qa_results(nb, pr, f"{d}/qa", stage, null_odds=pr)
    got = spark.read.parquet(f"{d}/qa/nbest").collect()
    assert sorted(r.stage for r in got) == ["eval", "test"]
    assert [[x.text for x in r.nbest] for r in got] == [["a", "b"]] * 2
    assert spark.read.parquet(f"{d}/qa/predictions").count() == 2
