"""Mixture, dialogues, neighbours, the pipeline, and every query against its SQL."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import catalog, chat, knn, mixing
from tessera.llm.base import table
from tessera.session import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        v = v.item()
    return "null" if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v) else round(v, 5) if isinstance(v, float) else v


def rows_sorted(pdf):
    return rows(pdf)


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert rows(catalog.QUERIES[name](spark, SF).toPandas()) == rows(con.execute(catalog.ORACLE_SQL[name]).df())


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in catalog.QUERIES) == list(range(1, 14))


# ------------------------------------------------------------------ mixture
def shares(spark, tokens):
    df = spark.createDataFrame([(s, t) for s, t in tokens.items()], "src string, tokens long")
    return df.withColumn("total", F.lit(float(sum(tokens.values()))))


def test_exponent_meets_either_target(spark):
    tokens = {"a": 900_000, "b": 60_000, "c": 30_000, "d": 10_000, "none": 0}
    p = np.array([t for t in tokens.values() if t]) / sum(tokens.values())

    def mixture(a):
        return p ** a / (p ** a).sum()

    df = shares(spark, tokens)
    a = mixing.bisect_exponent(df, target_entropy=1.0, max_repeats=None)
    w = mixture(a)
    assert abs(-(w * np.log(w)).sum() - 1.0) < 1e-4
    a = mixing.bisect_exponent(df, max_repeats=4.0)
    r = mixture(a) / p
    assert abs(r.max() / r.min() - 4.0) < 1e-3
    assert mixing.bisect_exponent(df, target_entropy=9.0, max_repeats=None) == 0.0
    assert mixing.bisect_exponent(df, target_entropy=0.0, max_repeats=None) == 1.0
    assert mixing.bisect_exponent(df, max_repeats=1e9) == 0.0
    assert mixing.bisect_exponent(df) == mixing.bisect_exponent(df, max_repeats=2.0)
    with pytest.raises(ValueError):
        mixing.bisect_exponent(df, target_entropy=1.0, max_repeats=2.0)


def mixed_docs(spark):
    rng = random.Random(0)
    rows = [(i, rng.choice("aaaaaaabbc"), " ".join("w" * rng.randrange(1, 30))) for i in range(600)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_default_budget_keeps_every_document(spark):
    rows, df = mixed_docs(spark)
    out = mixing.mix(df, max_repeats=2.0).collect()
    assert sorted(r.doc_id for r in out) == list(range(600))
    size = {s: sum(len(t.split()) for _, x, t in rows if x == s) for s in "abc"}
    drawn = {s: sum(len(r.text.split()) * r.repeats for r in out if r.source == s) for s in "abc"}
    weight = {r.source: r.weight for r in out}
    assert drawn["a"] == size["a"] and abs(sum(weight.values()) - 1) < 1e-9
    for s in "bc":  # budgets are met to within one document
        want = weight[s] * size["a"] / weight["a"]
        assert want - 30 <= drawn[s] <= want + 1 and drawn[s] / size[s] <= 2.001
    passes = mixing.draws(mixing.mix(df)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("pass").alias("p"))
    assert passes.where("n <> p").count() == 0


def test_small_budget_is_a_permuted_part(spark):
    rows, df = mixed_docs(spark)
    out = mixing.mix(df, budget=2000).collect()
    drawn = {s: sum(len(r.text.split()) * r.repeats for r in out if r.source == s) for s in "abc"}
    weight = {r.source: r.weight for r in out}
    assert all(weight[s] * 2000 - 31 <= drawn[s] <= weight[s] * 2000 + 1 for s in "abc")
    assert all(r.repeats == 1 for r in out) and len(out) < 600
    # a part of a pass is made of whole blocks but for one
    blocks = {}
    for r in mixing.mix(df).select("doc_id", "source", "block").collect():
        blocks.setdefault((r.source, r.block), set()).add(r.doc_id)
    taken = {r.doc_id for r in out}
    for s in "abc":
        cut = [k for k, v in blocks.items() if k[0] == s and v & taken and not v <= taken]
        assert len(cut) <= 1


def test_mix_odd_rows(spark, odd_docs, no_docs):
    out = mixing.mix(odd_docs)
    got = out.collect()
    assert len(got) == odd_docs.count() and out.columns.count("weight") == 1 and dict(out.dtypes)["weight"] == "double"
    assert len({(r.repeats, r.block) for r in got if r.doc_id == 1}) == 1
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", " ")], "doc_id long, source string, text string")
    assert [r.repeats for r in mixing.mix(blank).collect()] == [1, 1]


# ---------------------------------------------------------------- dialogues
def test_rotation_round_trip(spark):
    turns = [(1, 0, "system", "Be brief."), (1, 1, "ann", "Hi <|im_end|> there"), (1, 2, "bob", "Yo\n"),
             (1, 3, "ann", ""), (1, 4, "c d", "héé")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = {r.perspective: r for r in chat.rotate(df).collect()}
    assert set(out) == {"ann", "bob", "c d"}
    for who, r in out.items():
        at, lost, own = 0, "", []
        for x in r.runs:
            piece = r.rendered[at:at + abs(x)]
            at += abs(x)
            if x > 0:
                own.append(piece)
            else:
                lost += piece
        assert at == len(r.rendered) == r.n_chars and sum(map(len, own)) == r.n_loss_chars
        texts = [t.replace("<|", "< |") + chat.END for _, _, s, t in turns if s == who]
        assert own == texts and r.n_loss_turns == len(texts)
        assert r.rendered.count("<|im_start|>assistant\n") == len(texts)
        assert r.rendered.count("<|im_start|>user name=") == 4 - len(texts)
        assert r.rendered.startswith("<|im_start|>system\nBe brief.<|im_end|>\n")
    assert "name=c_d" in out["ann"].rendered


def test_rotation_parts_and_odd_rows(spark):
    rows = [(1, t, "ab"[t % 2], f"t{t}") for t in range(10)] + [(1, 3, "b", "t3")] * 5
    rows += [(None, 0, "a", "x"), (2, None, None, None), (3, 0, "system", "alone"), (4, 1, "a", "y"), (4, 1, "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("rendered", F.lit(1))
    out = chat.rotate(df, max_turns=4).collect()
    one = [r for r in out if r.conv_id == 1]
    assert sorted((r.part, r.perspective, r.n_turns) for r in one) == [
        (p, s, n) for p, n in ((0, 4), (1, 4), (2, 2)) for s in "ab"]
    assert {r.conv_id for r in out} == {1, 2, 4}
    two = next(r for r in out if r.conv_id == 2)
    assert two.perspective == "unknown" and two.rendered == "<|im_start|>assistant\n<|im_end|>\n"
    four = next(r for r in out if r.conv_id == 4)
    assert four.rendered.index("x<") < four.rendered.index("y<")
    assert chat.rotate(df.limit(0)).count() == 0


def test_rotation_gives_every_speaker_every_part(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "a", "x"), (1, 2, "b", "y"), (1, 5, "a", "z"), (1, 9, "c", "w"), (2, 0, "d", "v")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {(r.conv_id, r.part, r.perspective): r for r in chat.rotate(df, max_turns=4).collect()}
    assert set(out) == {(1, p, s) for p in range(3) for s in "abc"} | {(2, 0, "d")}
    opening = "<|im_start|>system\nbe brief<|im_end|>\n"
    assert out[1, 1, "b"].rendered == opening + "<|im_start|>user name=a\nz<|im_end|>\n" and out[1, 1, "b"].n_loss_turns == 0
    assert out[1, 2, "c"].rendered == opening + "<|im_start|>assistant\nw<|im_end|>\n"


def test_a_long_conversation_equals_the_sql(spark, tmp_path):
    rows = [(1, t, "system" if t < 2 or t == 900 else "abc"[t * t % 3], f"t{t} <|") for t in range(2000)]
    rows += [(2, t, "ab"[t % 2], "x") for t in range(5)] + [(3, 1000, "system", "late"), (3, 5, "system", "first"), (3, 2000, "d", "y")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = chat.op9_perspectives(spark, str(tmp_path)).toPandas()
    assert set(got.part) == {0, 1, 2, 3} and rows_sorted(got) == rows_sorted(con.execute(chat.ORACLE_SQL["op9_perspectives"]).df())


def test_rotation_has_no_python_and_one_shuffle(spark):
    plan = chat.op9_perspectives(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


# --------------------------------------------------------------- neighbours
def brute_knn(vecs, queries, k):
    out = []
    for q in queries:
        best = {}
        for i, v in vecs:
            if i != q[0] and len(v) == len(q[1]):
                best[i] = max(best.get(i, -10**18), int(np.dot(v, q[1])))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q[0], n + 1, i, s) for n, (i, s) in enumerate(top)]
    return sorted(out)


def test_knn_beyond_64_bits(spark):
    rows = [(i, [(-1.0) ** i * 10.0 ** (20 + i % 3), float(i)]) for i in range(40)]
    out = knn.voronoi_knn(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") < 2, k=3).collect()
    top = 2**63 - 1
    assert sorted(tuple(r) for r in out) == [(0, 1, 2, top), (0, 2, 4, top), (0, 3, 6, top), (1, 1, 3, top), (1, 2, 5, top), (1, 3, 7, top)]


@pytest.mark.parametrize("spread", [0.02, 1.0, 1000.0])
def test_knn_matches_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", 20)
    monkeypatch.setattr(knn, "QUERY_ROWS", 4)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8)) * 3
    vecs = [(i, (centres[i % 6] + rng.normal(size=8) * spread).tolist()) for i in range(400)]
    vecs += [(400 + i, vecs[0][1]) for i in range(60)]  # a hot vector: ties
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").repartition(5)
    got = knn.voronoi_knn(df, F.col("vec_id") % 20 == 0, 5).collect()
    whole = [(i, np.floor(np.array(v) * 256).astype(object)) for i, v in vecs]
    assert sorted(tuple(r) for r in got) == brute_knn(whole, [v for v in whole if v[0] % 20 == 0], 5)


def test_bounds_prune_far_cells(spark):
    pivots = {2: np.array([[100.0, 0], [0, 100], [-100, 0]])}
    data = [{"dim": 2, "cell": c, "n": 10, "radius": 5.0} for c in range(3)]
    assert knn.needed(data, [{"dim": 2, "cell": 0, "radius": 1.0}], pivots, {2: np.array([[100.0, 0]])}, 5) == [(2, 0, 0)]
    data[0]["n"] = 5  # with the query itself among five rows, the next cell is needed too
    assert [t[2] for t in knn.needed(data, [{"dim": 2, "cell": 0, "radius": 1.0}], pivots, {2: np.array([[100.0, 0]])}, 5)] == [0, 1]


def test_knn_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []),
            (7, [1.0]), (None, [9.0, 9.0]), (1, [2.0, 1.0]), (8, [1e12, 0.0]), (9, [-0.001, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in
                 knn.voronoi_knn(df, F.col("vec_id").isin(0, 7), 5).collect())
    v = [(i, [math.floor(256 * x) for x in e]) for i, e in rows
         if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    assert got == brute_knn([(i, np.array(e, object)) for i, e in v], [(0, np.array(v[0][1], object))], 5)
    assert knn.voronoi_knn(df.limit(0), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("kind", ["twice", "hot row", "hot id"])
def test_knn_repeated_ids(spark, kind, monkeypatch):
    """Blocks of more than 4 k rows in which copies, or one id's many vectors, hold the best scores."""
    monkeypatch.setattr(knn, "CELL_ROWS", 64)
    rng = np.random.default_rng(8)
    vecs = [(i, (rng.normal(size=4) + 2).tolist()) for i in range(120)]
    best = [4.0, 4.0, 4.0, 4.0]
    more = {"twice": vecs, "hot row": [(7, best)] * 300, "hot id": [(7, [x + 0.1 * (i % 40) for x in best]) for i in range(300)]}
    vecs = vecs + more[kind]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").repartition(2)
    got = knn.voronoi_knn(df, F.col("vec_id") % 20 == 0, 5).collect()
    whole = [(i, np.floor(np.array(v) * 256).astype(object)) for i, v in vecs]
    asked = {i: (i, v) for i, v in whole if i % 20 == 0}
    assert sorted(tuple(r) for r in got) == brute_knn(whole, list(asked.values()), 5)


# ----------------------------------------------------------------- pipeline
def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicate", "repeated_spans", "decontamination",
                                                      "mixture"]
    last = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, last, SF).cache()
        assert out.columns[:5] == docs.columns
        assert i == 4 or out.dtypes == docs.dtypes
        assert out.count() <= last.count() and out.count() > 0.6 * last.count()
        last = out
    got = corpus_pipeline.run(spark, SF)
    assert rows(got.toPandas()) == rows(last.toPandas())


def test_pipeline_against_plain_reading(spark):
    """Near-copies, contamination and toxicity of the result, checked on plain texts."""
    from test_minhash import brute
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    kept = corpus_pipeline.toxicity(spark, table(spark, SF, "documents"), SF)
    want = brute([(r.doc_id, r.text) for r in kept.collect()], 80)
    once = corpus_pipeline.near_duplicate(spark, kept, SF)
    assert sorted(r.doc_id for r in once.collect()) == sorted(i for i, c in want.items() if i == c)
    clean = corpus_pipeline.decontamination(spark, table(spark, SF, "documents"), SF)
    flat = lambda t: " ".join(t.lower().split())
    items = [flat(r.text) for r in table(spark, SF, "benchmark").collect()]
    dirty = {i for i, t in docs.items() if any(x in flat(t) for x in items)}
    left = {r.doc_id for r in clean.collect()}
    assert dirty and not dirty & left and left | dirty == set(docs)


def test_pipeline_odd_rows(spark, odd_docs, no_docs):
    cols = ["doc_id", "text", "lang", "source", "n_chars"]
    docs, none = odd_docs.select(*cols), no_docs.select(*cols)
    for _, stage in corpus_pipeline.STAGES:
        docs, none = stage(spark, docs, SF).cache(), stage(spark, none, SF).cache()
        assert none.count() == 0 and none.columns == docs.columns
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(1) == 1 and 0 in ids and 23 not in ids and None in ids and {20, 21, 22} <= set(ids)
