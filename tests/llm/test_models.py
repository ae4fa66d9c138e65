"""Toxicity machine, quality model and language chains: held-out accuracy, gradients, odd rows."""

import random
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid, quality, toxicity
from tessera.llm.base import held_out, table

SF = "/root/testdata/sf0.01"


def auc(score, label):
    s, y = np.array(score), np.array(label)
    a, b = s[y == 1], s[y == 0]
    return (a[:, None] > b[None]).mean() + 0.5 * (a[:, None] == b[None]).mean()


def test_held_out_is_crc32(spark):
    df = spark.createDataFrame([(i,) for i in (0, 1, 17, -4, None)], "doc_id long")
    got = {r.doc_id: r.h for r in df.select("doc_id", held_out("doc_id", 3, 1).alias("h")).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in (0, 1, 17, -4, None)}


@pytest.mark.parametrize("name,label,floor", [("toxicity", "toxic", 0.85), ("quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, floor):
    module = {"toxicity": toxicity, "quality": quality}[name]
    query = next(iter(module.QUERIES.values()))
    out = query(spark, SF)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    assert auc([r.score for r in rows], [r[label] for r in rows]) > floor
    assert out.where("score < 0 or score > 1 or predicted <> int(score >= 0.7)").count() == 0
    assert out.count() == 1000


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    some = labels.where(~held_out("doc_id", 3, 1))
    flipped = labels.withColumn("toxic", F.when(held_out("doc_id", 3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = toxicity.fit_toxicity(docs, some)
    b = toxicity.fit_toxicity(docs, flipped.where(~held_out("doc_id", 3, 1)))
    assert np.array_equal(a.weight, b.weight) and a.bias == b.bias


def test_factor_machine_learns_pairs():
    """Neither of two terms alone marks a text, both together do."""
    rng = np.random.default_rng(0)
    x = rng.random((800, 12)) < 0.4
    y = (x[:, 0] & x[:, 1]).astype(float)
    doc, col = np.nonzero(x)
    fm = toxicity.fit_machine(doc, col.astype(np.uint64), y, epochs=800, min_gain=0)
    keep = fm.lookup(col.astype(np.uint64)) >= 0
    z = fm.logits(doc[keep], fm.lookup(col.astype(np.uint64))[keep], 800)
    only = x[:, 0] ^ x[:, 1]
    assert ((z > 0) == (y == 1)).mean() > 0.97 and (z[only] < 0).mean() > 0.97


def test_pairs_are_learnt_from_terms_without_signal(spark):
    """Both words are as frequent in clean as in toxic texts; a text that holds both is toxic."""
    rng = random.Random(2)
    cells = [("badger heron", 1, 60), ("badger", 0, 140), ("heron", 0, 140), ("", 1, 120), ("", 0, 140)]
    rows = []
    for said, toxic, size in cells:
        for _ in range(size):
            words = said.split() + [f"{a}{b}" for a, b in zip(rng.choices("bdfgk", k=12), rng.choices("aeiou", k=12))]
            rng.shuffle(words)
            rows.append((len(rows), " ".join(words), said, toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, said string, toxic int")
    out = toxicity.score_toxicity(df, toxicity.fit_toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic")))
    by = {s: [r.toxicity for r in out.collect() if r.said == s] for s in ("badger heron", "badger", "heron")}
    assert np.mean(np.array(by["badger heron"]) >= 0.7) > 0.9
    assert np.mean(np.array(by["badger"] + by["heron"]) < 0.3) > 0.9


def test_models_without_labels_or_of_one_kind(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (None, 0, 1), (2, 5, 7)], "doc_id long, quality int, toxic int")
    for lab in (none, one):
        for score, fit in ((toxicity.score_toxicity, toxicity.fit_toxicity), (quality.score_quality, quality.fit_quality)):
            rows = score(odd_docs, fit(odd_docs, lab), out="score").collect()
            assert len(rows) == odd_docs.count() and len({r.score for r in rows}) == 1 and 0 < rows[0].score < 1
            assert score(no_docs, fit(no_docs, lab)).count() == 0


def test_columns_pass_and_clash(odd_docs):
    fm = toxicity.fit_machine(np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0))
    out = toxicity.score_toxicity(odd_docs, fm, out="score")
    assert sorted(out.columns) == sorted(odd_docs.columns) and dict(out.dtypes)["score"] == "double"


def test_additive_model_is_a_sum_of_tables():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # a pure interaction
    m = quality.fit_additive(x, y)
    z = m.logits(x)
    assert ((z > 0) == (y == 1)).mean() > 0.95
    assert m.pairs and m.pairs[0][:2] == (0, 1)
    again = np.full(len(x), m.bias)
    for f in range(3):
        again += m.tables[f][np.searchsorted(m.edges[f], x[:, f], "right")]
    for f, g, v in m.pairs:
        again += v[np.searchsorted(m.coarse[f], x[:, f], "right"), np.searchsorted(m.coarse[g], x[:, g], "right")]
    assert np.allclose(z, again)


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(4)
    first = np.array([0, 3, 4, 8])
    emit, trans = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    marg, pair = langid.chains(emit, trans, first)
    want_m, want_p = np.zeros((8, 3)), np.zeros((3, 3))
    for a, b in zip(first[:-1], first[1:]):
        total = 0
        m, p = np.zeros((b - a, 3)), np.zeros((3, 3))
        for path in product(range(3), repeat=b - a):
            s = np.exp(sum(emit[a + i, l] for i, l in enumerate(path)) + sum(trans[x, y] for x, y in zip(path, path[1:])))
            total += s
            for i, l in enumerate(path):
                m[i, l] += s
            for x, y in zip(path, path[1:]):
                p[x, y] += s
        want_m[a:b] = m / total
        want_p += p / total
    assert np.allclose(marg, want_m) and np.allclose(pair, want_p)


def test_language_accuracy_and_code_switching(spark, odd_docs, no_docs):
    docs = table(spark, SF, "documents")
    out = langid.op4_language_crf(spark, SF)
    rows = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    model = langid.fit_languages(docs.where(~held_out("doc_id", 3, 1)))
    text = {r.lang: r.text for r in docs.where("n_chars between 400 and 900").select("lang", "text").collect()}
    cut = lambda t: " ".join(t.split()[:25])
    mixed = spark.createDataFrame([(1, cut(text["en"]) + " " + cut(text["de"]))], "doc_id long, text string")
    runs = langid.label_languages(mixed, model).first().runs
    assert {r.lang for r in runs if r.words >= 15} == {"en", "de"} and sum(r.words for r in runs) >= 40
    odd = langid.label_languages(odd_docs, model).collect()
    by = {r.doc_id: r for r in odd}
    assert len(odd) == odd_docs.count()
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].runs == [] for i in (20, 21, 22))
    assert by[24].lang_pred in model.labels and 0 < by[24].score <= 1
    assert langid.label_languages(no_docs, model).count() == 0
    none = langid.fit_languages(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in langid.label_languages(odd_docs, none).collect()} == {"und"}
    marks = spark.createDataFrame([(1, "́̂ 12 ..")], "doc_id long, text string")
    assert langid.label_languages(marks, model).first().lang_pred == "und"


def test_chain_gradient_is_that_of_the_likelihood():
    """Emission gradient = marginals - gold, checked by differences."""
    rng = np.random.default_rng(9)
    emit, trans, gold = rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), np.array([0, 1, 1, 0, 1])

    def loss(e):
        z = [sum(e[i, l] for i, l in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))
             for p in product(range(2), repeat=5)]
        g = sum(e[i, l] for i, l in enumerate(gold)) + sum(trans[a, b] for a, b in zip(gold, gold[1:]))
        return np.log(np.exp(z).sum()) - g

    marg, _ = langid.chains(emit, trans, np.array([0, 5]))
    for _ in range(6):
        i, l = random.randrange(5), random.randrange(2)
        d = np.zeros_like(emit)
        d[i, l] = 1e-5
        assert abs((loss(emit + d) - loss(emit - d)) / 2e-5 - (marg[i, l] - (gold[i] == l))) < 1e-6
