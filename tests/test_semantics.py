"""Edge semantics against hand-made rows and small Python models."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import mc as MC
from tessera.operators import metrics as M
from tessera.operators import pairs as P
from tessera.operators import qa as QA
from tessera.operators import rouge as R
from tessera.operators import vocab as V

SF = "/root/testdata/sf0.001"
FEAT = ("example_id int, feature_id int, offsets array<struct<s:int,e:int>>, start_logits array<double>, "
        "end_logits array<double>")


def count(spark, table, where="true"):
    return spark.read.parquet(f"{SF}/{table}.parquet").where(where).count()


# ------------------------------------------------------- nothing gets lost
@pytest.mark.parametrize("name,key,table,where", [
    ("max_pool_vectors", "doc_id", "documents", "true"), ("qa_null_odds", "example_id", "documents", "true"),
    ("qa_beam_null_odds", "example_id", "documents", "true"), ("qa_predictions", "example_id", "documents", "true"),
    ("encode_tokens", "doc_id", "documents", "true"), ("repair_answers", "item_id", "benchmark", "true"),
    ("pair_by_id", None, "conversations", "role = 'user'"), ("truncate_pairs", "id", "documents", "true"),
    ("padded_batches", "doc_id", "documents", "true")])
def test_rows_are_conserved(spark, name, key, table, where):
    out = E.queries()[name](spark, SF)
    n = out.select(key).distinct().count() if key else out.count()
    assert n == count(spark, table, where)


def test_rejects_and_good_rows_add_up(spark):
    q = E.queries()
    items = count(spark, "benchmark")
    assert q["mc_rows"](spark, SF).count() + q["mc_rejects"](spark, SF).count() == items
    assert q["squad_rows"](spark, SF).count() + q["squad_rejects"](spark, SF).count() == items
    vectors = count(spark, "embeddings")
    lost = count(spark, "embeddings", "vec_id % 50 = 7 and vec_id % 20 <> 3")
    assert q["word_vectors_scan"](spark, SF).count() == vectors - lost
    assert q["word_vector_rejects"](spark, SF).count() == count(spark, "embeddings", "vec_id % 50 = 7")


# ---------------------------------------------------------- passage lookup
def test_lookup_matches_plain_containment(spark):
    rng = random.Random(0)
    words = ["cat", "con", "concatenate", "the", "bathe", "it", "now", "a", "b", "é"]
    docs = [(i, rng.choice(["", " "]) + rng.choice([" ", "  ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(0, 9))))
            for i in range(150)]
    passages = ["cat", "the cat", "at", "e", "cat now it", "a b a b a", "it  now", "the\ncat", "athe it no", "", " ", " cat", "cat "]
    p = spark.createDataFrame(list(enumerate(passages)), "item_id int, text string")
    d = spark.createDataFrame(docs, "doc_id int, text string")
    got = {(r.item_id, r.doc_id): r.char_start for r in MC.containing_docs(p, d).collect()}
    want = {(i, j): t.index(x) for i, x in enumerate(passages) for j, t in docs if x.strip() and x in t}
    assert got == want and {i for i, _ in want} >= {0, 1, 2, 3, 6, 7, 11}
    only_long = MC.containing_docs(p.where("item_id in (4, 5)"), d).collect()
    assert {(r.item_id, r.doc_id) for r in only_long} == {k for k in want if k[0] in (4, 5)}


def test_common_middle_words_make_few_candidates(spark):
    from tessera.functions.text import split_ws
    rng = random.Random(5)
    filler = ["".join(rng.choice("bcdfgklmnprstvz") for _ in range(5)) for _ in range(400)]
    passages = [(i, f"{rng.choice(filler)} common {rng.choice(filler)}") for i in range(20)]
    passages += [(100 + i, " ".join([rng.choice(filler), "common", "common", rng.choice(filler), "common", rng.choice(filler)])) for i in range(20)]
    docs = [(i, " ".join(w for _ in range(8) for w in (rng.choice(filler), "common"))) for i in range(400)]
    docs += [(1000 + i, "common x" + t + "y common") for i, (_, t) in enumerate(passages)]
    p = spark.createDataFrame(passages, "item_id int, text string")
    d = spark.createDataFrame(docs, "doc_id int, text string")
    pairs = MC.rare_gram_pairs(p.select("item_id", split_ws("text").alias("pt")), d.select("doc_id", split_ws("text").alias("dt")),
                               "item_id", "doc_id").distinct().count()
    true = sum(x in t for _, x in passages for _, t in docs)
    assert MC.containing_docs(p, d).count() == true >= 40
    assert pairs <= 2 * true + 400 * 20 * 8 / 15 ** 2  # a word's neighbours share both letters by chance


# ----------------------------------------------------- n-best and no answer
def nbest(spark, start, end, offsets, **kw):
    offs = [None if o is None else {"s": o[0], "e": o[1]} for o in offsets]
    f = spark.createDataFrame([(1, 1, offs, start, end)], FEAT)
    e = spark.createDataFrame([(1, "abcdef")], "example_id int, context string")
    return [(r.text, r.is_null) for r in QA.qa_nbest(e, f, **kw).orderBy("rank").collect()]


def test_null_candidate_ranks_after_equal_scores(spark):
    got = nbest(spark, [0.0] * 3, [0.0] * 3, [None, (0, 1), (1, 2)], n_best=3, max_len=5, with_negative=True)
    assert got == [("a", False), ("ab", False), ("b", False), ("", True)]
    got = nbest(spark, [0.0] * 3, [0.0] * 3, [None, (0, 1), (1, 2)], n_best=9, max_len=5, with_negative=True)
    assert got[-1] == ("", True) and len(got) == 4


def test_a_kept_empty_span_stands_for_the_null_candidate(spark):
    got = nbest(spark, [0.0, 5.0, 4.0], [0.0, 5.0, 4.0], [None, (0, 0), (1, 2)], n_best=2, max_len=1, with_negative=True)
    assert got == [("", False), ("b", False)]


def test_examples_of_empty_text_alone_keep_their_row(spark):
    f = spark.createDataFrame([(1, 1, [{"s": 1, "e": 1}], [1.0], [1.0]), (2, 2, [None, {"s": 0, "e": 3}], [1.0, 2.0], [1.0, 2.0])], FEAT)
    e = spark.createDataFrame([(1, "abc"), (2, "xyz")], "example_id int, context string")
    got = {r.example_id: r for r in QA.qa_predict(QA.qa_nbest(e, f, with_negative=True), with_negative=True).collect()}
    assert got[1].prediction == "" and got[1].score_diff is None and got[2].prediction == "xyz"


def test_beam_fallback_context_filter_and_null_score(spark):
    schema = ("example_id int, feature_id int, offsets array<struct<s:int,e:int>>, start_log_probs array<double>, "
              "start_index array<int>, end_log_probs array<double>, end_index array<int>, cls_logit double, "
              "token_is_max_context map<string,boolean>")
    offs = [None, {"s": 0, "e": 1}, {"s": 1, "e": 2}]
    b = spark.createDataFrame([
        (1, 1, offs, [-1.0, -2.0], [1, 2], [-1.0, -2.0, -3.0, -4.0], [1, 2, 2, 2], 0.5, {"1": True, "2": False}),
        (1, 2, offs, [-1.5, -2.0], [2, 1], [-1.0, -2.0, -3.0, -4.0], [2, 2, 1, 2], 0.25, {"2": True}),
        (2, 3, offs, [-1.0, -2.0], [0, 0], [-1.0, -2.0, -3.0, -4.0], [0, 0, 0, 0], 0.75, {"0": True})], schema)
    e = spark.createDataFrame([(1, "ab"), (2, "cd")], "example_id int, context string")
    nb = QA.qa_beam_nbest(e, b, start_n=2, end_n=2)
    got = [(r.example_id, r.text, r.start_logit) for r in nb.orderBy("example_id", "rank").collect()]
    assert got == [(1, "a", -1.0), (1, "b", -1.5), (1, "ab", -1.0), (1, "b", -1.5), (2, "", -1e-6)]
    odds = {r.example_id: (r.prediction, r.null_score) for r in QA.qa_beam_null_odds(nb, b).collect()}
    assert odds == {1: ("a", 0.25), 2: ("", -2e-6)}


def test_no_answer_scores(spark):
    refs = spark.createDataFrame([("1", ["the cat"]), ("2", []), ("3", []), ("4", ["dog"])], "id string, answers array<string>")
    preds = spark.createDataFrame([("1", "cat sat"), ("2", ""), ("3", "x")], "id string, prediction string")
    r = QA.qa_em_f1(preds, refs, with_negative=True).first()
    assert (r.n, r.has_answer_n, r.no_answer_n) == (4, 2, 2)
    assert r.exact_match == 25.0 and r.no_answer_exact_match == 50.0 and r.has_answer_exact_match == 0.0
    assert abs(r.has_answer_f1 - 100 * (2 * 0.5 * 1 / 1.5) / 2) < 1e-9 and r.no_answer_f1 == 50.0
    assert QA.format_predictions(preds, True).columns == ["id", "prediction_text", "no_answer_probability"]


# -------------------------------------------------------- pairs and columns
def test_pair_by_id(spark):
    refs = spark.createDataFrame([("1", "r1"), ("2", "r2")], "id string, ref string")
    preds = spark.createDataFrame([("1", "old", 1), ("1", "new", 2), ("9", "x", 3)], "id string, pred string, line int")
    got = sorted((r.id, r.pred, r.matched) for r in P.pair_by_id(refs, preds, ["id"], strict=False, order="line").collect())
    assert got == [("1", "new", True), ("2", None, False)]
    with pytest.raises(Exception, match="no prediction for 2"):
        P.pair_by_id(refs, preds, ["id"], order="line").collect()


def test_column_roles_and_optional_label(spark):
    df = spark.createDataFrame([("a", "b", "c")], "x string, tokens string, ner_tags string")
    assert P.resolve_columns(df, {"text": None, "label": None}, {"text": "tokens", "label": "ner_tags"}) == {
        "text": "tokens", "label": "ner_tags"}
    assert P.resolve_columns(df, {"text": None, "label": None}) == {"text": "x", "label": "tokens"}
    assert P.resolve_columns(df, {"text": "ner_tags"}) == {"text": "ner_tags"}
    with pytest.raises(ValueError, match="'zzz' is none of x, tokens"):
        P.resolve_columns(df, {"text": "zzz"})
    with pytest.raises(ValueError, match="only 1 columns"):
        P.resolve_columns(df.select("x"), {"text": None, "label": None})
    assert "id" in P.with_optional_label(df, "x", lambda d: d.withColumn("id", F.lit(1))).columns
    assert P.with_optional_label(df, "intent", lambda d: d.withColumn("id", F.lit(1))).columns == df.columns


# -------------------------------------------------------------------- ROUGE
def model_places(a, b, up):
    """LCS by memoised recursion from the ends."""
    import functools

    @functools.cache
    def size(i, j):
        if not i or not j:
            return 0
        return size(i - 1, j - 1) + 1 if a[i - 1] == b[j - 1] else max(size(i - 1, j), size(i, j - 1))

    i, j, out = len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.insert(0, i)
        elif size(i - 1, j) > size(i, j - 1) or up and size(i - 1, j) == size(i, j - 1):
            i -= 1
        else:
            j -= 1
    return out


def test_lcs_helpers():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(0, 9))] for _ in range(2))
        assert len(R.lcs_places(a, b, True)) == R.lcs_length(a, b)
        for up in (False, True):
            assert R.lcs_places(a, b, up) == model_places(a, b, up)


def test_lcs_of_long_texts_needs_little_memory():
    import tracemalloc
    rng = random.Random(3)
    a, b = ([rng.randrange(2000) for _ in range(20_000)] for _ in range(2))
    tracemalloc.start()
    places = R.lcs_places(a, b, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(places) == R.lcs_length(a, b) and peak < 50e6
    at = 0  # a subsequence of both
    for x in (a[i] for i in places):
        at = b.index(x, at) + 1


def test_logged_scores_with_stems(spark):
    pairs = spark.createDataFrame([(1, "The runner was running\nfast", "the runners run\nfaster")], "k int, hyp string, ref string")
    for tokenizer in ("alnum", "alnum_stemmed"):
        t = R.rouge_lsum(R.tokenize_pairs(pairs, ["k"], "hyp", "ref", tokenizer), "hyp", "ref", tokenizer != "alnum")
        n = R.rouge_n_multiset(t, ["k"], (1,)).first()
        hits = {"alnum": 1, "alnum_stemmed": 3}[tokenizer]  # the; runner run -> the, runner, run
        assert abs(n.rouge1 - 2 * hits / 9) < 1e-9 and abs(t.first().rougeLsum - 2 * hits / 9) < 1e-9
    plain, stemmed = (E.queries()[q](spark, SF).first() for q in ("rouge_logged", "rouge_logged_stemmed"))
    assert stemmed.rouge1 >= plain.rouge1 and stemmed.rougeLsum >= plain.rougeLsum


def test_rouge_l_of_either_family(spark):
    pairs = spark.createDataFrame([(1, "police killed the gunman", "police kill the gunman"),
                                   (2, "w1 w2 w6 w7 w8. w1 w3 w8 w9 w5", "w1 w2 w3 w4 w5"),
                                   (3, "the cat. the dog", "the dog. the cat")], "k int, hyp string, ref string")
    t = R.tokenize_pairs(pairs, ["k"], "hyp", "ref")
    got = {r.k: r.rougeL for r in R.rouge_l_set(t, "hyp", "ref").collect()}
    assert abs(got[1] - 0.75) < 1e-6
    p, r = 4 / 8, 4 / 5  # w1 w2 | w1 w3 w5: four distinct words, of eight and five
    assert abs(got[2] - 2 * p * r / (p + r)) < 1e-6 and abs(got[3] - 1.0) < 1e-6
    whole = {r.k: r.rougeL for r in R.rouge_l(t).collect()}
    assert abs(whole[1] - 0.75) < 1e-9 and whole[3] == 0.5
    lines = spark.createDataFrame([(1, "w1 w2 w6 w7 w8\nw1 w3 w8 w9 w5", "w1 w2 w3 w4 w5")], "k int, hyp string, ref string")
    s = R.rouge_lsum(lines, "hyp", "ref").first().rougeLsum
    assert abs(s - 2 * (4 / 10) * (4 / 5) / (4 / 10 + 4 / 5)) < 1e-9


def test_empty_hypotheses(spark):
    pairs = spark.createDataFrame([(1, "", "a b"), (2, "a", "a"), (3, " . ", "a")], "k int, hyp string, ref string")
    assert [r.k for r in R.tokenize_pairs(pairs, ["k"], "hyp", "ref", empty="ignore").collect()] == [2]
    scores = {r.k: r.rouge1 for r in R.rouge_n_set(R.tokenize_pairs(pairs, ["k"], "hyp", "ref")).collect()}
    assert scores[1] == 0.0 and scores[2] > 0.99
    with pytest.raises(Exception, match="empty hypothesis"):
        R.tokenize_pairs(pairs, ["k"], "hyp", "ref", empty="error").select("ht").collect()


def test_logged_scores_are_rounded(spark):
    r = E.queries()["rouge_logged"](spark, SF).first()
    for v in r.asDict().values():
        assert 0 < v < 100 and abs(v * 10_000 - round(v * 10_000)) < 1e-6
    assert r.rougeLsum >= r.rougeL - 1e-9
    gate = E.queries()["quality_gate"](spark, SF).first()
    per = [x.rougeL_f for x in E.queries()["rouge_l"](spark, SF).collect()]
    assert abs(gate.rougeL - 100 * sum(per) / len(per)) < 1e-3
    assert gate.passed == (gate.rouge1 > 22.0 and gate.rouge2 > 8.5 and gate.rougeL > 20.5)


# ------------------------------------------------------------- logs, models
def test_metric_log_keeps_lines_without_a_number(spark):
    lines = ["{'rouge1': 1.5, 'step': 1}", "{'rouge1': nan, 'step': 4}", "no metrics here", "{'step': 9}"]
    df = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    got = [(r.row_no, r.rouge1, r.step) for r in M.parse_metric_log(df, "line", order=["n"]).orderBy("row_no").collect()]
    assert got == [(0, 1.5, 1.0), (1, None, 4.0), (2, None, 9.0)]


def test_classifier_and_tagger_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = E.queries()["classify_text"](spark, sf).collect()
    assert 100 < len(rows) < 320 and sum(r.lang == r.predicted for r in rows) / len(rows) > 0.9
    alone = E.queries()["tag_tokens"](spark, sf).collect()
    together = [r for r in E.queries()["tag_sequences"](spark, sf).collect() if r.held]
    assert {(r.conv_id, r.turn) for r in alone} == {(r.conv_id, r.turn) for r in together}
    share = [sum(r.n_correct for r in rows) / sum(r.n_tokens for r in rows) for rows in (alone, together)]
    assert share[0] > 0.8 and share[1] > max(0.95, share[0])
    report = {r.label: r.f1 for r in E.queries()["tag_sequence_f1"](spark, sf).collect()}
    assert report["micro avg"] > 0.9


def test_vector_max_over_all_tokens(spark):
    from tessera.operators.ml import max_pool_vectors
    df = spark.createDataFrame([(1, [1.0, -2.0]), (1, [0.5, 3.0]), (2, [-1.0, -1.0])], "k int, vector array<double>")
    assert {r.k: r.pooled for r in max_pool_vectors(df, "k", dim=2).collect()} == {1: [1.0, 3.0], 2: [-1.0, -1.0]}


# -------------------------------------------------------------------- plans
def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_without_needless_shuffles(spark):
    q = E.queries()
    assert "Exchange" not in plan(q["token_offsets"](spark, SF)).replace("AQEShuffleRead", "")
    assert "Exchange" not in plan(q["context_windows"](spark, SF))
    p = plan(q["max_pool_vectors"](spark, SF))
    assert re.search(r"keys=\[doc_id#\d+L\], functions=\[max\(", p) and "keys=[doc_id, dim" not in p
    for name in ("rouge_n", "rouge_l"):
        assert plan(q[name](spark, SF)).count("Join") <= 2  # the pairing alone
    assert "CartesianProduct" not in plan(q["relevant_context"](spark, SF))


def test_broadcast_hint_needs_numbers_alone(spark):
    from tessera.operators.common import bounded_broadcast
    words = spark.createDataFrame([("a", 1)], "token string, id int")
    assert "broadcast" not in bounded_broadcast(words, 10)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in bounded_broadcast(words.select("id"), 10)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in bounded_broadcast(words.select("id"), 10**9)._jdf.queryExecution().analyzed().toString().lower()


def test_encode_separates_long_tokens(spark):
    long = "x" * 5000
    df = spark.createDataFrame([(1, f"{long} {long}y a")], "k int, t string")
    vocab = spark.createDataFrame([(long, 2), ("a", 3)], "token string, id int")
    assert V.encode(df, "k", "t", vocab, 10).first().ids == [2, 1, 3]
