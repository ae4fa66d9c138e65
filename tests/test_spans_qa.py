"""Windows, offsets and n-best decoding against small Python models."""

import math
import random
import re

from pyspark.sql import functions as F

from tessera.operators import qa as QA
from tessera.operators import spans as SP


def test_token_offsets_match_python(spark):
    rng = random.Random(1)
    texts = ["", " a  b", "x😀 中文 y", "\ttab\nnl  end "]
    texts += ["".join(rng.choice("ab \n😀中") for _ in range(rng.randint(0, 40))) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    rows = SP.token_rows(df, "k", "t").collect()
    got = {}
    for r in rows:
        got.setdefault(r.k, []).append((r.pos, r.token, r.s, r.e))
    for k, t in enumerate(texts):
        want = [(i, m.group(), m.start(), m.end()) for i, m in enumerate(re.finditer(r"\S+", t))]
        assert sorted(got.get(k, [])) == want


def test_window_fixture_cases(spark):
    # w = 8 tokens, overlap 2 -> step 6
    def windows(n):
        tok = spark.createDataFrame(
            [(1, [{"s": i, "e": i + 1} for i in range(n)])], "k int, offsets array<struct<s:int,e:int>>")
        return [(r.first_tok, r.n_tok) for r in SP.context_windows(tok, "k", 8, 2).orderBy("win").collect()]
    assert windows(0) == [(0, 0)]
    assert windows(8) == [(0, 8)]
    assert windows(9) == [(0, 8), (6, 3)]


def py_nbest(start, end, offsets, n_best, max_len):
    si = sorted(range(len(start)), key=lambda i: (-start[i], i))[:n_best]
    ei = sorted(range(len(end)), key=lambda i: (-end[i], i))[:n_best]
    c = []
    for a in si:
        for b in ei:
            if offsets[a] is None or offsets[b] is None or b < a or b - a + 1 > max_len:
                continue
            c.append((start[a] + end[b], offsets[a][0], offsets[b][1]))
    c.sort(key=lambda x: -x[0])
    return c[:n_best]


def test_nbest_vs_python(spark):
    rng = random.Random(5)
    feats, exs, want = [], [], {}
    for ex in range(20):
        L = 24
        st = [rng.random() for _ in range(L)]
        en = [rng.random() for _ in range(L)]
        offs = [None] + [(4 * i, 4 * i + 3) for i in range(L - 2)] + [None]
        feats.append((ex, ex, [None if o is None else {"s": o[0], "e": o[1]} for o in offs], st, en))
        ctx = "".join(rng.choice("abcdef ") for _ in range(120))
        exs.append((ex, ctx))
        want[ex] = [ctx[s:e] for _, s, e in py_nbest(st, en, offs, 5, 6)] or ["empty"]
    fdf = spark.createDataFrame(feats, "example_id int, feature_id int, offsets array<struct<s:int,e:int>>, "
                                       "start_logits array<double>, end_logits array<double>")
    edf = spark.createDataFrame(exs, "example_id int, context string")
    nb = QA.qa_nbest(edf, fdf, n_best=5, max_len=6).collect()
    got = {}
    for r in sorted(nb, key=lambda r: (r.example_id, r["rank"])):
        got.setdefault(r.example_id, []).append(r.text)
    assert got == want
    for ex in range(20):
        ps = [r.probability for r in nb if r.example_id == ex]
        assert math.isclose(sum(ps), 1.0, rel_tol=1e-9)


def test_no_candidate_gives_empty_row(spark):
    fdf = spark.createDataFrame([(1, 1, [None, None], [1.0, 2.0], [1.0, 2.0])],
                                "example_id int, feature_id int, offsets array<struct<s:int,e:int>>, "
                                "start_logits array<double>, end_logits array<double>")
    edf = spark.createDataFrame([(1, "ctx")], "example_id int, context string")
    r = QA.qa_nbest(edf, fdf).collect()
    assert [(x.text, x.probability) for x in r] == [("empty", 1.0)]


def test_em_f1(spark):
    p = spark.createDataFrame([("1", "The cat sat"), ("2", "a dog")], "id string, prediction string")
    g = spark.createDataFrame([("1", ["cat sat"]), ("2", ["the big dog", "dogs"])], "id string, answers array<string>")
    r = QA.qa_em_f1(p, g).first()
    assert r.exact_match == 50.0
    assert math.isclose(r.f1, (1.0 + 2 * 0.5 * 1.0 / 1.5) / 2 * 100)


def test_candidates_of_uneven_features_match_python(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for k in range(60):
        n, m = rng.choice([0, 1, 2, 7, 40, 90]), rng.choice([0, 1, 5, 40, 90])
        st, en = [rng.randrange(6) / 2 for _ in range(n)], [rng.randrange(6) / 2 for _ in range(m)]
        offs = [rng.choice([None, (3 * i, 3 * i + 2)]) if rng.random() < 0.3 else (3 * i, 3 * i + 2) for i in range(rng.choice([n, max(n, m)]))]
        most = {str(i): rng.choice([True, True, False, None]) for i in range(n) if rng.random() < 0.8}
        rows.append((k, k, [o and {"s": o[0], "e": o[1]} for o in offs], st, en, most or None))
        si = sorted(range(n), key=lambda i: (-st[i], i))[:5]
        ei = sorted(range(m), key=lambda i: (-en[i], i))[:5]
        at = lambda i: offs[i] if i < len(offs) else None
        pairs = [(-(st[a] + en[b]), i, j, at(a)[0], at(b)[1]) for i, a in enumerate(si) for j, b in enumerate(ei)
                 if most.get(str(a)) and at(a) and at(b) and a <= b < a + 12]
        want[k] = sorted(pairs)[:5]
    feats = spark.createDataFrame(rows, "example_id int, feature_id int, offsets array<struct<s:int,e:int>>, start_logits array<double>, "
                                        "end_logits array<double>, token_is_max_context map<string,boolean>")
    out = QA.feature_candidates(feats, 5, 12)
    assert {r.example_id: [(c.nscore, c.srank, c.erank, c.cs, c.ce) for c in r.c] for r in out.collect()} == want
    # no lambda runs over a feature's logits or its map of tokens
    assert "lambdafunction" not in out._jdf.queryExecution().executedPlan().toString()


def test_blocks_of_logits_are_bounded():
    import numpy as np
    lengths = np.array([0, 3, 385, 2_000_000, 1, 385, 0])
    runs = list(QA.logit_blocks(lengths, 400))
    assert [i for a, b in runs for i in range(a, b)] == list(range(7))
    assert all(b - a == 1 or (b - a) * max(400, lengths[a:b].max()) <= QA.BLOCK_LOGITS for a, b in runs)
    assert list(QA.logit_blocks(np.array([], int))) == []


def test_logits_of_the_stand_ins_run_in_batches(spark):
    from tessera.plans import standins as S
    sf = "/root/testdata/sf0.001"
    for df in (S.qa_features(spark, sf).select("start_logits", "end_logits"), S.qa_beams(spark, sf)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "sort_array" not in plan and "% 997" not in plan
    r = S.qa_features(spark, sf).where("example_id = 7 and feature_id % 100000 = 0").first()
    assert r.start_logits[0] == (13 * 7) % 400 / 100 and r.end_logits[0] == (11 * 7) % 400 / 100 - 2
    for i, v in enumerate(r.start_logits[1:]):
        assert v == (7919 * 7 + 10473 * i + 31 * i * i) % 997 / 100 - 5
    for i, v in enumerate(r.end_logits[1:]):
        assert v == (5501 * 7 + 7727 * i + 17 * i * i) % 991 / 100 - 5


def test_beams_of_the_stand_ins_match_python(spark):
    from tessera.plans import standins as S
    sf = "/root/testdata/sf0.001"
    feats = {r.feature_id: r for r in S.qa_features(spark, sf).collect()}
    beams = S.qa_beams(spark, sf).collect()
    assert len(beams) == len(feats)
    for b in beams:
        st, en = feats[b.feature_id].start_logits, feats[b.feature_id].end_logits
        starts = sorted(range(len(st)), key=lambda i: (-st[i], i))[:5]
        ends = [([e for e in sorted(range(len(en)), key=lambda i: (-en[i], i)) if e >= s] + [None] * 5)[:5] for s in starts]
        flat = [e for l in ends for e in l]
        assert b.start_index == starts and b.start_log_probs == [st[i] for i in starts]
        assert b.end_index == [e or 0 for e in flat] and b.end_log_probs == [-1e9 if e is None else en[e] for e in flat]
        assert b.cls_logit == st[0] + en[0]


def test_null_odds_read_the_beams_once(spark):
    import __spark_entry__ as E
    plan = E.queries()["qa_beam_null_odds"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2  # the texts and the beams


def test_windows_of_long_texts_are_cut_in_linear_time(spark):
    sizes = [0, 1, 5, 8, 9, 200_003]
    df = spark.createDataFrame([(n, "a " * n) for n in sizes] + [(-1, None)], "k int, t string")
    tok = SP.token_offsets(df, "k", "t")
    win = SP.context_windows(tok, "k", 8, 2, keep=("offsets", "tokens"))
    assert "slice(" not in win._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in win.collect():
        assert len(r.offsets) == len(r.tokens) == r.n_tok
        assert [(o.s, o.e) for o in r.offsets] == [(2 * i, 2 * i + 1) for i in range(r.first_tok, r.first_tok + r.n_tok)]
        assert (r.start_char, r.end_char) == ((2 * r.first_tok, 2 * (r.first_tok + r.n_tok) - 1) if r.n_tok else (0, 0))
        got.setdefault(r.k, []).append((r.win, r.first_tok, r.n_tok))
    for n in sizes:
        assert sorted(got[n]) == [(k, 6 * k, min(8, n - 6 * k)) for k in range(1 + max(0, -(-(n - 8) // 6)))]
    assert got[-1] == [(0, 0, 0)]
