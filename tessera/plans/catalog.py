"""Query catalog: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads whole driver tables (or tables Spark derives from them),
so its work grows with the scale factor.  Computed columns are aliased and
typed (bigint / double rounded to 6 places / string) to line up with the
DuckDB oracle in ``tessera.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import split_ws
from tessera.operators import vocab as V
from tessera.session import cut_lineage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# Parameters that are the feature of a query: vocabulary size, the length
# limits of a summarisation pair, first-n and sample sizes.
VOCAB_N = 10000
MAX_SOURCE, MAX_TARGET = 512, 64
PIECE_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # a public vocabulary, read where it lies
FIRST_DOCS, FIRST_FEATURES, SAMPLE_ROWS = 100, 200, 20


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _vocab(spark, sf):
    docs = table(spark, sf, "documents")
    return V.vocabulary(V.word_count(docs, "text"), VOCAB_N)


# ---------------------------------------------------------------- vocabulary
@query
def q_word_count(spark, sf):
    return V.word_count(table(spark, sf, "documents"), "text")


@query
def q_vocabulary(spark, sf):
    return _vocab(spark, sf).select("token", F.col("id").cast("bigint").alias("id"), "cnt")


@query
def q_split_union_vocab(spark, sf):
    docs = table(spark, sf, "documents").select("text", F.lit("train").alias("split"))
    bench = table(spark, sf, "benchmark").select("text", F.lit("eval").alias("split"))
    both = docs.unionByName(bench)
    from tessera.functions.text import split_ws
    return (both.select("split", F.explode(split_ws("text")).alias("token"))
            .groupBy("token")
            .agg(F.count(F.lit(1)).alias("cnt"),
                 F.count_if(F.col("split") == "train").alias("n_train"),
                 F.count_if(F.col("split") == "eval").alias("n_eval")))


@query
def q_encode_tokens(spark, sf):
    docs = table(spark, sf, "documents")
    enc = V.encode(docs, "doc_id", "text", _vocab(spark, sf), VOCAB_N)
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                      F.size(F.filter("ids", lambda x: x == 1)).cast("bigint").alias("n_unk"),
                      F.array_join("ids", " ").alias("ids"))


@query
def q_decode_ids(spark, sf):
    docs = table(spark, sf, "documents")
    vocab = _vocab(spark, sf)
    enc = V.encode(docs, "doc_id", "text", vocab, VOCAB_N)
    dec = V.decode(enc, "doc_id", "ids", vocab, VOCAB_N)
    return dec.select("doc_id", F.size("tokens").cast("bigint").alias("n_kept"),
                      F.array_join("tokens", " ").alias("text"))


@query
def q_oov_tokens(spark, sf):
    bench = table(spark, sf, "benchmark")
    return V.oov_tokens(V.word_count(bench, "text"), _vocab(spark, sf), VOCAB_N)


@query
def q_vocab_coverage(spark, sf):
    bench_tokens = V.word_count(table(spark, sf, "benchmark"), "text")
    return V.vocab_coverage(_vocab(spark, sf), bench_tokens).select(
        "n_total", "n_matched", r6("coverage").alias("coverage"))


# ---------------------------------------------------------------- labels
from tessera.operators import labels as L  # noqa: E402
from tessera.operators import metrics as M  # noqa: E402
from tessera.operators import pieces as PC  # noqa: E402
from tessera.operators import segment as SG  # noqa: E402
from tessera.operators import sentences as ST  # noqa: E402
from tessera.operators import spanscore as SS  # noqa: E402
from tessera.operators import tagger as TG  # noqa: E402
from tessera.operators import seqtags as T  # noqa: E402
from tessera.plans import standins as S  # noqa: E402


def _all_labels(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("lang").alias("label"))
    ev = table(spark, sf, "events").select(F.col("event_type").alias("label"))
    return L.label_index(docs.unionByName(ev), "label")


@query
def q_label_index(spark, sf):
    return _all_labels(spark, sf).select("label", F.col("idx").cast("bigint").alias("idx"))


@query
def q_label_encode(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    enc = L.encode_labels(docs, "lang", _all_labels(spark, sf), "label_id", strict=True)
    return enc.select("doc_id", "lang", F.col("label_id").cast("bigint").alias("label_id"))


@query
def q_label_drift(spark, sf):
    docs = table(spark, sf, "documents")
    model = docs.select(F.col("lang").alias("label"))
    labeled = docs.join(table(spark, sf, "labels"), "doc_id", "left_semi")
    data = (labeled.select(F.col("lang").alias("label"))
            .unionByName(table(spark, sf, "events").select(F.col("event_type").alias("label"))))
    return L.label_drift(model, data)


@query
def q_b_to_i_map(spark, sf):
    labels = L.label_index(S.tag_sequences(spark, sf), "gold", explode=True)
    return L.b_to_i_map(labels).select("b_label", F.col("b_idx").cast("bigint").alias("b_idx"),
                                       "i_label", F.col("i_idx").cast("bigint").alias("i_idx"))


@query
def q_dedupe_predictions(spark, sf):
    docs = table(spark, sf, "documents").select("text", "doc_id", "lang")
    return L.dedupe(docs, ["text"], "doc_id").select("doc_id", "lang")


# ---------------------------------------------------------------- sequences
@query
def q_entities_strict(spark, sf):
    e = T.entities(S.tag_sequences(spark, sf), ["conv_id", "turn"], "pred", strict=True)
    return e.select("conv_id", "turn", "etype", F.col("start").cast("bigint").alias("start"),
                    F.col("end").cast("bigint").alias("end"))


@query
def q_entities_lenient(spark, sf):
    e = T.entities(S.tag_sequences(spark, sf), ["conv_id", "turn"], "pred", strict=False)
    return e.select("conv_id", "turn", "etype", F.col("start").cast("bigint").alias("start"),
                    F.col("end").cast("bigint").alias("end"))


def _entity_report(seqs, strict):
    rep = T.entity_report(T.entity_counts(seqs, ["conv_id", "turn"], "gold", "pred", strict=strict))
    return rep.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"), F.col("support").cast("bigint").alias("support"))


@query
def q_entity_f1_strict(spark, sf):
    return _entity_report(S.tag_sequences(spark, sf), strict=True)


@query
def q_entity_f1_lenient(spark, sf):
    seqs = S.tag_sequences(spark, sf)
    counts = T.entity_counts(seqs, ["conv_id", "turn"], "gold", "pred", strict=False)
    acc = T.token_accuracy(seqs, "pred", "gold")
    return T.flat_metrics(counts, acc).select("metric", r6("value").alias("value"))


@query
def q_joint_accuracy(spark, sf):
    return T.joint_accuracy(S.tag_sequences(spark, sf), "pred", "gold").select(
        "n_seqs", r6("joint_acc").alias("joint_acc"))


@query
def q_token_accuracy(spark, sf):
    return T.token_accuracy(S.tag_sequences(spark, sf), "pred", "gold").select(
        F.col("n_tokens").cast("bigint").alias("n_tokens"), r6("token_acc").alias("token_acc"))


def _tag_labels(spark, sf):
    return L.label_index(S.tag_sequences(spark, sf), "gold", explode=True)


def _tag_ids(spark, sf):
    """Tag sequences with gold/pred tags mapped to label ids, and to the ids of
    the labels' I- forms: explode the positions, join the label table (AQE broadcasts it at runtime when
    small), regroup per sequence with map-side combined collect_list."""
    from tessera.operators.common import ordered_collect
    seqs = S.tag_sequences(spark, sf)
    labels = _tag_labels(spark, sf)
    ex = seqs.select("conv_id", "turn",
                     F.posexplode(F.arrays_zip("tokens", "gold", "pred")).alias("pos", "z"))
    inside = L.b_to_i_map(labels).select(F.col("b_idx").alias("idx"), "i_idx")
    labels = labels.join(inside, "idx", "left").select("label", "idx", F.coalesce("i_idx", "idx").alias("inside"))
    ex = (ex.join(labels.select(F.col("label").alias("g"), F.col("idx").alias("gid"), F.col("inside").alias("gin")),
                  F.col("z.gold") == F.col("g"), "left")
          .join(labels.select(F.col("label").alias("p"), F.col("idx").alias("pid"), F.col("inside").alias("pin")),
                F.col("z.pred") == F.col("p"), "left")
          .select("conv_id", "turn", "pos",
                  F.struct(F.col("z.tokens").alias("token"), "gid", "pid", "gin", "pin").alias("v")))
    g = ordered_collect(ex, ["conv_id", "turn"], "pos", "v", "vs")
    return g.select("conv_id", "turn", F.col("vs.token").alias("tokens"),
                    F.col("vs.gid").alias("gold_ids"), F.col("vs.pid").alias("pred_ids"),
                    F.col("vs.gin").alias("gold_inside"), F.col("vs.pin").alias("pred_inside"))


def _pieces(spark):
    return PC.piece_splitter(spark, PIECE_FILE)


@query
def q_word_pieces(spark, sf):
    """Every word of every document in pieces of a public vocabulary."""
    cut = _pieces(spark)
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce(F.flatten(cut(split_ws("text"))), F.array()).alias("p"))
    return docs.select("doc_id", F.size("p").cast("bigint").alias("n_pieces"),
                       F.size(F.filter("p", lambda x: x["id"].isNull())).cast("bigint").alias("n_unknown"),
                       F.array_join(F.transform("p", lambda x: x["id"].cast("string")), " ", "?").alias("ids"))


def _tag_pieces(spark, sf):
    return _tag_ids(spark, sf).withColumn("pieces", _pieces(spark)(F.col("tokens")))


def _aligned(spark, sf, inside=None):
    return _tag_pieces(spark, sf).select("conv_id", "turn", T.align_labels("pieces", "gold_ids", inside).alias("a"))


@query
def q_align_labels(spark, sf):
    return _aligned(spark, sf).select(
        "conv_id", "turn", F.size("a").cast("bigint").alias("n_pieces"),
        F.size(F.filter("a", lambda x: x["label"] != -100)).cast("bigint").alias("n_labeled"),
        F.array_join(F.transform("a", lambda x: x["label"].cast("string")), " ").alias("labels"))


@query
def q_align_labels_all(spark, sf):
    """Later pieces of a word carry the id of the label's I- form."""
    return _aligned(spark, sf, "gold_inside").select(
        "conv_id", "turn", F.array_join(F.transform("a", lambda x: x["label"].cast("string")), " ").alias("labels"))


@query
def q_masked_token_accuracy(spark, sf):
    s = _tag_pieces(spark, sf)
    gold = F.transform(T.align_labels("pieces", "gold_ids"), lambda x: x["label"])
    pred = F.transform(T.align_labels("pieces", "pred_ids", "pred_inside"), lambda x: x["label"])
    s = s.select(gold.alias("g"), pred.alias("p"))
    return T.token_accuracy(s, "p", "g", ignore=[-100, -1]).select(
        F.col("n_tokens").cast("bigint").alias("n_tokens"), r6("token_acc").alias("token_acc"))


@query
def q_tag_lines(spark, sf):
    from tessera.operators.common import ordered_collect
    s = _tag_pieces(spark, sf)
    pred = F.transform(T.align_labels("pieces", "pred_ids"), lambda x: x["label"])
    ex = s.select("conv_id", "turn", F.posexplode(pred).alias("pos", "idx")).where(
        ~F.col("idx").isin(-1, -100))
    back = ex.join(_tag_labels(spark, sf), "idx", "inner")
    out = ordered_collect(back, ["conv_id", "turn"], "pos", "label", "tags")
    return out.select("conv_id", "turn", F.array_join("tags", " ").alias("tags"))


@query
def q_encode_tags(spark, sf):
    from pyspark.sql import Window
    from tessera.functions.arrays import pad_array
    s = _tag_ids(spark, sf)
    n = F.max(F.size("gold_ids")).over(Window.partitionBy("conv_id"))
    return s.select("conv_id", "turn", F.size("gold_ids").cast("bigint").alias("length"),
                    F.array_join(pad_array("gold_ids", n, -1), " ").alias("tag_ids"))


@query
def q_encode_tags_fixed(spark, sf):
    """Tags cut and padded to 40, with the raw length."""
    s = _tag_ids(spark, sf).select("conv_id", "turn", T.encode_tags("gold_ids").alias("t"))
    return s.select("conv_id", "turn", F.col("t.length").cast("bigint").alias("length"), F.array_join("t.ids", " ").alias("tag_ids"))


# ---------------------------------------------------------------- QA data
from tessera.operators import mc as MC  # noqa: E402
from tessera.operators import qa as QA  # noqa: E402
from tessera.operators import spans as SP  # noqa: E402
from tessera.functions.text import repair_answer  # noqa: E402


def _mc(spark, sf):
    good, _rej = MC.mc_rows(S.qa_questions(spark, sf), S.context_pool(spark, sf))
    return good


@query
def q_relevant_context(spark, sf):
    hits = MC.containing_docs(table(spark, sf, "benchmark"), table(spark, sf, "documents"))
    return hits.select("item_id", "doc_id", F.col("char_start").cast("bigint").alias("char_start"))


@query
def q_mc_rows(spark, sf):
    m = _mc(spark, sf)
    return m.withColumn("labels", F.col("labels").cast("bigint"))


@query
def q_mc_rows_unlabeled(spark, sf):
    """The split without labels: nothing but paragraphs is known, and every label is 0."""
    m, _rej = MC.mc_rows(S.qa_questions(spark, sf).drop("relevant", "answer"), S.context_pool(spark, sf), labeled=False)
    return m.withColumn("labels", F.col("labels").cast("bigint"))


@query
def q_choices_regrouped(spark, sf):
    """A score for every choice of every question, four to a row."""
    g = MC.regroup_choices(MC.choice_scores(_mc(spark, sf)))
    return g.select("id", *[r6(F.col("values")[i]).alias(f"score{i}") for i in range(4)], F.col("pred").cast("bigint").alias("pred"))


@query
def q_mc_rejects(spark, sf):
    _good, rej = MC.mc_rows(S.qa_questions(spark, sf), S.context_pool(spark, sf))
    return rej.select("id", F.array_join("paragraphs", " ").alias("paragraphs"))


def _squad(spark, sf):
    return MC.squad_rows(S.qa_questions(spark, sf), S.context_pool(spark, sf))


@query
def q_squad_rejects(spark, sf):
    return _squad(spark, sf)[1]


@query
def q_squad_rows(spark, sf):
    sq, _rej = _squad(spark, sf)
    return sq.select("id", "title", "question", "context",
                     F.col("answers.text")[0].alias("answer_text"),
                     F.col("answers.answer_start")[0].cast("bigint").alias("answer_start"))


@query
def q_choice_pairs(spark, sf):
    p = MC.choice_pairs(_mc(spark, sf))
    return p.select("id", F.col("choice").cast("bigint").alias("choice"), "first", "second",
                    F.col("labels").cast("bigint").alias("labels"))


@query
def q_choose_context(spark, sf):
    c = MC.choose_context(_mc(spark, sf))
    return c.select("id", F.col("pred").cast("bigint").alias("pred"), r6("score").alias("score"))


@query
def q_mc_selected_context(spark, sf):
    m = _mc(spark, sf)
    s = MC.selected_context(m, MC.choose_context(m).select("id", "pred"))
    return s.select("id", F.col("pred").cast("bigint").alias("pred"), "context")


def _nbest_out(df):
    return df.select(F.col("example_id").cast("bigint").alias("example_id"),
                     F.col("rank").cast("bigint").alias("rank"), "text",
                     r6("start_logit").alias("start_logit"), r6("end_logit").alias("end_logit"),
                     r6("probability").alias("probability"))


@query
def q_qa_nbest(spark, sf):
    nb = QA.qa_nbest(S.qa_examples(spark, sf), S.qa_features(spark, sf), n_best=20, max_len=30)
    return _nbest_out(nb)


@query
def q_qa_nbest_max_context(spark, sf):
    """Starts only where the window is the token's best one (by rule: every third token is not)."""
    feats = S.with_max_context(S.qa_features(spark, sf))
    return _nbest_out(QA.qa_nbest(S.qa_examples(spark, sf), feats, n_best=20, max_len=30))


def _nbest_negative(spark, sf):
    return QA.qa_nbest(S.qa_examples(spark, sf), S.qa_features(spark, sf), n_best=20, max_len=30, with_negative=True)


@query
def q_qa_nbest_negative(spark, sf):
    return _nbest_negative(spark, sf).select(
        "example_id", F.col("rank").cast("bigint").alias("rank"), "text", r6("start_logit").alias("start_logit"),
        r6("end_logit").alias("end_logit"), r6("probability").alias("probability"), "is_null")


@query
def q_qa_null_odds(spark, sf):
    pr = QA.qa_predict(_nbest_negative(spark, sf), with_negative=True, threshold=0.0)
    return pr.select(F.col("example_id").cast("bigint").alias("example_id"), r6("null_score").alias("null_score"),
                     "best_text", r6("score_diff").alias("score_diff"), "prediction")


@query
def q_qa_beam_nbest(spark, sf):
    nb = QA.qa_beam_nbest(S.qa_examples(spark, sf), S.qa_beams(spark, sf), n_best=20, max_len=30)
    return _nbest_out(nb)


@query
def q_qa_beam_null_odds(spark, sf):
    odds = QA.qa_beam_null_odds(QA.qa_beam_nbest(S.qa_examples(spark, sf), S.qa_beams(spark, sf), n_best=20, max_len=30))
    return odds.select("example_id", "prediction", r6("null_score").alias("null_score"))


@query
def q_qa_predictions(spark, sf):
    nb = QA.qa_nbest(S.qa_examples(spark, sf), S.qa_features(spark, sf), n_best=20, max_len=30)
    pr = QA.qa_predict(nb)
    return pr.select(F.col("example_id").cast("bigint").alias("example_id"), "prediction",
                     repair_answer("prediction").alias("answer"))


@query
def q_repair_answers(spark, sf):
    b = table(spark, sf, "benchmark")
    a = F.col("text")
    k = F.col("item_id") % 5
    raw = (F.when(k == 0, F.concat(F.lit("《"), a)).when(k == 1, F.concat(a, F.lit("》")))
           .when(k == 2, F.concat(F.lit("「"), a)).when(k == 3, F.concat(a, F.lit("」"))).otherwise(a))
    return b.select("item_id", raw.alias("raw")).select("item_id", "raw", repair_answer("raw").alias("answer"))


@query
def q_token_offsets(spark, sf):
    t = SP.token_rows(table(spark, sf, "documents"), "doc_id", "text")
    return t.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token",
                    F.col("s").cast("bigint").alias("s"), F.col("e").cast("bigint").alias("e"))


@query
def q_context_windows(spark, sf):
    tok = SP.token_offsets(table(spark, sf, "documents"), "doc_id", "text")
    w = SP.context_windows(tok, "doc_id", w=128, overlap=32)
    return w.select("doc_id", *[F.col(c).cast("bigint").alias(c)
                                for c in ("win", "first_tok", "n_tok", "start_char", "end_char")])


@query
def q_answer_token_span(spark, sf):
    sq, _rej = _squad(spark, sf)
    tok = SP.token_offsets(sq.select("id", "context"), "id", "context")
    ans = sq.select("id", F.col("answers.answer_start")[0].alias("a_start"),
                    (F.col("answers.answer_start")[0] + F.length(F.col("answers.text")[0])).alias("a_end"))
    a = SP.answer_token_span(tok, ans, "id", w=64, overlap=16)
    return a.select("id", *[F.col(c).cast("bigint").alias(c) for c in ("win", "start_position", "end_position")])


def _shifted(sq):
    """A prediction for every row: as many characters as the answer has, up to two places late."""
    shift = F.col("id").cast("int") % 3
    start, size = F.col("answers.answer_start")[0], F.length(F.col("answers.text")[0])
    return sq.select("id", F.substring("context", start + shift + 1, size).alias("prediction"))


@query
def q_qa_em_f1_v2(spark, sf):
    """The no-answer form: unanswerable questions too; every second question is answered with ''."""
    sq, rej = _squad(spark, sf)
    refs = sq.select("id", F.col("answers.text").alias("answers")).unionByName(
        rej.select("id", F.array().cast("array<string>").alias("answers")))
    some = refs.select("id").join(_shifted(sq), "id", "left").select(
        "id", F.when(F.col("id").cast("int") % 2 == 0, F.lit("")).otherwise(F.coalesce("prediction", F.lit("some text")))
        .alias("prediction"))
    scored = QA.format_predictions(some, with_negative=True)
    r = QA.qa_em_f1(scored.select("id", F.col("prediction_text").alias("prediction")), refs, with_negative=True)
    return r.select(*[c if c.endswith("n") and not c.endswith("match") else r6(c).alias(c) for c in r.columns])


@query
def q_qa_em_f1(spark, sf):
    sq, _rej = _squad(spark, sf)
    preds = _shifted(sq)
    refs = sq.select("id", F.col("answers.text").alias("answers"))
    r = QA.qa_em_f1(preds, refs)
    return r.select("n", r6("exact_match").alias("exact_match"), r6("f1").alias("f1"))


@query
def q_argmax_label(spark, sf):
    from tessera.functions.arrays import argmax
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", argmax("embedding").cast("bigint").alias("pred"),
                    F.col("label").cast("bigint").alias("label"))


@query
def q_span_accuracy(spark, sf):
    from tessera.functions.arrays import argmax
    # a row's start vector is its own, its end vector that of the next row
    e = table(spark, sf, "embeddings")
    n = e.select(F.count(F.lit(1))).scalar()
    end = e.select(((F.col("vec_id") + n - 1) % n).alias("vec_id"), argmax("embedding").alias("pe"))
    x = e.select("vec_id", argmax("embedding").alias("ps"), "label").join(end, "vec_id").select(
        "ps", "pe", F.col("label").alias("gs"), (F.col("label") + F.col("vec_id") % 3).alias("ge"))
    return M.span_accuracy(x, "ps", "pe", "gs", "ge").select("n", r6("span_acc").alias("span_acc"))


# ---------------------------------------------------------------- summaries
from tessera.operators import rouge as R  # noqa: E402
from tessera.functions.text import strip_ws, sentence_lines, split_ws  # noqa: E402


@query
def q_summary_projection(spark, sf):
    return S.summaries(spark, sf)


@query
def q_paired_summaries(spark, sf):
    return S.summary_pairs(spark, sf)


@query
def q_pair_by_id(spark, sf):
    return S.all_pairs(spark, sf)


@query
def q_strip_text(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", strip_ws("text").alias("text"))


@query
def q_sentence_lines(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", sentence_lines("text").alias("s"))
    return d.select("doc_id", F.size("s").cast("bigint").alias("n_sentences"),
                    F.array_join("s", "\n").alias("lines"))


def _sentence_model(spark, sf):
    docs = table(spark, sf, "documents")
    counts = cut_lineage(ST.period_counts(docs, "text"))
    short = cut_lineage(ST.abbreviations(counts))
    return short, cut_lineage(ST.starters(docs, "text", counts, short))


@query
def q_sentence_model(spark, sf):
    """Abbreviations and sentence starters of the documents."""
    short, first = _sentence_model(spark, sf)
    return (short.select(F.lit("abbreviation").alias("kind"), "word", "n", F.col("dotted").alias("marked"), "score")
            .unionByName(first.select(F.lit("starter").alias("kind"), "word", "n", F.col("after").alias("marked"), "score")))


@query
def q_sentences_learned(spark, sf):
    split = ST.sentence_splitter(spark, *_sentence_model(spark, sf))
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce(split(F.col("text")), F.array()).alias("s"))
    return docs.select("doc_id", F.size("s").cast("bigint").alias("n_sentences"), F.array_join("s", "\n").alias("lines"))


@query
def q_truncate_pairs(spark, sf):
    s = S.summaries(spark, sf).select("id", split_ws("maintext").alias("src"), split_ws("title").alias("tgt"))
    s = s.select("id", "src", "tgt", F.slice("src", 1, MAX_SOURCE).alias("src_kept"), F.slice("tgt", 1, MAX_TARGET).alias("tgt_kept"))
    return s.select("id", F.size("src").cast("bigint").alias("n_src"), F.size("src_kept").cast("bigint").alias("n_src_kept"),
                    F.size("tgt").cast("bigint").alias("n_tgt"), F.size("tgt_kept").cast("bigint").alias("n_tgt_kept"),
                    F.array_join("src_kept", " ").alias("src_text"), F.array_join("tgt_kept", " ").alias("tgt_text"))


@query
def q_mask_labels(spark, sf):
    from tessera.functions.arrays import mask_pad
    s = S.summaries(spark, sf).select(F.col("id").cast("long").alias("doc_id"), F.col("title").alias("text"))
    enc = V.encode(s, "doc_id", "text", _vocab(spark, sf), VOCAB_N, to_len=64)
    return enc.select("doc_id", F.array_join(mask_pad("ids"), " ").alias("labels"))


PAIR = ["conv_id", "turn"]


def _pair_tokens(spark, sf, tokenizer="rouge"):
    return R.tokenize_pairs(S.summary_pairs(spark, sf), PAIR, "pred", "ref", tokenizer)


@query
def q_rouge_n(spark, sf):
    t = R.rouge_n_set(_pair_tokens(spark, sf))
    return t.select(*PAIR, r6("rouge1").alias("rouge1_f"), r6("rouge2").alias("rouge2_f"))


@query
def q_rouge_n_char(spark, sf):
    t = R.rouge_n_set(_pair_tokens(spark, sf, "char"))
    return t.select(*PAIR, r6("rouge1").alias("rouge1_f"), r6("rouge2").alias("rouge2_f"))


@query
def q_rouge_n_char_bigram(spark, sf):
    t = R.rouge_n_set(_pair_tokens(spark, sf, "char_bigram"))
    return t.select(*PAIR, r6("rouge1").alias("rouge1_f"), r6("rouge2").alias("rouge2_f"))


def _dictionary(spark, sf):
    return SG.learn_dictionary(table(spark, sf, "documents"), "text")


@query
def q_segment_dictionary(spark, sf):
    return _dictionary(spark, sf).select("word", "cnt", "cohesion", "freedom", "cost")


@query
def q_segment_text(spark, sf):
    split = SG.segmenter(spark, _dictionary(spark, sf))
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce(split(F.col("text")), F.array()).alias("words"))
    return docs.select("doc_id", F.size("words").cast("bigint").alias("n_words"), F.array_join("words", " ").alias("text"))


@query
def q_rouge_n_segmented(spark, sf):
    """Both sides cut into the words of the documents' dictionary before they are scored."""
    split = SG.segmenter(spark, _dictionary(spark, sf))
    t = R.rouge_n_set(_pair_tokens(spark, sf, R.segmented_words(split)))
    return t.select(*PAIR, r6("rouge1").alias("rouge1_f"), r6("rouge2").alias("rouge2_f"))


@query
def q_rouge_scores(spark, sf):
    t = R.rouge_n_set(_pair_tokens(spark, sf))
    return t.agg(F.count(F.lit(1)).alias("n_pairs"), r6(F.avg("rouge1") * 100).alias("rouge1"),
                 r6(F.avg("rouge2") * 100).alias("rouge2"))


@query
def q_rouge_n_multiset(spark, sf):
    t = R.rouge_n_multiset(_pair_tokens(spark, sf, "alnum"), PAIR)
    return t.select(*PAIR, r6(F.col("rouge1") * 100).alias("rouge1"), r6(F.col("rouge2") * 100).alias("rouge2"))


def _logged(spark, sf, stemmed):
    """The multiset family as it is logged: means times 100, four digits."""
    toks = _pair_tokens(spark, sf, "alnum_stemmed" if stemmed else "alnum")
    t = R.rouge_lsum(R.rouge_l(toks), "pred", "ref", stemmed)
    n = R.rouge_n_multiset(toks, PAIR)
    mean = t.agg(F.avg("rougeL").alias("rougeL"), F.avg("rougeLsum").alias("rougeLsum")).withColumn("_k", F.lit(0)).join(
        n.agg(F.avg("rouge1").alias("rouge1"), F.avg("rouge2").alias("rouge2")).withColumn("_k", F.lit(0)), "_k").drop("_k")
    return M.round_scaled(mean, ["rouge1", "rouge2", "rougeL", "rougeLsum"])


@query
def q_rouge_logged(spark, sf):
    return _logged(spark, sf, stemmed=False)


@query
def q_rouge_logged_stemmed(spark, sf):
    return _logged(spark, sf, stemmed=True)


@query
def q_rouge_l(spark, sf):
    t = R.rouge_l_set(_pair_tokens(spark, sf), "pred", "ref")
    return t.select(*PAIR, r6("rougeL").alias("rougeL_f"))


@query
def q_quality_gate(spark, sf):
    t = R.rouge_l_set(R.rouge_n_set(_pair_tokens(spark, sf)), "pred", "ref")
    wide = t.agg(*[(F.avg(c) * 100).alias(c) for c in ("rouge1", "rouge2", "rougeL")])
    return M.quality_gate(wide).select(r6("rouge1").alias("rouge1"), r6("rouge2").alias("rouge2"),
                                       r6("rougeL").alias("rougeL"), "passed")


# ---------------------------------------------------------------- metrics
@query
def q_accuracy(spark, sf):
    lab = table(spark, sf, "labels")
    per = M.accuracy(lab, "quality", "toxic", by="toxic").select(
        F.col("toxic").cast("string").alias("gold"), "n", "accuracy")
    tot = M.accuracy(lab, "quality", "toxic").select(F.lit("all").alias("gold"), "n", "accuracy")
    return per.unionByName(tot).select("gold", "n", r6("accuracy").alias("accuracy"))


@query
def q_prefixed_metrics(spark, sf):
    lab = table(spark, sf, "labels")
    hit = (F.col("quality") == F.col("toxic")).cast("double")
    row = lab.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).cast("double").alias("n"),
                  F.avg("toxic").cast("double").alias("eval_toxic_rate"))
    long = row.select(F.explode(F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in row.columns])).alias("m")).select("m.*")
    return M.prefix_metrics(long).select("metric", r6("value").alias("value"))


def _days(spark, sf):
    return table(spark, sf, "events").withColumn("day", F.to_date("ts"))


@query
def q_epoch_metrics(spark, sf):
    e = M.epoch_metrics(_days(spark, sf), "day", "value")
    return e.select(F.col("day").cast("string").alias("day"), "n_steps", r6("loss_sum").alias("loss_sum"),
                    r6("loss_mean").alias("loss_mean"))


@query
def q_best_epoch(spark, sf):
    per = _days(spark, sf).groupBy("event_type", "day").agg(F.avg("value").alias("metric"))
    b = M.best_so_far(per, ["event_type"], "day", "metric")
    return b.select("event_type", F.col("day").cast("string").alias("day"), r6("metric").alias("metric"), "is_best")


@query
def q_split_counts(spark, sf):
    u = (table(spark, sf, "documents").select(F.lit("train").alias("split"))
         .unionByName(table(spark, sf, "benchmark").select(F.lit("eval").alias("split")))
         .unionByName(table(spark, sf, "conversations").select(F.lit("test").alias("split"))))
    return M.split_counts(u)


def _log_lines(spark, sf):
    """Render per-day event aggregates as training-log lines."""
    d = _days(spark, sf).groupBy("day").agg(
        F.avg(F.when(F.col("event_type") == "click", F.col("value"))).alias("rouge1"),
        F.avg(F.when(F.col("event_type") == "view", F.col("value"))).alias("rouge2"),
        F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("rougeL"),
        F.avg(F.when(F.col("event_type") == "signup", F.col("value"))).alias("rougeLsum"),
        F.avg("value").alias("train_loss"), F.count(F.lit(1)).alias("step"))
    kv = [F.concat(F.lit(f"'{k}': "), F.coalesce(F.col(k).cast("string"), F.lit("nan"))) for k in
          ("rouge1", "rouge2", "rougeL", "rougeLsum", "train_loss")]
    kv.append(F.concat(F.lit("'epoch': "), F.datediff("day", F.lit("2000-01-01")).cast("string")))
    kv.append(F.concat(F.lit("'step': "), F.col("step").cast("string")))
    return d.select("day", F.concat(F.lit("{"), F.concat_ws(", ", *kv), F.lit("}")).alias("line"))


@query
def q_metric_log(spark, sf):
    p = M.parse_metric_log(_log_lines(spark, sf), "line", order=["day"])
    return p.select(F.col("row_no").cast("bigint").alias("row_no"), *[r6(c).alias(c) for c in M.LOG_KEYS])


# ---------------------------------------------------------------- ordering
from tessera.operators import batching as B  # noqa: E402


@query
def q_predictions_indexed(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return B.with_row_index(d, ["doc_id"]).select(
        F.concat(F.lit("test-"), F.col("row_idx").cast("string")).alias("id"), F.col("lang").alias("intent"))


@query
def q_padded_batches(spark, sf):
    d = table(spark, sf, "documents")
    enc = V.encode(d, "doc_id", "text", _vocab(spark, sf), VOCAB_N)
    pb = B.padded_batches(enc, ["doc_id"], "ids", batch_size=16, multiple_of=8)
    return pb.select("doc_id", F.col("batch_id").cast("bigint").alias("batch_id"),
                     F.size("ids").cast("bigint").alias("padded_len"),
                     F.size(F.filter("ids", lambda x: x == 0)).cast("bigint").alias("n_pad"))


@query
def q_first_n_features(spark, sf):
    d = B.first_n(table(spark, sf, "documents"), ["doc_id"], FIRST_DOCS)
    tok = SP.token_offsets(d, "doc_id", "text")
    w = SP.context_windows(tok, "doc_id", w=128, overlap=32)
    w = B.first_n(w, ["doc_id", "win"], FIRST_FEATURES)
    return w.select("doc_id", F.col("win").cast("bigint").alias("win"),
                    F.col("start_char").cast("bigint").alias("start_char"),
                    F.col("end_char").cast("bigint").alias("end_char"))


@query
def q_sample_rows(spark, sf):
    return B.sample_rows(table(spark, sf, "documents"), "doc_id", SAMPLE_ROWS, seed=7).select("doc_id", "lang")


@query
def q_shuffled_order(spark, sf):
    return B.shuffled(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", seed=11)


@query
def q_max_length(spark, sf):
    enc = V.encode(table(spark, sf, "documents"), "doc_id", "text", _vocab(spark, sf), VOCAB_N)
    return enc.agg(F.max(F.size("ids")).cast("bigint").alias("max_len"))


# ---------------------------------------------------------------- sources
from tessera.sources.readers import split_concat_json  # noqa: E402


@query
def q_concat_json(spark, sf):
    from tessera.operators.common import ordered_collect
    ev = table(spark, sf, "events").select((F.col("event_id") / 8).cast("long").alias("line_id"),
                                           "event_id", "props")
    lines = ordered_collect(ev, ["line_id"], "event_id", "props", "objs").select(
        "line_id", F.array_join("objs", "").alias("line"))
    objs = lines.select("line_id", F.explode(split_concat_json(F.col("line"))).alias("o"))
    parsed = objs.select("line_id", F.from_json("o", "k long").alias("r"))
    return parsed.groupBy("line_id").agg(F.count(F.lit(1)).alias("n_objects"), F.sum("r.k").alias("sum_k"))


def _vector_lines(spark, sf):
    """A word-vector file: header first, one line a vector; every line with vec_id % 50 = 7 ends in a field
    that is no number, and every vec_id % 20 = 3 has an earlier line, which the later one replaces."""
    e = table(spark, sf, "embeddings")
    word = F.concat(F.lit("w"), F.col("vec_id").cast("string"))
    bad = F.when(F.col("vec_id") % 50 == 7, F.lit("x"))
    body = e.select(F.concat_ws(" ", word, F.array_join(F.col("embedding").cast("array<string>"), " "), bad).alias("value"),
                    (F.col("vec_id") * 2 + 2).alias("line_no"))
    early = e.where("vec_id % 20 = 3").select(F.concat(word, F.lit(" 1 2 3")).alias("value"),
                                              (F.col("vec_id") * 2 + 1).alias("line_no"))
    header = e.agg(F.concat_ws(" ", F.count(F.lit(1)).cast("string"),
                               F.max(F.size("embedding")).cast("string")).alias("value")).withColumn("line_no", F.lit(0).cast("long"))
    return header.unionByName(body).unionByName(early)


@query
def q_word_vector_rejects(spark, sf):
    _vec, rej = V.parse_word_vectors(_vector_lines(spark, sf), order_col="line_no")
    f = F.split("line", " ")
    return rej.select(f[0].alias("token"), F.size(f).cast("bigint").alias("n_fields"))


@query
def q_word_vectors_scan(spark, sf):
    vec, _rej = V.parse_word_vectors(_vector_lines(spark, sf), order_col="line_no")
    return vec.select("token", F.size("vector").cast("bigint").alias("dim"),
                      r6(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))).alias("vsum"))


@query
def q_vector_dim_check(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("embedding").alias("vector"))
    return V.check_dims(e, 64).select(F.col("n_rows").cast("bigint").alias("n_rows"),
                                      F.col("min_dim").cast("bigint").alias("min_dim"),
                                      F.col("max_dim").cast("bigint").alias("max_dim"),
                                      F.col("n_bad").cast("bigint").alias("n_bad"))


@query
def q_logit_feature_audit(spark, sf):
    logits = table(spark, sf, "embeddings").select(
        (F.col("vec_id") / 2).cast("long").alias("example_id"), F.col("vec_id").alias("feature_id"))
    feats = table(spark, sf, "documents").select(
        F.col("doc_id").alias("example_id"),
        F.explode(F.array(F.col("doc_id") * 2, F.col("doc_id") * 2 + 1)).alias("feature_id"))
    k = ["example_id", "feature_id"]
    a = feats.join(logits, k, "left_anti").withColumn("issue", F.lit("missing_logits"))
    b = logits.join(feats, k, "left_anti").withColumn("issue", F.lit("missing_feature"))
    return a.unionByName(b)


# ---------------------------------------------------------------- ML surface
from tessera.operators import ml as ML  # noqa: E402


@query
def q_max_pool_vectors(spark, sf):
    """Every token has the vector whose id is its hash modulo the table's size; a text without tokens has [PAD]'s."""
    from tessera.functions.arrays import let
    from tessera.operators.common import md5_numbers
    emb = table(spark, sf, "embeddings")
    n = emb.select(F.count(F.lit(1))).first()[0]
    words = let(split_ws("text"), lambda ts: F.when(F.size(ts) == 0, F.array(F.lit(V.PAD_TOKEN))).otherwise(ts))
    ids = table(spark, sf, "documents").select("doc_id", md5_numbers(words, n).alias("ids"))
    tv = ML.pool_by_ids(ids, emb.select("vec_id", F.col("embedding").alias("vector")), "doc_id", dim=64)
    mp = ML.max_pool_vectors(tv, "doc_id", dim=64)
    mp = mp.select("doc_id", F.posexplode("pooled").alias("dim", "value"))
    return mp.select("doc_id", F.col("dim").cast("bigint").alias("dim"), r6(F.col("value").cast("double")).alias("value"))


@query
def q_embedding_matrix(spark, sf):
    vocab = _vocab(spark, sf)
    vec = table(spark, sf, "embeddings").select(F.concat(F.lit("w"), F.col("vec_id").cast("string")).alias("token"),
                                                F.col("embedding").alias("vector"))
    # vocabulary words get the vector of row (id - 2) when it exists
    vec = vec.select(F.col("token").alias("w"), "vector")
    named = vocab.select("token", "id").join(
        vec.select((F.substring("w", 2, 20).cast("int") + 2).alias("id"), "vector"), "id")
    m = V.embedding_matrix(vocab, named.select("token", "vector"), dim=64, seed=13, vocab_size=VOCAB_N)
    return m.select("id", "token", "matched", r6(F.aggregate("vector", F.lit(0.0),
                                                             lambda a, x: a + x.cast("double"))).alias("vsum"))


@query
def q_classify_text(spark, sf):
    """Language of the held-out fifth of all documents (by a hash of the id); the labelled rest is learnt from."""
    from tessera.operators.common import md5_number
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    away = md5_number(F.col("doc_id").cast("string")) % 5 == 0
    train = docs.where(~away).join(table(spark, sf, "labels"), "doc_id", "left_semi")
    model = ML.fit_text_classifier(train, "text", "lang", vocab_size=10000, max_iter=30)
    pred = model.transform(docs.where(away))
    labels = model.stages[0].labels
    to_label = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1)
    return pred.select("doc_id", "lang", to_label.alias("predicted"))


@query
def q_score_batches(spark, sf):
    """Scores of a linear model whose weights follow a rule: ((7 i + 13 j) % 11 - 5) / 4 for input i, class j."""
    import numpy as np
    from tessera.functions.arrays import argmax
    i, j = np.indices((64, 10))
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")
    s = ML.score(e, ML.linear_scorer(((7 * i + 13 * j) % 11 - 5) / 4, np.zeros(10)), "x", "logits", batch_size=128, dim=64)
    return s.select("vec_id", "label", argmax("logits").cast("bigint").alias("pred"))


@query
def q_map_batches(spark, sf):
    import pandas as pd

    # a batch's index numbers its rows, and explode repeats a row's number for each of its lines
    def explode_lines(b: pd.DataFrame) -> pd.DataFrame:
        lines = b.dropna(subset=["text"])
        lines = lines.assign(line=lines["text"].str.split("\n")).explode("line")
        return lines.assign(line_no=lines.groupby(level=0).cumcount())[["doc_id", "line_no", "line"]]

    d = table(spark, sf, "documents").select("doc_id", "text")
    return ML.map_batches(d, explode_lines, "doc_id long, line_no long, line string")


def _tag_split(spark, sf):
    """Tag sequences of all turns, every fifth by hash held out."""
    held = F.crc32(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary")) % 5 == 0
    return S.tag_sequences(spark, sf).withColumn("held", held)


@query
def q_tag_tokens(spark, sf):
    """Every token decided alone: learnt from four fifths of the turns, correct counts of the held-out ones."""
    toks = ML.token_context_features(_tag_split(spark, sf), ["conv_id", "turn", "held"], "tokens", "gold")
    model = ML.fit_tagger(toks.where(~F.col("held")), max_iter=20)
    labels = model.stages[0].labels
    pred = model.transform(toks.where("held"))
    to_label = F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("prediction").cast("int") + 1)
    return (pred.select("conv_id", "turn", (to_label == F.col("tag")).cast("int").alias("ok"))
            .groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_tokens"), F.sum("ok").alias("n_correct")))


@query
def q_tag_sequences(spark, sf):
    """A turn's tags decided together: learnt from four fifths of the turns, all turns tagged."""
    seqs = _tag_split(spark, sf)
    model = TG.fit_tagger(seqs.where(~F.col("held")), "tokens", "gold")
    out = seqs.withColumn("pred", TG.tag(spark, model, F.col("tokens")))
    ok = F.size(F.filter(F.arrays_zip("pred", "gold"), lambda x: x["pred"] == x["gold"]))
    return out.select("conv_id", "turn", "held", F.size("tokens").cast("bigint").alias("n_tokens"), ok.cast("bigint").alias("n_correct"),
                      F.array_join("pred", " ").alias("tags"))


@query
def q_tag_sequence_f1(spark, sf):
    """Entity F1 of the held-out turns, strict chunks."""
    seqs = _tag_split(spark, sf)
    model = TG.fit_tagger(seqs.where(~F.col("held")), "tokens", "gold")
    held = seqs.where("held").withColumn("pred", TG.tag(spark, model, F.col("tokens")))
    return _entity_report(held, strict=True)


# Windows of the second stage, and the longest span: a benchmark passage has to fit into one.
SPAN_WINDOW, SPAN_OVERLAP, SPAN_LONGEST = 128, 64, 64


def _two_stage(spark, sf):
    """Two-stage QA as one lazy plan: pick the context (TF-IDF), cut it into
    overlapping token windows, score spans by the question's words and their
    nearness, decode the best span."""
    m = _mc(spark, sf)
    chosen = MC.selected_context(m, MC.choose_context(m).select("id", "pred"))
    weights = SS.question_weights(m.select(F.col("video-id").alias("id"), "sent1"), table(spark, sf, "documents"), "id", "sent1", "text")
    tok = SP.token_offsets(chosen.select("id", "context"), "id", "context")
    win = SP.context_windows(tok, "id", SPAN_WINDOW, SPAN_OVERLAP, keep=("offsets", "tokens")).join(weights, "id")
    # every position may start or end a span: prefix sums are no scores of their own
    nb = QA.qa_nbest(chosen.select(F.col("id").alias("example_id"), "context"), SS.span_logits(win, "id"),
                     n_best=SPAN_WINDOW + 1, max_len=SPAN_LONGEST)
    return QA.qa_predict(nb).select(F.col("example_id").alias("id"), "prediction")


@query
def q_qa_two_stage(spark, sf):
    return _two_stage(spark, sf).select("id", "prediction", repair_answer("prediction").alias("answer"))


@query
def q_qa_two_stage_scores(spark, sf):
    """Exact match and F1 of the second stage's spans against the questions' answers."""
    pred = cut_lineage(_two_stage(spark, sf))
    refs = _mc(spark, sf).select(F.col("video-id").alias("id"), F.array("sent1").alias("answers"))
    return QA.qa_em_f1(pred, refs).select("n", r6("exact_match").alias("exact_match"), r6("f1").alias("f1"))
