"""Extractive-QA decoding as Spark jobs: top-n logit positions, start/end
band candidates, n-best per example with softmax probabilities, the
no-answer (null score) decision, beam-search candidates, answer repair,
exact match / token F1.

Per-feature work (finding one feature's top logits, pairing its top starts with
the ends inside the length band) runs on Arrow batches of features, a bounded
block of logits at a time; only the short per-feature candidate lists cross a
shuffle, keyed by ``example_id``, where a window ranks them across the example's
features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tessera.functions.arrays import let
from tessera.functions.text import char_span, normalize_answer, split_ws
from tessera.operators.common import list_lengths

# Text of the fallback prediction when no candidate survives,
# and the beam form's fallback logits and score.
EMPTY_TEXT = "empty"
BEAM_FALLBACK_LOGIT = -1e-6
BEAM_FALLBACK_SCORE = -2e-6


# Logits looked at together, padding included: a block needs some 30 bytes for each.
BLOCK_LOGITS = 500_000


def logit_blocks(lengths: np.ndarray, least: int = 1) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows whose matrix, as wide as the longest row (``least`` at least), stays within the block; one row at least."""
    i, wide = 0, least
    for j, n in enumerate(lengths.tolist()):
        if j > i and (j - i + 1) * max(wide, n) > BLOCK_LOGITS:
            yield i, j
            i, wide = j, least
        wide = max(wide, n)
    if i < len(lengths):
        yield i, len(lengths)


def negated(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of the lists' negated numbers, NaN behind each list's end and where null, and which places hold a number."""
    n = list_lengths(lists)
    there = np.arange(int(n.max(initial=1))) < n[:, None]
    flat = lists.flatten()
    out = np.full(there.shape, np.nan)
    out[there] = -pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
    if flat.null_count:
        there[there] = pc.is_valid(flat).to_numpy(zero_copy_only=False)
    return out, there


def top_positions(neg: np.ndarray, there: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of each row's n largest values (value desc, then lowest position), -1 behind the last, and the values.
    ``neg``: the negated values; only ``there`` counts.  Rows are cut at their n-th value before anything is sorted."""
    rows, width = neg.shape
    some = there
    if width > n:
        nth = np.partition(np.where(there, neg, np.nan), n - 1, axis=1)[:, n - 1]
        some = there & ~(neg > nth[:, None])
    r, p = np.nonzero(some)
    order = np.lexsort((neg[r, p], r))  # stable: the lowest position first
    r, p = r[order], p[order]
    rank = np.arange(len(r)) - np.searchsorted(r, np.arange(rows))[r]
    kept = rank < n
    r, p, rank = r[kept], p[kept], rank[kept]
    pos, value = np.full((rows, n), -1), np.zeros((rows, n))
    pos[r, rank], value[r, rank] = p, -neg[r, p]
    return pos, value


def _taken(values: pa.Array, lengths: np.ndarray, pos: np.ndarray, offsets: pa.Array) -> pa.Array:
    """For each position of a row its element in the list (null where it has none), in one run."""
    firsts = offsets.to_numpy()[:-1].astype(np.int64)
    known = (pos >= 0) & (pos < lengths[:, None])
    return values.take(pa.array((firsts[:, None] + pos).ravel(), mask=~known.ravel()))


def _spans_at(offsets: pa.Array, pos: np.ndarray, field: str) -> tuple[np.ndarray, np.ndarray]:
    """One end of the character spans at ``pos``, and where both ends are known."""
    got = _taken(offsets.values, list_lengths(offsets), pos, offsets.offsets)
    s, e = pc.struct_field(got, "s"), pc.struct_field(got, "e")
    known = pc.and_(pc.is_valid(s), pc.is_valid(e)).to_numpy(zero_copy_only=False)
    ends = pc.fill_null(s if field == "s" else e, 0).to_numpy(zero_copy_only=False)
    return ends.reshape(pos.shape), known.reshape(pos.shape)


def _most_context(maps: pa.Array, pos: np.ndarray) -> np.ndarray:
    """Which positions are true in the rows' map<string,boolean>."""
    ends = maps.offsets.to_numpy().astype(np.int64)
    keys, items = (x.slice(ends[0], ends[-1] - ends[0]) for x in (maps.keys, maps.items))
    width = int(pos.max(initial=0)) + 1
    at = pc.index_in(keys, value_set=pa.array([str(i) for i in range(width)], keys.type))
    good = pc.and_(pc.is_valid(at), pc.fill_null(items, False)).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(maps)), np.diff(ends))
    table = np.zeros((len(maps), width), bool)
    table[row[good], pc.fill_null(at, 0).to_numpy(zero_copy_only=False)[good]] = True
    return table[np.arange(len(maps))[:, None], np.maximum(pos, 0)]


def _block_pairs(starts: pa.Array, ends: pa.Array, offsets: pa.Array, most: pa.Array | None, n_best: int,
                 max_len: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Candidates of a block of features: how many each has, and their columns in order."""
    sp, sv = top_positions(*negated(starts), n_best)
    ep, ev = top_positions(*negated(ends), n_best)
    cs, s_ok = _spans_at(offsets, sp, "s")
    ce, e_ok = _spans_at(offsets, ep, "e")
    if most is not None:
        s_ok &= _most_context(most, sp)
    far = ep[:, None, :] - sp[:, :, None]
    r, i, j = np.nonzero(s_ok[:, :, None] & e_ok[:, None, :] & (far >= 0) & (far < max_len))
    nscore = -(sv[r, i] + ev[r, j])
    order = np.lexsort((nscore, r))  # stable: start rank, then end rank
    r, i, j, nscore = r[order], i[order], j[order], nscore[order]
    kept = np.arange(len(r)) - np.searchsorted(r, np.arange(len(starts)))[r] < n_best
    r, i, j, nscore = r[kept], i[kept], j[kept], nscore[kept]
    return np.bincount(r, minlength=len(starts)), [nscore, i, j, cs[r, i], ce[r, j], sv[r, i], ev[r, j]]


def feature_candidates(feats: DataFrame, n_best: int, max_len: int) -> DataFrame:
    """Per feature: valid (start, end) pairs among its top-n starts and top-n
    ends inside the band ``start <= end < start + max_len`` (both on context
    tokens, start allowed by ``token_is_max_context`` when given).  Only the
    feature's best ``n_best`` pairs are kept - the example-level n-best can
    only contain those.  Features are worked on in blocks of whole arrays; a
    logit that is null takes no part."""
    span = feats.schema["offsets"].dataType.elementType
    pair = StructType([StructField("nscore", DoubleType()), StructField("srank", IntegerType()), StructField("erank", IntegerType()),
                       StructField("cs", span["s"].dataType), StructField("ce", span["e"].dataType),
                       StructField("start_logit", DoubleType()), StructField("end_logit", DoubleType())])
    null = StructType([StructField("start_logit", DoubleType()), StructField("end_logit", DoubleType())])
    out = StructType([feats.schema["example_id"], feats.schema["feature_id"], StructField("c", ArrayType(pair)), StructField("null", null)])
    has_tmc = "token_is_max_context" in feats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            wide = np.maximum(list_lengths(col["start_logits"]), list_lengths(col["end_logits"]))
            for lo, hi in logit_blocks(wide, n_best * n_best):
                part = {n: c.slice(lo, hi - lo) for n, c in col.items()}
                sizes, cols = _block_pairs(part["start_logits"], part["end_logits"], part["offsets"],
                                           part.get("token_is_max_context"), n_best, max_len)
                span_type = part["offsets"].type.value_type
                types = [pa.float64(), pa.int32(), pa.int32(), span_type.field("s").type, span_type.field("e").type, pa.float64(), pa.float64()]
                rows = pa.StructArray.from_arrays([pa.array(c).cast(t) for c, t in zip(cols, types)], names=pair.names)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), rows)
                yield pa.RecordBatch.from_arrays([part["example_id"], part["feature_id"], lists, part["null"]],
                                                 names=["example_id", "feature_id", "c", "null"])

    first = F.struct(F.get("start_logits", F.lit(0)).cast("double").alias("start_logit"),
                     F.get("end_logits", F.lit(0)).cast("double").alias("end_logit")).alias("null")
    logits = [F.col(c).cast("array<double>").alias(c) for c in ("start_logits", "end_logits")]
    return feats.select("example_id", "feature_id", first, *logits, "offsets",
                        *(["token_is_max_context"] if has_tmc else [])).mapInArrow(run, out)


def qa_nbest(examples: DataFrame, feats: DataFrame, n_best: int = 20, max_len: int = 30,
             with_negative: bool = False) -> DataFrame:
    """n-best answers per example: (example_id, rank, text, start_logit,
    end_logit, score, probability, is_null).

    ``examples``: example_id, context.  ``feats``: example_id, feature_id,
    offsets array<struct<s,e>> (null = not context), start_logits,
    end_logits (and optionally token_is_max_context map<string,boolean>).
    Ranking is score desc, then feature order, start rank, end rank - the
    order a stable sort of the nested candidate loops gives."""
    cand = feature_candidates(feats, n_best, max_len)
    found = F.transform("c", lambda x: F.struct(
        (-x["nscore"]).alias("score"), x["srank"].alias("srank"), x["erank"].alias("erank"), x["start_logit"].alias("start_logit"),
        x["end_logit"].alias("end_logit"), x["cs"].alias("cs"), x["ce"].alias("ce"), F.lit(False).alias("is_null")))
    if with_negative:  # a feature's null candidate travels with its spans
        null = F.col("null")
        found = F.concat(found, F.array(F.struct(
            (null["start_logit"] + null["end_logit"]).alias("score"), F.lit(-1).alias("srank"), F.lit(-1).alias("erank"),
            null["start_logit"].alias("start_logit"), null["end_logit"].alias("end_logit"), F.lit(0).alias("cs"),
            F.lit(0).alias("ce"), F.lit(True).alias("is_null"))))
    # explode_outer + null filter: a plain explode makes the optimizer infer
    # `size(c) > 0` and push that copy of the candidate search into the join
    rows = (cand.select("example_id", "feature_id", F.explode_outer(found).alias("c")).where(F.col("c").isNotNull())
            .select("example_id", "feature_id", "c.*"))
    if with_negative:
        # minimum null score over the example's features (first feature on ties)
        own = F.when(F.col("is_null"), F.struct("score", "feature_id"))
        rows = (rows.withColumn("_least", F.min(own).over(Window.partitionBy("example_id")))
                .where(~F.col("is_null") | (F.struct("score", "feature_id") == F.col("_least"))).drop("_least"))
    # the null candidate comes after candidates of the same score
    w = Window.partitionBy("example_id").orderBy(F.desc("score"), "is_null", "feature_id", "srank", "erank")
    ranked = rows.withColumn("rank", F.row_number().over(w))
    kept = F.col("rank") <= n_best
    if with_negative:
        # a null candidate beyond the n best is added back, unless a kept span is [0, 0) itself
        zero = F.max(F.when(kept & (F.col("cs") == 0) & (F.col("ce") == 0), 1)).over(Window.partitionBy("example_id"))
        ranked = ranked.withColumn("_zero", zero)
        kept = kept | (F.col("is_null") & F.col("_zero").isNull())
    ranked = ranked.where(kept)
    # examples drive: one without candidates gets a row without text
    with_text = examples.select("example_id", "context").join(ranked, "example_id", "left").select(
        "example_id", "rank", F.when(F.col("rank").isNotNull(), char_span("context", "cs", "ce")).alias("text"),
        "start_logit", "end_logit", "score", "is_null")
    return _with_fallback(with_text, EMPTY_TEXT, 0.0, 0.0, also_lone_empty=True)


def _with_fallback(rows: DataFrame, text: str, logit: float, score: float, also_lone_empty: bool, keep: list = ()) -> DataFrame:
    """Softmax over an example's rows; an example without candidates (or, with
    ``also_lone_empty``, with a single candidate of empty text) gets a made-up
    first row.  One window for counts, ranks and probabilities."""
    we = Window.partitionBy("example_id")
    fake = F.struct(F.lit(0).alias("rank"), F.lit(text).alias("text"), F.lit(logit).alias("start_logit"),
                    F.lit(logit).alias("end_logit"), F.lit(score).alias("score"), F.lit(False).alias("is_null"))
    own = F.struct("rank", "text", "start_logit", "end_logit", "score", "is_null")
    none = F.col("rank").isNull()
    lone = (F.count(F.lit(1)).over(we) == 1) & (F.col("text") == "") if also_lone_empty else F.lit(False)
    out = rows.withColumn("_rows", F.when(none, F.array(fake)).when(lone, F.array(fake, own)).otherwise(F.array(own)))
    out = out.select("example_id", *keep, F.explode("_rows").alias("r")).select("example_id", *keep, "r.*")
    e = F.exp(F.col("score") - F.max("score").over(we))
    return (out.withColumn("probability", e / F.sum(e).over(we))
            .withColumn("rank", F.row_number().over(we.orderBy("rank"))))


def qa_predict(nbest: DataFrame, with_negative: bool = False, threshold: float = 0.0) -> DataFrame:
    """Final answer per example.  Without negatives: the top text.  With
    negatives: best non-empty prediction vs the null score; the answer is ''
    when ``null - best_start - best_end > threshold`` (strict)."""
    if not with_negative:
        return nbest.where(F.col("rank") == 1).select("example_id", F.col("text").alias("prediction"))
    full = F.col("text") != ""
    j = nbest.groupBy("example_id").agg(
        F.min_by(F.when(full, F.struct("text", "start_logit", "end_logit")), F.when(full, F.col("rank"))).alias("b"),
        F.max(F.when(F.col("is_null"), F.col("score"))).alias("null_score"))
    diff = F.col("null_score") - F.col("b.start_logit") - F.col("b.end_logit")
    # every example keeps its row: without a non-empty candidate the answer is ''
    return j.select("example_id", "null_score", F.coalesce("b.text", F.lit("")).alias("best_text"),
                    diff.alias("score_diff"),
                    F.when(diff > F.lit(threshold), F.lit("")).otherwise(F.coalesce("b.text", F.lit(""))).alias("prediction"))


def _ok(x: Column) -> Column:
    return x["o"].isNotNull() & x["o"]["s"].isNotNull() & x["o"]["e"].isNotNull()


def beam_candidates(beams: DataFrame, n_best: int = 20, max_len: int = 30,
                    start_n: int = 5, end_n: int = 5) -> DataFrame:
    """Beam-search layout: start slot i owns end slots i*end_n .. i*end_n+end_n-1.
    Starts without maximum context are left out where ``token_is_max_context`` is given."""
    offs = F.col("offsets")
    if "token_is_max_context" in beams.columns:
        most = F.transform("start_index", lambda p: F.coalesce(F.col("token_is_max_context")[p.cast("string")], F.lit(False)))
    else:
        most = F.transform("start_index", lambda p: F.lit(True))
    beams = beams.withColumn("_most", most)
    st = F.transform(F.arrays_zip(F.col("start_index").alias("pos"), F.col("start_log_probs").alias("v"), F.col("_most").alias("most")),
                     lambda x, i: F.struct(i.alias("rank"), x["v"].alias("v"), x["pos"].alias("pos"),
                                           F.when(x["most"], F.try_element_at(offs, x["pos"] + 1)).alias("o")))
    en = F.transform(F.arrays_zip(F.col("end_index").alias("pos"), F.col("end_log_probs").alias("v")),
                     lambda x, i: F.struct(i.alias("slot"), x["v"].alias("v"), x["pos"].alias("pos"),
                                           F.try_element_at(offs, x["pos"] + 1).alias("o")))

    def ends_for(s, ends):
        return F.transform(
            F.filter(F.slice(ends, s["rank"] * end_n + 1, F.lit(end_n)),
                     lambda e: _ok(s) & _ok(e) & (e["pos"] >= s["pos"]) & (e["pos"] - s["pos"] + 1 <= max_len)),
            lambda e: F.struct(s["rank"].alias("srank"), (e["slot"] - s["rank"] * end_n).alias("erank"),
                               s["v"].alias("start_logit"), e["v"].alias("end_logit"),
                               s["o"]["s"].alias("cs"), e["o"]["e"].alias("ce")))

    # both sides are lambda variables of the pairing, so each is computed once a row
    pairs = let(F.struct(st.alias("st"), en.alias("en")),
                lambda x: F.flatten(F.transform(x["st"], lambda s: ends_for(s, x["en"]))))
    null = [c for c in ("cls_logit",) if c in beams.columns]
    found = beams.select("example_id", "feature_id", *null, F.explode_outer(pairs).alias("c"))
    if null:  # the smallest null score over all features of an example, those without candidates too
        found = found.withColumn("cls_logit", F.min("cls_logit").over(Window.partitionBy("example_id")))
    return found.where(F.col("c").isNotNull()).select(
        "example_id", "feature_id", (F.col("c.start_logit") + F.col("c.end_logit")).alias("score"),
        F.col("c.srank").alias("srank"), F.col("c.erank").alias("erank"),
        F.col("c.start_logit").alias("start_logit"), F.col("c.end_logit").alias("end_logit"),
        F.col("c.cs").alias("cs"), F.col("c.ce").alias("ce"), *null)


def qa_beam_nbest(examples: DataFrame, beams: DataFrame, n_best: int = 20, max_len: int = 30,
                  start_n: int = 5, end_n: int = 5) -> DataFrame:
    """n-best answers of beams; where these have ``cls_logit``, the example's
    smallest one comes along (null where it has no candidate)."""
    rows = beam_candidates(beams, n_best, max_len, start_n, end_n)
    null = [c for c in ("cls_logit",) if c in rows.columns]
    w = Window.partitionBy("example_id").orderBy(F.desc("score"), "feature_id", "srank", "erank")
    ranked = rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_best)
    out = examples.select("example_id", "context").join(ranked, "example_id", "left").select(
        "example_id", "rank", F.when(F.col("rank").isNotNull(), char_span("context", "cs", "ce")).alias("text"),
        "start_logit", "end_logit", "score", F.lit(False).alias("is_null"), *null)
    return _with_fallback(out, "", BEAM_FALLBACK_LOGIT, BEAM_FALLBACK_SCORE, also_lone_empty=False, keep=null).drop("is_null")


def qa_beam_null_odds(nbest: DataFrame, beams: DataFrame | None = None) -> DataFrame:
    """Null score of every example of a beam n-best: the smallest ``cls_logit``
    of its features, or the fallback score where it has no candidate.  An n-best
    that does not carry ``cls_logit`` takes it from ``beams``, a second pass."""
    if "cls_logit" not in nbest.columns:
        nbest = nbest.join(beams.groupBy("example_id").agg(F.min("cls_logit").alias("cls_logit")), "example_id", "left")
    first = nbest.where("rank = 1").select("example_id", F.col("text").alias("prediction"), "score", "cls_logit")
    made_up = (F.col("prediction") == "") & (F.col("score") == BEAM_FALLBACK_SCORE)
    return first.select(
        "example_id", "prediction",
        F.when(made_up | F.col("cls_logit").isNull(), F.lit(BEAM_FALLBACK_SCORE)).otherwise(F.col("cls_logit")).alias("null_score"))


def format_predictions(preds: DataFrame, with_negative: bool = False) -> DataFrame:
    """Rows as a SQuAD scorer takes them: id, prediction_text and, for the
    no-answer form, no_answer_probability 0.0."""
    out = preds.select("id", F.col("prediction").alias("prediction_text"))
    return out.withColumn("no_answer_probability", F.lit(0.0)) if with_negative else out


def qa_scores(preds: DataFrame, refs: DataFrame) -> DataFrame:
    """Exact match and token F1 (0..1) of every reference id: the best over its
    gold answers.  An id without gold answers has the gold answer ''; an id
    without prediction fails both.  Token overlap is counted by explode and
    aggregation, linear in the answers' length."""
    gold = F.when(F.size(F.coalesce("answers", F.array())) == 0, F.array(F.lit(""))).otherwise(F.col("answers"))
    j = refs.select("id", F.posexplode(gold).alias("_no", "gold"),
                    (F.size(F.coalesce("answers", F.array())) > 0).alias("has_answer"))
    j = j.join(preds.select("id", "prediction"), "id", "left")
    j = j.select("id", "_no", "has_answer", normalize_answer("prediction").alias("np"), normalize_answer("gold").alias("ng"))
    j = j.select("*", F.coalesce(split_ws("np"), F.array()).alias("pt"), split_ws("ng").alias("gt"))
    marks = F.concat(F.transform("pt", lambda t: F.struct(t.alias("t"), F.lit(1).alias("p"), F.lit(0).alias("g"))),
                     F.transform("gt", lambda t: F.struct(t.alias("t"), F.lit(0).alias("p"), F.lit(1).alias("g"))))
    keys = ["id", "_no", "has_answer", "np", "ng"]
    per = (j.select(*keys, F.explode_outer(marks).alias("m")).groupBy(*keys, F.col("m.t").alias("t"))
           .agg(F.sum("m.p").alias("p"), F.sum("m.g").alias("g"))
           .groupBy(*keys).agg(F.coalesce(F.sum(F.least("p", "g")), F.lit(0)).alias("common"),
                               F.coalesce(F.sum("p"), F.lit(0)).alias("n_p"), F.coalesce(F.sum("g"), F.lit(0)).alias("n_g")))
    em = F.coalesce((F.col("np") == F.col("ng")).cast("double"), F.lit(0.0))
    prec, rec = F.col("common") / F.col("n_p"), F.col("common") / F.col("n_g")
    f1 = (F.when(F.col("np").isNull(), F.lit(0.0))
          .when((F.col("n_p") == 0) | (F.col("n_g") == 0), (F.col("n_p") == F.col("n_g")).cast("double"))
          .when(F.col("common") == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec)))
    return per.groupBy("id", "has_answer").agg(F.max(em).alias("em"), F.max(f1).alias("f1"))


def qa_em_f1(preds: DataFrame, refs: DataFrame, with_negative: bool = False) -> DataFrame:
    """EM and F1 (x100) averaged over ids; ``with_negative`` adds the figures of
    ids with and without gold answers."""
    def figures(prefix: str, cond):
        return [F.count_if(cond).alias(f"{prefix}n"),
                (F.avg(F.when(cond, F.col("em"))) * 100).alias(f"{prefix}exact_match"),
                (F.avg(F.when(cond, F.col("f1"))) * 100).alias(f"{prefix}f1")]

    aggs = figures("", F.lit(True))
    if with_negative:
        aggs += figures("has_answer_", F.col("has_answer")) + figures("no_answer_", ~F.col("has_answer"))
    return qa_scores(preds, refs).agg(*aggs)
