"""Stand-in rules that derive the reference's data shapes from the driver
tables.  The same rules are restated in SQL in ``oracle.py``.

Fixed rules (query and oracle must agree):
- tag sequences: one per conversation turn; tokens = whitespace split of the
  turn text; token type CAP if it starts with A-Z, else PUN if it ends with
  ',' or '.', else O; gold tag = B-type at the start of a run of one type,
  I-type inside it, O for O; predicted tag = O at positions p % 5 = 2,
  else B- turned into I- at p % 7 = 3, else the gold tag.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tessera.functions.arrays import let
from tessera.functions.text import split_ws
from tessera.session import cut_lineage, table


def tag_sequences(spark, sf) -> DataFrame:
    conv = table(spark, sf, "conversations")
    toks = split_ws("text")
    def of_type(t):
        return F.when(t.rlike("^[A-Z]"), "CAP").when(t.rlike("[,.]$"), "PUN").otherwise("O")

    def gold_tags(types):
        before = F.concat(F.array(F.lit(None).cast("string")), types)  # one more than types, the last is not looked at
        pairs = F.slice(F.arrays_zip(types.alias("t"), before.alias("b")), 1, F.size(types))
        return F.transform(pairs, lambda x: F.when(x["t"] == "O", "O")
                           .when(x["b"] == x["t"], F.concat(F.lit("I-"), x["t"])).otherwise(F.concat(F.lit("B-"), x["t"])))

    # every array is a lambda variable: a filter on the result may repeat the expression, but never for each token
    base = conv.select("conv_id", "turn", toks.alias("tokens"), let(F.transform(toks, of_type), gold_tags).alias("gold"))
    pred = F.transform("gold", lambda g, i: F.when(i % 5 == 2, "O")
                       .when(i % 7 == 3, F.regexp_replace(g, "^B-", "I-")).otherwise(g))
    return base.withColumn("pred", pred)


# QA stand-ins --------------------------------------------------------------
# Fixed rules:
# - relevant document of a benchmark item = smallest doc_id whose text
#   contains the item text; an item without such a document takes document
#   item_id % n_documents and has no answer start.
# - distractor k (1..3) = (relevant + 101*k + item_id) % n_documents; the
#   relevant id sits at position item_id % 4, distractors fill the other
#   positions in order of k.  Items with item_id % 10 = 9 list three
#   paragraphs only, which the multiple-choice rows have to reject.
# - question = answer = the whole passage, answer start = its offset in the
#   relevant document.
# - QA examples = all documents; features = their windows of 384 tokens that
#   share 128, a CLS token first.  Logits of document d's token t, and of the
#   CLS token of window w (whole numbers modulo primes, over 100):
#     start: (7919 d + 10473 t + 31 t t) % 997 / 100 - 5; CLS (13 d + 7 w) % 400 / 100
#     end:   (5501 d + 7727 t + 17 t t) % 991 / 100 - 5; CLS (11 d + 5 w) % 400 / 100 - 2
QA_WINDOW, QA_OVERLAP = 384, 128


def qa_questions(spark, sf) -> DataFrame:
    from tessera.operators.mc import containing_docs
    docs = table(spark, sf, "documents")
    bench = table(spark, sf, "benchmark")
    hits = containing_docs(bench, docs)
    rel = (hits.groupBy("item_id")
           .agg(F.min_by(F.struct("doc_id", "char_start"), F.col("doc_id")).alias("r"))
           .select("item_id", F.col("r.doc_id").alias("found"), F.col("r.char_start").alias("char_start")))
    rel = cut_lineage(rel)  # three numbers an item: looked up once, read by every branch of the plan
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    q = bench.join(rel, "item_id", "left").withColumn("n_docs", n_docs)
    q = q.withColumn("relevant", F.coalesce("found", F.col("item_id") % F.col("n_docs")))
    rp = F.col("item_id") % 4
    paragraphs = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda p: F.when(p == rp, F.col("relevant"))
                             .otherwise((F.col("relevant") + 101 * F.when(p < rp, p + 1).otherwise(p)
                                         + F.col("item_id")) % F.col("n_docs")))
    listed = F.slice(paragraphs, 1, F.when(F.col("item_id") % 10 == 9, 3).otherwise(4))
    return q.select(F.col("item_id").cast("string").alias("id"), "item_id",
                    F.col("text").alias("question"), listed.alias("paragraphs"), "relevant",
                    F.struct("text", F.col("char_start").cast("int").alias("start")).alias("answer"))


def context_pool(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("ctx_id"), "text")


def qa_examples(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("example_id"), F.col("text").alias("context"))


def qa_features(spark, sf) -> DataFrame:
    from tessera.operators.spans import context_windows, token_offsets
    docs = table(spark, sf, "documents")
    tok = token_offsets(docs, "doc_id", "text", tokens=False)
    offsets, logits = StructField("offsets", tok.schema["offsets"].dataType), ArrayType(DoubleType())
    fields = [docs.schema["doc_id"], StructField("win", IntegerType()), offsets, StructField("start_logits", logits),
              StructField("end_logits", logits)]
    feats = context_windows(tok, "doc_id", QA_WINDOW, QA_OVERLAP, keep=("offsets",), finish=(fields, _with_logits))
    return feats.select(F.col("doc_id").alias("example_id"), (F.col("doc_id") * 100_000 + F.col("win")).alias("feature_id"),
                        "offsets", "start_logits", "end_logits")


def with_max_context(feats) -> DataFrame:
    """Adds token_is_max_context: false at the CLS token and at every token t of document d with (d + t) % 3 = 0."""
    first = (F.col("feature_id") - F.col("example_id") * 100_000) * (QA_WINDOW - QA_OVERLAP)
    at = F.sequence(F.lit(1), F.size("offsets") - 1)
    known = F.map_from_arrays(F.transform(at, lambda p: p.cast("string")),
                              F.transform(at, lambda p: (F.col("example_id") + first + p - 1) % 3 != 0))
    return feats.withColumn("token_is_max_context", F.when(F.size("offsets") > 1, known)
                            .otherwise(F.create_map().cast("map<string,boolean>")))


def _with_logits(cols: dict[str, pa.Array]) -> dict[str, pa.Array]:
    """Windows with a CLS token in front, which has no place in the text, and the logits of all their tokens."""
    known = cols["doc_id"].is_valid().to_numpy(zero_copy_only=False)
    d, win, first, n = (pc.fill_null(cols[c].cast(pa.int64()), 0).to_numpy(zero_copy_only=False) for c in ("doc_id", "win", "first_tok", "n_tok"))
    ends = np.concatenate([[0], np.cumsum(n + 1)])
    bounds, is_cls = pa.array(ends.astype(np.int32)), np.zeros(ends[-1], bool)
    is_cls[ends[:-1]] = True
    t = np.arange(ends[-1]) - np.repeat(ends[:-1] + 1 - first, n + 1)

    def logits(a, b, c, mod, cls):
        out = np.fmod(np.repeat(a * d, n + 1) + b * t + c * t * t, mod) / 100 - 5
        out[ends[:-1]] = cls
        return pa.ListArray.from_arrays(bounds, pa.array(out), mask=pa.array(~known))

    spans = cols["offsets"].flatten().take(pa.array(np.cumsum(~is_cls) - 1, mask=is_cls))
    return {"doc_id": cols["doc_id"], "win": cols["win"], "offsets": pa.ListArray.from_arrays(bounds, spans),
            "start_logits": logits(7919, 10473, 31, 997, np.fmod(13 * d + 7 * win, 400) / 100),
            "end_logits": logits(5501, 7727, 17, 991, np.fmod(11 * d + 5 * win, 400) / 100 - 2)}


def qa_beams(spark, sf) -> DataFrame:
    """Beam layout from the same features: start slots = top-5 start
    positions, end slot i*5+j = the j-th best end position among those at or
    after start slot i's position (rank order; logits as log-probs); the null
    score is the CLS token's start + end logit."""
    f = qa_features(spark, sf)
    f = f.select("example_id", "feature_id", "offsets", (F.col("start_logits")[0] + F.col("end_logits")[0]).alias("cls_logit"),
                 "start_logits", "end_logits")
    numbers, places = ArrayType(DoubleType()), ArrayType(IntegerType())
    return f.mapInArrow(_beam_slots(5), StructType([
        *(f.schema[c] for c in ("example_id", "feature_id", "offsets")), StructField("start_log_probs", numbers), StructField("start_index", places),
        StructField("end_log_probs", numbers), StructField("end_index", places), f.schema["cls_logit"]]))


def _beam_slots(n):
    """The n best starts of a feature and for each the n best ends not before it; missing ends are -1e9 at 0.
    A map of batches: a column function would keep the offsets of its whole batches, on disk where memory is short."""
    from tessera.operators.common import list_lengths
    from tessera.operators.qa import logit_blocks, negated, top_positions

    def lists(values, kept, kind):
        sizes = kept.reshape(len(kept), -1).sum(axis=1)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values[kept]).cast(kind))

    def block(starts, ends):
        sp, sv = top_positions(*negated(starts), n)
        neg, there = negated(ends)
        slots = [top_positions(neg, there & (np.arange(neg.shape[1]) >= sp[:, k, None]), n) for k in range(n)]
        ep, ev = (np.stack(x, axis=1) for x in zip(*slots))
        made = ep < 0
        has = sp >= 0
        each = np.repeat(has[:, :, None], n, axis=2)
        return [lists(sv, has, pa.float64()), lists(sp, has, pa.int32()), lists(np.where(made, -1e9, ev), each, pa.float64()),
                lists(np.where(made, 0, ep), each, pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wide = np.maximum(list_lengths(b.column("start_logits")), list_lengths(b.column("end_logits")))
            for i, j in logit_blocks(wide):
                part = {c: b.column(c).slice(i, j - i) for c in b.schema.names}
                slots = block(part["start_logits"], part["end_logits"])
                yield pa.RecordBatch.from_arrays(
                    [part["example_id"], part["feature_id"], part["offsets"], *slots, part["cls_logit"]],
                    names=["example_id", "feature_id", "offsets", "start_log_probs", "start_index", "end_log_probs", "end_index", "cls_logit"])

    return run


# Summarisation stand-ins ---------------------------------------------------
# Fixed rules: a reference/prediction pair is a user turn (reference) and the
# assistant turn that directly follows it in the same conversation
# (prediction); a document's title is its first line, its main text the rest.
def all_pairs(spark, sf) -> DataFrame:
    """Every user turn with the assistant turn after it (NULL and not matched where there is none)."""
    from tessera.functions.text import strip_ws
    from tessera.operators.pairs import pair_by_id
    c = table(spark, sf, "conversations")
    ref = c.where(F.col("role") == "user").select("conv_id", "turn", strip_ws("text").alias("ref"))
    hyp = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), strip_ws("text").alias("pred"))
    return pair_by_id(ref, hyp, ["conv_id", "turn"], strict=False)


def summary_pairs(spark, sf) -> DataFrame:
    return all_pairs(spark, sf).where("matched").drop("matched")


def summaries(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    first_nl = F.instr("text", "\n")
    return d.select(F.col("doc_id").cast("string").alias("id"),
                    F.when(first_nl > 0, F.substring("text", 1, first_nl - 1)).otherwise(F.col("text")).alias("title"),
                    F.when(first_nl > 0, F.expr("substring(text, instr(text, '\\n') + 1)")).otherwise(F.lit(""))
                    .alias("maintext"))
