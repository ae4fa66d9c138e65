"""IOB tag sequences: entity (chunk) extraction, entity P/R/F1, sequence and
token accuracy, sub-word label alignment, tag output lines.

Chunking runs inside each row with array higher-order functions (linear in
the sequence length), so no shuffle or window is needed to find entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import IGNORE_INDEX, TAG_PAD, index_range, let, pad_array

# IOB2 prefixes and the outside tag.
OUTSIDE = "O"
BEGIN, INSIDE = "B", "I"


def _at(arr: Column, i: Column) -> Column:
    return F.try_element_at(arr, i + 1)


def tag_prefix(tag: Column) -> Column:
    return F.when(tag == OUTSIDE, F.lit(OUTSIDE)).otherwise(F.substring(tag, 1, 1))


def tag_type(tag: Column) -> Column:
    return F.when(tag == OUTSIDE, F.lit(OUTSIDE)).otherwise(F.substring(tag, 3, 1 << 30))


def chunks(tags_col, strict: bool) -> Column:
    """array<struct<etype,start,end>> of entities in an IOB tag array.

    A chunk opens at position 0, at any B- or O tag, after an O, or where the
    type changes; strict (IOB2) mode keeps only chunks opened by B-, lenient
    mode also keeps chunks opened by a stray I-."""
    tags = F.col(tags_col) if isinstance(tags_col, str) else tags_col
    n = F.size(tags)

    def opens(i):
        cur, prev = _at(tags, i), _at(tags, i - 1)
        return (F.when(i == 0, F.lit(True))
                .otherwise((tag_prefix(cur) != INSIDE) | (prev == OUTSIDE)
                           | (tag_type(cur) != tag_type(prev))))

    starts = F.filter(index_range(n), opens)
    # pair every chunk start with the next one (zip, no lambda over `starts`)
    bounds = F.arrays_zip(starts.alias("b"), F.concat(F.slice(starts, 2, n), F.array(n)).alias("nb"))
    spans = F.transform(bounds, lambda x: F.struct(
        tag_type(_at(tags, x["b"])).alias("etype"),
        tag_prefix(_at(tags, x["b"])).alias("prefix"),
        x["b"].alias("start"),
        (x["nb"] - 1).alias("end")))
    keep = (lambda c: c["prefix"] == BEGIN) if strict else (lambda c: c["prefix"] != OUTSIDE)
    return F.transform(F.filter(spans, keep),
                       lambda c: F.struct(c["etype"].alias("etype"), c["start"].alias("start"),
                                          c["end"].alias("end")))


def entities(df: DataFrame, keys: list, tags_col: str, strict: bool) -> DataFrame:
    """One row per entity: keys, etype, start, end (inclusive token indexes)."""
    return (df.select(*keys, F.explode_outer(chunks(tags_col, strict)).alias("e")).where(F.col("e").isNotNull())
            .select(*keys, "e.etype", "e.start", "e.end"))


def entity_counts(df: DataFrame, keys: list, gold_col: str, pred_col: str, strict: bool) -> DataFrame:
    """Per entity type: n_gold, n_pred, n_tp.  Gold and prediction of one
    sequence live in the same row, so true positives are a hash-based
    ``array_intersect`` there (linear), and only per-type counters are
    aggregated (partial aggregation map-side, no join)."""
    df = df.select(chunks(gold_col, strict).alias("_g"), chunks(pred_col, strict).alias("_p"))
    gold, pred = F.col("_g"), F.col("_p")

    def tally(arr, g, p, t):
        return F.transform(arr, lambda c: F.struct(c["etype"].alias("etype"), F.lit(g).alias("g"),
                                                   F.lit(p).alias("p"), F.lit(t).alias("t")))

    marks = F.concat(tally(gold, 1, 0, 0), tally(pred, 0, 1, 0), tally(F.array_intersect(gold, pred), 0, 0, 1))
    return (df.select(F.explode_outer(marks).alias("m")).where(F.col("m").isNotNull())
            .groupBy(F.col("m.etype").alias("etype"))
            .agg(F.sum("m.g").cast("long").alias("n_gold"), F.sum("m.p").cast("long").alias("n_pred"),
                 F.sum("m.t").cast("long").alias("n_tp")))


def _prf(tp, npred, ngold):
    p = F.when(npred > 0, tp / npred).otherwise(F.lit(0.0))
    r = F.when(ngold > 0, tp / ngold).otherwise(F.lit(0.0))
    f = F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return p, r, f


def _row(label, p, r, f, n):
    return F.struct(F.lit(label).alias("label"), F.col(p).alias("precision"), F.col(r).alias("recall"),
                    F.col(f).alias("f1"), F.col(n).alias("support"))


def _kv(name, value):
    return F.struct(name.alias("metric"), value.cast("double").alias("value"))


def entity_report(counts: DataFrame) -> DataFrame:
    """Per-type precision/recall/f1/support plus micro, macro and weighted
    averages (gold and prediction in their named roles)."""
    p, r, f = _prf(F.col("n_tp"), F.col("n_pred"), F.col("n_gold"))
    per = counts.select(F.col("etype").alias("label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), F.col("n_gold").alias("support"),
                        "n_tp", "n_pred", "n_gold")
    tot = per.agg(F.sum("n_tp").alias("tp"), F.sum("n_pred").alias("np"), F.sum("n_gold").alias("ng"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.try_divide(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
                  F.try_divide(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
                  F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"))
    mp, mr, mf = _prf(F.col("tp"), F.col("np"), F.col("ng"))
    avgs = tot.select(F.explode(F.array(
        F.struct(F.lit("micro avg").alias("label"), mp.alias("precision"), mr.alias("recall"),
                 mf.alias("f1"), F.col("ng").alias("support")),
        _row("macro avg", "mp", "mr", "mf", "ng"),
        _row("weighted avg", "wp", "wr", "wf", "ng"))).alias("a"))
    return per.select("label", "precision", "recall", "f1", "support").unionByName(avgs.select("a.*"))


def flat_metrics(counts: DataFrame, token_acc: DataFrame) -> DataFrame:
    """Long (metric, value) table: ``{type}_{precision,recall,f1,number}``
    plus ``overall_{precision,recall,f1,accuracy}``."""
    p, r, f = _prf(F.col("n_tp"), F.col("n_pred"), F.col("n_gold"))
    per = counts.select(F.explode(F.array(
        _kv(F.concat("etype", F.lit("_precision")), p),
        _kv(F.concat("etype", F.lit("_recall")), r),
        _kv(F.concat("etype", F.lit("_f1")), f),
        _kv(F.concat("etype", F.lit("_number")), F.col("n_gold")))).alias("m"))
    tot = counts.agg(F.sum("n_tp").alias("tp"), F.sum("n_pred").alias("np"), F.sum("n_gold").alias("ng"))
    op, orr, of = _prf(F.col("tp"), F.col("np"), F.col("ng"))
    overall = tot.select(F.explode(F.array(
        _kv(F.lit("overall_precision"), op),
        _kv(F.lit("overall_recall"), orr),
        _kv(F.lit("overall_f1"), of))).alias("m"))
    acc = token_acc.select(F.struct(F.lit("overall_accuracy").alias("metric"),
                                    F.col("token_acc").alias("value")).alias("m"))
    return per.unionByName(overall).unionByName(acc).select("m.*")


def joint_accuracy(df: DataFrame, pred_col: str, gold_col: str, len_col: str | None = None) -> DataFrame:
    """Share of sequences whose prediction equals the gold over the true length."""
    if len_col:
        eq = F.slice(pred_col, 1, F.col(len_col)) == F.slice(gold_col, 1, F.col(len_col))
    else:
        eq = F.col(pred_col) == F.col(gold_col)
    return df.agg(F.count(F.lit(1)).alias("n_seqs"), F.avg(eq.cast("double")).alias("joint_acc"))


def token_accuracy(df: DataFrame, pred_col: str, gold_col: str, ignore=None) -> DataFrame:
    """Accuracy over flattened positions; positions whose gold is in
    ``ignore`` (sentinels) are dropped first."""
    z = F.arrays_zip(F.col(pred_col).alias("p"), F.col(gold_col).alias("g"))
    if ignore:
        z = F.filter(z, lambda x: ~x["g"].isin(*ignore))
    # both counts read one lambda variable: the optimizer would make the arrays anew for each
    per = df.select(let(z, lambda a: F.struct(F.size(a).alias("n"), F.size(F.filter(a, lambda x: x["p"] == x["g"])).alias("c"))).alias("x"))
    return per.select("x.*").agg(F.sum("n").alias("n_tokens"), (F.sum("c") / F.sum("n")).alias("token_acc"))


# Fixed value: the length that tag sequences are cut and padded to.
TAG_LENGTH = 40


def encode_tags(ids_col: str, n: int = TAG_LENGTH) -> Column:
    """struct<length, ids>: the sequence's own length, and its label ids cut at ``n`` and padded with -1."""
    return F.struct(F.size(ids_col).alias("length"), pad_array(ids_col, n, TAG_PAD).alias("ids"))


def align_labels(pieces_col: str, label_ids_col: str, inside_ids_col: str | None = None) -> Column:
    """Per-piece labels: special tokens -> -100; the first piece of a word
    carries the word's label; later pieces -100, or, when ``inside_ids_col``
    gives for each word the id of its label's I- form (the label itself where
    there is none), that id.  ``pieces_col`` holds each word's array of pieces.
    Returns array<struct<word_idx,label>> including the leading and trailing
    special token."""
    labels = F.col(label_ids_col)
    per_word = F.transform(F.col(pieces_col), lambda ps, i: F.transform(
        ps, lambda _p, j: F.struct(
            i.alias("word_idx"),
            F.when(j == 0, F.try_element_at(labels, i + 1))
            .otherwise(F.lit(IGNORE_INDEX) if inside_ids_col is None else F.try_element_at(F.col(inside_ids_col), i + 1))
            .alias("label"))))
    special = F.struct(F.lit(None).cast("int").alias("word_idx"), F.lit(IGNORE_INDEX).alias("label"))
    return F.concat(F.array(special), F.flatten(per_word), F.array(special))
