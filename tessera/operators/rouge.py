"""ROUGE as Spark jobs.

Two families of scores, each over token arrays of a pair's row:

- set family: n-gram *sets* with f = 2pr/(p+r+1e-8), and ROUGE-L as the union of
  the sentence-pair LCS over ``.``-sentences (the figures the gate uses);
- multiset family: clipped n-gram counts, ROUGE-L over the whole token
  sequence, and ROUGE-Lsum as the clipped union LCS over lines.

All scores of a family are columns of one row, so a pair is neither shuffled
nor joined: n-gram overlaps are higher-order functions over the row's arrays,
and the LCS, which has no linear SQL form, is one Arrow-batched helper.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import ngrams
from tessera.functions.stem import stems
from tessera.functions.text import alnum_words, rouge_words, split_ws

# Fixed value: smoothing term of the set-ROUGE F score.
SET_F_EPS = 1e-8


def _chars(c: Column) -> Column:
    return F.filter(F.split(c, "", -1), lambda t: ~t.rlike(r"(?U)^\s*$"))


def _char_pairs(c: Column) -> Column:
    """Characters in pairs, a lone character as it is."""
    t = _chars(c)
    return F.when(F.size(t) < 2, t).otherwise(F.zip_with(
        F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0))), F.slice(t, 2, F.greatest(F.size(t), F.lit(1))),
        lambda a, b: F.concat(a, b)))


TOKENIZERS = {
    "rouge": rouge_words,          # '.'-cut sentences, one-space words
    "whitespace": split_ws,
    "alnum": alnum_words,          # lower-case [a-z0-9] words
    "alnum_stemmed": lambda c: stems(alnum_words(c)),  # their stems
    "char": _chars,
    "char_bigram": _char_pairs,
}


def segmented_words(segment) -> Callable[[Column], Column]:
    """Words as the scorer sees text that was segmented and joined by spaces."""
    return lambda c: rouge_words(F.array_join(segment(c), " "))


def tokenize_pairs(pairs: DataFrame, keys: list, hyp: str, ref: str, tokenizer: str | Callable = "rouge",
                   empty: str = "zero") -> DataFrame:
    """Token arrays ``ht`` and ``rt`` of each pair, beside the pair's own columns.

    ``tokenizer`` is a name of ``TOKENIZERS`` or a function from a text column
    to an array of words (a segmenter).  ``empty`` says what becomes of a pair
    with a side without tokens: ``zero`` scores it 0, ``ignore`` leaves it out,
    ``error`` fails the job."""
    tok = TOKENIZERS[tokenizer] if isinstance(tokenizer, str) else tokenizer
    out = pairs.withColumns({"ht": tok(F.col(hyp)), "rt": tok(F.col(ref))})
    # a blank sentence counts as one empty token, which is no content
    blank = ~(F.exists("ht", lambda t: t != "") & F.exists("rt", lambda t: t != ""))
    if empty == "ignore":
        out = out.where(~blank)
    elif empty == "error":
        out = out.withColumn("ht", F.when(blank, F.raise_error(F.lit("empty hypothesis or reference")).cast("array<string>"))
                             .otherwise(F.col("ht")))
    elif empty != "zero":
        raise ValueError(f"empty={empty!r}; expected zero, ignore or error")
    return out


def _ratio(a, b) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def set_f(p: Column, r: Column) -> Column:
    return 2.0 * (p * r) / (p + r + SET_F_EPS)


def plain_f(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def rouge_n_set(toks: DataFrame, ns=(1, 2)) -> DataFrame:
    """Adds set ROUGE-N F scores ``rouge{n}``; one row in, one row out, no shuffle."""
    for n in ns:
        toks = toks.withColumns({f"_h{n}": F.array_distinct(ngrams("ht", n)), f"_r{n}": F.array_distinct(ngrams("rt", n))})
    for n in ns:
        h, r = F.col(f"_h{n}"), F.col(f"_r{n}")
        toks = toks.withColumn(f"_o{n}", F.size(F.array_intersect(h, r)))
        toks = toks.withColumns({f"_p{n}": _ratio(F.col(f"_o{n}"), F.size(h)), f"_q{n}": _ratio(F.col(f"_o{n}"), F.size(r))})
        toks = toks.withColumn(f"rouge{n}", set_f(F.col(f"_p{n}"), F.col(f"_q{n}")))
        toks = toks.drop(f"_h{n}", f"_r{n}", f"_o{n}", f"_p{n}", f"_q{n}")
    return toks


def rouge_n_multiset(toks: DataFrame, keys: list, ns=(1, 2)) -> DataFrame:
    """Per pair clipped n-gram F scores ``rouge{n}`` (overlap = sum of min counts).

    One explode of all orders, one aggregation per (pair, order, n-gram) that is
    combined map-side, one per pair; ``keys`` must be unique."""
    def side(c, n, h, r):
        return F.transform(ngrams(c, n), lambda g: F.struct(F.lit(n).alias("n"), g.alias("g"), F.lit(h).alias("h"),
                                                            F.lit(r).alias("r")))

    marks = F.concat(*[side(c, n, h, r) for n in ns for c, h, r in (("ht", 1, 0), ("rt", 0, 1))])
    counts = (toks.select(*keys, F.explode_outer(marks).alias("x"))
              .groupBy(*keys, F.col("x.n").alias("n"), F.col("x.g").alias("g"))
              .agg(F.sum("x.h").alias("h"), F.sum("x.r").alias("r")))
    aggs = []
    for n in ns:
        mine = F.col("n") == n
        aggs += [F.coalesce(F.sum(F.when(mine, F.least("h", "r"))), F.lit(0)).alias(f"o{n}"),
                 F.coalesce(F.sum(F.when(mine, F.col("h"))), F.lit(0)).alias(f"h{n}"),
                 F.coalesce(F.sum(F.when(mine, F.col("r"))), F.lit(0)).alias(f"r{n}")]
    per = counts.groupBy(*keys).agg(*aggs)
    f = [plain_f(_ratio(F.col(f"o{n}"), F.col(f"h{n}")), _ratio(F.col(f"o{n}"), F.col(f"r{n}"))).alias(f"rouge{n}") for n in ns]
    return per.select(*keys, *f)


def lcs_length(a: list, b: list) -> int:
    """LCS length of two token lists, bit-parallel over ``a`` (one big-int
    pass per token of ``b``)."""
    if not a or not b:
        return 0
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & masks.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def lcs_places(ref: list, hyp: list, up_on_tie: bool) -> list:
    """Places in ``ref`` of one longest common subsequence.

    Where dropping the last word of either side costs nothing, ``up_on_tie``
    drops the reference's, else the hypothesis's.

    A row of the table is one integer: bit j is 0 where the j-th word of ``hyp``
    adds to the length.  Every sqrt(n)-th row is kept and the rows between two
    of them are made again on the way back, so that memory is about
    2 sqrt(n) m bits."""
    n, m = len(ref), len(hyp)
    masks: dict = {}
    for j, y in enumerate(hyp):
        masks[y] = masks.get(y, 0) | (1 << j)
    full = (1 << m) - 1

    def below(v: int, word) -> int:
        u = v & masks.get(word, 0)
        return ((v + u) | (v - u)) & full

    step = math.isqrt(n) + 1
    kept, v = [full], full
    for i, x in enumerate(ref, 1):
        v = below(v, x)
        if i % step == 0:
            kept.append(v)
    out, i, j, base, rows = [], n, m, None, []
    length = m - v.bit_count()  # of the first i and j words
    while length:
        if base != (i - 1) // step:
            base = (i - 1) // step
            rows = [kept[base]]
            for x in ref[base * step:min(n, (base + 1) * step)]:
                rows.append(below(rows[-1], x))
        if ref[i - 1] == hyp[j - 1]:
            i, j, length = i - 1, j - 1, length - 1
            out.append(i)
            continue
        here = i - base * step
        up = j - (rows[here - 1] & ((1 << j) - 1)).bit_count()
        left = length - (0 if rows[here] >> (j - 1) & 1 else 1)
        if up > left or (up_on_tie and up == left):
            i, length = i - 1, up
        else:
            j, length = j - 1, left
    return out[::-1]


def union_lcs_words(refs: list, hyps: list) -> int:
    """How many distinct words lie on an LCS of some reference and some hypothesis sentence."""
    union = set()
    for r in refs:
        for h in hyps:
            union.update(r[i] for i in lcs_places(r, h, up_on_tie=False))
    return len(union)


def union_lcs_hits(refs: list, hyps: list) -> int:
    """Reference places on an LCS with some hypothesis sentence, clipped by both sides' word counts."""
    left_r = Counter(w for s in refs for w in s)
    left_h = Counter(w for s in hyps for w in s)
    hits = 0
    for r in refs:
        for i in sorted({i for h in hyps for i in lcs_places(r, h, up_on_tie=True)}):
            w = r[i]
            if left_r[w] > 0 and left_h[w] > 0:
                hits += 1
                left_r[w] -= 1
                left_h[w] -= 1
    return hits


def _pairwise(fn):
    """An Arrow-batched udf of two array columns; built here so that it travels with the job."""
    @F.pandas_udf("long")
    def run(h: pd.Series, r: pd.Series) -> pd.Series:
        def plain(x):
            return [plain(y) for y in x] if hasattr(x, "__iter__") and not isinstance(x, str) else x
        return pd.Series([fn(plain(y), plain(x)) for x, y in zip(h, r)], dtype="int64")

    return run


def rouge_l(toks: DataFrame) -> DataFrame:
    """Adds ``rougeL``: F of the LCS of the whole token sequences (multiset family)."""
    lcs = _pairwise(lcs_length)("ht", "rt")
    out = toks.withColumn("_lcs", lcs)
    return out.withColumn("rougeL", plain_f(_ratio(F.col("_lcs"), F.size("ht")), _ratio(F.col("_lcs"), F.size("rt")))).drop("_lcs")


def dot_sentences(col) -> Column:
    """Sentences cut at ``.`` (empty ones dropped), each as its whitespace words; a blank one is [""]."""
    c = F.col(col) if isinstance(col, str) else col
    pieces = F.filter(F.split(c, r"\.", -1), lambda p: F.length(p) > 0)
    return F.transform(pieces, lambda p: F.when(F.size(split_ws(p)) == 0, F.array(F.lit(""))).otherwise(split_ws(p)))


def rouge_l_set(toks: DataFrame, hyp: str, ref: str) -> DataFrame:
    """Adds ``rougeL`` of the set family: union LCS over ``.``-sentences against distinct words."""
    out = toks.withColumns({"_hs": dot_sentences(hyp), "_rs": dot_sentences(ref)})
    out = out.withColumn("_lcs", _pairwise(union_lcs_words)("_hs", "_rs"))
    n, m = F.size(F.array_distinct(F.flatten("_hs"))), F.size(F.array_distinct(F.flatten("_rs")))
    return out.withColumn("rougeL", set_f(_ratio(F.col("_lcs"), n), _ratio(F.col("_lcs"), m))).drop("_hs", "_rs", "_lcs")


def rouge_lsum(toks: DataFrame, hyp: str, ref: str, stemmed: bool = False) -> DataFrame:
    """Adds ``rougeLsum`` of the multiset family: clipped union LCS over lines, of words or of their stems."""
    def lines(c):
        found = F.filter(F.transform(F.split(F.col(c), "\n", -1), alnum_words), lambda s: F.size(s) > 0)
        return stems(found, nested=True) if stemmed else found

    out = toks.withColumns({"_hs": lines(hyp), "_rs": lines(ref)})
    out = out.withColumn("_hits", _pairwise(union_lcs_hits)("_hs", "_rs"))
    n, m = F.size(F.flatten("_hs")), F.size(F.flatten("_rs"))
    return out.withColumn("rougeLsum", plain_f(_ratio(F.col("_hits"), n), _ratio(F.col("_hits"), m))).drop("_hs", "_rs", "_hits")
