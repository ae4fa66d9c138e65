"""Mixing sources to target weights: temperature mixing by budgeted block permutations.

Source s with token share p_s gets the weight w_s = p_s^a / sum_r p_r^a.  The
exponent a is bisected in [0, 1], from proportional (1) towards uniform (0):

- ``target_entropy`` (nats): the largest a whose mixture has at least that
  entropy (0 where even uniform weights fall short);
- ``max_repeats``: the smallest a under which no source is repeated more than
  that often beside the least repeated one.

Each step of the bisection evaluates 15 exponents at once in one aggregate over
the per-source table, so neither sources nor documents go to the driver.  The
exponent is rounded to six decimals.

``budget`` is in tokens (words); by default it is the smallest budget under
which no source loses a document.  Source s receives round(budget * w_s)
tokens: as many full passes as fit, then a part of one more pass.  A source's
documents are dealt by hash to about sqrt(documents) blocks; a pass takes blocks
in a hashed permutation that differs from pass to pass.  The last pass takes
whole blocks while they fit, and from the first one that does not, documents in
permuted order while they fit.  Both cumulative sums run over about sqrt(n)
rows, also for a source that holds a third of all documents.

Defined cases: null and '' are one unnamed source; a text that is null, empty
or blank has no token, and a source of such texts alone is passed once; rows
repeated under one id are drawn alike (they tie, and fit together or not at
all); rows without id share one block and are drawn alike too; a very long text
counts with all its tokens; an empty table gives an empty result; other columns pass through, and one
named like a result column is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.base import forget, stored, table

MAX_REPEATS = 2.0
SEED = "mix"


def n_tokens(text: Column) -> Column:
    """Words (runs without ASCII whitespace) of a text; 0 for a null."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "")), F.lit(0)).cast("long")


def _hash(*parts) -> Column:
    return F.md5(F.concat_ws(":", F.lit(SEED), *[p.cast("string") for p in parts]))


def _number(h: Column) -> Column:
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def _measure(sizes: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(entropy, largest w/p, smallest w/p) of the mixture at each exponent, in one aggregate."""
    p = F.col("tokens") / F.col("total")
    cols = []
    for i, a in enumerate(exponents):
        x = F.pow(p, F.lit(a))
        cols += [F.sum(x).alias(f"z{i}"), F.sum(x * F.log(p)).alias(f"s{i}"), F.max(x / p).alias(f"m{i}"),
                 F.min(x / p).alias(f"l{i}")]
    r = sizes.where("tokens > 0").agg(*cols).first()
    return [(math.log(r[f"z{i}"]) - a * r[f"s{i}"] / r[f"z{i}"], r[f"m{i}"] / r[f"z{i}"], r[f"l{i}"] / r[f"z{i}"])
            for i, a in enumerate(exponents)]


def bisect_exponent(sizes: DataFrame, target_entropy: float | None = None,
                    max_repeats: float | None = None) -> float:
    """Exponent for a per-source table with ``tokens`` and ``total``, to six decimals; without a target ``MAX_REPEATS``."""
    if target_entropy is not None and max_repeats is not None:
        raise ValueError("give one of target_entropy and max_repeats")
    if target_entropy is None and max_repeats is None:
        max_repeats = MAX_REPEATS
    if sizes.where("tokens > 0").isEmpty():
        return 1.0

    def enough(m):  # true from some exponent on (repeats) or up to some exponent (entropy)
        return m[0] >= target_entropy - 1e-12 if max_repeats is None else m[1] <= max_repeats * m[2] * (1 + 1e-12)

    low, high = 0.0, 1.0
    at_low, at_high = (enough(m) for m in _measure(sizes, [low, high]))
    if max_repeats is not None and at_low or max_repeats is None and not at_low:
        return 0.0
    if max_repeats is None and at_high:
        return 1.0
    while high - low > 1e-9:
        grid = [low + (high - low) * i / 16 for i in range(1, 16)]
        ok = [enough(m) for m in _measure(sizes, grid)]
        # the side that holds: upper end for repeats, lower end for entropy
        i = ok.index(True) if max_repeats is not None and True in ok else 15
        if max_repeats is None:
            i = ok.index(False) if False in ok else 15
        edges = [low, *grid, high]
        low, high = edges[i], edges[i + 1]
    return round(high if max_repeats is not None else low, 6)


def mixture_plan(docs: DataFrame, id_col: str, source_col: str, tokens: Column, target_entropy: float | None,
                 max_repeats: float | None, budget: int | None):
    """(per-source table, per-block table): source, n_blocks, weight, passes, and which blocks the last pass takes."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(source_col), F.lit("")).alias("src"),
                       tokens.alias("tokens"))
    rows = stored(rows)
    sizes = rows.groupBy("src").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    sizes = stored(sizes)
    sizes = sizes.withColumn("total", F.lit(float(sizes.agg(F.sum("tokens")).first()[0] or 0)))
    a = bisect_exponent(sizes, target_entropy, max_repeats)
    z = sizes.where("tokens > 0").agg(F.sum(F.pow(F.col("tokens") / F.col("total"), F.lit(a)))).first()[0] or 1.0
    w = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.col("total"), F.lit(a)) / F.lit(z)).otherwise(F.lit(0.0))
    plan = sizes.withColumn("weight", w)
    if budget is None:
        whole = plan.where("tokens > 0").agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
        share = F.greatest(F.col("tokens"), F.round(F.lit(whole) * F.col("weight")).cast("long"))
    else:
        share = F.round(F.lit(float(budget)) * F.col("weight")).cast("long")
    plan = (plan.withColumn("share", share)
            .withColumn("passes", F.when(F.col("tokens") > 0, F.expr("share div tokens")).otherwise(F.lit(1)).cast("long"))
            .withColumn("rest", F.when(F.col("tokens") > 0, F.col("share") % F.col("tokens")).otherwise(F.lit(0)))
            .withColumn("n_blocks", F.ceil(F.sqrt("docs")).cast("long")))
    plan = stored(plan.select("src", "weight", "share", "passes", "rest", "n_blocks"))
    dealt = (rows.join(plan, "src")
             .withColumn("block", _number(_hash(F.lit("block"), F.col("id"))) % F.col("n_blocks"))
             .withColumn("key", _hash(F.col("passes"), F.lit("doc"), F.col("id"))))
    blocks = (dealt.groupBy("src", "block").agg(F.sum("tokens").alias("tokens"), F.first("passes").alias("passes"),
                                                F.first("rest").alias("rest"))
              .withColumn("order", _hash(F.col("passes"), F.lit("block"), F.col("block"))))
    upto = F.sum("tokens").over(Window.partitionBy("src").orderBy("order", "block")
                                .rowsBetween(Window.unboundedPreceding, 0))
    blocks = blocks.withColumn("upto", upto).withColumn("left", F.col("rest") - (F.col("upto") - F.col("tokens")))
    blocks = stored(blocks.select("src", "block", ((F.col("rest") > 0) & (F.col("upto") <= F.col("rest"))).alias("inside"),
                                  ((F.col("upto") > F.col("rest")) & (F.col("left") > 0)).alias("edge"), "left"))
    used = F.sum("tokens").over(Window.partitionBy("src", "block").orderBy("key")
                                .rangeBetween(Window.unboundedPreceding, 0))
    cutoff = (dealt.select("src", "block", "key", "tokens").join(blocks.where("edge"), ["src", "block"])
              .withColumn("used", used).where("used <= left").groupBy("src", "block").agg(F.max("key").alias("last")))
    blocks = stored(blocks.select("src", "block", "inside").join(cutoff, ["src", "block"], "left"))
    forget(rows)
    return plan, blocks


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        target_entropy: float | None = None, max_repeats: float | None = None,
        budget: int | None = None) -> DataFrame:
    """Drawn rows of ``docs`` with ``weight`` (of the source), ``block`` and ``repeats`` (how often drawn)."""
    names = ("weight", "block", "repeats")
    cols = [c for c in docs.columns if c not in names]
    plan, blocks = mixture_plan(docs, id_col, source_col, n_tokens(F.col(text_col)), target_entropy, max_repeats, budget)
    out = docs.select(*[F.col(f"`{c}`") for c in cols], F.coalesce(F.col(source_col), F.lit("")).alias("__src"),
                      F.col(id_col).cast("string").alias("__id"))
    plan = plan.select(F.col("src").alias("__src"), "weight", F.col("passes").alias("__passes"), F.col("n_blocks").alias("__n"))
    blocks = blocks.select(F.col("src").alias("__src"), F.col("block"), F.col("inside").alias("__in"),
                           F.col("last").alias("__last"))
    out = (out.join(plan, "__src")
           .withColumn("block", _number(_hash(F.lit("block"), F.col("__id"))) % F.col("__n"))
           .join(blocks, ["__src", "block"]))
    more = F.col("__in") | F.coalesce(_hash(F.col("__passes"), F.lit("doc"), F.col("__id")) <= F.col("__last"), F.lit(False))
    return (out.withColumn("repeats", F.col("__passes") + more.cast("long")).where("repeats > 0")
            .select(*[F.col(f"`{c}`") for c in cols], "weight", "block", "repeats"))


def draws(mixed: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """One row for each draw: pass number, and the hashed order of blocks and of documents within that pass."""
    each = mixed.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("repeats") - 1)))
    return (each.withColumn("block_order", _hash(F.col("pass"), F.lit("block"), F.col("block")))
            .withColumn("doc_order", _hash(F.col("pass"), F.lit("doc"), F.col(id_col))))


def op2_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws of every document under temperature mixing with at most 2 : 1 repetition between sources."""
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "source", F.round("weight", 6).alias("weight"), "block", "repeats")


QUERIES = {"op2_temperature_mix": op2_temperature_mix}
ORACLE_SQL = {"op2_temperature_mix": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(source, '') AS src,
    len([x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']) AS tokens FROM documents),
s AS (SELECT src, sum(tokens)::BIGINT AS tokens, count(*) AS docs, (sum(sum(tokens)) OVER ())::DOUBLE AS total
      FROM d GROUP BY src),
pos AS (SELECT src, tokens / total AS p FROM s WHERE tokens > 0),
bis(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid,
          (SELECT max(pow(p, (lo + hi) / 2) / p) <= 2.0 * min(pow(p, (lo + hi) / 2) / p) * (1 + 1e-12) FROM pos) AS ok
        FROM bis WHERE i < 40)),
a AS (SELECT CASE WHEN (SELECT max(1 / p) <= 2.0 * min(1 / p) * (1 + 1e-12) FROM pos) THEN 0.0
             ELSE round((SELECT hi FROM bis WHERE i = 40), 6) END AS a),
w AS (SELECT s.*, CASE WHEN tokens > 0 THEN pow(tokens / total, a) / (SELECT sum(pow(p, a)) FROM pos) ELSE 0.0 END AS weight
      FROM s, a),
b AS (SELECT w.*, greatest(tokens, round((SELECT max(tokens / weight) FROM w WHERE tokens > 0) * weight)::BIGINT) AS share
      FROM w),
plan AS (SELECT src, weight, CASE WHEN tokens > 0 THEN share // tokens ELSE 1 END AS passes,
           CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END AS rest, ceil(sqrt(docs))::BIGINT AS n FROM b),
dealt AS (SELECT d.*, weight, passes, rest, ('0x' || substr(md5('mix:block:' || doc_id), 1, 8))::BIGINT % n AS block,
            md5('mix:' || passes || ':doc:' || doc_id) AS k FROM d JOIN plan USING (src)),
bl AS (SELECT *, sum(tokens) OVER (PARTITION BY src ORDER BY o, block ROWS UNBOUNDED PRECEDING) AS upto
       FROM (SELECT src, block, sum(tokens) AS tokens, any_value(rest) AS rest,
               md5('mix:' || any_value(passes) || ':block:' || block) AS o FROM dealt GROUP BY src, block)),
e AS (SELECT dealt.*, bl.rest > 0 AND upto <= bl.rest AS inside, upto > bl.rest AND bl.rest - (upto - bl.tokens) > 0 AS edge,
        bl.rest - (upto - bl.tokens) AS remain,
        sum(dealt.tokens) OVER (PARTITION BY src, block ORDER BY k RANGE UNBOUNDED PRECEDING) AS used
      FROM dealt JOIN bl USING (src, block))
SELECT doc_id, source, round(weight, 6) AS weight, block,
  (passes + CASE WHEN inside OR (edge AND used <= remain) THEN 1 ELSE 0 END)::BIGINT AS repeats
FROM e WHERE passes + CASE WHEN inside OR (edge AND used <= remain) THEN 1 ELSE 0 END > 0"""}
