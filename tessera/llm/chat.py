"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every speaker of a conversation the dialogue is rendered once with that
speaker as the assistant: their turns carry the loss, every other speaker is a
named user, and system turns stay system turns without loss.  A turn reads

    <|im_start|>assistant\\n...<|im_end|>\\n           the perspective's own turns
    <|im_start|>user name=NAME\\n...<|im_end|>\\n      the others
    <|im_start|>system\\n...<|im_end|>\\n

``<|`` inside a text becomes ``< |`` and a name keeps letters, digits, ``_`` and
``-`` (others become ``_``), so that no text can forge a turn.  The mask is a list
of signed run lengths in characters, one pair for each turn: -n for n characters
without loss (the header; the whole of other people's turns), +n for n with loss
(text and end mark of the perspective's own turns).

A conversation longer than ``max_turns`` (512) turn numbers is rendered in parts
of that many: a row holds one, so no row has to hold a conversation of any length.
Every part gives one row for each speaker of the whole conversation, also for
those silent in it.  The opening system turns (those before anybody else speaks)
stand at the head of every part; every other turn is in exactly one.  Turns that share a number
(null ones all have 0) share a part, which grows with them.

Defined cases: rows repeated in full count once (combined before the shuffle);
several texts of one turn are ordered by speaker and text; a null turn counts as
turn 0; a null speaker is called ``unknown``; a null text is empty; rows without
conversation id belong to no dialogue; a dialogue of system turns alone has no
speaker and gives no row; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import table

MAX_TURNS = 512
END = "<|im_end|>\n"


def _name(role: Column) -> Column:
    return F.regexp_replace(role, r"[^A-Za-z0-9_\-]", "_")


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", system: str = "system", max_turns: int = MAX_TURNS) -> DataFrame:
    """One row for each conversation part and speaker: rendered text, mask runs and their sums."""
    turn = F.coalesce(F.col(turn_col).cast("long"), F.lit(0))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"), F.floor(turn / max_turns).cast("long").alias("part"),
        F.struct(turn.alias("turn"), F.coalesce(role_col, F.lit("unknown")).alias("role"),
                 F.coalesce(text_col, F.lit("")).alias("text")).alias("m"))
    said = rows.select("conv_id", "part", F.col("m.role").alias("perspective"))
    begun = F.min(F.when(F.col("m.role") != system, F.col("m.turn"))).alias("begun")
    long = (rows.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b"), begun).where("a < b")
            .select("conv_id", "begun"))
    many = not long.isEmpty()
    if many:
        opening = rows.where(F.col("m.role") == system).join(long, "conv_id").where(F.col("m.turn") < F.col("begun"))
        later = said.join(long, "conv_id", "left_semi").select("conv_id", F.col("part").alias("later")).distinct()
        rows = rows.unionByName(opening.join(later, "conv_id").where("later > part").select("conv_id", F.col("later").alias("part"), "m"))
    parts = rows.groupBy("conv_id", "part").agg(F.array_sort(F.collect_set("m")).alias("ms"))
    speakers = F.array_sort(F.filter(F.array_distinct(F.col("ms.role")), lambda r: r != system))
    if not many:  # a part is a whole conversation and has its speakers
        views = parts.select("conv_id", "part", "ms", F.explode(speakers).alias("perspective"))
    else:
        who = said.where(F.col("perspective") != system).select("conv_id", "perspective").distinct()
        views = parts.join(who, "conv_id").select("conv_id", "part", "ms", "perspective")

    def head(m: Column) -> Column:
        who = (F.when(m["role"] == system, F.lit("system")).when(m["role"] == F.col("perspective"), F.lit("assistant"))
               .otherwise(F.concat(F.lit("user name="), _name(m["role"]))))
        return F.concat(F.lit("<|im_start|>"), who, F.lit("\n"))

    def body(m: Column) -> Column:
        return F.concat(F.replace(m["text"], F.lit("<|"), F.lit("< |")), F.lit(END))

    views = views.select("conv_id", "part", "perspective", F.transform("ms", lambda m: F.struct(
        head(m).alias("head"), body(m).alias("body"), (m["role"] == F.col("perspective")).alias("own"))).alias("ts"))
    views = views.select("conv_id", "part", "perspective", "ts", F.flatten(F.transform("ts", lambda t: F.array(
        -F.length(t["head"]), F.when(t["own"], F.length(t["body"])).otherwise(-F.length(t["body"]))))).alias("runs"))
    total = F.aggregate("runs", F.lit(0).cast("long"), lambda s, x: s + F.abs(x).cast("long"))
    loss = F.aggregate("runs", F.lit(0).cast("long"), lambda s, x: s + F.greatest(x, F.lit(0)).cast("long"))
    return views.select(
        "conv_id", "part", "perspective", F.size("ts").cast("long").alias("n_turns"),
        F.size(F.filter("ts", lambda t: t["own"])).cast("long").alias("n_loss_turns"),
        total.alias("n_chars"), loss.alias("n_loss_chars"),
        F.array_join(F.transform("ts", lambda t: F.concat(t["head"], t["body"])), "").alias("rendered"), "runs")


def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every speaker's side; the mask as comma-separated runs."""
    out = rotate(table(spark, sf_dir, "conversations"))
    return out.withColumn("mask", F.array_join(F.col("runs").cast("array<string>"), ",")).drop("runs")


QUERIES = {"op9_perspectives": op9_perspectives}
ORACLE_SQL = {"op9_perspectives": r"""
WITH t AS (SELECT DISTINCT conv_id, coalesce(turn, 0) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
parts AS (SELECT DISTINCT conv_id, floor(turn / 512)::BIGINT AS part FROM t),
opening AS (SELECT t.* FROM t JOIN (SELECT conv_id, min(turn) FILTER (role <> 'system') AS begun FROM t GROUP BY 1) b USING (conv_id)
            WHERE role = 'system' AND turn < begun),
p AS (SELECT *, floor(turn / 512)::BIGINT AS part FROM t UNION ALL
      SELECT o.*, part FROM opening o JOIN parts USING (conv_id) WHERE part > floor(turn / 512)),
v AS (SELECT DISTINCT conv_id, part, role AS perspective FROM parts JOIN t USING (conv_id) WHERE role <> 'system'),
r AS (SELECT p.*, perspective, role = perspective AS own,
        '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant'
          ELSE 'user name=' || regexp_replace(role, '[^A-Za-z0-9_\-]', '_', 'g') END || chr(10) AS head,
        replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
      FROM p JOIN v USING (conv_id, part))
SELECT conv_id, part, perspective, count(*) AS n_turns, count(*) FILTER (own) AS n_loss_turns,
  sum(length(head) + length(body))::BIGINT AS n_chars, coalesce(sum(length(body)) FILTER (own), 0)::BIGINT AS n_loss_chars,
  string_agg(head || body, '' ORDER BY turn, role, text) AS rendered,
  string_agg((-length(head))::VARCHAR || ',' || (CASE WHEN own THEN length(body) ELSE -length(body) END)::VARCHAR, ','
    ORDER BY turn, role, text) AS mask
FROM r GROUP BY conv_id, part, perspective"""}
