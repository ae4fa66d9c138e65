"""Near-duplicate classes by b-bit MinHash over word shingles.

1. One narrow map gives each text its distinct shingles' count and 128-bit set
   fingerprint, ``bands * rows`` minima, a key for each band of minima, and the
   low ``4`` bits of every minimum packed sixteen to a long.
2. Texts of one shingle set collapse into their smallest id (a grouped minimum,
   combined before the shuffle): a group of copies costs one representative.
3. Representatives that share a band key are candidates.  No bucket is paired
   up: in every round each bucket names hubs (first one, the member that shares
   most buckets with others; then up to 256 of those outside its largest
   component, spread by hash; then 1024, ...) and members are compared with hubs alone.  A hub has then met its whole bucket
   and leaves it; a bucket ends when its members are known to be connected.
   Nothing is capped: a pair of members is skipped only if already connected or
   if it cannot reach the threshold.  The proof of that is exact: after the first round the shingles of
   the open buckets' texts are counted, and a text of n shingles, u of them
   shared at all, is at most u / n similar to any other and u / (n + m - u) to
   one of m; when texts go for that reason, the rest are counted again.  So
   thousands of copies that differ from one original in words of their own meet
   the original, but not one another.  Between rounds a text is one row with its
   open keys; only the buckets' counts and meetings are made key by key.
4. A candidate's similarity is estimated from equal packed lanes, counted by
   bit operations and corrected for chance agreement, (m - c) / (1 - c) with
   c = 1/16; pairs within ``slack`` of the threshold or above are confirmed on
   the full shingle sets, in integers: 100 * |A & B| >= percent * |A | B|.
5. Components by large-star / small-star steps over the confirmed links.

With 48 bands of 7 rows a pair at 0.85 shares no band with probability 1e-8,
at 0.80 with 1e-5; the estimate's standard error is 0.024 at most, and the slack
is five times that, 0.12.

Defined cases: a null, empty or blank text has 0 shingles and is linked with
nothing; a text of fewer than five words is one shingle; rows repeated under
one id are one node, with the links of all its texts; a null id is linked with
nothing and kept; very long texts are read whole, a block of text holds one at
least; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import components, forget, likely, map_text, stored, table
from tessera.llm.textvec import Words, by_doc, distinct_pairs, lower_ascii, mix, shingles, text_block

SHINGLE = 5
BANDS, ROWS = 48, 7
LANES = 16  # of 4 bits in a long
BLOCK = 1_000_000  # text bytes worked on at once: a task holds a few dozen arrays as long
HUBS = 256  # that a large bucket names in the second round, four times as many in each further one


def _long_lists(flat: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(flat.view(np.int64)))


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, bands: int = BANDS,
               rows: int = ROWS) -> DataFrame:
    """id, n, fa, fb (set fingerprint), keys (a long for each band), sig (packed low bits)."""
    k = bands * rows
    mult = np.random.default_rng(11).integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salt = np.random.default_rng(12).integers(1, 2**63, bands, dtype=np.uint64)
    words_of_sig = -(-k // LANES)

    def sign(buf, offs):
        n_docs = len(offs) - 1
        w = Words(lower_ascii(buf), offs)
        doc, h = distinct_pairs(*shingles(w, w.hashes(), shingle), n_docs)
        n = np.bincount(doc, minlength=n_docs)
        has = np.flatnonzero(n)
        fa, fb = np.zeros(n_docs, np.uint64), np.zeros(n_docs, np.uint64)
        keys = np.zeros((n_docs, bands), np.uint64)
        lanes = np.zeros((n_docs, words_of_sig * LANES), np.uint64)
        if len(has):
            at = np.concatenate([[0], np.cumsum(n[has])[:-1]])
            fa[has] = np.add.reduceat(mix(h ^ np.uint64(0x1F83D9ABFB41BD6B)), at)
            fb[has] = np.bitwise_xor.reduceat(mix(h + np.uint64(0x5BE0CD19137E2179)), at)
            low = np.empty((len(has), k), np.uint64)
            tmp = np.empty_like(h)
            for i in range(k):
                np.multiply(h, mult[i], out=tmp)
                low[:, i] = np.minimum.reduceat(tmp, at)
            low = mix(low)
            for b in range(bands):
                acc = np.full(len(has), salt[b])
                for r in range(rows):
                    acc = mix(acc * np.uint64(0xD1342543DE82EF95) + low[:, b * rows + r])
                keys[has, b] = acc
            lanes[has[:, None], np.arange(k)[None, :]] = low & np.uint64(15)
        shift = np.uint64(4) * np.arange(LANES, dtype=np.uint64)
        sig = np.bitwise_or.reduce(lanes.reshape(n_docs, words_of_sig, LANES) << shift, axis=2)
        own = np.where(n > 0, bands, 0)
        return [n.astype(np.int64), fa.view(np.int64), fb.view(np.int64),
                _long_lists(keys[has].ravel(), np.concatenate([[0], np.cumsum(own)])),
                _long_lists(sig.ravel(), np.arange(n_docs + 1) * words_of_sig)]

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    return map_text(src, sign, "n long, fa long, fb long, keys array<long>, sig array<long>", ["id"], "t", BLOCK)


def estimate(a: str, b: str, lanes: int) -> Column:
    """Collision-corrected similarity from two packed signatures of ``lanes`` 4-bit minima."""
    def differing(x: Column) -> Column:
        y = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        y = y.bitwiseOR(F.shiftrightunsigned(y, 2)).bitwiseAND(F.lit(0x1111111111111111))
        return F.bit_count(y)

    miss = F.aggregate(F.zip_with(a, b, lambda x, y: differing(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return (1 - miss / lanes - 1 / 16) / (1 - 1 / 16)


def confirm(pairs: DataFrame, docs: DataFrame, percent: int, shingle: int = SHINGLE) -> DataFrame:
    """The (a, b) pairs of ids whose full shingle sets reach ``percent``; docs has id and t."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    some = likely(docs.where("id is not null"), "id", ids)
    both = (pairs.join(some.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a")
            .join(some.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def sets(col, n):
        w = Words(lower_ascii(text_block(col)[0]), text_block(col)[1])
        return distinct_pairs(*shingles(w, w.hashes(), shingle), n)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.cumsum(sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy().astype(np.int64)
                                 for c in (2, 3)))
            i = 0
            while i < batch.num_rows:
                base = size[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(size, base + BLOCK, "right")))
                part = batch.slice(i, j - i)
                i, n = j, j - i
                da, ha = sets(part.column(2), n)
                db, hb = sets(part.column(3), n)
                d, h = np.concatenate([da, db]), np.concatenate([ha, hb])
                order = by_doc(d, h, n)
                d, h = d[order], h[order]
                same = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
                inter = np.bincount(d[1:][same], minlength=n)
                union = np.bincount(da, minlength=n) + np.bincount(db, minlength=n) - inter
                ok = pa.array((union > 0) & (100 * inter >= percent * union))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(ok)

    return both.mapInArrow(check, "a long, b long")


def lone_shingles(ids: DataFrame, docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, lone): how many shingles of each text of ``ids`` no other of these texts holds."""
    def run(buf, offs):
        w = Words(lower_ascii(buf), offs)
        doc, h = distinct_pairs(*shingles(w, w.hashes(), shingle), len(offs) - 1)
        return [_long_lists(h, np.searchsorted(doc, np.arange(len(offs))))]

    some = likely(docs.where("id is not null"), "id", ids).join(ids, "id", "left_semi")
    rows = map_text(some, run, "hs array<long>", ["id"], "t", BLOCK).select("id", F.explode("hs").alias("h"))
    once = rows.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id")).where("c = 1")
    return once.groupBy("id").agg(F.count(F.lit(1)).alias("lone"))


def _open(state: DataFrame, percent: int) -> DataFrame:
    """The rows of ``state`` with the keys of buckets that still hold two components, and w, these buckets' sizes.

    A key also goes where the row could reach no member: of a text's n shingles
    u are shared with any other candidate, so against a text of m shingles its
    similarity is at most u / (n + m - u).
    """
    rows = state.select("id", "set", "n", "u", "comp", "many", F.explode("keys").alias("key"))
    buckets = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("m"), F.min("comp").alias("x"),
                                       F.max("comp").alias("y")).where("x < y").select("key", "c", "m"))
    able = rows.join(buckets, "key").where(
        F.lit(100) * F.col("u") >= F.lit(percent) * (F.col("n") + F.col("m") - F.col("u")))
    return (able.groupBy("id", "set", "n", "u", "comp", "many")
            .agg(F.sum("c").alias("w"), F.collect_list("key").alias("keys")))  # at most one for each band


def _labelled(state: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``state`` with comp from the links so far."""
    if not links:
        return state.withColumn("comp", F.col("id"))
    labels = _labels(reduce(DataFrame.unionByName, links))
    return state.drop("comp").join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _peeled(state: DataFrame, src: DataFrame, percent: int, shingle: int) -> DataFrame:
    """``state``, stored, without texts that can reach no other: u is counted, then buckets are looked at again.

    Once texts have gone, more shingles of the others are theirs alone: repeated
    until few more go.  The lone shingles of an id with several texts are not
    told apart, so such an id stays as it is.
    """
    left = state.count()
    while left:
        lone = lone_shingles(state.select("id").distinct(), src, shingle)
        u = F.when(F.col("many"), F.col("n")).otherwise(F.col("n") - F.coalesce("lone", F.lit(0)))
        able = state.join(lone, "id", "left").withColumn("u", u).drop("lone").where(F.lit(100) * F.col("u") >= F.lit(percent) * F.col("n"))
        was, state = state, stored(_open(able, percent))
        forget(was)
        before, left = left, state.count()
        if left > 0.9 * before:
            break
    return state


def _hubs(state: DataFrame, wide: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """Rows by bucket, and the hubs that each bucket names; ``wide`` is 0 where it names one.

    Rows have ks, their open keys, main, their bucket's largest component, and
    size, how many of its members are outside it."""
    rows = state.select("id", "n", "u", "w", "comp", "many", F.col("keys").alias("ks"), F.explode("keys").alias("key"))
    if wide:  # members outside a bucket's largest component are hubs: all at once where they are few
        tally = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
        size = (tally.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("size"))
                .select("key", F.col("top.comp").alias("main"), (F.col("size") - F.col("top.c")).alias("size")))
        rows = rows.join(size, "key")
        part = F.when(F.col("size") <= HUBS, F.col("id")).otherwise(F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(wide)))
        dealt = rows.where("comp <> main").withColumn("part", part)
    else:
        rows = rows.withColumns({"main": F.col("comp"), "size": F.lit(0)})
        dealt = rows.withColumn("part", F.lit(0))
    hubs = (dealt.groupBy("key", "part")
            .agg(F.max(F.struct("w", (-F.col("id")).alias("minus"), "comp", "n", "u", "many", "ks")).alias("h"))
            .select("key", (-F.col("h.minus")).alias("hub"), F.col("h.comp").alias("hub_comp"), F.col("h.n").alias("hub_n"),
                    F.col("h.u").alias("hub_u"), F.col("h.many").alias("hub_many"), F.col("h.ks").alias("hub_ks")))
    return rows, hubs


def _labels(links: DataFrame) -> DataFrame:
    """(id, comp): the smallest node within two links of each linked node.

    Equal labels prove that nodes are connected (a star gets one label), which
    is all that skipping pairs needs; whole components follow at the end."""
    both = links.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(
        links.select(F.col("b").alias("id"), F.col("a").alias("to")))
    one = both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("m"))
    two = (both.join(one.select(F.col("id").alias("to"), "m"), "to").groupBy("id").agg(F.min("m").alias("comp")))
    return two.select("id", F.least("id", "comp").alias("comp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80,
                    shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, slack: float = 0.12) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    feats = stored(signatures(src, "id", "t", shingle, bands, rows))
    sets = feats.where("n > 0 and id is not null")
    groups = sets.groupBy("fa", "fb", "n").agg(F.min("id").alias("rep"))
    member = stored(feats.select("id", "n", "fa", "fb").join(groups, ["fa", "fb", "n"], "left")
                    .select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep")))
    # an id with several texts is one node: its texts' representatives are linked through it
    some = (member.where("id is not null").groupBy("id").agg(F.min("rep").alias("x"), F.max("rep").alias("y"),
                                                             F.min("n").alias("p"), F.max("n").alias("q"))
            .where("x < y or p < q").select("id"))
    many = stored(some)
    mixed = not many.isEmpty()
    reps = groups.select(F.col("rep").alias("id"))
    sig = sets.select("id", "fa", "fb", "n", "sig", "keys").join(reps, "id", "left_semi").dropDuplicates(["id", "fa", "fb", "n"])
    # where every id has one text, its text need not be told apart from others of the id
    sig = sig.withColumn("set", F.xxhash64("fa", "fb", "n") if mixed else F.lit(0).cast("long")).drop("fa", "fb")
    sig = sig.join(many.withColumn("many", F.lit(True)), "id", "left") if mixed else sig.withColumn("many", F.lit(None).cast("boolean"))
    sig = stored(sig.withColumn("many", F.coalesce("many", F.lit(False))))
    lanes = sig.select("id", "sig")
    links = [stored(member.where("n > 0").join(many, "id", "left_semi").select(F.col("id").alias("a"), F.col("rep").alias("b"))
                    .distinct())] if mixed else []

    def meet(state: DataFrame, wide: int, turn: int) -> DataFrame:
        """Members of a bucket against its hubs; hubs leave their buckets."""
        by_key, hubs = _hubs(state, wide, turn)
        hubs = stored(hubs)
        both = F.least("u", "hub_u")
        meets = F.lit(True)
        if wide:  # a pair that shares several open buckets meets in one of them, and once where both are hubs
            meets = ((F.array_min(F.array_intersect("ks", "hub_ks")) == F.col("key"))
                     & ((F.col("comp") == F.col("main")) | (F.col("size") > HUBS) | (F.col("id") < F.col("hub"))))
            if mixed:  # of an id with several texts each has its own keys
                meets = meets | F.col("many") | F.col("hub_many")
        near = F.lit(100) * both >= F.lit(percent) * (F.col("n") + F.col("hub_n") - both)
        pairs = (by_key.join(hubs, "key").where("id <> hub and comp <> hub_comp").where(meets)
                 .where(near | F.col("many") | F.col("hub_many"))
                 .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())
        close = stored(pairs.join(lanes.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
                       .join(lanes.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
                       .where(estimate("sa", "sb", bands * rows) >= percent / 100 - slack).select("a", "b").distinct())
        links.append(stored(confirm(close, src, percent, shingle).distinct()))
        gone = hubs.groupBy(F.col("hub").alias("id")).agg(F.collect_set("key").alias("met"))
        left = state.join(gone, "id", "left").withColumn(
            "keys", F.when(F.col("met").isNull(), F.col("keys")).otherwise(F.array_except("keys", "met"))).drop("met")
        new = stored(_open(_labelled(left, links), percent))
        forget(state, hubs, close)
        return new

    state = stored(_open(_labelled(sig.select("id", "set", "n", F.col("n").alias("u"), "many", "keys"), links), percent))
    turn = 0
    while not state.isEmpty():
        state = meet(state, HUBS * 4 ** (turn - 1) if turn else 0, turn)
        if turn == 0:
            state = _peeled(state, src, percent, shingle)
        turn += 1
    out, top = member, F.col("rep")
    if links:
        comp = components(reduce(DataFrame.unionByName, links))
        out = member.join(comp.select(F.col("u").alias("rep"), F.col("v").alias("comp")), "rep", "left")
        top = F.coalesce("comp", "rep")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), top.alias("component_id"),
                      F.coalesce(F.col("id") == top, F.lit(True)).alias("kept"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents at 85 %."""
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


QUERIES = {"op3_minhash": op3_minhash}
ORACLE_SQL = {"op3_minhash": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, e.b FROM r JOIN e ON r.v = e.a),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.u = d.doc_id"""}
