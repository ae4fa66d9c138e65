"""Word segmentation: a dictionary counted from a corpus, and the best path through each text's word lattice.

The dictionary is found without labels.  Every substring of up to ``longest``
letters is counted; one is a word if its parts belong together (cohesion: the
least of ln(f(s) * N / (f(head) * f(tail))) over its cuts, N letters in all) and
if it stands free (the smaller entropy of its next and of its previous letter,
a run's edge counting as one more letter).  Single letters are always words.
A word costs round(1000 * ln(T / f)), T being the sum of f over the dictionary; a
letter outside it costs what half an occurrence would.  Costs are whole numbers,
so paths compare exactly.

Segmenting is a narrow map: runs of letters are cut along the cheapest path of
dictionary words (ties: the longer last word), other runs without blanks are
words as they stand.  The dictionary has a stated size, so its hashes and costs
are broadcast as plain arrays.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.arrays import index_range, let
from tessera.operators.common import by_slices
from tessera.session import cut_lineage

LETTERS = r"[\p{L}\p{M}]+"
PIECES = r"[\p{L}\p{M}]+|[^\p{L}\p{M}\p{Z}\x09-\x0D\x85]+"
LONGEST = 4
DICTIONARY_ROWS = 20_000
COST_SCALE = 1000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.iinfo(np.int64).max // 4


def letter_runs(df: DataFrame, text_col: str) -> DataFrame:
    """(run, cnt): runs of letters with their counts, so that a run is cut up once however often it stands there."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))
    return (df.select(F.explode_outer(runs).alias("run")).where(F.col("run").isNotNull())
            .groupBy("run").agg(F.count(F.lit(1)).alias("cnt")))


def gram_counts(runs: DataFrame, longest: int) -> DataFrame:
    """(gram, n, f): occurrences of every substring of 1 to ``longest`` letters."""
    def grams(x):
        chars = F.filter(F.split(x, "", -1), lambda c: c != "")
        return let(chars, lambda c: F.flatten(F.transform(index_range(F.size(c)), lambda i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(longest), F.size(c) - i)),
            lambda n: F.struct(F.array_join(F.slice(c, i + 1, n), "").alias("g"), n.alias("n"))))))

    return (runs.select("cnt", F.explode_outer(grams(F.col("run"))).alias("x")).where(F.col("x").isNotNull())
            .groupBy(F.col("x.g").alias("gram"), F.col("x.n").alias("n")).agg(F.sum("cnt").alias("f")))


def _entropy(f: Column, total: Column, weighted: Column) -> Column:
    """Entropy of a letter's neighbours: ``total`` occurrences with a neighbour in the run, the rest at its edge."""
    edge = f - total
    return F.log(f) - (weighted + F.when(edge > 0, edge * F.log(edge)).otherwise(0.0)) / f


def gram_figures(grams: DataFrame, longest: int, least: int) -> DataFrame:
    """(gram, n, f, freedom) of the substrings of up to ``longest`` letters that occur ``least`` times.

    ``grams`` goes one letter further: each gives its count to itself, to its
    head as a next letter and to its tail as a previous one, so that one
    aggregation makes all sums.
    """
    zero = F.lit(0).cast("long")
    mark = lambda g, own, nxt, prv: F.struct(g.alias("g"), own.alias("own"), nxt.alias("nxt"), prv.alias("prv"))
    chars = F.col("n")
    rows = grams.select(F.explode(F.when(chars == 1, F.array(mark(F.col("gram"), F.col("f"), zero, zero))).otherwise(F.array(
        mark(F.col("gram"), F.col("f"), zero, zero),
        mark(F.expr("substring(gram, 1, n - 1)"), zero, F.col("f"), zero),
        mark(F.expr("substring(gram, 2, n - 1)"), zero, zero, F.col("f"))))).alias("x")).select("x.*")

    def weighted(c):
        return F.sum(F.when(F.col(c) > 0, F.col(c) * F.log(c)).otherwise(0.0))

    sums = rows.groupBy("g").agg(F.sum("own").alias("f"), F.sum("nxt").alias("nxt"), weighted("nxt").alias("nw"),
                                 F.sum("prv").alias("prv"), weighted("prv").alias("pw"))
    free = F.least(_entropy(F.col("f"), F.col("nxt"), F.col("nw")), _entropy(F.col("f"), F.col("prv"), F.col("pw")))
    return (sums.withColumn("n", F.length("g")).where((F.col("n") <= longest) & (F.col("f") >= least))
            .select(F.col("g").alias("gram"), "n", "f", F.round(free, 6).alias("freedom")))


def learn_dictionary(df: DataFrame, text_col: str = "text", longest: int = LONGEST, least: int = 20, cohesion: float = 1.0,
                     freedom: float = 0.5, size: int = DICTIONARY_ROWS) -> DataFrame:
    """(word, cnt, cohesion, freedom, cost): at most ``size`` words, the most frequent ones."""
    grams = gram_counts(letter_runs(df, text_col), longest + 1)
    figures = cut_lineage(gram_figures(grams, longest, least))
    cuts = figures.where("n > 1").select("gram", "f", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"), "n")
    cuts = cuts.select("gram", "f", F.expr("substring(gram, 1, k)").alias("head"), F.expr("substring(gram, k + 1, n - k)").alias("tail"))
    part = figures.select("gram", "f")
    letters = figures.where("n = 1").select(F.sum("f").alias("letters"))  # one row
    held = (cuts.join(part.select(F.col("gram").alias("head"), F.col("f").alias("hf")), "head")
            .join(part.select(F.col("gram").alias("tail"), F.col("f").alias("tf")), "tail")
            .select("gram", F.log(F.col("f") / F.col("hf") * letters.scalar() / F.col("tf")).alias("c"))
            .groupBy("gram").agg(F.round(F.min("c"), 6).alias("cohesion")))
    words = (figures.join(held, "gram", "left")
             .where((F.col("n") == 1) | (F.col("cohesion") >= cohesion) & (F.col("freedom") >= freedom))
             .orderBy(F.desc("f"), "gram").limit(size))
    words = cut_lineage(words.select(F.col("gram").alias("word"), F.col("f").alias("cnt"), "cohesion", "freedom"))
    total = words.select(F.sum("cnt").alias("t")).scalar()
    return words.withColumn("cost", F.round(F.log(total / F.col("cnt")) * COST_SCALE).cast("long"))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words together, and where each word begins (one entry more)."""
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64), at


def _hashes(codes: np.ndarray, longest: int) -> list[np.ndarray]:
    """For n = 1 .. longest the hash of the n letters from each place on."""
    out, h = [], np.zeros(len(codes), np.uint64)
    for n in range(1, min(longest, len(codes)) + 1):
        h = h[:len(codes) - n + 1] * _FACTOR + codes[n - 1:] + np.uint64(1)
        out.append(h ^ (h >> np.uint64(31)))
    return out


class Lattice:
    """The dictionary as sorted hashes and costs; cuts many runs together."""

    def __init__(self, words: list[str], costs: list[int], unknown: int, longest: int):
        h = np.array([_hashes(_codes([w])[0], len(w))[-1][0] for w in words], np.uint64)
        order = np.argsort(h)
        self.hashes, self.costs = h[order], np.array(costs, np.int64)[order]
        self.unknown, self.longest = unknown, longest

    def price(self, h: np.ndarray, missing: int) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), missing, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.costs[at], missing)

    def cut(self, runs: list[str]) -> list[list[str]]:
        """Each run's words along its cheapest path; all runs advance letter by letter together."""
        codes, at = _codes(runs)
        size = np.diff(at)
        order = np.argsort(-size, kind="stable")
        begin, size = at[:-1][order], size[order]
        cost = [self.price(h, self.unknown if n == 1 else _NEVER) for n, h in enumerate(_hashes(codes, self.longest), 1)]
        best = np.zeros(len(codes) + len(runs), np.int64)
        back = np.zeros(len(codes) + len(runs), np.int64)
        base = begin + order  # a run has one place more than letters
        for j in range(1, int(size.max(initial=0)) + 1):
            some = int(np.searchsorted(-size, -j, "right"))
            here = base[:some] + j
            low = np.full(some, _NEVER, np.int64)
            long = np.ones(some, np.int64)
            for n in range(min(self.longest, j), 0, -1):
                total = best[here - n] + cost[n - 1][begin[:some] + j - n]
                less = total < low
                low[less], long[less] = total[less], n
            best[here], back[here] = low, long
        out: list[list[str]] = [[] for _ in runs]
        for i, b, n in zip(order.tolist(), base.tolist(), size.tolist()):
            run, words = runs[i], []
            while n:
                k = int(back[b + n])
                words.append(run[n - k:n])
                n -= k
            out[i] = words[::-1]
        return out


def segmenter(spark: SparkSession, dictionary: DataFrame, longest: int = LONGEST,
              size: int = DICTIONARY_ROWS) -> Callable[[Column], Column]:
    """A function from a text column to its array of words; ``dictionary`` has at most ``size`` rows (word, cnt, cost)."""
    rows = dictionary.select("word", "cnt", "cost").limit(size + 1).collect()
    if len(rows) > size:
        raise ValueError(f"a dictionary of more than {size} words is not broadcast")
    total = sum(r["cnt"] for r in rows)
    sent = spark.sparkContext.broadcast(([r["word"] for r in rows], [r["cost"] for r in rows],
                                         round(COST_SCALE * math.log(2 * total)) if total else 0))

    @F.arrow_udf("array<string>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, costs, unknown = sent.value
        lattice = Lattice(words, costs, unknown, longest)  # once a task

        def part(pieces: pa.Array) -> pa.Array:
            flat = pieces.flatten().dictionary_encode()
            found = flat.dictionary.to_pylist()
            lettered = [i for i, x in enumerate(found) if x[0].isalpha() or _is_mark(x[0])]
            parts = [[x] for x in found]
            for i, p in zip(lettered, lattice.cut([found[i] for i in lettered])):
                parts[i] = p
            taken = pa.array(parts, pa.list_(pa.string())).take(flat.indices)
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False))]).astype(np.int32)
            first = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False))])
            return pa.ListArray.from_arrays(pa.array(ends[first]), taken.flatten(),
                                            mask=pieces.is_null() if pieces.null_count else None)

        return by_slices(batches, part)

    return lambda text: split(F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)))


def _is_mark(c: str) -> bool:
    import unicodedata

    return unicodedata.category(c)[0] in "LM"
