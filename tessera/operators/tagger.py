"""Sequence tagging with transitions: an averaged structured perceptron over hashed word features.

A sequence's tags are chosen together, by the best path through emission and
transition scores; a path that IOB rules out (an I- tag that does not continue
its own type) has no score.  Training is iterated parameter mixing: the
training sequences, each distinct one once and stored for all epochs, are dealt by hash into shards of
about ``SHARD_ROWS``; every epoch each shard passes over its sequences from the
common weights, in one grouped Arrow call, and the shards' weights are averaged
in Spark.  Shards depend on the data alone, so the model does not depend on the
partitioning.  A model has ``slots`` feature slots, whatever the corpus' size;
that many rows a label are all the driver sees of an epoch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage

SLOTS = 1 << 16
SHARD_ROWS = 2000
BATCH = 8          # sequences decoded with the same weights in training
_OUT = -1e9


def allowed(labels: list[str]) -> np.ndarray:
    """Transition scores that IOB gives: 0 or ruled out; the last row is the sequence's start."""
    out = np.zeros((len(labels) + 1, len(labels)))
    for j, to in enumerate(labels):
        if to.startswith("I-"):
            for i, came in enumerate([*labels, "O"]):
                if came[:2] not in ("B-", "I-") or came[2:] != to[2:]:
                    out[i, j] = _OUT
    return out


def _shape(word: str) -> str:
    out = ""
    for c in word:
        kind = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out.endswith(kind):
            out += kind
    return out[:8]


class WordFeatures:
    """Slots of a word's own features and of what it says about its neighbours; each distinct word once."""

    def __init__(self, slots: int):
        self.slots, self.known = slots, {}

    def of(self, word: str) -> tuple[list[int], list[int], list[int]]:
        if word not in self.known:
            near = [word, _shape(word), word[-1:]]
            own = [*near, word.lower(), word[:2], word[:3], word[-2:], word[-3:]]
            self.known[word] = tuple([zlib.crc32(f"{side}{i}{v}".encode()) % self.slots for i, v in enumerate(vs)]
                                     for side, vs in (("w", own), ("p", near), ("n", near)))
        return self.known[word]

    def rows(self, sentences: list[list[str]]) -> list[np.ndarray]:
        """(words, 15) slots of each sentence; the slot 0 stands for the edges too."""
        found: dict[str, int] = {}
        code = np.array([found.setdefault(w, len(found)) for s in sentences for w in s], np.int64)
        size = np.array([len(s) for s in sentences], np.int64)
        own, prev, near = (np.array([*(self.of(w)[i] for w in found), [0] * n], np.int64).reshape(len(found) + 1, n)
                           for i, n in enumerate((8, 3, 3)))
        ends = np.cumsum(size)
        before, after = np.append(len(found), code)[:len(code)], np.append(code, len(found))[1:]
        before[(ends - size)[size > 0]] = after[ends[size > 0] - 1] = len(found)
        rows = np.concatenate([own[code], prev[before], near[after], np.zeros((len(code), 1), np.int64)], 1)
        return np.split(rows, ends[:-1]) if len(size) else []


def best_paths(scores: list[np.ndarray], trans: np.ndarray) -> list[np.ndarray]:
    """The best label path of each sequence of emission scores; sequences advance together, ties to the first label."""
    size = np.array([len(s) for s in scores], np.int64)
    order = np.argsort(-size, kind="stable")
    labels = trans.shape[1]
    longest = int(size.max(initial=0))
    # step by step: the sequences that are longer than t, longest first, stand at first[t]:first[t + 1]
    alive = np.searchsorted(-size[order], -np.arange(longest), "left")
    first = np.concatenate([[0], np.cumsum(alive)]).astype(np.int64)
    places = [first[:size[i]] + k for k, i in enumerate(order)]
    here = np.empty((int(first[-1]), labels))
    for k, i in enumerate(order):
        here[places[k]] = scores[i]
    back = np.zeros((len(here), labels), np.int16)
    last = np.zeros((len(scores), labels))
    for t in range(longest):
        some = slice(0, int(alive[t]))
        at = slice(int(first[t]), int(first[t + 1]))
        if t == 0:
            last[some] = trans[labels] + here[at]
        else:
            reach = last[some, :, None] + trans[None, :labels]
            back[at] = reach.argmax(1)
            last[some] = reach.max(1) + here[at]
    final = last.argmax(1) if labels else np.zeros(len(scores), np.int64)
    path, now = np.zeros(len(here), np.int64), np.zeros(0, np.int64)
    for t in range(longest - 1, -1, -1):
        if len(now):
            now = back[int(first[t + 1]) + np.arange(len(now)), now]
        now = np.concatenate([now, final[len(now):int(alive[t])]])
        path[int(first[t]):int(first[t + 1])] = now
    out = [np.zeros(0, np.int64)] * len(scores)
    for k, i in enumerate(order):
        out[i] = path[places[k]]
    return out


class Tagger:
    """Labels, emission weights (slots x labels) and transition weights."""

    def __init__(self, labels: list[str], emit: np.ndarray, trans: np.ndarray):
        self.labels, self.emit, self.trans = labels, emit, trans

    def paths(self, feats: list[np.ndarray]) -> list[np.ndarray]:
        ends = np.cumsum([len(f) for f in feats])
        scores = np.split(self.emit[np.concatenate(feats)].sum(1), ends[:-1]) if len(feats) else []
        return best_paths(scores, self.trans + allowed(self.labels))

    def tags(self, sentences: list[list[str]], words: WordFeatures) -> list[list[str]]:
        return [[self.labels[j] for j in p] for p in self.paths(words.rows(sentences))]


def _epoch(labels: list[str], emit: np.ndarray, trans: np.ndarray, feats: list[np.ndarray], gold: list[np.ndarray]):
    """One pass from the given weights: changes of the weights at its end, and on average over its steps."""
    model = Tagger(labels, emit.copy(), trans.copy())
    sum_emit, sum_trans = np.zeros_like(emit), np.zeros_like(trans)
    steps = max(1, -(-len(feats) // BATCH))
    for step in range(steps):
        f, g = feats[step * BATCH:(step + 1) * BATCH], gold[step * BATCH:(step + 1) * BATCH]
        rest = steps - step  # how many of the averaged weights hold this step's change
        if not f:
            break
        # all of a step's sequences at once; where both paths agree, the changes are none
        x, y, p = np.concatenate(f), np.concatenate(g), np.concatenate(model.paths(f))
        head = np.cumsum([0, *map(len, g[:-1])])
        other = y != p
        if not other.any():
            continue
        for path, sign in ((y, 1.0), (p, -1.0)):
            came = np.append(len(labels), path[:-1])
            came[head] = len(labels)
            for emits, transits, w in ((model.emit, model.trans, sign), (sum_emit, sum_trans, sign * rest / steps)):
                np.add.at(emits, (x[other], path[other, None]), w)
                np.add.at(transits, (came, path), w)
    return model.emit - emit, model.trans - trans, sum_emit, sum_trans


def fit_tagger(df: DataFrame, tokens_col: str, tags_col: str, epochs: int = 5, slots: int = SLOTS,
               shard_rows: int = SHARD_ROWS) -> Tagger:
    """Learn from all sequences of ``df``: arrays of tokens and of IOB tags, of one length each."""
    spark = df.sparkSession
    # stored: every epoch reads the sequences again, and their tags may be costly to make
    rows = cut_lineage(df.select(F.col(tokens_col).alias("tokens"), F.col(tags_col).alias("tags"))
                       .where("size(tokens) > 0 and size(tokens) = size(tags)").dropDuplicates())
    labels = sorted(r["t"] for r in rows.select(F.explode("tags").alias("t")).distinct().collect() if r["t"] is not None)
    n = rows.count()
    if not n or not labels:
        return Tagger(labels or ["O"], np.zeros((slots, max(1, len(labels)))), np.zeros((max(1, len(labels)) + 1, max(1, len(labels)))))
    shards = -(-n // shard_rows)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("tokens", "tags"), F.lit(shards)).cast("int"))
    emit, trans = np.zeros((slots, len(labels))), np.zeros((len(labels) + 1, len(labels)))
    mean_emit, mean_trans = emit.copy(), trans.copy()
    for _ in range(epochs):
        sent = spark.sparkContext.broadcast((emit, trans))

        def learn(shard: pa.Table) -> pa.Table:
            emit, trans = sent.value  # noqa: B023  run within the epoch
            words, at = WordFeatures(slots), {x: i for i, x in enumerate(labels)}
            pairs = sorted(zip(shard.column("tokens").to_pylist(), shard.column("tags").to_pylist()),
                           key=lambda x: (zlib.crc32("\0".join(map(str, x[0])).encode()), list(map(str, x[0])), list(map(str, x[1]))))
            pairs = [(list(map(str, t)), y) for t, y in pairs if all(v in at for v in y)]
            found = _epoch(labels, emit, trans, words.rows([t for t, _ in pairs]), [np.array([at[v] for v in y]) for _, y in pairs])
            end = np.concatenate([found[0], found[1]]).ravel()
            avg = np.concatenate([found[2], found[3]]).ravel()
            pick = np.flatnonzero((end != 0) | (avg != 0))
            return pa.table({"i": pa.array(pick), "end": pa.array(end[pick]), "avg": pa.array(avg[pick])})

        sums = (dealt.groupBy("shard").applyInArrow(learn, "i long, end double, avg double")
                .groupBy("i").agg(F.sum("end").alias("end"), F.sum("avg").alias("avg"))).toArrow()
        i = sums.column("i").to_numpy()
        flat = np.zeros((2, (slots + len(labels) + 1) * len(labels)))
        flat[0, i], flat[1, i] = (sums.column(c).to_numpy() / shards for c in ("end", "avg"))
        end, avg = flat.reshape(2, -1, len(labels))
        mean_emit += (emit + avg[:slots]) / epochs
        mean_trans += (trans + avg[slots:]) / epochs
        # multiples of 2**-20: the steps' whole numbers add to them exactly, in whatever order
        emit, trans = (np.round(np.ldexp(w, 20)) / (1 << 20) for w in (emit + end[:slots], trans + end[slots:]))
        sent.unpersist()
    # sums over shards are added in any order: weights are kept to what order cannot change
    return Tagger(labels, np.round(mean_emit, 6), np.round(mean_trans, 6))


def tag(spark: SparkSession, model: Tagger, tokens: Column) -> Column:
    """array<string> of tags of an array of tokens (a null token counts as an empty one), by a narrow Arrow map."""
    labels = model.labels
    sent = spark.sparkContext.broadcast((model.emit, model.trans))
    slots = len(model.emit)

    def batches(sentences: list) -> Iterator[list]:
        for i in range(0, len(sentences), 256):
            yield sentences[i:i + 256]

    @F.arrow_udf("array<string>")
    def label(tokens: pa.Array) -> pa.Array:
        tagger, words, out = Tagger(labels, *sent.value), WordFeatures(slots), []
        for part in batches(tokens.to_pylist()):
            given = [[w or "" for w in s or ()] for s in part]
            out += [None if s is None else t for s, t in zip(part, tagger.tags(given, words))]
        return pa.array(out, pa.list_(pa.string()))

    return label(tokens)
