"""Language ID by a linear-chain conditional random field over words.

A text's words (runs of letters, lower-cased) form one chain; each word has one
of the learnt languages.  A word's features are its beginnings and endings (1 to
4 bytes), its byte trigrams, the word itself, and membership in each language's
lexicon (the words most frequent in it); a learned transition matrix ties
neighbours.  Forward-backward gives every word's distribution over languages,
also inside code-switched texts; a text's language is the one with the highest
mean over its words (ties to the first in alphabetical order), and its score is
that mean.

Features are hashed into 2**18 rows.  Fitting is stochastic gradient descent
(AdaGrad) on the likelihood of the documents' labels, over chains of 64 words,
from a bounded, documented sample (``sample_rows``, default 1500 rows, those
whose id hashes lowest, whole texts).  Labelling is one narrow map: emissions are
computed once for each distinct word of a block, and the chains of a block
advance together.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text when no labelled row is given; a repeated row gets its copy's
label; an empty table gives an empty result; other columns pass through, and one
named like a result column is replaced.  A very long text is one chain, labelled
whole in one task, at about 100 bytes of memory a word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import apart, bounded_sample, held_out, letters, map_text, table
from tessera.llm.textvec import Words, mix, text_block

SAMPLE_ROWS = 1500
ROOM = 1 << 18
LEXICON = 300


def word_features(w: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``at``, hashed feature) pairs of the words ``at``, sorted by index."""
    s, e = w.start[at], w.end[at]
    size = e - s
    who, out = [np.arange(len(at))], [mix(w.gram(s, e))]
    for n in (1, 2, 3, 4):
        ok = np.flatnonzero(size >= n)
        for kind, a in ((1, s[ok]), (2, e[ok] - n)):
            who.append(ok)
            out.append(mix(w.gram(a, a + n) ^ np.uint64(0x1234567 * (10 * n + kind))))
    count = np.maximum(size - 2, 0)
    ok = np.repeat(np.arange(len(at)), count)
    a = s[ok] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    who.append(ok)
    out.append(mix(w.gram(a, a + 3) ^ np.uint64(0xABCDEF)))
    who, feat = np.concatenate(who), (np.concatenate(out) >> np.uint64(46)).astype(np.int64)
    order = np.argsort(who, kind="stable")
    return who[order], feat[order]


def chains(emit: np.ndarray, trans: np.ndarray, first: np.ndarray, moves: bool = True):
    """Marginals of each word and, where asked for, expected transition counts, by scaled forward-backward.

    ``first`` has the chains' starts and the end; all chains advance together, longest first.
    """
    n, labels = emit.shape
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    start, length = first[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    live = np.searchsorted(-length, -np.arange(steps), "left")
    local = np.exp(emit - emit.max(1, keepdims=True))
    move = np.exp(trans - trans.max())
    fwd, bwd = np.empty((n, labels)), np.ones((n, labels))
    cur = None
    for t in range(steps):
        at = start[:live[t]] + t
        cur = local[at] if t == 0 else (cur[:live[t]] @ move) * local[at]
        cur = cur / cur.sum(1, keepdims=True)
        fwd[at] = cur
    cur = np.zeros((0, labels))
    for t in range(steps - 2, -1, -1):
        m = live[t + 1]
        ahead = np.ones((m, labels))
        ahead[:len(cur)] = cur
        at = start[:m] + t
        cur = (local[at + 1] * ahead) @ move.T
        cur = cur / cur.sum(1, keepdims=True)
        bwd[at] = cur
    marg = fwd * bwd
    marg /= marg.sum(1, keepdims=True)
    if not moves:
        return marg, None
    inner = np.ones(n, bool)
    inner[first[1:][np.diff(first) > 0] - 1] = False
    at = np.flatnonzero(inner)
    pair = fwd[at][:, :, None] * move[None] * (local[at + 1] * bwd[at + 1])[:, None, :]
    pair = (pair / pair.sum((1, 2), keepdims=True)).sum(0) if len(at) else np.zeros((labels, labels))
    return marg, pair


@dataclass
class ChainModel:
    labels: list[str]
    weight: np.ndarray   # (ROOM + labels, labels)
    trans: np.ndarray    # (labels, labels)
    lexicon: list[np.ndarray]  # sorted word hashes of each label

    def emissions(self, w: Words, at: np.ndarray, h: np.ndarray) -> np.ndarray:
        who, feat = word_features(w, at)
        rows = self.weight[feat].astype(float)
        sums = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, 0)])
        first = np.searchsorted(who, np.arange(len(at) + 1))
        out = sums[first[1:]] - sums[first[:-1]]
        for i, known in enumerate(self.lexicon):
            out[np.isin(h, known)] += self.weight[ROOM + i]
        return out


def fit_chain(texts: list[str], langs: list[str], epochs: int = 4, batch: int = 64, rate: float = 0.1, cut: int = 64,
              l2: float = 1e-6, seed: int = 3) -> ChainModel:
    """Fit on normalised texts (letters only) of a bounded sample and their languages."""
    labels = sorted(set(langs))
    n_labels = len(labels)
    model = ChainModel(labels, np.zeros((ROOM + n_labels, n_labels)), np.zeros((n_labels, n_labels)), [])
    if n_labels == 0:
        return model
    y = np.array([labels.index(x) for x in langs])
    buf, offs = text_block(pa.array(texts, pa.large_string()))
    w = Words(buf, offs)
    h = w.hashes()
    for i in range(n_labels):
        words, count = np.unique(h[y[w.doc] == i], return_counts=True)
        model.lexicon.append(np.sort(words[np.argsort(-count, kind="stable")][:LEXICON]))
    rng = np.random.default_rng(seed)
    gw, gt = np.full_like(model.weight, 1e-4), np.full_like(model.trans, 1e-4)
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
            tok = np.concatenate([np.arange(w.first[d], w.first[d + 1]) for d in some]) if len(some) else np.zeros(0, int)
            if not len(tok):
                continue
            uniq, one, inv = np.unique(h[tok], return_index=True, return_inverse=True)
            at = tok[one]
            emit = model.emissions(w, at, uniq)[inv]
            size = w.first[some + 1] - w.first[some]
            heads = np.concatenate([np.arange(a, b, cut) for a, b in zip(np.cumsum(size) - size, np.cumsum(size))])
            first = np.append(heads, len(tok)).astype(np.int64)
            marg, pair = chains(emit, model.trans, first)
            gold = y[w.doc[tok]]
            err = marg
            err[np.arange(len(tok)), gold] -= 1
            per_word = np.zeros((len(at), n_labels))
            np.add.at(per_word, inv, err)
            inner = np.ones(len(tok), bool)
            inner[first[1:] - 1] = False
            want = np.zeros_like(pair)
            np.add.at(want, (gold[inner], gold[inner]), 1)  # a document's words share its label
            g = (pair - want) / len(tok)
            gt += g * g
            model.trans -= rate * g / np.sqrt(gt)
            who, feat = word_features(w, at)
            used, back = np.unique(feat, return_inverse=True)
            g = np.zeros((len(used), n_labels))
            np.add.at(g, back, per_word[who])
            g = g / len(some) + l2 * model.weight[used]
            gw[used] += g * g
            model.weight[used] -= rate * g / np.sqrt(gw[used])
            for i, known in enumerate(model.lexicon):
                g = per_word[np.isin(uniq, known)].sum(0) / len(some)
                gw[ROOM + i] += g * g
                model.weight[ROOM + i] -= rate * g / np.sqrt(gw[ROOM + i])
    model.weight = model.weight.astype(np.float32)
    # a chain of one label only never sees a switch: keep transitions finite
    model.trans = np.clip(model.trans, -4, 4)
    return model


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  sample_rows: int = SAMPLE_ROWS, **fit) -> ChainModel:
    """Model fitted on at most ``sample_rows`` rows with text and language."""
    good = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    ids = bounded_sample(good.select(F.col(id_col).alias("id")).distinct(), sample_rows, "id")
    rows = (good.select(F.col(id_col).alias("id"), letters(text_col).alias("t"), F.col(lang_col).alias("y"))
            .join(F.broadcast(ids), "id").collect())
    rows.sort(key=lambda r: (r["id"], r["t"], r["y"]))
    return fit_chain([r["t"] for r in rows], [r["y"] for r in rows], **fit)


def label_languages(docs: DataFrame, model: ChainModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with lang_pred, score, and ``runs``: stretches of words of one language, in order."""
    shared = apart(docs.sparkSession, model)

    def label(buf, offs):
        m = shared.value
        n = len(offs) - 1
        w = Words(buf, offs)
        if not m.labels or not len(w.start):
            return [pa.array(["und"] * n), np.zeros(n), pa.array([[]] * n, runs)]
        h = w.hashes()
        uniq, one, inv = np.unique(h, return_index=True, return_inverse=True)
        emit = m.emissions(w, one, uniq)[inv]
        has = np.flatnonzero(w.counts())
        marg, _ = chains(emit, m.trans, np.append(w.first[has], len(h)), moves=False)
        mean = np.zeros((n, len(m.labels)))
        mean[has] = np.add.reduceat(marg, w.first[has], axis=0) / w.counts()[has][:, None]
        top = mean.argmax(1)
        best = marg.argmax(1)
        head = np.ones(len(h), bool)
        head[1:] = (best[1:] != best[:-1]) | (w.doc[1:] != w.doc[:-1])
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(h)))
        first = np.searchsorted(at, w.first)
        names = pa.array(m.labels)
        parts = pa.StructArray.from_arrays([names.take(pa.array(best[at])), pa.array(size.astype(np.int32))],
                                           ["lang", "words"])
        pred = np.where(w.counts() > 0, np.array(m.labels, object)[top], "und")
        return [pa.array(pred.tolist(), pa.string()), np.where(w.counts() > 0, mean[np.arange(n), top], 0.0),
                pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), parts)]

    runs = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))
    return map_text(docs, label, "lang_pred string, score double, runs array<struct<lang:string,words:int>>",
                    docs.columns if keep is None else keep,
                    F.when(F.col(text_col).rlike(r"\p{L}"), letters(text_col)))


def op4_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; learns from ids whose crc32 mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.where(~held_out("doc_id", 3, 1)))
    out = label_languages(docs, model, keep=["doc_id"])
    return out.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score",
                      F.greatest(F.size("runs") - 1, F.lit(0)).alias("n_switches"))


QUERIES = {"op4_language_crf": op4_language_crf}
ORACLE_SQL: dict[str, str] = {}
