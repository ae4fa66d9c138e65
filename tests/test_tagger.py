"""The structured tagger: paths against all paths, IOB rules, the same model at any layout."""

import itertools
import random
import time

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import tagger as TG

LABELS = ["B-A", "B-B", "I-A", "I-B", "O"]


def test_paths_are_best_and_valid():
    rng = np.random.default_rng(0)
    trans = rng.normal(size=(6, 5)) + TG.allowed(LABELS)
    scores = [rng.normal(size=(n, 5)) * 3 for n in (4, 0, 1, 5, 3, 5)]
    for s, path in zip(scores, TG.best_paths(scores, trans)):
        def total(p):
            return sum(s[t, y] + trans[p[t - 1] if t else 5, y] for t, y in enumerate(p))
        best = max(itertools.product(range(5), repeat=len(s)), key=total)
        assert tuple(path) == best
        names = ["O"] + [LABELS[y] for y in path]
        assert all(not b.startswith("I-") or a[2:] == b[2:] and a != "O" for a, b in zip(names, names[1:]))


def sentences(n, seed):
    """Names after a title, places after 'in'; a name has no sign of its own."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    rows = []
    for i in range(n):
        tokens, tags = [], []
        for _ in range(rng.randrange(1, 7)):
            kind = rng.random()
            if kind < 0.3:
                tokens += ["Dr", word(3)]
                tags += ["B-A", "I-A"]
            elif kind < 0.5:
                tokens += ["in", word(4).title()]
                tags += ["O", "B-B"]
            else:
                tokens.append(word(3))
                tags.append("O")
        rows.append((i, tokens, tags))
    return rows


def test_learns_and_keeps_iob(spark):
    df = spark.createDataFrame(sentences(400, 1), "id int, tokens array<string>, tags array<string>")
    model = TG.fit_tagger(df, "tokens", "tags", slots=1 << 12, shard_rows=100)
    new = spark.createDataFrame(sentences(100, 2) + [(900, [], []), (901, None, None), (902, [None, "Dr"], ["O", "B-A"])],
                                "id int, tokens array<string>, tags array<string>")
    got = new.withColumn("p", TG.tag(spark, model, F.col("tokens"))).collect()
    by = {r.id: r for r in got}
    assert by[900].p == [] and by[901].p is None and len(by[902].p) == 2
    right = sum(a == b for r in got if r.id < 900 for a, b in zip(r.p, r.tags))
    assert right / sum(len(r.p) for r in got if r.id < 900) > 0.97
    for r in got:
        for a, b in zip(["O", *(r.p or [])], r.p or []):
            assert not b.startswith("I-") or a[2:] == b[2:]


def test_same_model_at_any_layout(spark):
    df = spark.createDataFrame(sentences(150, 3) * 2, "id int, tokens array<string>, tags array<string>")
    made = [TG.fit_tagger(df.repartition(k), "tokens", "tags", epochs=2, slots=1 << 10, shard_rows=40) for k in (1, 6)]
    assert made[0].labels == made[1].labels
    assert np.array_equal(made[0].emit, made[1].emit) and np.array_equal(made[0].trans, made[1].trans)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, [], []), (2, None, None), (3, ["a"], ["O", "O"])], "id int, tokens array<string>, tags array<string>")
    model = TG.fit_tagger(df, "tokens", "tags", slots=64)
    out = spark.createDataFrame([(["x", "y"],)], "tokens array<string>").select(TG.tag(spark, model, F.col("tokens")).alias("t"))
    assert out.first().t == ["O", "O"]


def test_sequences_are_made_once_for_all_epochs(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def tags(x):
        made.add(1)
        return x

    df = spark.createDataFrame(sentences(60, 4), "id int, tokens array<string>, tags array<string>").withColumn("tags", tags("tags"))
    TG.fit_tagger(df, "tokens", "tags", epochs=4, slots=1 << 10, shard_rows=20)
    assert made.value <= 2 * 60


def test_tags_of_a_long_turn_are_linear(spark, tmp_path):
    """20,000 words in one turn: looking back a word must not make all types again."""
    from tessera.plans import standins as S
    words = ["Aa", "Bb", "cc,", "dd", "Ee", "ff."] * 3334
    spark.createDataFrame([(1, 0, "user", " ".join(words)), (1, 1, "user", None)], "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    begun = time.monotonic()
    rows = S.tag_sequences(spark, str(tmp_path)).where("size(tokens) = size(gold) or gold is null").orderBy("turn").collect()
    assert time.monotonic() - begun < 15
    assert rows[0].gold[:8] == ["B-CAP", "I-CAP", "B-PUN", "O", "B-CAP", "B-PUN", "B-CAP", "I-CAP"] and len(rows[0].gold) == len(words)
    assert rows[0].pred[:5] == ["B-CAP", "I-CAP", "O", "O", "B-CAP"] and rows[1].gold is None
