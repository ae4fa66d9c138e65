"""IOB chunking (strict and lenient) against a small Python model."""

import random

from pyspark.sql import functions as F

from tessera.operators.seqtags import entities


def model(tags, strict):
    out, i, n = [], 0, len(tags)
    starts = []
    for i in range(n):
        cur, prev = tags[i], tags[i - 1] if i else None
        pf = "O" if cur == "O" else cur[0]
        ty = "O" if cur == "O" else cur[2:]
        pty = None if prev is None else ("O" if prev == "O" else prev[2:])
        if i == 0 or pf != "I" or prev == "O" or ty != pty:
            starts.append(i)
    for k, b in enumerate(starts):
        e = (starts[k + 1] if k + 1 < len(starts) else n) - 1
        t = tags[b]
        if t == "O":
            continue
        if strict and t[0] != "B":
            continue
        out.append((t[2:], b, e))
    return out


def run(spark, seqs, strict):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "sid int, tags array<string>")
    rows = entities(df, ["sid"], "tags", strict).collect()
    got = {}
    for r in rows:
        got.setdefault(r.sid, []).append((r.etype, r.start, r.end))
    return [sorted(got.get(i, [])) for i in range(len(seqs))]


def test_fixture_rows(spark):
    seq = ["O", "I-x", "B-x", "I-x", "I-y"]
    assert run(spark, [seq], True) == [[("x", 2, 3)]]
    assert run(spark, [seq], False) == [[("x", 1, 1), ("x", 2, 3), ("y", 4, 4)]]
    assert run(spark, [[]], True) == [[]]


def test_random_sequences(spark):
    rng = random.Random(7)
    tags = ["O", "B-a", "I-a", "B-b", "I-b"]
    seqs = [[rng.choice(tags) for _ in range(rng.randint(0, 15))] for _ in range(300)]
    for strict in (True, False):
        assert run(spark, seqs, strict) == [sorted(model(s, strict)) for s in seqs]


def test_token_accuracy_makes_its_arrays_once(spark):
    from pyspark.sql import functions as F
    from tessera.operators.seqtags import token_accuracy
    df = spark.createDataFrame([([1, 2, -1, 3], [1, 3, 3, 3]), ([], [])], "g array<int>, p array<int>")
    df = df.select(F.transform("g", lambda x: x + 0).alias("g"), F.transform("p", lambda x: x + 0).alias("p"))
    out = token_accuracy(df, "p", "g", ignore=[-100, -1])
    assert out.first().asDict() == {"n_tokens": 3, "token_acc": 2 / 3}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("arrays_zip(") == 1
