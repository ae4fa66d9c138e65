"""Span scores against trying every span."""

import math
import random

from pyspark.sql import functions as F

from tessera.operators import qa as QA
from tessera.operators import spanscore as SS
from tessera.operators import spans as SP


def test_best_span_is_found(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 60)))) for i in range(30)]
    asked = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 6)))) for i in range(30)]
    c = spark.createDataFrame(docs, "id int, text string")
    q = spark.createDataFrame(asked, "id int, question string")
    weights = SS.question_weights(q, c, "id", "question", "text")
    win = SP.context_windows(SP.token_offsets(c, "id"), "id", 16, 8, keep=("offsets", "tokens")).join(weights, "id")
    nb = QA.qa_nbest(c.select(F.col("id").alias("example_id"), F.col("text").alias("context")), SS.span_logits(win, "id", gap=300),
                     n_best=17, max_len=8)
    got = {r.example_id: (r.text, r.score) for r in nb.where("rank = 1").collect()}
    df = {w: sum(w in t.split() for _, t in docs) for w in vocab}
    for (i, text), (_, question) in zip(docs, asked):
        worth = [round(1000 * math.log(31 / (1 + df[t]))) if t in question.split() else -300 for t in text.split()]
        n = len(worth)
        best = None
        for k in range(max(1, 1 + math.ceil((n - 16) / 8))):
            for a in range(8 * k, min(8 * k + 16, n)):
                for b in range(a, min(a + 8, 8 * k + 16, n)):
                    best = max(best if best is not None else -10**9, sum(worth[a:b + 1]))
        if best is None or not question:
            assert got[i][0] == "empty"
        else:
            assert abs(got[i][1] - best / 1000) < 1e-9
            assert got[i][0] in text
