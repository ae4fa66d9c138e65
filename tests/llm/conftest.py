import random

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, repeated rows, ties, a long text and columns with clashing names."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    prose = [" ".join(rng.choice(vocab) for _ in range(60)) + "." for _ in range(12)]
    long = " ".join(rng.choice(vocab) for _ in range(20_000))
    rows = [(i, t, "en", f"s{i % 3}", len(t), 1.0, "x") for i, t in enumerate(prose)]
    rows += [(20, None, "en", None, None, 1.0, "x"), (21, "", None, "", 0, 1.0, "x"), (22, " \t\n ", "fr", "s0", 4, 1.0, "x"),
             (23, prose[0], "en", "s0", len(prose[0]), 1.0, "x"), (1, prose[1], "en", "s1", len(prose[1]), 1.0, "x"),
             (None, prose[2], "en", "s2", len(prose[2]), 1.0, "x"), (24, long, "de", "s1", len(long), 1.0, "x"),
             (25, "héé ß 1 2", None, "s1", 9, 1.0, "x"), (26, "a b", "en", "s1", 3, 1.0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, "
                                       "weight string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
