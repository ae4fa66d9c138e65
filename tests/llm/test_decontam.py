import random

import numpy as np
import pytest

from tessera.llm.decontam import ItemIndex, banded_edits, find_contamination, matches


def edits(item, text):
    """Fewest edits that turn item into a substring of text."""
    cur = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(cur[j - 1] + (a != b), cur[j] + 1, new[-1] + 1))
        cur = new
    return min(cur)


def change(rng, s, k):
    s = list(s)
    for _ in range(k):
        i = rng.randrange(len(s))
        s[i:i + 1] = rng.choice([[], ["z"], [s[i], "q"]])
    return "".join(s)


def corpus(seed=2):
    rng = random.Random(seed)
    syllables = ["the", "an", "in", "er", "on", "tion", " ", " ", "ed", "or"]
    text = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    items = [(i, " ".join(text(rng.randrange(8, 60)).split())) for i in range(12)]
    docs = []
    for i in range(80):
        parts = [text(rng.randrange(0, 120))]
        if i % 2:
            _, item = items[rng.randrange(12)]
            parts += [change(rng, item, rng.randrange(0, max(1, int(len(item) * 0.08) + 1))), text(30)]
        docs.append((i, " ".join("".join(parts).split())))
    return items, docs


@pytest.mark.parametrize("rate", [0.0, 0.05, 0.1])
def test_matches_brute_force(rate):
    items, docs = corpus()
    rng = random.Random(3)
    short = ["".join(rng.choice("abcdef") for _ in range(n)) for n in (9, 10, 11, 15, 19, 20, 23, 30, 31, 39)]
    items += [(100 + i, t) for i, t in enumerate(short)]
    docs += [(200 + i, t[:2] + change(rng, t, rng.randrange(0, int(len(t) * rate) + 2)) + " tail") for i, t in enumerate(short * 3)]
    raw = [t.encode() for _, t in docs]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    got, want, used = {}, {}, 0
    for q in range(1, 9):
        index = ItemIndex([(i, t.encode()) for i, t in items], rate, q)
        used += len(index.ids)
        for (d, j), v in matches(index, np.frombuffer(b"".join(raw), np.uint8), offs).items():
            got[d, int(index.ids[j])] = v[0]
    assert used == len(items)
    for d, (_, t) in enumerate(docs):
        for i, item in items:
            e = edits(item.encode(), t.encode())
            if e <= int(len(item.encode()) * rate):
                want[d, i] = e
    assert got == want and len(want) > 5 and (rate == 0 or len(set(want.values())) > 2)


def test_the_shortest_items_stand_as_words(spark):
    items = spark.createDataFrame([(1, "abc def"), (2, "b"), (3, "abcdefghijk"), (4, "ß")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x abc def y"), (2, "xabc  DEF y"), (3, "a b, c"), (4, "rib"), (5, "say abcdefgXijk now"), (6, "groß ß")],
                                 "doc_id long, text string")
    out = {r.doc_id: (r["items"], r.edits) for r in find_contamination(docs, items).collect()}
    assert out == {1: ([1], [0]), 2: ([], []), 3: ([2], [0]), 4: ([], []), 5: ([3], [1]), 6: ([4], [0])}


@pytest.mark.parametrize("seed", range(5))
def test_banded_alignment_is_exact_within_its_band(seed):
    rng = random.Random(seed)
    item = "".join(rng.choice("abc") for _ in range(20))
    text = "".join(rng.choice("abc") for _ in range(5)) + change(rng, item, 2) + "bca"
    a, b = (np.frombuffer(x.encode(), np.uint8) for x in (item, text))
    assert banded_edits(a, b, -25, 60) == edits(item, text)


def test_shards_give_the_same(spark):
    items, docs = corpus(4)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    one = find_contamination(d, b).collect()
    many = find_contamination(d, b, shard_bytes=400).collect()
    assert sorted(one) == sorted(many) and any(r.contaminated for r in one)
    assert all(r["items"] == sorted(r["items"]) and len(r["items"]) == len(r.edits) for r in one)


def test_odd_rows(spark, odd_docs, no_docs):
    text = odd_docs.where("doc_id = 0").first().text
    bench = spark.createDataFrame([(1, text.upper()), (2, None), (3, "a"), (None, text), (4, ""), (1, text)],
                                  "item_id long, text string")
    out = find_contamination(odd_docs.withColumnRenamed("weight", "items"), bench)
    assert out.columns.count("items") == 1 and out.columns[-4:] == ["contaminated", "items", "edits", "starts"]
    assert sorted(r.doc_id for r in out.collect() if r.contaminated) == [0, 23, 26]  # 26 is "a b"
    assert find_contamination(odd_docs, bench.limit(0)).where("contaminated").count() == 0
    assert find_contamination(no_docs, bench).count() == 0
