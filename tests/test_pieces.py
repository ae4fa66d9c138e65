"""Sub-word pieces against a plain longest match."""

import base64
import random

from pyspark.sql import functions as F

from tessera.operators import pieces as PC
from tessera.operators.seqtags import align_labels


def table_file(tmp_path, pieces):
    path = tmp_path / "pieces.txt"
    path.write_bytes(b"".join(base64.b64encode(p if isinstance(p, bytes) else p.encode()) + b" %d\n" % i for i, p in enumerate(pieces)))
    return str(path)


def plain(word, pieces):
    out, rest, start = [], word, True
    while rest:
        fits = [p for p in pieces if isinstance(p, str) and p.strip(" ") and (p[1:] if p[0] == " " else p) == rest[:len(p) - (p[0] == " ")]
                and (p[0] == " ") == start]
        p = max(fits, key=len, default=None)
        n = 1 if p is None else len(p) - (p[0] == " ")
        out.append((rest[:n], None if p is None else pieces.index(p)))
        rest, start = rest[n:], False
    return out


def test_longest_match_and_round_trip(spark, tmp_path):
    rng = random.Random(2)
    pieces = [" ", b"\xe4\xb8", "😀", " 中", "中文"] + sorted({rng.choice(["", " "]) + "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5)))
                                                          for _ in range(90)})
    path = table_file(tmp_path, pieces)
    words = ["".join(rng.choice("abcé中文😀x") for _ in range(rng.randrange(0, 12))) for _ in range(200)] + ["ab" * 3000]
    rows = [(i, words[i:i + 5]) for i in range(0, 200, 5)] + [(900, None), (901, []), (902, [None, "a"]), (903, words[-1:])]
    df = spark.createDataFrame(rows, "id int, words array<string>")
    cut = PC.piece_splitter(spark, path)
    got = {r.id: r.p for r in df.select("id", cut(F.col("words")).alias("p")).collect()}
    for i, ws in rows:
        if ws is None:
            assert got[i] is None
            continue
        assert [None if p is None else [(x.piece, x.id) for x in p] for p in got[i]] == [None if w is None else plain(w, pieces) for w in ws]
        assert ["".join(x.piece for x in p or ()) for p in got[i]] == [w or "" for w in ws]


def test_labels_follow_pieces(spark):
    df = spark.createDataFrame([([["ab", "c"], ["d"], [], ["e", "f", "g"]], [3, 0, 5, 4], [2, 0, 6, 4])],
                               "p array<array<string>>, y array<int>, inside array<int>")
    one, every = df.select(align_labels("p", "y").label, align_labels("p", "y", "inside").label).first()
    assert one == [-100, 3, -100, 0, 4, -100, -100, -100]
    assert every == [-100, 3, 2, 0, 4, 4, 4, -100]
    words = df.select(align_labels("p", "y").word_idx).first()[0]
    assert words == [None, 0, 0, 1, 3, 3, 3, None]


def test_grams_of_a_passage_are_among_those_of_its_documents():
    """Blocks of any size give the same grams, and a text that holds a passage whole holds all its inner ones."""
    import random

    import pyarrow as pa

    from tessera.operators.mc import word_grams
    rng = random.Random(1)
    docs = [[rng.choice(["ab", "abc", "é", "x", "yz"]) for _ in range(rng.randrange(12))] for _ in range(60)] + [None, []]
    lists = pa.array(docs, pa.list_(pa.string()))
    whole = word_grams(lists, False)
    assert word_grams(lists, False, limit=3).equals(whole) and whole.to_pylist()[-2:] == [[], []]
    assert word_grams(lists.slice(5, 20), False).to_pylist() == whole.to_pylist()[5:25]
    for d, held in zip(docs, whole.to_pylist()):
        if d and len(d) > 4:
            text = " ".join(d)
            part = text[1 if len(d[0]) > 1 else 0:len(text) - (len(d[-1]) > 1)].split()
            inner = word_grams(pa.array([part], pa.list_(pa.string())), True)[0].as_py()
            assert inner and set(inner) <= set(held)


def test_tokens_are_scanned_block_by_block(monkeypatch):
    """One batch of many texts is never worked on as one buffer."""
    import pyarrow as pa

    from tessera.operators import spans as SP
    seen, scan = [], SP._scan_block
    monkeypatch.setattr(SP, "_scan_block", lambda t: seen.append(t.nbytes) or scan(t))
    texts = pa.array([None, "", "a  é b", "word " * 300_000] * 3)
    got = SP.scan_tokens(texts)
    assert len(seen) >= 3 and got.equals(scan(texts)) and got[2].as_py()[1] == {"s": 3, "e": 4}


def test_batches_are_worked_on_in_slices():
    import pyarrow as pa

    from tessera.operators.common import by_slices
    seen = []
    lists = [pa.array([[1, 2, 3], None, [], [4] * 9, [5]]), pa.array([], pa.list_(pa.int64())), pa.array([[6]])]
    out = list(by_slices(iter(lists), lambda x: seen.append(x.flatten().to_pylist()) or x, limit=4))
    assert sum((x.to_pylist() for x in out), []) == sum((x.to_pylist() for x in lists), [])
    assert seen == [[1, 2, 3], [4] * 9, [5], [6]]
