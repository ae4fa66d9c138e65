import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import textvec as V

texts = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b世.", max_size=40)), min_size=1, max_size=8)


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_match_the_pattern(ts):
    buf, offs = V.text_block(pa.array(ts, pa.string()))
    w = V.Words(V.lower_ascii(buf), offs)
    raw = w.buf.tobytes()
    got = [[raw[a:b].decode() for a, b, d in zip(w.start, w.end, w.doc) if d == i] for i in range(len(ts))]
    assert got == [words_of(t) for t in ts]
    by_word = {}
    for x, h in zip([x for g in got for x in g], w.hashes().tolist()):
        assert by_word.setdefault(x, h) == h
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(1, 5))
def test_shingles_are_runs_of_words(ts, k):
    buf, offs = V.text_block(pa.array(ts, pa.string()))
    w = V.Words(V.lower_ascii(buf), offs)
    doc, h = V.distinct_pairs(*V.shingles(w, w.hashes(), k), len(ts))
    n = np.bincount(doc, minlength=len(ts))
    for i, t in enumerate(ts):
        x = words_of(t)
        runs = {tuple(x[j:j + k]) for j in range(len(x) - k + 1)} or ({tuple(x)} if x else set())
        assert n[i] == len(runs)


def test_sliced_arrays_and_blocks():
    arr = pa.array(["a b", None, "c", "dd ee ff", ""])
    buf, offs = V.text_block(arr.slice(2, 2))
    assert buf.tobytes() == b"cdd ee ff" and offs.tolist() == [0, 1, 9]
    batch = pa.RecordBatch.from_arrays([arr], names=["t"])
    parts = list(V.cut(batch, "t", 4))
    assert [p.num_rows for p in parts] == [3, 1, 1] and sum(p.num_rows for p in parts) == 5
