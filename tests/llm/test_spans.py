import random
import re

from tessera.llm.spans import remove_repeats


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t.lower())


def prose(rng, n, stops=True):
    w = [f"w{rng.randrange(5000)}" for _ in range(n)]
    return " ".join(x + ("." if stops and rng.random() < 0.12 else "") for x in w)


def test_repeated_passages_go_and_clean_text_stays(spark):
    rng = random.Random(3)
    passages = [prose(rng, 55), prose(rng, 80, stops=False), "same " * 60]
    rows = []
    for i in range(60):
        own = [prose(rng, 50), prose(rng, 40, stops=i % 2 == 0)]
        own.insert(1, passages[i % 3] if i % 5 < 3 and i >= 3 else passages[i] if i < 3 else "")
        rows.append((i, "\n".join(own)))
    before = dict(rows)
    out = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for i in sorted(out):
        w = words(out[i].text)
        for j in range(len(w) - 49):
            assert first.setdefault(tuple(w[j:j + 50]), i) == i
    for i in range(60):
        if i >= 3 and not i % 5 < 3:
            assert out[i].text == before[i] and out[i].n_removed == 0
        own = set(words(before[i])) - {x for p in passages for x in words(p)}
        left = set(words(out[i].text))
        assert len(own - left) <= 26  # at most the pieces at the passage's two edges
    for p in range(3):
        assert out[p].text == before[p] or p == 2  # the run of one word repeats within its own text


def test_first_occurrence_is_smallest_id_and_leftmost(spark):
    s = [f"alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i} eta{i}." for i in range(6)]
    rows = [(9, " ".join(s[:3])), (4, " ".join(s[:3]) + " Tail here."), (5, " ".join(s[3:] + s[3:]))]
    out = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[4].n_removed == 0 and out[9].text == "" and out[9].n_removed == 3
    assert out[5].text.strip() == " ".join(s[3:])


def test_a_passage_is_found_at_any_line_width(spark):
    rng = random.Random(8)
    w = [f"p{rng.randrange(5000)}" + ("." if i % 9 == 8 else "") for i in range(60)]

    def wrapped(width):
        return "\n".join(" ".join(w[i:i + width]) for i in range(0, 60, width))

    rows = [(1, "First text here.\n\n" + wrapped(10)), (2, wrapped(13) + "\n\nOther end."), (3, " ".join(w)), (4, wrapped(10))]
    out = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].n_removed == 0 and out[1].text == rows[0][1]
    assert out[2].text.strip() == "Other end." and out[3].text == out[4].text == ""


def test_rows_without_id_stay_whole(spark):
    rng = random.Random(9)
    t = prose(rng, 60)
    rows = [(None, t + "\n\n" + t), (5, t), (6, t)]
    out = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[None].text == rows[0][1] and out[None].n_removed == 0 and out[5].text == t and out[6].n_removed > 5


def test_odd_rows(odd_docs, no_docs):
    out = remove_repeats(odd_docs.withColumnRenamed("weight", "n_removed"))
    assert out.columns[:2] == ["doc_id", "text"] and out.columns[-2:] == ["n_sentences", "n_removed"]
    rows = {(r.doc_id, i): r for i, r in enumerate(out.collect())}
    assert len(rows) == odd_docs.count()
    by = {k[0]: r for k, r in rows.items()}
    assert by[20].text is None and by[21].text == "" and by[22].text == " \t\n " and by[23].text == ""
    assert by[None].n_removed == 0 and by[24].n_removed == 0
    assert all(r.n_removed == 0 for (i, _), r in rows.items() if i == 1)
    assert remove_repeats(no_docs).count() == 0
