"""JSON cut at record boundaries, at any range size."""

import json
import random

import pytest

from tessera.sources import readers as RD
from tessera.sources.json_ranges import json_ranges, objects_of, read_json_array


def values(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 4)
    if kind == 0:
        return rng.choice(['}{', 'a"b', "\\\\", '\\"', "[,]", "é中😀", "line\nend", "", " x "])
    if kind == 1:
        return rng.randrange(1000)
    if kind == 2:
        return None
    if kind == 3:
        return rng.choice(["\\" * 9 + '"', "]", "[1,2]"])
    if kind == 4:
        return [values(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(["k", "}", '"', "\\"]) + str(i): values(rng, depth + 1) for i in range(rng.randrange(3))}


def test_objects_back_to_back():
    rng = random.Random(1)
    for _ in range(200):
        objs = [{"a": values(rng), "b": values(rng)} for _ in range(rng.randrange(5))]
        text = rng.choice(["", " ", "\n"]).join(json.dumps(o, ensure_ascii=rng.random() < 0.5) for o in objs)
        assert [json.loads(x) for x in objects_of(text)] == objs


def test_concatenated_file_with_nesting(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a":{"b":"}{"}}{"a":{"b":"x\\"}{"}}\n{"a":null}')
    got = RD.read_concat_json(spark, str(tmp_path / "c.json"), "a struct<b:string>").collect()
    assert sorted(r.a.b if r.a else "" for r in got) == ["", 'x"}{', "}{"]


@pytest.mark.parametrize("size", [3, 17, 64, 1000, 1 << 20])
def test_array_of_strings_in_ranges(spark, tmp_path, size):
    rng = random.Random(size)
    want = [rng.choice(['a"', "\\" * rng.randrange(8), "x,y", "]", "é中😀" * 3, "", "[\n"]) for _ in range(40)]
    (tmp_path / "ctx.json").write_text(json.dumps(want, ensure_ascii=False, indent=rng.choice([None, 1])), encoding="utf-8")
    got = RD.read_contexts(spark, str(tmp_path / "ctx.json"), range_bytes=size)
    assert [(r.ctx_id, r.text) for r in got.orderBy("ctx_id").collect()] == list(enumerate(want))
    if size < 100:
        assert json_ranges(spark, str(tmp_path / "ctx.json"), size).count() > 3


def test_records_of_several_files(spark, tmp_path):
    rng = random.Random(4)
    for name in "ab":
        rows = [{"id": f"{name}{i}", "t": rng.choice(["}{", 'q"', None]), "n": {"x": [i, {"y": "]"}]}} for i in range(25)]
        (tmp_path / f"{name}.json").write_text(" " + json.dumps(rows) + "\n")
    (tmp_path / "empty.json").write_text("[]")
    out = RD.read_records(spark, str(tmp_path), "id string, t string, n string", range_bytes=50)
    got = {(r.file.rsplit("/", 1)[-1], r.idx): (r.id, json.loads(r.n)) for r in out.collect()}
    assert got == {(f"{name}.json", i): (f"{name}{i}", {"x": [i, {"y": "]"}]}) for name in "ab" for i in range(25)}


def test_odd_files(spark, tmp_path):
    (tmp_path / "blank.json").write_text("")
    (tmp_path / "one.json").write_text("[ 5 ]")
    assert [(r.idx, r.value) for r in read_json_array(spark, str(tmp_path), "int").collect()] == [(0, 5)]
    (tmp_path / "object.json").write_text('{"a": [1, 2]}')
    with pytest.raises(ValueError, match="not a JSON array"):
        read_json_array(spark, str(tmp_path / "object.json"), "int")
