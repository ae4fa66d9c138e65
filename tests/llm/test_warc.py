import base64
import gzip
import hashlib
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import warc
from tessera.llm.warc import read_archive, records_of, write_archive

SCHEMA = "page_id long, url string, html string"


def some_pages(n=120, seed=0):
    rng = random.Random(seed)
    bodies = [f"<p>{rng.random()} {'é∂ ' * rng.randrange(40)}\r\n\r\nx</p>" for _ in range(60)]
    rows = [(i, f"http://h{i % 7}.example/{i}?q=a b\n", rng.choice(bodies)) for i in range(n)]
    rows += [(500, "http://x/", None), (501, None, ""), (None, None, "nobody's"), (None, "http://n/", rows[0][2]),
             (502, "http://x/", "big " * 50_000), (503, "http://x/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n")]
    return rows + rows[:4] + [(7, "http://other/", rows[7][2])]


def brute(rows, least=0):
    def key(r):
        return (r[0] is None, r[0] or 0, r[1] or "", r[1] is not None)

    out, seen = [], {}
    for r in sorted(rows, key=key):
        raw = (r[2] or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        old = raw in seen and len(raw) >= least
        out.append((r[0], len(raw), digest, "revisit" if old else "response", seen[raw] if old else None))
        seen.setdefault(raw, r[0])
    return sorted(out, key=repr)


def archive(spark, rows, tmp, parts=3, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return write_archive(df, f"file://{tmp}", **kw)


def back(spark, manifest, **kw):
    return sorted((tuple(r) for r in read_archive(spark, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def files(tmp):
    return {n: open(f"{tmp}/{n}", "rb").read() for n in sorted(os.listdir(tmp))}


@pytest.mark.parametrize("least", [0, 200])
def test_round_trip(spark, tmp_path, least):
    rows = some_pages()
    assert back(spark, archive(spark, rows, tmp_path, least=least)) == brute(rows, least)


def test_same_bytes_at_any_layout(spark, tmp_path, monkeypatch):
    rows = some_pages(300)
    monkeypatch.setattr(warc, "COPIES", 3)
    rows += [rows[20]] * 10 + [rows[3]] * 5
    small = {"roll": 2000, "shard_bytes": 9000}
    made = []
    for i, parts in enumerate((1, 5)):
        random.Random(i).shuffle(rows)
        m = archive(spark, rows, tmp_path / str(i), parts, **small)
        assert back(spark, m) == brute(rows)
        made.append(files(tmp_path / str(i)))
    assert made[0] == made[1]
    names = [n for n in made[0] if n.endswith(".gz")]
    assert len({n.split("-")[1] for n in names}) > 5 and len(names) > len({n.split("-")[1] for n in names})
    ids = []  # ranges follow the id, file by file
    for n in names:
        got = [f for f, _ in records_of(io.BytesIO(made[0][n])) if f["WARC-Type"] != "warcinfo"]
        ids += [int(f.get("Page-ID", -1)) for f in got]
        last = gzip.decompress(made[0][n])
        assert last.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and last.endswith(b"\r\n\r\n")
    assert ids == sorted(ids) and len(ids) == len(rows)


def test_payloads_and_links(spark, tmp_path):
    rows = some_pages(80)
    m = archive(spark, rows, tmp_path)
    got = {(r.page_id, bytes(r.payload).decode()) for r in read_archive(spark, m, payloads=True).collect() if r.payload is not None}
    assert {t for _, t in got} == {r[2] or "" for r in rows} and got <= {(r[0], r[2] or "") for r in rows}
    heads = [f for n, raw in files(tmp_path).items() if n.endswith(".gz") for f, _ in records_of(io.BytesIO(raw))]
    ids = [f["WARC-Record-ID"] for f in heads]
    assert len(set(ids)) == len(ids)
    by = {f["WARC-Record-ID"]: f for f in heads}
    for f in heads:
        if f["WARC-Type"] == "revisit":
            to = by[f["WARC-Refers-To"]]
            assert to["WARC-Type"] == "response" and to["WARC-Payload-Digest"] == f["WARC-Payload-Digest"]
        if "WARC-Target-URI" in f:
            assert not set(f["WARC-Target-URI"]) & set(" \r\n\t")


def test_damage_is_found(spark, tmp_path):
    rows = some_pages(20)
    m = archive(spark, rows, tmp_path)
    name = next(n for n in files(tmp_path) if n.endswith(".gz"))
    raw = gzip.decompress((tmp_path / name).read_bytes())
    (tmp_path / name).write_bytes(gzip.compress(raw.replace(b"<p>", b"<q>", 1)))
    with pytest.raises(Exception, match="digest"):
        read_archive(spark, m).collect()


def test_only_listed_files_count_and_commit_repeats(spark, tmp_path):
    rows = some_pages(20)
    work, folder = f"file://{tmp_path}/_temporary-x", f"file://{tmp_path}"
    os.makedirs(tmp_path / "_temporary-x")
    data = warc.member(warc.page_record(1, "http://a/", 5, 0, b"hello", None))
    (tmp_path / "_temporary-x" / "t1").write_bytes(data)
    (tmp_path / "_temporary-x" / "lost-attempt").write_bytes(b"half")
    listed = spark.createDataFrame([(0, 0, "a.warc.gz", "t1", len(data), 1, 1, 1, "")],
                                   "shard int, seq int, name string, temp string, bytes long, records long, first_id long, "
                                   "last_id long, sha1 string")
    for _ in range(2):
        m = warc.commit(listed, work, folder)
        assert back(spark, m) == [(1, 5, base64.b32encode(hashlib.sha1(b"hello").digest()).decode(), "response", None)]
    assert sorted(os.listdir(tmp_path)) == ["MANIFEST.json", "a.warc.gz"]


def test_reader_takes_any_piece_size():
    raw = b"".join(warc.member(warc.page_record(i, None, i, 0, b"x" * i * 50, None)) for i in range(20))
    for piece in (1, 7, 100, 1 << 20):
        got = list(records_of(io.BytesIO(raw), piece))
        assert [f["Page-ID"] for f, _ in got] == [str(i) for i in range(20)]
        assert all(b.endswith(b"\r\n\r\n" + b"x" * i * 50) for i, (_, b) in enumerate(got))


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert back(spark, archive(spark, [], tmp_path / "none")) == []
    df = spark.createDataFrame(some_pages(15), SCHEMA).selectExpr("*", "1 as page", "'x' as sha", "2 as at", "3 as `key`", "4 as n")
    got = back(spark, write_archive(df, f"file://{tmp_path}/wide"))
    assert got == brute(some_pages(15))
    assert df.where(F.lit(False)).count() == 0
