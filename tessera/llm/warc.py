"""WARC archives: a deterministic sharded writer and its reader.

Writing:
1. A narrow pass gives every record its payload's SHA-1, length and a 64-bit
   hash.  Payloads that occur more than once get their first record (smallest
   key) by a grouped minimum, combined before the shuffle.
2. Records are range-sorted by (id, url and payload hash).  The range bounds are
   quantiles of a sample picked by hash, so that neither the input's layout nor
   the number of executors shows in the archives.  Rows repeated in full more
   than ``COPIES`` times travel as one row with a count, in parts of ``COPIES``:
   a hot row is neither shuffled nor sorted many times, and spreads over shards.
   Payloads cross the network once; who is a revisit comes as narrow rows dealt
   by the same ranges and is merged in the shard's sort order.
3. A shard's task writes one gzip member a record and rolls to a new file at
   ``roll`` compressed bytes.  Headers are made anew: lengths, payload and block
   digests from the bytes, record ids from key and digest, one fixed date.
   Files go to a temporary name of their own task attempt; an attempt that is
   lost or repeated leaves a file that no manifest names.
4. The tasks' file lists, stored, are the manifest.  Files are renamed from it
   (a step that can be repeated), and MANIFEST.json, written last under a
   temporary name and renamed, commits the archive.  Readers open listed files.

Reading deals the manifest's files to tasks, which inflate them in pieces, read
record after record, and check lengths and both digests.

Files are opened through Arrow's file systems by the folder's URI (file, hdfs,
s3, gs), in tasks and on the driver.

Defined cases: a null payload is empty; a null id stands before all others and
is no page to refer to if another exists; a null url becomes ``urn:page:`` and
the id, blanks and control characters in urls are escaped; repeated rows are
written as often as they stand there, the first of a payload as response; a
record is built in memory, so a payload may have up to 2 GB, Spark's limit for a
cell; an empty table makes an archive without files; other columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.base import forget, stored, table
from tessera.operators.common import with_row_index
from tessera.session import ensure_checkpoint_dir

COPIES = 256                 # of one row that travel as one
ROLL = 1 << 30               # compressed bytes of a file
SHARD_BYTES = 256 << 20      # payload bytes for each shard
SAMPLE = 64                  # sampled rows for each shard
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps(parts))}>"


def _target(url: str | None, page: int | None) -> str:
    return f"urn:page:{'' if page is None else page}" if url is None else urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%~")


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """Head, block and end of one record; the length comes from the block."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def page_record(page: int | None, url: str | None, key: int, copy: int, payload: bytes, first: dict | None) -> bytes:
    """A response, or a revisit of the record that ``first`` (page, url, key) names."""
    digest = base32_sha1(payload)
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if first else http + payload
    fields = [("WARC-Type", "revisit" if first else "response"), ("WARC-Record-ID", record_id(page, key, copy, digest)),
              ("WARC-Date", DATE), ("WARC-Target-URI", _target(url, page)), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Type", "application/http; msgtype=response")]
    if page is not None:
        fields.append(("Page-ID", str(page)))
    if first:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first["page"], first["key"], 0, digest)),
                   ("WARC-Refers-To-Target-URI", _target(first["url"], first["page"])), ("WARC-Refers-To-Date", DATE)]
        if first["page"] is not None:
            fields.append(("Refers-To-Page-ID", str(first["page"])))
    return warc_record(fields, block)


def member(raw: bytes) -> bytes:
    """One gzip member; no name and no time in its head."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _open(folder: str):
    return pafs.FileSystem.from_uri(folder)


def bounds(keys: DataFrame, shards: int) -> list[tuple[int, int, int]]:
    """shards - 1 upper bounds in (at, key, part) order; only they reach the driver, three numbers a shard.

    The sample is picked by the keys' hash, about ``SAMPLE`` rows a shard, and ranked in Spark."""
    if shards < 2:
        return []
    share = min(1.0, SAMPLE * shards / keys.count())
    mark = F.shiftrightunsigned(F.xxhash64("at", "key", "part"), 1) / F.lit(float(1 << 63))
    some = with_row_index(keys.select("at", "key", "part").where(mark <= share), ["at", "key", "part"], "nr")
    n = some.count()
    ends = some.where((F.col("nr") > 0) & (F.floor(F.col("nr") * shards / n) > F.floor((F.col("nr") - 1) * shards / n)))
    return sorted((r["at"], r["key"], r["part"]) for r in ends.collect()) if n else []


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  least: int = 0, roll: int = ROLL, shard_bytes: int = SHARD_BYTES, prefix: str = "pages") -> str:
    """Write ``pages`` below ``folder`` (new or empty) and return the manifest's path.

    Of records with equal payloads of at least ``least`` bytes all but the first are revisits.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = (pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"),
                         payload.alias("payload"))
            .withColumns({"sha": F.sha1(F.col("payload").cast("binary")), "x": F.xxhash64("payload"),
                          "n": F.octet_length("payload")})
            .withColumns({"at": F.coalesce("page", F.lit(-(1 << 63))), "key": F.xxhash64("url", "sha", "x")}))
    same = ["at", "page", "url", "key", "sha", "n"]
    keys = rows.groupBy(*same, "x").agg(F.count(F.lit(1)).alias("copies"))
    keys = stored(keys.select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.col("copies") / COPIES).cast("int") - 1)).alias("part"))
                  .withColumn("here", F.least(F.col("copies") - F.col("part") * COPIES, F.lit(COPIES)).cast("int")))
    total = keys.agg(F.sum(F.col("n").cast("decimal(38,0)") * F.col("here"))).first()[0] or 0
    ends = bounds(keys, max(1, -(-int(total) // shard_bytes)))
    # a payload's first record: a null id only where there is no other
    order = F.struct(F.col("page").isNull().alias("none"), "page", F.coalesce("url", F.lit("")).alias("u"), "url", "key")
    first = (keys.groupBy("sha", "n", "x").agg(F.min(order).alias("f"), F.sum("here").alias("all"))
             .where((F.col("all") > 1) & (F.col("n") >= least))
             .select("sha", "n", "x", F.col("f.page").alias("first_page"), F.col("f.url").alias("first_url"),
                     F.col("f.key").alias("first_key")))
    told = (keys.join(first, ["sha", "n", "x"], "left")
            .select("at", "key", "part", "here", "page", "url", F.col("first_key").isNotNull().alias("has_first"),
                    "first_page", "first_url", "first_key", F.lit(None).cast("string").alias("payload")))
    # payloads once for each key and part: repeated rows are dropped where they are many
    many = keys.where("copies > 1").select("at", "key").distinct()
    plain = rows.select("at", "key", "payload")
    if many.isEmpty():
        texts = plain.withColumn("part", F.lit(0))
    else:
        copied = (plain.join(many, ["at", "key"], "left_semi").groupBy("at", "key").agg(F.min("payload").alias("payload"))
                  .join(keys.select("at", "key", "part"), ["at", "key"]))
        texts = plain.join(many, ["at", "key"], "left_anti").withColumn("part", F.lit(0)).unionByName(copied)
    dealt = told.unionByName(texts, allowMissingColumns=True).withColumn("kind", F.col("payload").isNotNull())
    edges = pages.sparkSession.sparkContext.broadcast(ends)

    @F.pandas_udf("int")
    def shard(at: pd.Series, key: pd.Series, part: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(edges.value, x) for x in zip(at.tolist(), key.tolist(), part.tolist())], dtype="int32")

    if ends:
        dealt = dealt.withColumn("shard", shard("at", "key", "part"))
    else:
        dealt = dealt.withColumn("shard", F.lit(0))
    work = f"{folder.rstrip('/')}/_temporary-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(work)
        fs.create_dir(path)
        out, made, now, info = None, [], None, None

        def close():
            nonlocal out
            if out is not None:
                out["file"].close()
                made.append({k: v for k, v in out.items() if k not in ("file", "hash")} | {"sha1": out["hash"].hexdigest()})
                out = None

        def put(raw: bytes, s: int, at: int):
            nonlocal out
            if out is not None and (out["shard"] != s or out["bytes"] >= roll):
                seq = out["seq"] + 1 if out["shard"] == s else 0
                close()
            elif out is None:
                seq = 0
            if out is None:
                name = f"{prefix}-{s:06d}-{seq:05d}.warc.gz"
                temp = f"{name}.{uuid.uuid4().hex}"
                out = {"shard": s, "seq": seq, "name": name, "temp": temp, "bytes": 0, "records": 0, "first_id": at,
                       "file": fs.open_output_stream(f"{path}/{temp}", compression=None), "hash": hashlib.sha1()}
                head = warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(name)), ("WARC-Date", DATE),
                                    ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                                   b"format: WARC File Format 1.1\r\n")
                emit(member(head))
            emit(member(raw))
            out["records"] += 1
            out["last_id"] = at

        def emit(data: bytes):
            out["file"].write(data)
            out["hash"].update(data)
            out["bytes"] += len(data)

        for batch in batches:
            for r in batch.to_pylist():
                if r["payload"] is None:
                    info = r
                    continue
                if info is None or (info["at"], info["key"], info["part"]) != (r["at"], r["key"], r["part"]):
                    raise ValueError(f"no key row for page {r['at']}")
                payload, page, key = r["payload"].encode(), info["page"], info["key"]
                prime = (info["has_first"] and {"page": info["first_page"], "url": info["first_url"], "key": info["first_key"]})
                for j in range(info["here"]):
                    copy = info["part"] * COPIES + j
                    own = prime and (prime["page"], prime["key"], 0) == (page, key, copy)
                    put(page_record(page, info["url"], key, copy, payload, None if own or not prime else prime),
                        r["shard"], r["at"])
        close()
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=listed)

    listed = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("temp", pa.string()),
                        ("bytes", pa.int64()), ("records", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()),
                        ("sha1", pa.string())])
    ddl = "shard int, seq int, name string, temp string, bytes long, records long, first_id long, last_id long, sha1 string"
    files = stored(dealt.repartition(len(ends) + 1, "shard").sortWithinPartitions("shard", "at", "key", "part", "kind")
                   .mapInArrow(write, ddl))
    forget(keys)
    return commit(files, work, folder)


def commit(files: DataFrame, work: str, folder: str) -> str:
    """Rename the listed files and write MANIFEST.json; may be repeated after a failure."""
    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, source = _open(work)
        _, target = _open(folder)
        for batch in batches:
            for r in batch.to_pylist():
                at, to = f"{source}/{r['temp']}", f"{target}/{r['name']}"
                if fs.get_file_info(at).type != pafs.FileType.NotFound:
                    fs.move(at, to)
                if fs.get_file_info(to).size != r["bytes"]:
                    raise OSError(f"{to}: not the file of the manifest")
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    files.select("name", "temp", "bytes").mapInArrow(rename, "n long").agg(F.sum("n")).collect()
    fs, target = _open(folder)
    fs.create_dir(target)
    rows = files.orderBy("name").drop("temp").collect()  # one row for each GB of archive
    temp = f"{target}/MANIFEST.json.{uuid.uuid4().hex}"
    with fs.open_output_stream(temp) as f:
        f.write("".join(json.dumps(r.asDict()) + "\n" for r in rows).encode())
    fs.move(temp, f"{target}/MANIFEST.json")
    at = _open(work)[1]
    if fs.get_file_info(at).type == pafs.FileType.Directory:
        fs.delete_dir(at)  # what lost or repeated attempts left
    forget(files)
    return f"{folder.rstrip('/')}/MANIFEST.json"


def records_of(stream, piece: int = 1 << 20) -> Iterator[tuple[dict, bytes]]:
    """(fields, block) of every record of a gzipped archive, read in pieces."""
    data, z, end = bytearray(), zlib.decompressobj(31), False

    def more() -> bool:
        nonlocal z, end
        raw = stream.read(piece)
        end = not raw
        while raw:
            data.extend(z.decompress(raw))
            raw = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)
        return not end

    while True:
        while (cut := data.find(b"\r\n\r\n")) < 0 and more():
            pass
        if cut < 0:
            if data.strip():
                raise ValueError("a record without head")
            return
        lines = data[:cut].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        stop = cut + 4 + int(fields["Content-Length"])
        while len(data) < stop + 4 and more():
            pass
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"{fields.get('WARC-Record-ID')}: length and record end differ")
        block = bytes(data[cut + 4:stop])
        del data[:stop + 4]
        yield fields, block


def read_archive(spark: SparkSession, manifest: str, payloads: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, file (and the payload of responses)."""
    folder = manifest.rsplit("/", 1)[0]
    fs, path = _open(manifest)
    with fs.open_input_stream(path) as f:
        files = [json.loads(x) for x in f.read().decode().splitlines()]
    ddl = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, "
           "file string" + (", payload binary" if payloads else ""))
    if not files:
        return spark.createDataFrame([], ddl)
    names = spark.createDataFrame([(f["name"], f["records"]) for f in files], "name string, records long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, source = _open(folder)
        for batch in batches:
            for name, want in zip(*(c.to_pylist() for c in batch.columns)):
                out, size, seen = [], 0, 0
                with fs.open_input_stream(f"{source}/{name}", compression=None) as stream:
                    for fields, block in records_of(stream):
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        seen += 1
                        if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                            raise ValueError(f"{name}: block digest of {fields['WARC-Record-ID']}")
                        http, payload = block.split(b"\r\n\r\n", 1)
                        n = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and (len(payload) != n or base32_sha1(payload) != digest):
                            raise ValueError(f"{name}: payload of {fields['WARC-Record-ID']}")
                        page, to = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                        row = {"page_id": page and int(page), "payload_bytes": n, "payload_digest": digest, "record_type": kind,
                               "refers_to": to and int(to), "url": fields["WARC-Target-URI"], "file": name}
                        if payloads:
                            row["payload"] = payload if kind == "response" else None
                            size += len(payload)
                        out.append(row)
                        if len(out) >= 10_000 or size > 16 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema=schema)
                            out, size = [], 0
                if seen != want:
                    raise ValueError(f"{name}: {seen} records, not {want}")
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("file", pa.string()),
                        *([("payload", pa.binary())] if payloads else [])])
    return names.repartition(len(files), "name").mapInArrow(read, ddl)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as an archive below spark.checkpoint.dir and read back."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    manifest = write_archive(table(spark, sf_dir, "pages"), folder)
    return read_archive(spark, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op13_warc": op13_warc}
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(bits, {1 + 5 * i}, 5))::INT, 1)"
                      for i in range(32))
ORACLE_SQL = {"op13_warc": f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, sha1(html) AS sha FROM p),
b AS (SELECT page_id, url, html, array_to_string([bin(('0x' || substr(sha, i, 1))::INT + 16)[2:] FOR i IN range(1, 41)], '')
        AS bits FROM h),
f AS (SELECT *, first_value(page_id) OVER w AS head, row_number() OVER w AS nr FROM b
      WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST, coalesce(url, ''), url))
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN nr = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN nr > 1 THEN head END AS refers_to FROM f"""}
