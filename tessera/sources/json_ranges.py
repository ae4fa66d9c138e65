"""JSON cut at record boundaries: objects written back to back, and one array read by many tasks.

Boundaries follow brackets outside strings, with escapes, at any nesting; a few
passes over the bytes find them.  An array file is read in byte ranges.  Where a
range lies in the array (inside a string, how deep, behind how many elements)
depends on everything before it, so a first pass sums each range up for both
cases of its first byte; the sums of a file, one row for each range, are chained
on the driver, and a second pass cuts out the elements that begin in each range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 64 << 20
_QUOTE, _ESCAPE, _COMMA = 34, 92, 44


def structure(buf: np.ndarray, inside: bool = False) -> tuple[np.ndarray, np.ndarray, bool]:
    """(places, depth steps, whether the end is inside a string): brackets and commas outside strings.

    ``inside``: the bytes begin inside a string.  The first byte is not escaped."""
    place = np.arange(len(buf))
    plain = np.maximum.accumulate(np.where(buf != _ESCAPE, place, -1))  # the last byte that is no backslash
    run = np.zeros(len(buf), np.int64)
    run[1:] = place[:-1] - plain[:-1]
    quotes = (buf == _QUOTE) & (run % 2 == 0)
    parity = (np.cumsum(quotes) + inside) % 2
    at = np.flatnonzero(np.isin(buf, np.frombuffer(b"{}[],", np.uint8)) & (parity == 0))
    step = np.select([np.isin(buf[at], [123, 91]), buf[at] == _COMMA], [1, 0], -1)
    return at, step, bool(parity[-1]) if len(buf) else inside


def objects_of(text: str) -> list[str]:
    """The values of a text of JSON objects or arrays one after another; what is between them is dropped."""
    raw = text.encode()
    at, step, _ = structure(np.frombuffer(raw, np.uint8))
    depth = np.cumsum(step)
    begin = at[(step == 1) & (depth == 1)]
    end = at[(step == -1) & (depth == 0)] + 1
    return [raw[a:b].decode() for a, b in zip(begin, end)]


def split_objects(col: Column) -> Column:
    """array<string> of the objects written back to back in a text."""
    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else objects_of(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    return run(col)


def _open(path: str):
    """Spark writes file:/x where others write file:///x."""
    fs, at = pafs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and path[5:7] != "//" else path)
    return fs.open_input_file(at)


def _bytes(f, a: int, b: int) -> np.ndarray:
    f.seek(a)
    return np.frombuffer(f.read(max(0, b - a)), np.uint8)


def _edge(f, at: int, size: int) -> int:
    """The first place from ``at`` on whose byte before is no backslash, so that it is not escaped."""
    while 0 < at < size:
        some = _bytes(f, at - 1, min(size, at + 4096))
        free = np.flatnonzero(some != _ESCAPE)
        if len(free):
            return at + int(free[0])
        at += len(some) - 1
    return min(at, size)


def _summary(buf: np.ndarray, inside: bool) -> dict:
    """Where a range leads to: end state, depth, and commas by depth (relative to its beginning)."""
    at, step, end = structure(buf, inside)
    depth = np.cumsum(step)
    level, count = np.unique(depth[buf[at] == _COMMA], return_counts=True)
    return {"inside": end, "depth": int(step.sum()), "commas": dict(zip(level.tolist(), count.tolist()))}


def json_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, start, stop): byte ranges of the files of ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.where("length > 0").select(F.col("path").alias("file"), "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start")).select(
        "file", "length", "start", F.least(F.col("start") + range_bytes, "length").alias("stop"))


def read_json_array(spark: SparkSession, path: str, schema: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, idx, value): the elements of every file's JSON array with their places in it.

    ``schema`` is the elements' type in DDL (``string``, ``struct<...>``).  Files
    that hold no array raise ValueError."""
    ranges = json_ranges(spark, path, range_bytes)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with _open(r["file"]) as f:
                    a, b = (_edge(f, r[c], r["length"]) for c in ("start", "stop"))
                    buf = _bytes(f, a, b)
                kept = buf[~np.isin(buf, np.frombuffer(b" \t\r\n\xef\xbb\xbf", np.uint8))]
                row = {"file": r["file"], "start": a, "stop": b, "head": int(kept[0]) if len(kept) else None}
                for name, inside in (("out", False), ("in", True)):
                    s = _summary(buf, inside)
                    row |= {f"{name}_end": s["inside"], f"{name}_depth": s["depth"], f"{name}_levels": list(s["commas"]),
                            f"{name}_counts": list(s["commas"].values())}
                yield pa.RecordBatch.from_pylist([row], schema=kind)

    half = [(f"{n}_{c}", t) for n in ("out", "in") for c, t in (
        ("end", pa.bool_()), ("depth", pa.int64()), ("levels", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())))]
    kind = pa.schema([("file", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("head", pa.int32()), *half])
    ddl = "file string, start long, stop long, head int, " + ", ".join(
        f"{n}_end boolean, {n}_depth long, {n}_levels array<long>, {n}_counts array<long>" for n in ("out", "in"))
    found = ranges.repartition("file", "start").mapInArrow(sums, ddl).collect()  # one row for each ``range_bytes``
    begun, headless = [], {}
    for r in sorted(found, key=lambda r: (r["file"], r["start"])):
        if r["file"] not in headless:
            inside, depth, index = False, 0, 0
            headless[r["file"]] = True
        if headless[r["file"]] and r["head"] is not None:
            if r["head"] != ord("["):
                raise ValueError(f"{r['file']}: not a JSON array")
            headless[r["file"]] = False
        if r["stop"] > r["start"]:
            begun.append((r["file"], r["start"], r["stop"], inside, depth, index))
        side = "in" if inside else "out"
        index += dict(zip(r[f"{side}_levels"], r[f"{side}_counts"])).get(1 - depth, 0)
        inside, depth = r[f"{side}_end"], depth + r[f"{side}_depth"]
    if not begun:
        return spark.createDataFrame([], f"file string, idx long, value {schema}")
    starts = spark.createDataFrame(begun, "file string, start long, stop long, inside boolean, depth long, idx long")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with _open(r["file"]) as f:
                    yield from cut(f, r, f.size())

    def marks(buf: np.ndarray, inside: bool, depth: int):
        """Places where elements end or begin, and the state behind."""
        at, step, end = structure(buf, inside)
        deep = depth + np.cumsum(step)
        pick = (step == 0) & (deep == 1) | (step == 1) & (deep == 1) & (buf[at] == 91) | (step == -1) & (deep == 0)
        return at[pick], step[pick], end, int(deep[-1]) if len(deep) else depth

    def cut(f, r: dict, size: int) -> Iterator[pa.RecordBatch]:
        buf = _bytes(f, r["start"], r["stop"])
        at, step, inside, depth = marks(buf, r["inside"], r["depth"])
        opens = np.flatnonzero(step >= 0)
        if not len(opens):
            return
        tail, stop = [], r["stop"]
        closed = opens[-1] + 1 < len(at)
        while not closed and stop < size:  # the last element ends in a later range
            to = _edge(f, min(size, stop + (1 << 20)), size)
            more = _bytes(f, stop, to)
            ends, _, inside, depth = marks(more, inside, depth)
            closed = bool(len(ends))
            tail.append(more[:ends[0]] if closed else more)
            stop = to
        raw = buf.tobytes()
        texts = []
        for n in opens:
            begin = int(at[n]) + 1
            texts.append(raw[begin:int(at[n + 1])] if n + 1 < len(at) else raw[begin:] + b"".join(x.tobytes() for x in tail))
        index = r["idx"] + np.cumsum(step[opens] == 0)
        rows = [(i, t.decode().strip()) for i, t in zip(index.tolist(), texts)]
        rows = [(i, t) for i, t in rows if t]  # an empty array has no element
        for k in range(0, len(rows), 10_000):
            part = rows[k:k + 10_000]
            yield pa.RecordBatch.from_pydict({"file": [r["file"]] * len(part), "idx": [i for i, _ in part], "json": [t for _, t in part]})

    cells = starts.repartition(len(begun), "file", "start").mapInArrow(elements, "file string, idx long, json string")
    return cells.select("file", "idx", F.from_json(F.concat(F.lit("["), "json", F.lit("]")), f"array<{schema}>")[0].alias("value"))
