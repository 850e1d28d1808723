"""Reading one large JSON document in many tasks.

A keypoint file is one document: an object whose arrays ``images`` and
``annotations`` hold millions of elements. Spark reads such a file in one
task. Here it is cut into blocks of bytes, and the elements that start in
a block are its task's work. Where a block starts in the document's structure
is found out without reading the file in order:

1. Each block is read under both assumptions, that it starts inside a string
   or outside of one, and reports whether it ends inside and by how much the
   nesting changes: four numbers a block.
2. Those are composed in the order of the blocks, which gives each block's
   true start: inside a string or not, and its depth.
3. Each block then reports the arrays that open directly under the root
   object within it, with their names: some rows a document.
4. Each block's task cuts out the elements of the wanted array that start in
   it, reading past its end for the last one, and Spark parses them.

Blocks are opened with pyarrow's file systems (local, HDFS, S3, GCS). The
document is UTF-8, whose bytes beyond ASCII never look like structure.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 16 << 20
#: A block's last element is read on in steps of this many bytes.
READ_ON = 1 << 16
QUOTE, BACKSLASH, OPEN, CLOSE = ord('"'), ord("\\"), (ord("{"), ord("[")), (ord("}"), ord("]"))


def _open(path: str):
    if "://" not in path and path.startswith("file:"):
        path = path[len("file:"):]
    if "://" in path or path.startswith("/"):
        system, name = pafs.FileSystem.from_uri(path)
        return system.open_input_file(name)
    return pafs.LocalFileSystem().open_input_file(path)


def _read(f, start: int, size: int) -> bytes:
    f.seek(start)
    return f.read(size)


def _escaped_start(f, start: int) -> bool:
    """Whether the byte at ``start`` follows an odd run of backslashes."""
    run, at = 0, start
    while at > 0:
        step = min(READ_ON, at)
        back = _read(f, at - step, step)
        here = len(back) - len(back.rstrip(b"\\"))
        run += here
        if here < step:
            break
        at -= step
    return run % 2 == 1


def _structure(data: bytes, escaped: bool):
    """Positions of the quotes that open or close a string, and of brackets."""
    b = np.frombuffer(data, np.uint8)
    slash = b == BACKSLASH
    quotes = np.flatnonzero(b == QUOTE)
    if slash.any() or escaped:
        # length of the run of backslashes that ends before each byte
        last_other = np.maximum.accumulate(np.where(~slash, np.arange(len(b)), -1))
        before = np.concatenate([[-1], last_other[:-1]]) if len(b) else last_other
        run = np.arange(len(b)) - 1 - before
        run = np.where((before < 0) & escaped, run + 1, run)
        quotes = quotes[run[quotes] % 2 == 0]
    change = np.isin(b, OPEN).astype(np.int8) - np.isin(b, CLOSE).astype(np.int8)
    return quotes, np.flatnonzero(change), change


def _outside(quotes: np.ndarray, places: np.ndarray, inside: bool) -> np.ndarray:
    """Which places lie outside of strings."""
    return (np.searchsorted(quotes, places) + inside) % 2 == 0


def _each(body, names_types):
    """A mapInArrow function over rows of blocks; ``body`` yields tuples."""
    schema = pa.schema(names_types)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                with _open(row["path"]) as f:
                    for item in body(f, row):
                        out.append(item)
                        if len(out) == 1000:
                            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, o)) for o in out], schema)
                            out = []
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, o)) for o in out], schema)
    return run


def _summary(f, row):
    data = _read(f, row["start"], row["size"])
    quotes, places, change = _structure(data, _escaped_start(f, row["start"]))
    nest = [int(change[places[_outside(quotes, places, inside)]].sum()) for inside in (False, True)]
    yield row["path"], row["start"], len(quotes) % 2 == 1, nest[0], nest[1]


def _arrays(f, row):
    """Arrays that open at depth 1 within the block: where, and their names."""
    data = _read(f, row["start"], row["size"])
    quotes, places, change = _structure(data, _escaped_start(f, row["start"]))
    places = places[_outside(quotes, places, row["inside"])]
    depth = row["depth"] + np.cumsum(change[places])
    for at in places[(change[places] > 0) & (depth == 2)].tolist():
        if data[at] == OPEN[1]:
            yield row["path"], row["start"] + at, _key_before(f, row["start"] + at)


def _key_before(f, at: int) -> str | None:
    """The name in ``"name": [`` that ends at the bracket."""
    size = 256
    while True:
        first = max(0, at - size)
        head = _read(f, first, at - first).rstrip()
        if head.endswith(b":"):
            head = head[:-1].rstrip()
            quotes, _, _ = _structure(head, first > 0 and _escaped_start(f, first))
            if len(quotes) >= 2:
                return json.loads(head[quotes[-2]:].decode())
        if first == 0:
            return None
        size *= 8


def _elements(f, row):
    """Objects of the wanted array that start in the block, as text."""
    start, size = row["start"], row["size"]
    data = _read(f, start, size)
    quotes, places, change = _structure(data, _escaped_start(f, start))
    places = places[_outside(quotes, places, row["inside"])]
    depth = row["depth"] + np.cumsum(change[places])
    opens = places[(change[places] > 0) & (depth == 3)]
    ends = places[(change[places] < 0) & (depth == 2)]
    spans = row["spans"]
    for at in opens.tolist():
        if data[at] != OPEN[0] or not any(s["first"] < start + at < s["last"] for s in spans):
            continue
        k = int(np.searchsorted(ends, at))
        yield row["path"], start + at, (data[at:int(ends[k]) + 1] if k < len(ends)
                                        else _read_on(f, start, data, at)).decode()


def _read_on(f, start: int, data: bytes, at: int) -> bytes:
    """An element that its block's end cuts: read on until it closes."""
    text, step = data[at:], READ_ON
    while True:
        quotes, places, change = _structure(text, False)
        places = places[_outside(quotes, places, False)]
        closed = np.flatnonzero(np.cumsum(change[places]) == 0)
        if len(closed):
            return text[:int(places[closed[0]]) + 1]
        more = _read(f, start + at + len(text), step)
        if not more:
            raise ValueError(f"the element at byte {start + at} never ends")
        text, step = text + more, step * 2


def _blocks(spark: SparkSession, path: str, block_bytes: int) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # contents stay unread
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(block_bytes).cast("long"))
    return (files.where("length > 0").select("path", "length", F.explode(starts).alias("start"))
            .withColumn("size", F.least(F.lit(block_bytes).cast("long"), F.col("length") - F.col("start"))))


def json_elements(spark: SparkSession, path: str, array: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The objects of the array ``array`` that lies directly in the document's
    root object: path, start (byte offset) and value (the object's text).

    Elements that are no objects are left out. A name that occurs twice counts
    twice. Empty files and documents without the array give no rows."""
    # one row a block; each row its own task, as a block is what a task reads
    blocks = _blocks(spark, path, block_bytes)
    n = max(1, min(blocks.count(), 100_000))
    spread = blocks.repartitionByRange(n, "path", "start")
    told = spread.mapInArrow(_each(_summary, [
        ("path", pa.string()), ("start", pa.int64()), ("flips", pa.bool_()), ("nest_out", pa.int64()), ("nest_in", pa.int64())]),
        "path string, start long, flips boolean, nest_out long, nest_in long")
    rows = {}
    for r in told.collect():  # five values a block
        rows.setdefault(r.path, []).append(r)
    state = []
    for name, parts in rows.items():
        inside, depth = False, 0
        for r in sorted(parts, key=lambda r: r.start):
            state.append((name, r.start, inside, depth))
            depth += r.nest_in if inside else r.nest_out
            inside ^= r.flips
        if inside or depth:
            raise ValueError(f"{name}: the document ends inside a string or at depth {depth}")
    known = spark.createDataFrame(state, "path string, start long, inside boolean, depth int")
    placed = blocks.join(known, ["path", "start"])
    opened = placed.repartitionByRange(n, "path", "start").mapInArrow(_each(_arrays, [
        ("path", pa.string()), ("at", pa.int64()), ("name", pa.string())]), "path string, at long, name string").collect()
    spans = {}
    for name in rows:  # the arrays directly under the root: a few a document
        mine = sorted((r.at, r.name) for r in opened if r.path == name)
        spans[name] = [{"first": at, "last": mine[i + 1][0] if i + 1 < len(mine) else 1 << 62}
                       for i, (at, key) in enumerate(mine) if key == array]
    wanted = spark.createDataFrame([(k, v) for k, v in spans.items() if v],
                                   "path string, spans array<struct<first: long, last: long>>")
    return (placed.join(wanted, "path").repartitionByRange(n, "path", "start")
            .mapInArrow(_each(_elements, [("path", pa.string()), ("start", pa.int64()), ("value", pa.string())]),
                        "path string, start long, value string"))


def read_json_array(spark: SparkSession, path: str, array: str, schema: T.StructType,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``json_elements`` parsed with ``schema``."""
    e = json_elements(spark, path, array, block_bytes)
    return e.select(F.from_json("value", schema).alias("e")).select("e.*")
