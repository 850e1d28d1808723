"""Sharding by a k-d tree over document metadata.

A node of the tree holds the documents that its ancestors' splits send to it,
and how many leaves it is to become. It is split along the metadata dimension
in which its documents spread widest, at the weighted median: the place where
the bytes on either side are in the ratio of the leaves on either side. All
nodes of a level are split by the same few jobs, and a job returns one row a
node: the driver holds one level of the tree, never documents. Rows carry
the node they are in; a level's splits are a table that is joined to them.

The weighted median is exact. Each dimension has a 64-bit code: the value
(24 bits, scaled between the least and the greatest of all rows), a hash of the text (16 bits), so that equal texts stay together
where they can, and a hash of the row (24 bits), so that a group of equal rows
of any size can still be cut. Four jobs a level narrow the median down by 16
bits each, from sums of bytes a node and bucket (65,536 buckets at most).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, gapless_rank, stored

#: Bits of a dimension's value.
VALUE_BITS = 24
STEP_BITS = 16
SENT_NODES = 200_000
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean")


@dataclass
class Split:
    """A node of the level at hand and where it is cut: codes of dimension
    ``dim`` up to ``at`` go left. ``first`` is the number of its first leaf."""

    first: int
    leaves: int
    dim: int = 0
    at: int = 0
    goal: float = 0.0
    before: int = 0

    @property
    def half(self) -> int:
        return self.leaves // 2


def _number(kind: str, name: str):
    """A metadata column as a double whose order is its own, or None where it
    has no distances (text and nested values). NaN counts as null."""
    col = F.col(name)
    if kind == "date":
        return F.unix_date(col).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    if kind in NUMBERS or kind.startswith("decimal"):
        v = col.cast("double")
        return F.when(~F.isnan(v), v)
    return None


def _values(docs: DataFrame, dims: list[str]):
    """24-bit order codes of the metadata columns, null first. Numbers, dates
    and times are scaled between the least and greatest finite value of all
    rows (infinities: at the ends); other kinds by a hash of their text."""
    kinds = dict(docs.dtypes)
    top = (1 << VALUE_BITS) - 1
    numbers = {i: n for i, d in enumerate(dims) if (n := _number(kinds[d], d)) is not None}
    ends = None
    if numbers:  # one row; halves, so that no difference overflows
        finite = {i: F.when(F.abs(n) < float("inf"), n / 2) for i, n in numbers.items()}
        ends = docs.agg(*(f(v).alias(f"{g}{i}") for i, v in finite.items() for g, f in (("lo", F.min), ("hi", F.max)))).first()
    out = []
    for i, d in enumerate(dims):
        if i in numbers:
            lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
            if lo is None or hi <= lo:
                code = F.when(numbers[i] == float("inf"), F.lit(top)).otherwise(F.lit(0))
            else:
                part = F.least(F.greatest((numbers[i] / 2 - lo) / (hi - lo), F.lit(0.0)), F.lit(1.0))
                code = F.when(numbers[i].isNotNull(), F.floor(part * (top - 1)) + 1)
        else:
            code = F.shiftright(F.crc32(F.col(d).cast("string").cast("binary")), 32 - VALUE_BITS)
        out.append(F.coalesce(code, F.lit(0)).cast("long"))
    return out


def _nodes(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A table of one row a node, some 60 bytes each: sent to the tasks up to
    ``SENT_NODES`` rows. Beyond, it is joined by shuffle, where so many nodes
    are keys enough to spread the rows."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= SENT_NODES else df


def _of_dim(dims: int):
    """The code of the dimension that a row's node is cut along."""
    return F.element_at(F.array(*(F.col(f"_c{d}") for d in range(dims))), F.col("_dim") + 1)


def _split_level(rows: DataFrame, level: list[Split], widths: list[int]) -> list[Split]:
    """Choose dimension and median of each node that is to be cut; nodes
    without rows are left out."""
    spark, dims = rows.sparkSession, len(widths)
    shift = 64 - 1 - VALUE_BITS  # codes are 63 bits, never negative
    asked = _nodes(spark, [(n.first,) for n in level], "_node long")
    spread = rows.join(asked, "_node").groupBy("_node").agg(
        F.sum("size").alias("total"),
        *(f(F.shiftright(f"_c{d}", shift)).alias(f"{g}{d}") for d in range(dims) for g, f in (("lo", F.min), ("hi", F.max))))
    by_first = {n.first: n for n in level}
    found = []
    for r in spread.collect():  # one row a node
        n = by_first[r["_node"]]
        n.dim = max(range(dims), key=lambda d: ((r[f"hi{d}"] - r[f"lo{d}"]) / max(1, widths[d]), -d))
        n.goal = r["total"] * n.half / n.leaves
        found.append(n)
    if not found:
        return []
    for low in (48, 32, 16, 0):
        state = _nodes(spark, [(n.first, n.dim, n.at, n.before, float(n.goal)) for n in found],
                       "_node long, _dim int, _at long, _before long, _goal double")
        code = _of_dim(dims)
        sums = (rows.join(state, "_node").where(F.shiftright(code, low + STEP_BITS) == F.col("_at") if low < 48 else F.lit(True))
                .groupBy("_node", "_before", "_goal", F.shiftright(code, low).alias("_bucket")).agg(F.sum("size").alias("bytes")))
        run = Window.partitionBy("_node").orderBy("_bucket")  # 65,536 buckets a node at most
        upto = sums.withColumn("upto", F.sum("bytes").over(run) + F.col("_before"))
        # the bucket in which the running sum reaches the goal, else the last
        hit = (upto.groupBy("_node").agg(
            F.min(F.when(F.col("upto") >= F.col("_goal"), F.struct("_bucket", "upto", "bytes"))).alias("hit"),
            F.max(F.struct("_bucket", "upto", "bytes")).alias("last"))
            .select("_node", F.coalesce("hit", "last").alias("b")).select("_node", "b.*"))
        for r in hit.collect():  # one row a node
            n = by_first[r["_node"]]
            n.at, n.before = r["_bucket"], r["upto"] - r["bytes"]
            # the row at the median goes to the side that leaves the smaller error
            if low == 0 and n.goal - n.before < r["upto"] - n.goal:
                n.at -= 1
    return found


def _coded(docs: DataFrame, dims: list[str], doc_id: str, text: str) -> DataFrame:
    """doc_id, size, text_crc32, a row number and one code a dimension."""
    body = F.col(text)
    base = docs.select(F.col(doc_id).alias("doc_id"),
                       (F.coalesce(F.octet_length(body), F.lit(0)) + 16).cast("long").alias("size"),
                       F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("_row"),
                       *(v.alias(f"_v{i}") for i, v in enumerate(_values(docs, dims))))
    twin = F.pmod(F.xxhash64("text_crc32", "size"), F.lit(1 << 16))
    own = F.pmod(F.xxhash64("doc_id", "_row"), F.lit(1 << 23))
    return base.select("doc_id", "size", "text_crc32", "_row", *(
        F.shiftleft(F.col(f"_v{i}"), 39).bitwiseOR(F.shiftleft(twin, 23)).bitwiseOR(own).alias(f"_c{i}")
        for i in range(len(dims))))


def kd_shards(docs: DataFrame, dims: list[str], shards: int | None = None, target_bytes: int | None = None,
              doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Put each document into one shard of about equal bytes.

    Either ``shards`` leaves, or as many as leaves of ``target_bytes`` need.
    Returns doc_id, size (UTF-8 bytes of the text, null none, plus 16),
    text_crc32 (null as empty), shard (from 0) and slot (gapless from 0 within
    the shard). Rows are returned as often as given; equal rows may share
    every code, so only they can stand between a shard and its target. Null
    and NaN metadata count as the least value, no rows give none, and other columns
    are ignored, so no name can clash."""
    # codes are written once: the levels below only compare them
    rows = stored(_coded(docs, dims, doc_id, text).withColumn("_node", F.lit(0).cast("long")), "kd-rows")
    shift = 64 - 1 - VALUE_BITS
    whole = rows.agg(F.sum("size").alias("size"), *((F.max(F.shiftright(f"_c{d}", shift)) - F.min(F.shiftright(f"_c{d}", shift))).alias(f"w{d}")
                                                    for d in range(len(dims)))).first()
    widths = [whole[f"w{d}"] or 0 for d in range(len(dims))]
    if shards is None:
        shards = max(1, round((whole["size"] or 0) / target_bytes))
    level = [Split(0, shards)] if shards > 1 else []
    while level:
        found = _split_level(rows, level, widths)
        if not found:
            break
        cuts = _nodes(docs.sparkSession, [(n.first, n.dim, n.at, n.first + n.half) for n in found],
                      "_node long, _dim int, _at long, _right long")
        goes = F.when(_of_dim(len(dims)) > F.col("_at"), F.col("_right")).otherwise(F.col("_node"))
        before, rows = rows, stored(rows.join(cuts, "_node", "left").withColumn("_node", goes)
                                    .drop("_dim", "_at", "_right"), "kd-rows")
        dropped(before)
        level = [m for n in found for m in (Split(n.first, n.half), Split(n.first + n.half, n.leaves - n.half)) if m.leaves > 1]
    placed = rows.select("doc_id", "size", "text_crc32", "_row", F.col("_node").cast("int").alias("shard"))
    return gapless_rank(placed, ["shard"], ["doc_id", "_row"], "slot").drop("_row")
