"""URL filters by a sort-merge range join.

A rule is a host and a path prefix. Its canonical key is the host with its
labels reversed, a separator, and the path, so that all keys which a rule
fits form one interval of the sorted keys. A URL is a point for each suffix of
its host (``a.b.com`` -> ``com``, ``com.b``, ``com.b.a``), because a rule fits
its host and all subdomains. Points and rules are dealt by ranges of the key;
a rule goes to each range that its interval meets. One sorted sweep a range
keeps a stack of the rules whose interval holds the current key: the rules on
the stack are nested prefixes of one another.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Boundary keys are drawn from at most this many points; they decide where
#: rows are dealt and never what comes out.
BOUNDARY_SAMPLE = 20_000
SEP = "\x00"


def _with_parts(df: DataFrame, url: str) -> DataFrame:
    """Add host and path: the host is what follows the first ``://`` up to
    ``/``, ``?``, ``#`` or the end with A-Z lower-cased; the path runs on to
    ``?``, ``#`` or the end. Null or no ``://``: both empty."""
    lower = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rest = F.when(F.instr(url, "://") > 0,
                  F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)"))
    return (df.withColumn("_rest", F.coalesce(rest, F.lit("")))
            .withColumn("host", F.translate(F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1), *lower))
            .withColumn("path", F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1))
            .drop("_rest"))


def _reversed_host(host):
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def _sweep(batches):
    """Points and rules come sorted by (range, key, kind), rules before points
    of the same key. Yields each point with every rule that holds it."""
    stack: list[tuple[str, str, str, int]] = []  # key, rule, verdict, length
    here = None
    for batch in batches:
        cols = batch.to_pydict()
        out = ([], [], [], [])
        for part, key, kind, ref, verdict, size in zip(*(cols[c] for c in (
                "_range", "_key", "_kind", "_ref", "_verdict", "_size"))):
            if part != here:
                stack, here = [], part
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, ref, verdict, size))
            elif stack:
                # longest rule on the stack; a block wins between equal rules
                best = max(stack, key=lambda r: (r[3], r[2] == "block", r[1]))
                for col, v in zip(out, (ref, best[1], best[2], best[3])):
                    col.append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
             pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())],
            names=["_ref", "rule", "verdict", "_size"])


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
               ranges: int | None = None) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and
    all subdomains if the URL's path starts with the rule's; the longest rule
    (characters of host and path) wins, between equally long ones a block.
    ``rule`` is host and path of the winner, null if none fits; ``verdict`` is
    then ``default``.

    Null URLs and URLs without ``://`` have empty host and path and fit no
    rule. Rules with a null part are ignored; repeated rules count once; no
    rules or no pages give no matches or no rows. Repeated pages are judged
    once and each keeps its row. Columns of ``pages`` named like one that is
    added are replaced.
    """
    spark = pages.sparkSession
    pages = _with_parts(pages.drop("host", "path", "rule", "verdict"), url)
    # a path is empty or starts with the slash that a host cannot hold, so the
    # two written together name one host and one path
    pages = pages.withColumn("_ref", F.concat("host", "path"))
    sites = pages.where("host <> ''").select("host", "path", "_ref").distinct()
    points = (sites.withColumn("_labels", F.reverse(F.split("host", r"\.", -1)))
              .withColumn("_n", F.explode(F.sequence(F.lit(1), F.size("_labels"))))
              .select(F.concat(F.array_join(F.slice("_labels", F.lit(1), F.col("_n")), "."),
                               F.lit(SEP), "path").alias("_key"), "_ref"))
    rules = (rules.select("host", "path", "verdict").dropna().distinct()
             .select(F.concat(_reversed_host(F.col("host")), F.lit(SEP), "path").alias("_key"),
                     F.concat("host", "path").alias("_ref"), F.col("verdict").alias("_verdict"),
                     (F.length("host") + F.length("path")).cast("long").alias("_size")))

    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    drawn = [r[0] for r in points.select("_key").orderBy(F.xxhash64("_ref", "_key")).limit(BOUNDARY_SAMPLE).collect()]
    drawn = sorted((k.encode() for k in drawn))
    edges = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []

    def first_range(key: str) -> int:
        return bisect_right(edges, key.encode())

    def last_range(key: str) -> int:
        # keys that start with this one end before its successor
        low = bisect_right(edges, key.encode())
        while low < len(edges) and edges[low].startswith(key.encode()):
            low += 1
        return low

    def deal_points(batches):
        for b in batches:
            keys = b.column(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([first_range(k) for k in keys.to_pylist()], pa.int32()), keys, b.column(1)],
                names=["_range", "_key", "_ref"])

    def deal_rules(batches):
        for b in batches:
            rows = [(r, *x) for x in zip(*(b.column(i).to_pylist() for i in range(4)))
                    for r in range(first_range(x[0]), last_range(x[0]) + 1)]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64()))],
                names=["_range", "_key", "_ref", "_verdict", "_size"])

    dealt = (rules.mapInArrow(deal_rules, "_range int, _key string, _ref string, _verdict string, _size long")
             .withColumn("_kind", F.lit(0))
             .unionByName(points.mapInArrow(deal_points, "_range int, _key string, _ref string")
                          .withColumn("_kind", F.lit(1)), allowMissingColumns=True))
    swept = (dealt.repartition(ranges, "_range")
             .sortWithinPartitions("_range", "_key", "_kind")
             .mapInArrow(_sweep, "_ref string, rule string, verdict string, _size long"))
    best = (swept.groupBy("_ref")
            .agg(F.max(F.struct("_size", F.col("verdict") == "block", "rule", "verdict")).alias("_best"))
            .select("_ref", "_best.rule", "_best.verdict"))
    return (pages.join(best, "_ref", "left").drop("_ref")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))
