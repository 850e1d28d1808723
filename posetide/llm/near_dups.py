"""MinHash near-duplicates by bottom-k sketches.

One hash function orders all three-word shingles; a document's sketch is its
least ``SKETCH`` hashes. The least ``LISTED`` of them are its entries in
inverted lists. Two sets with a likeness of 0.85 share, of the ``LISTED`` least
hashes of their union, all but a few: fewer than ``LEAST_SHARED`` with a
probability under 1e-8. So

* lists of up to ``LONG`` documents give all their pairs, with the number of
  lists that a pair shares (its overlap); a pair that shares fewer than the
  least number, after what longer lists could hide, is dropped;
* a document of which nearly the whole sketch lies in longer lists belongs to a
  large group of near copies. It is held against a few members (centres) of the
  shortest of its long lists, and what that links is one component. Only the
  members of long lists that still join different components go on (of each
  one's lists as many, shortest first, that two which share the least number
  meet in one of them: the prefix-filter bound). They are joined on the rarest
  shingles of their full sets, again as many as the likeness asks for. Pages of
  one template with words of their own have these in front, so they meet nobody.
* what is left are sets that are nearly all common shingles. They are held
  against each other in blocks, by clusters of components that share a list;
  only links come out, and the linked part of a large group takes no part.

Candidates pass an estimate from the sketch of the union and are confirmed on
the full sets. Documents with equal sets are one node from the start. Links
become components by alternating large-star and small-star steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from .common import U64, HASHES, dropped, mix, stored, text_bytes, windows

SHINGLE = 3
LIKENESS = 85  # per cent
SKETCH = 64
LISTED = 32
#: 27.2 expected, standard deviation 2.0
LEAST_SHARED = 15
#: 0.85 less six standard deviations of an estimate from 64 hashes
LEAST_ESTIMATE = 0.58
LONG = 100
CENTRES = 8
#: Sets on either side of a block.
BLOCK = 500
#: Up to so many rows (edges, pairs) are dealt to a task a core; beyond, Spark's
#: own exchanges deal them and split what is hot.
FEW_ROWS = 2_000_000


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted 63-bit hashes of the distinct shingles; fewer words than a
    shingle has are one, no words are none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    h = HASHES.of(words)
    runs = windows(h, SHINGLE) if len(h) >= SHINGLE else mix(windows(h, len(h)) + U64(len(h)))
    return np.unique(runs >> U64(1)).view(np.int64)


def _sketched(batches):
    for batch in batches:
        sizes, keys, sketches = [], [], []
        for t in text_bytes(batch.column("_text")):
            s = shingle_set(t)
            sizes.append(len(s))
            keys.append(xxh3_128_digest(s.tobytes()) if len(s) else None)
            sketches.append(s[:SKETCH])
        offsets = pa.array(np.cumsum([0, *map(len, sketches)]), pa.int32())
        values = pa.array(np.concatenate(sketches) if sketches else [], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("_row"), batch.column("_text_key"), pa.array(sizes, pa.int64()),
             pa.array(keys, pa.binary()), pa.ListArray.from_arrays(offsets, values)],
            names=["doc_id", "_row", "_text_key", "n_shingles", "_set", "_sketch"])


def _full_sets(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array([shingle_set(t).tobytes() for t in text_bytes(batch.column("_text"))], pa.binary())],
            names=["node", "full"])


def _confirmed(batches):
    """Pairs whose full sets reach the likeness."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("full_a").to_pylist(), batch.column("full_b").to_pylist()):
            a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= LIKENESS * (len(a) + len(b) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _few(df: DataFrame, rows: int) -> int | None:
    """Tasks for a small table, None to leave it to Spark."""
    spark = df.sparkSession
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-rows // 20_000)))
    return tasks if rows <= FEW_ROWS and tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _dealt(df: DataFrame, tasks: int | None, key: str) -> DataFrame:
    return df.repartition(tasks, key) if tasks else df


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the least node that each node of ``edges`` (a, b) reaches.

    Large-star hangs each node's larger neighbours on its least neighbour,
    small-star its smaller ones; repeated until nothing moves (a logarithmic
    number of rounds in practice), with each round in a stored table."""
    def both_ways(e):
        return e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def state(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(edges)
    while seen[0]:
        tasks = _few(edges, seen[0])
        near = _dealt(both_ways(edges), tasks, "a")
        least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # every edge now points from the larger to the smaller node
        large = _dealt(large.where("a <> b"), tasks, "a").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).where("a <> b")
        moved = stored(_dealt(small, tasks, "a").distinct(), "edges")
        now = state(moved)
        dropped(edges)
        edges = moved
        if now == seen:
            break
        seen = now
    return (edges.groupBy("a").agg(F.min("b").alias("comp")).select(F.col("a").alias("node"), "comp")
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()))


def _both(pairs: DataFrame, table: DataFrame, column: str, tasks: int | None) -> DataFrame:
    """Pairs (a, b, ...) with the ``column`` of both nodes, as ``column``_a and _b."""
    for side in ("a", "b"):
        mine = _dealt(table.select(F.col("node").alias(side), F.col(column).alias(f"{column}_{side}")), tasks, side)
        pairs = _dealt(pairs, tasks, side).join(mine, side)
    return pairs


def _near_enough(pairs: DataFrame, sketches: DataFrame, tasks: int | None = None) -> DataFrame:
    """Pairs (a, b, ...) whose union sketch estimates enough likeness."""
    a, b = F.col("_sketch_a"), F.col("_sketch_b")
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    estimate = F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union)
    return _both(pairs, sketches, "_sketch", tasks).where(estimate >= LEAST_ESTIMATE).drop("_sketch_a", "_sketch_b")


def _confirm(pairs: DataFrame, full: DataFrame, tasks: int | None = None) -> DataFrame:
    """Pairs (a, b), each given once, whose full sets are alike."""
    return _both(pairs.select("a", "b"), full, "full", tasks).mapInArrow(_confirmed, "a long, b long")


def _comparable(x: str, y: str):
    """Sizes whose ratio allows the likeness."""
    return (F.col(x) * 100 >= F.col(y) * LIKENESS) & (F.col(y) * 100 >= F.col(x) * LIKENESS)


def _shingles(batches):
    """(node, _c, n, v, k) of every shingle of a set; one that more than ``LONG``
    sets of a batch hold is common, and only counted (node null)."""
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column("full").to_pylist()]
        sizes = np.array([len(x) for x in sets], np.int64)
        values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        kinds, which, held = np.unique(values, return_inverse=True, return_counts=True)
        own = held[which] <= LONG
        common = held > LONG
        node, comp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "_c"))
        at = owner[own]
        more = pa.nulls(int(common.sum()), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(x[at], pa.int64()), more]) for x in (node, comp, sizes)]
            + [pa.array(np.r_[values[own], kinds[common]]), pa.array(np.r_[np.ones(len(at), np.int64), held[common]])],
            names=["node", "_c", "n", "v", "k"])


def _by_rare_shingles(open_: DataFrame, full: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, mostly): pairs (a, b) of sets (node, _c) of different components
    that share one of their rarest shingles, and the sets that are mostly common
    shingles (node, _c, _full_common), which alone can be alike without that.

    In one order of all shingles by how many sets hold them, two sets that share
    ``t`` meet in the first ``size - t + 1`` of each. A set's prefix that has only
    rare shingles (``LONG`` holders at most) needs no others."""
    tokens = stored(open_.join(full, "node").mapInArrow(_shingles, "node long, _c long, n long, v long, k long"), "shingles")
    held = stored(tokens.groupBy("v").agg(F.sum("k").alias("held"), F.min("node").alias("one")), "shingle-counts")
    alone = held.where("held = 1").groupBy(F.col("one").alias("node")).agg(F.count("*").alias("alone"))
    rare = tokens.where("node is not null").join(held.where(F.col("held").between(2, LONG)).select("v", "held"), "v")
    prefix = F.col("n") - F.ceil(F.col("n") * LIKENESS / 100) + 1
    place = F.row_number().over(Window.partitionBy("node").orderBy("held", "v"))
    some = F.count("*").over(Window.partitionBy("node"))
    rare = (rare.withColumn("_at", place).withColumn("rare", some).join(alone, "node", "left")
            .withColumn("alone", F.coalesce("alone", F.lit(0))))
    first = rare.where(F.col("_at") <= prefix - F.col("alone")).select("node", "_c", "n", "v")
    x, y = first.alias("x"), first.alias("y")
    pairs = (x.join(y, F.col("x.v") == F.col("y.v"))
             .where((F.col("x.node") < F.col("y.node")) & (F.col("x._c") != F.col("y._c")) & _comparable("x.n", "y.n"))
             .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct())
    sizes = open_.join(full.select("node", (F.octet_length("full") / 8).cast("long").alias("n")), "node")
    counted = (sizes.join(alone, "node", "left")
               .join(rare.groupBy("node").agg(F.first("rare").alias("rare")), "node", "left")
               .withColumn("common", F.col("n") - F.coalesce("alone", F.lit(0)) - F.coalesce("rare", F.lit(0))))
    # sets that share only common shingles: both hold 85 % of their own, the smaller one 2 * 85 / 185
    mostly = (counted.where(F.col("common") * 100 >= F.col("n") * LIKENESS)
              .select("node", "_c", (F.col("common") * (100 + LIKENESS) >= F.col("n") * 2 * LIKENESS).alias("_full_common")))
    return pairs, mostly


def _compared(batches):
    """Sets sorted by cluster, block of queries, block of all -> links between a
    query and any other set, one of the two full of common shingles: of those
    that a block finds, as many as join components that no link before joined."""
    def index(rows):
        sets = [np.frombuffer(r[3], np.int64) for r in rows]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        return values[order], owner[order], sizes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows])

    def links_of(rows):
        queries = [r for r in rows if r[0] == 0]
        others = [r for r in rows if r[0] == 1]
        if not queries or not others:
            return []
        every = index(others)
        full_common = [r for r in others if r[4]]
        some = index(full_common) if full_common else None
        out, root = [], {}

        def find(c):
            while (up := root.setdefault(c, c)) != c:
                root[c] = c = root[up]
            return c

        for _, node, comp, full, common in queries:
            if (against := every if common else some) is None:
                continue
            values, owner, sizes, names, comps = against
            own = np.frombuffer(full, np.int64)
            low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            n = high - low
            at = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(sizes))
            hit = (100 * both >= LIKENESS * (len(own) + sizes - both)) & (comps != comp)
            for x, other in zip(names[hit].tolist(), comps[hit].tolist()):
                if (mine := find(comp)) != (its := find(other)):
                    root[mine] = its
                    out.append((node, x))
        return out

    def batch_of(rows):
        a, b = zip(*rows) if rows else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    here, group = None, []
    for batch in batches:
        for c, i, j, *row in zip(*(batch.column(k).to_pylist() for k in ("_cluster", "_i", "_j", "_side", "node", "_c", "full", "_full_common"))):
            if (c, i, j) != here:
                yield batch_of(links_of(group))
                here, group = (c, i, j), []
            group.append(row)
    yield batch_of(links_of(group))


def _blocks(inside: DataFrame, full: DataFrame, tasks: int | None = None) -> DataFrame:
    """Links (a, b) in clusters (node, _c, _full_common, _cluster) that no
    component holds yet: each node outside its cluster's largest component
    against the nodes of the cluster, ``BLOCK`` against ``BLOCK`` sets a time."""
    inside = _dealt(inside, tasks, "_cluster")
    sizes = inside.groupBy("_cluster", "_c").agg(F.count("*").alias("k"), F.max("_full_common").alias("f"))
    sizes = (sizes.groupBy("_cluster").agg(F.max_by("_c", F.struct("k", "_c")).alias("_main"), F.sum("k").alias("_all"),
                                           F.max("k").alias("_most"), F.max("f").alias("_any"))
             .where("_all > _most and _any")
             .select("_cluster", "_main", F.ceil((F.col("_all") - F.col("_most")) / BLOCK).cast("int").alias("_is"),
                     F.ceil(F.col("_all") / BLOCK).cast("int").alias("_js")))
    sets = _dealt(inside.join(sizes, "_cluster"), tasks, "node").join(_dealt(full, tasks, "node"), "node")
    i, j = F.pmod(F.xxhash64("node"), F.col("_is")).cast("int"), F.pmod(F.xxhash64("node"), F.col("_js")).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["_cluster", "_i", "_j", "_side", "node", "_c", "full", "_full_common"]
    queries = sets.where("_c <> _main").withColumn("_i", i).withColumn("_j", each("_js")).withColumn("_side", F.lit(0))
    others = sets.withColumn("_j", j).withColumn("_i", each("_is")).withColumn("_side", F.lit(1))
    parts = tasks or int(inside.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (queries.select(*columns).unionByName(others.select(*columns))
            .repartition(parts, "_cluster", "_i", "_j").sortWithinPartitions("_cluster", "_i", "_j")
            .mapInArrow(_compared, "a long, b long"))


def _links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, comp) of the linked nodes. ``nodes``: stored node, n, _text_key,
    _sketch; ``docs``: _text_key, _text."""
    entries = nodes.select("node", "n", F.explode(F.slice("_sketch", 1, LISTED)).alias("v"))
    lists = entries.groupBy("v").agg(F.count("*").alias("held")).where("held > 1")
    entries = stored(entries.join(lists, "v"), "entries")
    short, long = entries.where(F.col("held") <= LONG), entries.where(F.col("held") > LONG)

    # what longer lists can hide of a node
    hidden = long.groupBy("node").agg(F.count("*").alias("hidden"))
    short = short.join(hidden, "node", "left").withColumn("hidden", F.coalesce("hidden", F.lit(0)))
    x, y = short.alias("x"), short.alias("y")
    shared = (x.join(y, F.col("x.v") == F.col("y.v"))
              .where((F.col("x.node") < F.col("y.node")) & _comparable("x.n", "y.n"))
              .groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
              .agg(F.count("*").alias("overlap"), F.min(F.least("x.hidden", "y.hidden")).alias("hidden"),
                   F.min(F.least("x.n", "y.n")).alias("n")))
    least = F.least(F.lit(LEAST_SHARED), F.ceil(F.col("n") / 2))  # a set under LISTED is its own sketch
    pairs = stored(shared.where(F.col("overlap") >= least - F.col("hidden")).select("a", "b", "overlap"), "pairs")

    # nodes that only long lists may link, by the shortest of their long lists:
    # those of a group are shorter than those of a passage that many groups share.
    # Two that share ``whole`` long lists meet, in one order of all lists, before
    # either has fewer than that left: no other list is needed to find a partner
    whole = F.least(F.lit(LEAST_SHARED), F.ceil(F.col("n") * 0.4)).cast("int")
    members = (long.join(hidden, "node").where(F.col("hidden") >= whole)
               .groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("held", "v"))).alias("_keys"))
               .withColumn("_keys", F.slice("_keys", F.lit(1), F.size("_keys") - whole + 1)))
    members = stored(members, "members")
    first = members.select("node", "n", F.col("_keys")[0]["v"].alias("v"))
    # the same few members of a list for everyone in it, drawn by hash
    some = (first.groupBy("v").agg(*(F.min_by(F.struct("node", "n"), F.xxhash64("node", F.lit(k))).alias(f"c{k}") for k in range(CENTRES)))
            .select("v", F.explode(F.array_distinct(F.array(*(f"c{k}" for k in range(CENTRES))))).alias("c"))
            .select("v", F.col("c.node").alias("a"), F.col("c.n").alias("_n")))
    stars = (first.join(some, "v").where((F.col("a") != F.col("node")) & _comparable("n", "_n"))
             .select("a", F.col("node").alias("b")))

    need = (pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(members.select("node")).distinct()
            .join(nodes.select("node", "_text_key"), "node"))
    full = stored(docs.join(need, "_text_key").groupBy("node").agg(F.any_value("_text").alias("_text"))
                  .mapInArrow(_full_sets, "node long, full binary"), "full-sets")

    # first the likeliest partner of each node, so that groups become components
    likely = (pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "overlap"))
              .groupBy("b").agg(F.max_by("a", F.struct("overlap", -F.col("a"))).alias("a")).select("a", "b"))
    first_tried = stored(likely.unionByName(stars).distinct(), "candidates")
    tasks = _few(first_tried, first_tried.count())
    links = stored(_confirm(_near_enough(first_tried, nodes, tasks), full, tasks), "links")
    comp = stored(components(links), "components")

    # then every candidate that is not inside a component yet
    def placed(df, node, name):
        c = comp.select(F.col("node").alias(node), F.col("comp").alias(name))
        return df.join(c, node, "left").withColumn(name, F.coalesce(name, node))

    rest = placed(placed(pairs.select("a", "b"), "a", "_ca"), "b", "_cb").where("_ca <> _cb").select("a", "b")
    ties = stored(placed(members.select("node", F.explode("_keys.v").alias("v")), "node", "_c"), "ties")
    # a list whose holders are one component by now joins nothing
    joins = ties.groupBy("v").agg(F.min("_c").alias("lo"), F.max("_c").alias("hi")).where("lo < hi").select("v")
    ties = stored(ties.join(joins, "v"), "ties")
    alike, mostly = _by_rare_shingles(ties.select("node", "_c").distinct(), full)
    mostly = stored(mostly, "common-sets")
    rest = stored(rest.unionByName(alike).distinct(), "candidates")
    tasks = _few(rest, rest.count())
    more = _confirm(_near_enough(rest, nodes, tasks), full, tasks)
    cluster = components(ties.join(mostly.select("node"), "node", "left_semi")
                         .select(F.col("_c").alias("a"), (-1 - F.col("v")).alias("b")).distinct())
    inside = mostly.join(cluster.select(F.col("node").alias("_c"), F.col("comp").alias("_cluster")), "_c")
    inside = stored(inside, "clusters")
    more = more.unionByName(_blocks(inside, full, _few(inside, BLOCK * inside.count())))
    links = stored(links.unionByName(more), "links")
    return components(links)


def _grouped(docs: DataFrame, doc_id: str, text: str):
    """(rows, sets): a row a document (doc_id, _row, _text_key, n_shingles,
    _set) and of each set its component (_set, _comp, component_id)."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_text_key"),
                         F.monotonically_increasing_id().alias("_row"))
    kind = dict(chosen.dtypes)["doc_id"]
    rows = stored(chosen.mapInArrow(_sketched, f"doc_id {kind}, _row long, _text_key string, n_shingles long, _set binary, _sketch array<long>"), "sketches")
    sets = rows.where("n_shingles > 0").groupBy("_set").agg(
        F.min("_row").alias("node"), F.min("doc_id").alias("_least"), F.min("_text_key").alias("_text_key"), F.min("n_shingles").alias("n"))
    sets = stored(sets, "sets")
    nodes = stored(sets.join(rows.select(F.col("_row").alias("node"), "_sketch"), "node").drop("_set", "_least"), "nodes")
    comp = _links(nodes, chosen.select("_text_key", "_text"))
    placed = sets.join(comp, "node", "left").select("_set", "_least", F.coalesce("comp", "node").alias("_comp"))
    least = placed.groupBy("_comp").agg(F.min("_least").alias("component_id"))
    return rows, placed.join(least, "_comp").select("_set", "_comp", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of documents whose sets of three-word shingles have a Jaccard
    likeness of at least 0.85, directly or over other documents.

    Returns doc_id, n_shingles, component_id (the smallest doc_id of the group)
    and kept (doc_id is component_id). Words are runs without ASCII white
    space, A-Z lower-cased; fewer than three are one shingle. Null, empty and
    blank texts have none and are linked with nothing. Repeated rows are one
    group; rows without doc_id are kept if their whole group has none. No
    documents give no rows; other columns are ignored."""
    rows, of_set = _grouped(docs, doc_id, text)
    out = rows.select("doc_id", "n_shingles", "_set").join(of_set.select("_set", "component_id"), "_set", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (out.withColumn("component_id", own)
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group of near_duplicates, of those it calls
    ``kept``; same columns. Documents are told apart by id and text together,
    so a null or repeated doc_id drops no text of another group; without words,
    one of each (id, text) stays."""
    rows, of_set = _grouped(docs, "doc_id", "text")
    key = lambda text: F.sha2(F.concat_ws("\x01", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text), 256)
    mine = F.col("doc_id").eqNullSafe(F.col("component_id"))
    led = (rows.join(of_set, "_set").where(mine).groupBy("_comp")
           .agg(F.min(key(F.col("_text_key"))).alias("_key")).select("_key"))
    kept = led.unionByName(rows.where("n_shingles = 0").select(key(F.col("_text_key")).alias("_key")).distinct())
    keyed = docs.withColumn("_key", key(F.md5(F.coalesce(F.col("text"), F.lit("")))))
    return keyed.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select(*docs.columns)
