"""Suppression and similarity.

Design for scale. Greedy NMS is order dependent, but only overlapping boxes
interact. So instead of collecting every box of an image into one task:

1. Candidate pairs come from a spatial grid join: every box is exploded to
   the grid cells it covers and joined on (key, cell). A pair is emitted
   only in the cell that holds the top-left corner of the two boxes'
   intersection, so each overlapping pair appears exactly once and boxes
   that do not overlap never meet. A hot image spreads over its cells.
   Suppression uses a grid of several levels, one for each power of two of
   width and height: boxes of very different size cannot suppress one
   another, so a pair meets only on a level near both of its sizes. Cells
   that hold many boxes are thinned before any pair is formed.
2. Exact copies (same key and coordinates) are collapsed first with a
   partial aggregate: only the first copy in greedy order can survive.
3. The greedy decision is resolved round by round on the pair graph: a box
   with no live predecessor is kept, its successors are suppressed, edges
   from suppressed boxes drop out. Rounds equal the longest suppression
   chain, each round is a few joins on shrinking tables, and lineage is cut
   through the reliable checkpoint folder after every round.

The greedy order is score descending, then id ascending (a total order; the
reference's unstable argsort leaves ties undefined).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from posetide.functions.boxes import iou
from posetide.schema import OKS_SIGMAS
from posetide.session import cut_lineage


def greedy_score(score: Column) -> Column:
    """Score as the greedy order takes it, on every path: null and NaN come
    last, and tie with one another."""
    score = score.cast("double")
    return F.when(score.isNull() | F.isnan(score), F.lit(float("-inf"))).otherwise(score)


def _regular(pad: float) -> Column:
    """Whether a box has four numbers and some extent; any other box overlaps
    nothing, so it neither suppresses nor is suppressed."""
    ok = F.lit(True)
    for c in ("x1", "y1", "x2", "y2"):
        v = F.col(c).cast("double")
        ok = ok & v.isNotNull() & ~F.isnan(v)
    return F.coalesce(ok & (F.col("x2") - F.col("x1") + pad > 0) & (F.col("y2") - F.col("y1") + pad > 0), F.lit(False))


def _before(a_score: Column, a_id: Column, b_score: Column, b_id: Column) -> Column:
    return (a_score > b_score) | ((a_score == b_score) & (a_id < b_id))


def resolve_greedy(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Greedy maximal independent set in a fixed order.

    nodes: (key, id); edges: (key, src, dst) where src precedes dst and src
    suppresses dst if src is kept. Returns (key, id) of kept nodes.

    Only the edges go through the rounds: a source that no live edge enters is
    kept, what it points at is dropped, edges of dropped nodes go. The nodes
    are read once, at the end, to leave out the dropped ones."""
    live = cut_lineage(edges.select(key, "src", "dst"))
    kept = nodes.select(key, "id").distinct()
    dropped: list[DataFrame] = []
    while not live.isEmpty():
        entered = live.select(key, F.col("dst").alias("src"))
        first = live.select(key, "src").join(entered, [key, "src"], "left_anti").distinct()
        gone = cut_lineage(live.join(first, [key, "src"], "left_semi").select(key, F.col("dst").alias("id")).distinct())
        dropped.append(gone)
        live = cut_lineage(live.join(gone.withColumnRenamed("id", "src"), [key, "src"], "left_anti")
                           .join(gone.withColumnRenamed("id", "dst"), [key, "dst"], "left_anti"))
    if not dropped:
        return kept
    out = dropped[0]
    for p in dropped[1:]:
        out = out.unionByName(p)
    return kept.join(out, [key, "id"], "left_anti")


def _grid_cells(df: DataFrame, cell: float, pad: float) -> DataFrame:
    """Explode boxes to the grid cells their (padded) extent covers."""
    cx0 = F.floor(F.col("x1") / cell)
    cx1 = F.greatest(cx0, F.floor((F.col("x2") + pad) / cell))
    cy0 = F.floor(F.col("y1") / cell)
    cy1 = F.greatest(cy0, F.floor((F.col("y2") + pad) / cell))
    return (df.withColumn("cx", F.explode(F.sequence(cx0, cx1)))
              .withColumn("cy", F.explode(F.sequence(cy0, cy1))))


def overlap_pairs(boxes: DataFrame, key: str = "image_id", id_col: str = "det_id",
                  plus_one: bool = False, cell: float = 64.0) -> DataFrame:
    """Every pair of boxes of the same key that overlap, once, with IoU.

    Output: key, id_a, id_b (id_a < id_b), iou. Pairs that do not touch are
    never formed (grid join), so the cost follows overlaps, not key size."""
    pad = 1.0 if plus_one else 0.0
    b = boxes.select(F.col(key).alias("k"), F.col(id_col).alias("id"),
                     *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    cells = _grid_cells(b, cell, pad)
    a_ = cells.select(*[F.col(c).alias(f"a_{c}") for c in cells.columns])
    b_ = cells.select(*[F.col(c).alias(f"b_{c}") for c in cells.columns])
    j = a_.join(b_, (F.col("a_k") == F.col("b_k")) & (F.col("a_cx") == F.col("b_cx"))
                & (F.col("a_cy") == F.col("b_cy")) & (F.col("a_id") < F.col("b_id")))
    corner_x = F.floor(F.greatest("a_x1", "b_x1") / cell)
    corner_y = F.floor(F.greatest("a_y1", "b_y1") / cell)
    A = {c: F.col(f"a_{c}") for c in ("x1", "y1", "x2", "y2")}
    B = {c: F.col(f"b_{c}") for c in ("x1", "y1", "x2", "y2")}
    iw = F.least(A["x2"], B["x2"]) - F.greatest(A["x1"], B["x1"]) + pad
    ih = F.least(A["y2"], B["y2"]) - F.greatest(A["y1"], B["y1"]) + pad
    return (j.where((F.col("a_cx") == corner_x) & (F.col("a_cy") == corner_y) & (iw > 0) & (ih > 0))
             .select(F.col("a_k").alias(key), F.col("a_id").alias("id_a"), F.col("b_id").alias("id_b"),
                     iou(A, B, plus_one).alias("iou")))


def _collapse_copies(boxes: DataFrame, key: str, id_col: str, score_col: str):
    """Exact copies: only the first copy in greedy order can be kept (IoU of a
    copy with its leader is 1). Partial aggregation keeps hot copy groups
    cheap. Returns (leaders, followers) as (key, id) frames."""
    coords = ["x1", "y1", "x2", "y2"]
    leaders = (boxes.groupBy(key, *coords)
               .agg(F.min(F.struct((-F.col(score_col)).alias("ns"), F.col(id_col).alias("id"))).alias("m"))
               .select(key, *coords, F.col("m.id").alias("leader_id")))
    tagged = boxes.join(leaders, [key, *coords])
    return tagged



def _axis_level(side: Column) -> Column:
    """Level of a side: the least n >= 0 with side <= 2^n, from the bits of
    a whole number, so that powers of two fall on the right side."""
    below = F.greatest(F.ceil(side), F.lit(1)).cast("long") - 1
    return F.when(below <= 0, F.lit(0)).otherwise(F.length(F.bin(below))).cast("int")


def level_reach(thr: float) -> int:
    """How many levels apart two boxes of IoU ``thr`` or more can be. The IoU
    is at most the ratio of their sides along either axis, which n levels
    apart is below 2^(1 - n)."""
    return math.floor(1 + math.log2(1 / thr))


def level_cells(boxes: DataFrame, reach: int, pad: float) -> DataFrame:
    """The cells a box touches on its own level of width and height and on the
    ``reach`` levels above: columns lx, ly (own levels), mx, my (the cell's
    levels), cx, cy. On each level a box touches at most two cells along an
    axis, because no cell is smaller than the box."""
    out = (boxes.withColumn("lx", _axis_level(F.col("x2") - F.col("x1") + pad))
           .withColumn("ly", _axis_level(F.col("y2") - F.col("y1") + pad)))
    for axis, lo, hi in (("x", "x1", "x2"), ("y", "y1", "y2")):
        out = out.withColumn(f"m{axis}", F.explode(F.sequence(F.col(f"l{axis}"), F.col(f"l{axis}") + reach)))
        size = F.pow(F.lit(2.0), F.col(f"m{axis}"))
        first = F.floor(F.col(lo) / size)
        out = out.withColumn(f"c{axis}", F.explode(F.sequence(first, F.greatest(first, F.floor((F.col(hi) + pad) / size)))))
    return out


def _suppressing_pairs(cand: DataFrame, reach: int, pad: float, hit) -> DataFrame:
    """Every pair that ``hit`` accepts, once, from the level grid. cand: k, id,
    score, x1, y1, x2, y2. A pair meets on the greater of its levels along
    each axis, in the cell of its intersection's corner. Returns k, src, dst
    in greedy order."""
    cells = level_cells(cand, reach, pad)
    a = cells.select(*[F.col(c).alias(f"a_{c}") for c in cells.columns])
    b = cells.select(*[F.col(c).alias(f"b_{c}") for c in cells.columns])
    j = a.join(b, [F.col(f"a_{c}") == F.col(f"b_{c}") for c in ("k", "mx", "my", "cx", "cy")]
               + [_before(F.col("a_score"), F.col("a_id"), F.col("b_score"), F.col("b_id"))])
    here = F.lit(True)
    for axis, lo in (("x", "x1"), ("y", "y1")):
        level = F.greatest(f"a_l{axis}", f"b_l{axis}")
        corner = F.floor(F.greatest(f"a_{lo}", f"b_{lo}") / F.pow(F.lit(2.0), level))
        here = here & (F.col(f"a_m{axis}") == level) & (F.col(f"a_c{axis}") == corner)
    A = {c: F.col(f"a_{c}") for c in ("x1", "y1", "x2", "y2")}
    B = {c: F.col(f"b_{c}") for c in ("x1", "y1", "x2", "y2")}
    return (j.where(here & hit(A, B))
            .select(F.col("a_k").alias("k"), F.col("a_id").alias("src"), F.col("b_id").alias("dst")))


def _thin_dense_cells(cand: DataFrame, reach: int, pad: float, hit, limit: int):
    """Settle boxes until no cell of the level grid holds more than ``limit``.

    A box that comes first in every cell it touches has no open box before it
    that could suppress it: it is kept, and what it suppresses goes. Only kept
    boxes meet others here, so the cost of a round follows the boxes and not
    their pairs. Boxes of one cell that do not suppress one another are
    bounded by geometry (like sizes in one place), and the first open box of a
    key always qualifies, so the rounds end. Exact: kept and dropped are what
    the greedy walk keeps and drops. Returns (kept ids, open boxes)."""
    spot = ["k", "mx", "my", "cx", "cy"]
    kept = []
    while True:
        cells = level_cells(cand, reach, pad)
        order = F.struct((-F.col("score")).alias("ns"), "id")
        tops = cut_lineage(cells.groupBy(*spot).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("top")))
        crowded = tops.where(F.col("n") > limit)
        if crowded.isEmpty():
            return kept, cand
        # first in all of its cells: as many cells name it as it touches
        touched = (_axis_cells("x", "x1", "x2", reach, pad) * _axis_cells("y", "y1", "y2", reach, pad))
        named = tops.groupBy("k", F.col("top.id").alias("id")).agg(F.count(F.lit(1)).alias("named"))
        sure = cut_lineage(cand.withColumn("touched", touched).join(named, ["k", "id"])
                           .where(F.col("named") == F.col("touched")).drop("named", "touched"))
        kept.append(sure.select("k", "id"))
        a = level_cells(sure, reach, pad)
        a = a.select(*spot, *[F.col(c).alias(f"a_{c}") for c in ("id", "x1", "y1", "x2", "y2")])
        A = {c: F.col(f"a_{c}") for c in ("x1", "y1", "x2", "y2")}
        B = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}
        gone = (cells.join(a, spot).where(hit(A, B) | (F.col("id") == F.col("a_id")))
                .select("k", "id").distinct())
        cand = cut_lineage(cand.join(gone, ["k", "id"], "left_anti"))


def _axis_cells(axis: str, lo: str, hi: str, reach: int, pad: float) -> Column:
    """How many cells along one axis a box touches on all its levels."""
    level, total = _axis_level(F.col(hi) - F.col(lo) + pad), F.lit(0).cast("long")
    for up in range(reach + 1):
        size = F.pow(F.lit(2.0), level + up)
        first = F.floor(F.col(lo) / size)
        total = total + F.greatest(first, F.floor((F.col(hi) + pad) / size)) - first + 1
    return total


DENSE_CELL = 512  # cells with more boxes are thinned before pairs are formed
MIN_LEVEL_THR = 1 / 64  # below, too many levels could hold a pair

SMALL_GROUP = 256  # keys with at most this many candidates fold in one pass


def split_by_group_size(df: DataFrame, key: str, cap: int = SMALL_GROUP):
    """Split rows into bounded groups (folded in one pass) and large groups
    (distributed pair-graph path); both exact.

    Only the set of large keys is computed (a partial aggregate: one row
    per key) and cut from the lineage. When it is empty — the usual case —
    the input is returned as is with no join. Returns (small, big or None)."""
    big_keys = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
                           .where(F.col("_n") > cap).select(key))
    if big_keys.isEmpty():
        return df, None
    return df.join(big_keys, key, "left_anti"), df.join(big_keys, key, "left_semi")


def _fold_greedy(small: DataFrame, key: str, id_col: str, score_col: str, fields: list[str], suppresses) -> DataFrame:
    """Greedy NMS of bounded groups: sort each group's candidates by
    (score desc, id) and fold, keeping a candidate unless a kept one
    suppresses it. ``suppresses(kept, cand)`` builds the boolean Column."""
    item = F.struct((-F.col(score_col)).alias("ns"), F.col(id_col).alias("id"), *[F.col(f) for f in fields])
    g = small.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("bs"))
    kept = F.aggregate("bs", F.slice("bs", 1, 0), lambda acc, b: F.when(
        F.exists(acc, lambda k: suppresses(k, b)), acc).otherwise(F.concat(acc, F.array(b))))
    return g.select(key, F.explode(kept).alias("b")).select(key, F.col("b.id").alias("id"))


def box_nms(dets: DataFrame, thr: float = 0.3, tie: str = "keep", key: str = "image_id",
            id_col: str = "det_id", score_col: str = "score", plus_one: bool = True,
            cell: float = 64.0, collapse_copies: bool = True, small_group: int = SMALL_GROUP,
            dense_cell: int = DENSE_CELL) -> DataFrame:
    """Greedy box NMS per ``key``; returns the kept rows of ``dets``.

    tie="keep"     suppress when overlap > thr (G1 numpy and G3 GPU form)
    tie="suppress" suppress when overlap >= thr (G2 Cython form)
    Areas use the inclusive +1 pixel convention of the reference. Null and NaN
    scores come last; a box without four numbers or without extent overlaps
    nothing and is kept. Both rules hold before any split by group size.
    Cells of the grid with more than ``dense_cell`` boxes are thinned round by
    round before pairs are formed; results do not depend on it."""
    if tie not in ("keep", "suppress"):
        raise ValueError("tie must be 'keep' or 'suppress'")
    if thr < 0 or (tie == "suppress" and thr <= 0):
        raise ValueError("threshold must make non-overlapping boxes compatible")
    every = dets.select(key, id_col, greedy_score(F.col(score_col)).alias(score_col), "x1", "y1", "x2", "y2",
                        _regular(1.0 if plus_one else 0.0).alias("_regular"))
    base = every.where("_regular").drop("_regular")
    small, big = split_by_group_size(base, key, small_group)

    def over(k, b):
        o = iou({c: k[c] for c in ("x1", "y1", "x2", "y2")}, {c: b[c] for c in ("x1", "y1", "x2", "y2")}, plus_one)
        return (o > thr) if tie == "keep" else (o >= thr)
    kept_small = _fold_greedy(small, key, id_col, score_col, ["x1", "y1", "x2", "y2"], over)
    if big is None:
        kept = kept_small
    else:
        kept = kept_small.unionByName(_box_nms_graph(big, thr, tie, key, id_col, score_col, plus_one, cell,
                                                     collapse_copies, dense_cell))
    kept = kept.unionByName(every.where("not _regular").select(key, F.col(id_col).alias("id")))
    return dets.join(kept.withColumnRenamed("id", id_col), [key, id_col], "left_semi")


def _box_nms_graph(base: DataFrame, thr: float, tie: str, key: str, id_col: str, score_col: str,
                   plus_one: bool, cell: float, collapse_copies: bool, dense_cell: int) -> DataFrame:
    """Large groups: collapse exact copies, thin dense cells, pair what is left
    on the level grid, resolve the greedy order round by round. Returns (key, id) kept."""
    copies_drop = thr < 1.0 if tie == "keep" else thr <= 1.0
    if collapse_copies and copies_drop:
        tagged = _collapse_copies(base, key, id_col, score_col)
        cand = tagged.where(F.col(id_col) == F.col("leader_id")).drop("leader_id")
    else:
        cand = base
    pad = 1.0 if plus_one else 0.0
    cand = cut_lineage(cand.select(F.col(key).alias("k"), F.col(id_col).alias("id"), F.col(score_col).alias("score"),
                                   *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]))

    def hit(A, B):
        w = F.least(A["x2"], B["x2"]) - F.greatest(A["x1"], B["x1"]) + pad
        h = F.least(A["y2"], B["y2"]) - F.greatest(A["y1"], B["y1"]) + pad
        o = iou(A, B, plus_one)
        return (w > 0) & (h > 0) & ((o > thr) if tie == "keep" else (o >= thr))
    if thr >= MIN_LEVEL_THR:
        reach = level_reach(thr)
        kept, cand = _thin_dense_cells(cand, reach, pad, hit, dense_cell)
        edges = _suppressing_pairs(cand, reach, pad, hit)
    else:  # boxes of any two sizes may suppress one another
        kept = []
        pairs = overlap_pairs(cand, "k", "id", plus_one=plus_one, cell=cell)
        over = (F.col("iou") > thr) if tie == "keep" else (F.col("iou") >= thr)
        sc = cand.select("k", "id", "score")
        p = (pairs.where(over).join(sc.withColumnsRenamed({"id": "id_a", "score": "sa"}), ["k", "id_a"])
             .join(sc.withColumnsRenamed({"id": "id_b", "score": "sb"}), ["k", "id_b"]))
        a_first = _before(F.col("sa"), F.col("id_a"), F.col("sb"), F.col("id_b"))
        edges = p.select("k", F.when(a_first, F.col("id_a")).otherwise(F.col("id_b")).alias("src"),
                         F.when(a_first, F.col("id_b")).otherwise(F.col("id_a")).alias("dst"))
    out = resolve_greedy(cand.select("k", "id"), edges, "k")
    for part in kept:
        out = out.unionByName(part)
    return out.select(F.col("k").alias(key), "id")


# ---------------------------------------------------------------------------
# OKS similarity and suppression
# ---------------------------------------------------------------------------

def oks_expr(gx, gy, dx, dy, dv, area_g, area_d, sigmas, vis_thr=None) -> Column:
    """Object keypoint similarity between pose g and pose d (arrays),
    unrolled over the K sigmas (plain element access, codegen-friendly).

    Mask (when ``vis_thr`` is set) uses d's visibility only — the
    reference's ``list(a) and list(b)`` evaluates to the second list (Q5).
    No joint left -> 0. Summation runs in joint order."""
    denom = (area_g + area_d) / 2.0 + F.lit(2.220446049250313e-16)
    total, count = F.lit(0.0), F.lit(0)
    for i, s in enumerate(sigmas):
        ex = F.element_at(dx, i + 1) - F.element_at(gx, i + 1)
        ey = F.element_at(dy, i + 1) - F.element_at(gy, i + 1)
        term = F.exp(-((ex * ex + ey * ey) / F.lit((2.0 * s) ** 2) / denom / 2.0))
        if vis_thr is not None:
            on = F.element_at(dv, i + 1) > vis_thr
            total = total + F.when(on, term).otherwise(F.lit(0.0))
            count = count + F.when(on, 1).otherwise(0)
        else:
            total = total + term
            count = count + 1
    return F.when(count == 0, F.lit(0.0)).otherwise(total / count)


def _oks_candidates(poses: DataFrame, key: str, thr: float, sigmas, cell: float) -> DataFrame:
    """Pairs that can reach OKS > thr, found without an all-pairs join.

    mean(exp(-e_i)) > thr needs some joint i with
    d_i^2 < -2 ln(thr) * var_i * ((a_g + a_d)/2 + eps) <= r_i(p)^2, where p is
    the larger pose and r_i(p)^2 = -2 ln(thr) var_i (a_p + eps). Each pose
    probes the cells of a square of radius r_i(p) around its joint i; every
    pose inserts its joint i point; the join on (key, joint, cell) finds all
    such pairs."""
    n = len(sigmas)
    k2 = -2.0 * math.log(thr)
    var = F.array(*[F.lit((2.0 * s) ** 2) for s in sigmas])
    j = poses.select(key, "id", "area", F.posexplode(F.arrays_zip("kx", "ky")).alias("joint", "pt"))
    j = j.where(F.col("joint") < n).select(
        key, "id", "joint", F.col("pt.kx").alias("x"), F.col("pt.ky").alias("y"),
        F.sqrt(F.lit(k2) * var[F.col("joint")] * (F.col("area") + F.lit(2.220446049250313e-16))).alias("r"))
    ins = j.select(key, F.col("id").alias("id_b"), "joint",
                   F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    probe = (j.withColumn("cx", F.explode(F.sequence(F.floor((F.col("x") - F.col("r")) / cell),
                                                      F.floor((F.col("x") + F.col("r")) / cell))))
              .withColumn("cy", F.explode(F.sequence(F.floor((F.col("y") - F.col("r")) / cell),
                                                      F.floor((F.col("y") + F.col("r")) / cell))))
              .select(key, F.col("id").alias("id_a"), "joint", "cx", "cy"))
    pairs = probe.join(ins, [key, "joint", "cx", "cy"]).where(F.col("id_a") != F.col("id_b"))
    lo = F.least("id_a", "id_b")
    hi = F.greatest("id_a", "id_b")
    return pairs.select(key, lo.alias("id_a"), hi.alias("id_b")).distinct()


PAIR_GROUP = 32  # keys with at most this many poses form their few pairs without a grid


def oks_pairs(poses: DataFrame, thr: float, key: str = "image_id", id_col: str = "pose_id",
              sigmas=None, vis_thr=None, cell: float = 64.0, score_col: str = "score",
              pair_group: int = PAIR_GROUP) -> DataFrame:
    """Directed OKS for every candidate pair whose OKS can exceed ``thr``.

    poses: key, id_col, score, area, kx, ky, kv (arrays of K joints).
    Output: key, src, dst (src first in greedy order), oks(src -> dst) where
    src plays g and dst plays d (the visibility mask comes from dst).

    A grid of all joints is dearer than the pairs of a small key: up to
    ``pair_group`` poses, at most half as many pairs a pose, meet in one join on
    the key. Poses of larger keys meet in the cells of the grid."""
    sigmas = sigmas or OKS_SIGMAS
    fields = ["id", "score", "area", "kx", "ky", *(["kv"] if vis_thr is not None else [])]
    p = poses.select(key, F.col(id_col).alias("id"), F.col(score_col).alias("score"),
                     F.col("area").cast("double").alias("area"), "kx", "ky", "kv").select(key, *fields)
    small, big = split_by_group_size(p, key, pair_group)

    def sides(df):
        return [df.select(key, *[F.col(c).alias(f"{s}_{c}") for c in fields]) for s in "ab"]
    a, b = sides(small)
    j = a.join(b.hint("merge"), key).where(F.col("a_id") < F.col("b_id"))
    if big is not None:
        a, b = sides(big)
        j = j.unionByName(_oks_candidates(big, key, thr, sigmas, cell)
                          .join(a.withColumn("id_a", F.col("a_id")).hint("merge"), [key, "id_a"])
                          .join(b.withColumn("id_b", F.col("b_id")).hint("merge"), [key, "id_b"]).select(*j.columns))
    a_first = _before(F.col("a_score"), F.col("a_id"), F.col("b_score"), F.col("b_id"))
    # which of the two is g matters for the visibility only
    dv = F.when(a_first, F.col("b_kv")).otherwise(F.col("a_kv")) if vis_thr is not None else None
    oks = oks_expr(F.col("a_kx"), F.col("a_ky"), F.col("b_kx"), F.col("b_ky"), dv, F.col("a_area"), F.col("b_area"),
                   sigmas, vis_thr)
    return j.select(key, F.when(a_first, F.col("a_id")).otherwise(F.col("b_id")).alias("src"),
                    F.when(a_first, F.col("b_id")).otherwise(F.col("a_id")).alias("dst"), oks.alias("oks"))


def pose_score(df: DataFrame, score_per_joint: bool = False, score_col: str = "score",
               joint_scores: str = "kv") -> DataFrame:
    """Person score: given score, or the mean of the joint scores."""
    if score_per_joint:
        s = F.aggregate(joint_scores, F.lit(0.0), lambda a, v: a + v) / F.size(joint_scores)
        return df.withColumn(score_col, s)
    return df


def oks_nms(poses: DataFrame, thr: float = 0.9, key: str = "image_id", id_col: str = "pose_id",
            sigmas=None, vis_thr=None, score_per_joint: bool = False, cell: float = 64.0,
            small_group: int = SMALL_GROUP) -> DataFrame:
    """Greedy OKS NMS; keeps a pose unless an earlier kept pose has
    OKS > thr with it. Same pair-graph resolution as ``box_nms``."""
    if not 0.0 < thr < 1.0:
        raise ValueError("OKS threshold must be in (0, 1)")
    sigmas = sigmas or OKS_SIGMAS
    poses = pose_score(poses, score_per_joint)
    base = poses.select(key, id_col, greedy_score(F.col("score")).alias("score"), F.col("area").cast("double").alias("area"), "kx", "ky", "kv")
    small, big = split_by_group_size(base, key, small_group)

    def over(k, b):
        return oks_expr(k["kx"], k["ky"], b["kx"], b["ky"], b["kv"], k["area"], b["area"], sigmas, vis_thr) > thr
    kept = _fold_greedy(small, key, id_col, "score", ["area", "kx", "ky", "kv"], over)
    if big is not None:
        pairs = oks_pairs(big, thr, key, id_col, sigmas, vis_thr, cell)
        edges = pairs.where(F.col("oks") > thr).select(key, "src", "dst")
        kept = kept.unionByName(resolve_greedy(big.select(key, F.col(id_col).alias("id")), edges, key))
    return poses.join(kept.withColumnRenamed("id", id_col), [key, id_col], "left_semi")


def rescore(overlap: Column, score: Column, thr: float, kind: str = "gaussian") -> Column:
    """Soft-NMS re-scoring of a score by its overlap with a kept item."""
    if kind == "linear":
        return F.when(overlap >= thr, score * (1 - overlap)).otherwise(score)
    if kind == "gaussian":
        return score * F.exp(-(overlap * overlap) / thr)
    raise ValueError("kind must be 'gaussian' or 'linear'")


def _walk_order(cur, np):
    """Class of a current score in the order of picks: a number (3), none (2),
    one that a pose without numbers has spoilt (1)."""
    return np.where(np.isnan(cur), 1, np.where(cur == -np.inf, 2, 3))


def soft_oks_nms_walk(kx, ky, kv, area, score, ids, thr, max_dets, sigmas, vis_thr=None, kind="gaussian",
                      taken=None, bound=None):
    """Soft OKS NMS of G groups of n poses side by side in numpy. kx, ky, kv:
    [G, n, K]; area, score, ids: [G, n]. Each round picks the best current
    score of every group, ties to the smaller id, and re-scores the rest.

    Returns (pose [G, R], score [G, R]), pose -1 where a group has ended.
    ``taken`` [G]: picks a group has had before. ``bound`` (score [G], id [G],
    there [G]): the best pose outside the group. Scores move towards zero only,
    so a pick stands while it comes before that pose; then the group ends. The
    first pick always stands."""
    import numpy as np
    G, n = score.shape
    var = (2.0 * np.asarray(sigmas)) ** 2
    by_id = np.argsort(ids, axis=1, kind="stable")
    ids = np.take_along_axis(ids, by_id, 1)
    area = np.take_along_axis(area, by_id, 1)
    cur = np.take_along_axis(score, by_id, 1)
    joints = [[np.take_along_axis(np.ascontiguousarray(a[:, :, j]), by_id, 1) for j in range(len(sigmas))]
              for a in ((kx, ky) if vis_thr is None else (kx, ky, kv))]
    alive, going, g = np.ones((G, n), dtype=bool), np.ones(G, dtype=bool), np.arange(G)
    taken = np.zeros(G, dtype=np.int64) if taken is None else taken
    poses, scores = [], []
    for step in range(min(n, max_dets)):
        kinds = np.where(alive, _walk_order(cur, np), 0)
        top = kinds.max(axis=1)
        shown = np.where(kinds == 3, cur, 0.0)
        best = np.where(kinds == top[:, None], shown, -np.inf).argmax(axis=1)
        going &= (top > 0) & (taken + step < max_dets)
        if bound is not None and step:
            out_kind = np.where(bound[2], _walk_order(bound[0], np), 0)
            b, o = shown[g, best], np.where(out_kind == 3, bound[0], 0.0)
            first = np.where(o > 0, (b > o) | ((b == o) & (ids[g, best] < bound[1])), b > 0)
            first = np.where(top == 3, first, ids[g, best] < bound[1])
            going &= (out_kind == 0) | (top > out_kind) & ((top < 3) | (out_kind < 3)) | (top == out_kind) & first
        if not going.any():
            break
        poses.append(np.where(going, by_id[g, best], -1))
        scores.append(cur[g, best])
        alive[g, best] &= ~going
        with np.errstate(invalid="ignore"):
            denom = (area[g, best][:, None] + area) / 2.0 + np.finfo(np.float64).eps
            total, count = np.zeros((G, n)), np.zeros((G, n))
            for j, v in enumerate(var):  # joint after joint, as the column form adds them
                x, y = joints[0][j], joints[1][j]
                ex, ey = x - x[g, best][:, None], y - y[g, best][:, None]
                term = np.exp(-((ex * ex + ey * ey) / v / denom / 2.0))
                if vis_thr is not None:
                    on = joints[2][j] > vis_thr
                    term, count = np.where(on, term, 0.0), count + on
                total += term
            o = total / len(var) if vis_thr is None else np.where(count > 0, total / np.maximum(count, 1), 0.0)
            new = cur * np.exp(-(o * o) / thr) if kind == "gaussian" else np.where(o >= thr, cur * (1 - o), cur)
            cur = np.where(alive & going[:, None] & (cur > -np.inf), new, cur)
    if not poses:
        return np.zeros((G, 0), dtype=np.int64), np.zeros((G, 0))
    return np.stack(poses, axis=1), np.stack(scores, axis=1)


def _fixed_lists(lists, size: int, np):
    """An Arrow list column as [rows, size], NaN where a list is shorter or null."""
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    start = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    length = np.where(lists.is_valid().to_numpy(zero_copy_only=False), np.diff(start), 0)
    at = start[:-1, None] + np.arange(size)
    inside = np.arange(size) < length[:, None]
    if not len(values):
        return np.full(at.shape, np.nan)
    return np.where(inside, values[np.minimum(at, len(values) - 1)], np.nan)


def _walk_packed(packed: DataFrame, key: str, key_type: str, id_type: str, thr, max_dets, sigmas, vis_thr, kind,
                 rest: bool) -> DataFrame:
    """Picks of packed groups: (key, picks: array of (id, rank, score)).
    packed: key, g (structs id, cur, area, kx, ky, kv) and, with ``rest``, the
    best pose outside (out_cur, out_id) and the picks so far (taken); then
    ``made`` has the picked poses of keys that have not ended."""
    K = len(sigmas)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            lists = batch.column("g")
            flat, sizes = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            pid = flat.field("id")
            least = np.iinfo(np.int64).min  # a null id comes first, as Spark sorts it
            num = {c: flat.field(c).to_numpy(zero_copy_only=False).astype(np.float64, copy=False) for c in ("cur", "area")}
            num["id"] = pid.cast(pa.int64()).fill_null(least).to_numpy(zero_copy_only=False)
            pts = {c: _fixed_lists(flat.field(c), K, np) for c in (("kx", "ky") if vis_thr is None else ("kx", "ky", "kv"))}
            taken = batch.column("taken").to_numpy(zero_copy_only=False) if rest else np.zeros(len(sizes), dtype=np.int64)
            if rest:
                there = batch.column("out_cur").is_valid().to_numpy(zero_copy_only=False)
                out_cur = batch.column("out_cur").to_numpy(zero_copy_only=False).astype(np.float64)
                out_id = batch.column("out_id").cast(pa.int64()).fill_null(least).to_numpy(zero_copy_only=False)
            found = []
            for n in np.unique(sizes):
                every = np.flatnonzero(sizes == n)
                for rows in np.array_split(every, max(1, len(every) * int(n) // 100_000)):
                    at = starts[rows][:, None] + np.arange(n)
                    who, sc = soft_oks_nms_walk(pts["kx"][at], pts["ky"][at], pts["kv"][at] if vis_thr is not None else None,
                                                num["area"][at], num["cur"][at], num["id"][at], thr, max_dets, sigmas, vis_thr,
                                                kind, taken[rows], (out_cur[rows], out_id[rows], there[rows]) if rest else None)
                    r, c = np.nonzero(who >= 0)
                    found.append((rows[r], c, at[r, who[r, c]], taken[rows[r]] + c + 1, sc[r, c]))
            row, step, place, rank, sc = (np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(5))
            order = np.lexsort((step, row))
            count = np.bincount(row.astype(np.int64), minlength=len(sizes))
            offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
            place = pa.array(place[order].astype(np.int64))
            picks = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
                [pid.take(place), pa.array(rank[order]).cast(pa.int32()), pa.array(sc[order]).cast(pa.float64())],
                names=["id", "rank", "score"]))
            out = {key: batch.column(key), "picks": picks}
            if rest:  # what the other poses are re-scored by, unless the key has ended
                open_ = (taken + count < max_dets) & (there | (count < sizes))
                mine = np.repeat(open_, count)
                made = flat.take(pa.array(np.asarray(place)[mine]))
                ends = pa.array(np.concatenate([[0], np.cumsum(np.where(open_, count, 0))]).astype(np.int32))
                out["made"] = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
                    [made.field(c) for c in ("id", "area", "kx", "ky")], names=["id", "area", "kx", "ky"]))
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
    schema = f"{key} {key_type}, picks array<struct<id: {id_type}, rank: int, score: double>>"
    if rest:
        schema += f", made array<struct<id: {id_type}, area: double, kx: array<double>, ky: array<double>>>"
    return packed.mapInArrow(run, schema)


PICK_LIST = 32  # poses of a key that one round looks at together


def soft_oks_nms(poses: DataFrame, thr: float = 0.3, max_dets: int = 20, key: str = "image_id",
                 id_col: str = "pose_id", sigmas=None, vis_thr=None, score_per_joint: bool = False,
                 kind: str = "gaussian", small_group: int = SMALL_GROUP, pick_list: int = PICK_LIST) -> DataFrame:
    """Soft OKS NMS — pick the best remaining pose per key, re-score all
    remaining poses of that key by their OKS with it, repeat up to
    ``max_dets`` times (the cap is the operator's feature).

    A key with at most ``small_group`` poses is walked in one go. Larger keys
    take rounds: the ``pick_list`` best poses of a key are walked together as
    long as none outside the list can come first (re-scoring only lowers a
    score), then an equi-join re-scores the other poses of the key with the
    round's picks. A round makes one pick at least; work per round is linear,
    and no more than ``pick_list`` poses of a key are collected. Returns kept
    poses with ``rank`` (pick order) and the ``score`` at pick time. A null or
    NaN score comes last and is given back as null; groups of any size are
    walked in the same order."""
    sigmas = sigmas or OKS_SIGMAS
    poses = pose_score(poses, score_per_joint)
    none = F.lit(float("-inf"))
    fields = ["id", "cur", "area", "kx", "ky", *(["kv"] if vis_thr is not None else [])]
    base = poses.select(key, F.col(id_col).alias("id"), greedy_score(F.col("score")).alias("cur"),
                        F.col("area").cast("double").alias("area"), "kx", "ky", "kv").select(key, *fields)
    small, big = split_by_group_size(base, key, small_group)
    types = dict(poses.dtypes)
    walk = (key, types[key], types[id_col], thr, max_dets, sigmas, vis_thr, kind)
    item = F.struct(*fields)
    out = _walk_packed(small.groupBy(key).agg(F.collect_list(item).alias("g")), *walk, rest=False).select(key, "picks")
    remaining = big.withColumn("taken", F.lit(0)) if big is not None else None
    order = Window.partitionBy(key).orderBy(
        F.when(F.isnan("cur"), 1).when(F.col("cur") == none, 2).otherwise(3).desc(), F.col("cur").desc(), "id")
    while remaining is not None:
        top = remaining.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= pick_list + 1)
        inside, outside = F.col("rn") <= pick_list, F.col("rn") > pick_list
        packed = top.groupBy(key).agg(
            F.collect_list(F.when(inside, item)).alias("g"), F.max(F.when(outside, F.col("cur"))).alias("out_cur"),
            F.max(F.when(outside, F.col("id"))).alias("out_id"), F.max("taken").cast("long").alias("taken"))
        picked = cut_lineage(_walk_packed(packed, *walk, rest=True))
        out = out.unionByName(picked.select(key, "picks"))
        made = picked.where(F.size("made") > 0).select(key, "made")
        if made.isEmpty():
            break
        again = remaining.join(made, key)
        # a pick takes one row with its id; the first in order was walked
        copy = F.row_number().over(Window.partitionBy(key, "id").orderBy(F.col("cur").desc()))
        again = again.withColumn("copy", copy).where(F.col("copy") > F.size(F.filter("made", lambda m: m["id"].eqNullSafe(F.col("id")))))

        def lowered(cur, g):
            o = oks_expr(g["kx"], g["ky"], F.col("kx"), F.col("ky"), F.col("kv") if vis_thr is not None else None,
                         g["area"], F.col("area"), sigmas, vis_thr)
            return F.when(cur > none, F.coalesce(rescore(o, cur, thr, kind), F.lit(float("nan")))).otherwise(cur)
        remaining = cut_lineage(again.withColumn("cur", F.aggregate("made", F.col("cur"), lowered))
                                .withColumn("taken", (F.col("taken") + F.size("made")).cast("int")).drop("made", "copy"))
    out = out.select(key, F.explode("picks").alias("p")).select(
        key, F.col("p.id").alias(id_col), F.col("p.rank").alias("rank"), F.col("p.score").alias("score"))
    return out.withColumn("score", F.when(F.col("score") > none, F.col("score")))
