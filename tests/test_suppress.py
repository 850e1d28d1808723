"""Suppression: the distributed forms equal a plain sequential walk, on data
with a hot image and piles of exact copies."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from posetide.operators import suppress as S
from posetide.schema import OKS_SIGMAS


def seq_nms(boxes, thr, tie="keep"):
    """Sequential greedy NMS, +1 areas, order score desc then id asc."""
    order = sorted(range(len(boxes)), key=lambda i: (-boxes[i][4], boxes[i][5]))
    kept = []
    for i in order:
        x1, y1, x2, y2 = boxes[i][:4]
        ok = True
        for k in kept:
            a = boxes[k]
            iw = max(0.0, min(x2, a[2]) - max(x1, a[0]) + 1)
            ih = max(0.0, min(y2, a[3]) - max(y1, a[1]) + 1)
            inter = iw * ih
            o = inter / ((x2 - x1 + 1) * (y2 - y1 + 1) + (a[2] - a[0] + 1) * (a[3] - a[1] + 1) - inter)
            if (o > thr) if tie == "keep" else (o >= thr):
                ok = False
                break
        if ok:
            kept.append(i)
    return {boxes[i][5] for i in kept}


def _boxes(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    did = 0
    for img in range(30):
        n = 400 if img == 0 else rng.integers(1, 12)  # image 0 is hot
        for _ in range(n):
            x1, y1 = rng.uniform(0, 300, 2)
            w, h = rng.uniform(5, 80, 2)
            rows.append((img, did, float(x1), float(y1), float(x1 + w), float(y1 + h), float(rng.integers(0, 20) / 20)))
            did += 1
    for c in range(150):  # a pile of exact copies in image 1
        rows.append((1, did, 10.0, 10.0, 60.0, 90.0, float((c % 7) / 7)))
        did += 1
    return rows


@pytest.mark.parametrize("small_group", [256, 0])
@pytest.mark.parametrize("tie,thr", [("keep", 0.3), ("suppress", 0.5)])
def test_box_nms_matches_sequential(spark, small_group, tie, thr):
    rows = _boxes()
    df = spark.createDataFrame(rows, "image_id long, det_id long, x1 double, y1 double, x2 double, y2 double, score double")
    got = {(r.image_id, r.det_id) for r in S.box_nms(df, thr=thr, tie=tie, small_group=small_group).collect()}
    want = set()
    for img in {r[0] for r in rows}:
        bs = [(r[2], r[3], r[4], r[5], r[6], r[1]) for r in rows if r[0] == img]
        want |= {(img, i) for i in seq_nms(bs, thr, tie)}
    assert got == want


def test_overlap_pairs_are_all_overlapping_pairs(spark):
    rows = _boxes(1)[:800]
    df = spark.createDataFrame(rows, "image_id long, det_id long, x1 double, y1 double, x2 double, y2 double, score double")
    got = {(r.image_id, r.id_a, r.id_b) for r in S.overlap_pairs(df, cell=32.0).collect()}
    want = set()
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] < b[1] and min(a[4], b[4]) > max(a[2], b[2]) and min(a[5], b[5]) > max(a[3], b[3]):
                want.add((a[0], a[1], b[1]))
    assert got == want


def _poses(seed=0, n_img=12):
    rng = np.random.default_rng(seed)
    rows, pid = [], 0
    for img in range(n_img):
        n = 60 if img == 0 else int(rng.integers(1, 8))
        base = rng.uniform(0, 100, 2)
        for _ in range(n):
            off = base + rng.normal(0, 6, 2)
            kx = [float(off[0] + 2 * j + rng.normal(0, 1)) for j in range(17)]
            ky = [float(off[1] + 3 * j + rng.normal(0, 1)) for j in range(17)]
            kv = [float(rng.uniform()) for _ in range(17)]
            rows.append((img, pid, float(rng.integers(0, 50) / 50), float(rng.uniform(500, 5000)), kx, ky, kv))
            pid += 1
    return rows


def _oks(g, d, sig, vis_thr=None):
    var = (2 * np.asarray(sig)) ** 2
    e = ((np.array(d[4]) - g[4]) ** 2 + (np.array(d[5]) - g[5]) ** 2) / var / ((g[3] + d[3]) / 2 + np.spacing(1)) / 2
    if vis_thr is not None:
        e = e[np.array(d[6]) > vis_thr]
    return float(np.exp(-e).mean()) if len(e) else 0.0


POSE_SCHEMA = "image_id long, pose_id long, score double, area double, kx array<double>, ky array<double>, kv array<double>"


@pytest.mark.parametrize("small_group", [256, 0])
@pytest.mark.parametrize("vis_thr", [None, 0.3])
def test_oks_nms_matches_sequential(spark, small_group, vis_thr):
    rows = _poses()
    df = spark.createDataFrame(rows, POSE_SCHEMA)
    got = {(r.image_id, r.pose_id) for r in
           S.oks_nms(df, 0.5, vis_thr=vis_thr, small_group=small_group).collect()}
    want = set()
    for img in {r[0] for r in rows}:
        ps = sorted([r for r in rows if r[0] == img], key=lambda r: (-r[2], r[1]))
        kept = []
        for p in ps:
            if all(_oks(k, p, OKS_SIGMAS, vis_thr) <= 0.5 for k in kept):
                kept.append(p)
        want |= {(img, p[1]) for p in kept}
    assert got == want


def test_oks_candidates_cover_every_pair_above_threshold(spark):
    rows = _poses(3)
    df = spark.createDataFrame(rows, POSE_SCHEMA)
    got = {(r.image_id, min(r.src, r.dst), max(r.src, r.dst)) for r in
           S.oks_pairs(df, 0.2).where(F.col("oks") > 0.2).collect()}
    want = {(a[0], a[1], b[1]) for a in rows for b in rows
            if a[0] == b[0] and a[1] < b[1] and _oks(a, b, OKS_SIGMAS) > 0.2}
    assert got == want


def test_soft_nms_rounds_equal_local(spark):
    rows = _poses(5)
    df = spark.createDataFrame(rows, POSE_SCHEMA)
    a = {(r.image_id, r.pose_id, r.rank, round(r.score, 9)) for r in S.soft_oks_nms(df, 0.3, 20).collect()}
    b = {(r.image_id, r.pose_id, r.rank, round(r.score, 9)) for r in
         S.soft_oks_nms(df, 0.3, 20, small_group=0).collect()}
    assert a == b
    assert max(r[2] for r in a) == 20  # the hot image is capped at max_dets picks


def test_rescore_rules(spark):
    df = spark.createDataFrame([(0.5, 0.8), (0.1, 0.8)], "o double, s double")
    r = df.select(S.rescore(F.col("o"), F.col("s"), 0.3, "linear").alias("lin"),
                  S.rescore(F.col("o"), F.col("s"), 0.3, "gaussian").alias("g")).collect()
    assert r[0].lin == pytest.approx(0.4) and r[1].lin == pytest.approx(0.8)
    assert r[0].g == pytest.approx(0.8 * np.exp(-0.25 / 0.3))


def test_null_and_odd_boxes_do_not_depend_on_group_size(spark):
    """One order and one rule for odd boxes, whichever path a group takes."""
    nan = float("nan")
    rows = []
    for img in range(6):
        for i in range(12):
            x = float((i * 7 + img) % 5)
            rows.append((img, f"d{i:02d}", [0.9, 0.9, None, nan, 0.1 * i][i % 5], x, 0.0, x + 10, 10.0))
        rows += [(img, "n1", 0.95, None, 0.0, 9.0, 9.0), (img, "n2", nan, nan, 0.0, 9.0, 9.0), (img, "n3", 0.99, 5.0, 5.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "image_id long, det_id string, score double, x1 double, y1 double, x2 double, y2 double")
    got = [sorted((r.image_id, r.det_id) for r in S.box_nms(df, 0.3, small_group=n).collect()) for n in (0, 14, 15, 16, 256)]
    assert all(g == got[0] for g in got)
    assert all((img, n) in got[0] for img in range(6) for n in ("n1", "n2", "n3"))


def test_soft_nms_order_does_not_depend_on_group_size(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i, score in enumerate((float("nan"), None, 0.5, 0.9)):
        x, y = rng.uniform(0, 60, 17), rng.uniform(0, 60, 17)
        rows.append((1, i, [float(v) for v in x], [float(v) for v in y], [1.0] * 17, 2000.0, score))
    rows.append((1, 4, *rows[3][2:6], 0.9))     # an exact copy
    df = spark.createDataFrame(rows, "image_id long, pose_id long, kx array<double>, ky array<double>, kv array<double>, area double, score double")
    walks = [[(r.rank, r.pose_id, r.score is None, round(r.score or 0, 9)) for r in
              sorted(S.soft_oks_nms(df, 0.3, 5, small_group=n, kind="linear").collect(), key=lambda r: r.rank)] for n in (5, 4)]
    assert walks[0] == walks[1] and [w[1] for w in walks[0]] == [3, 2, 4, 0, 1]
    assert [w[2] for w in walks[0]] == [False, False, False, True, True]


BOX_SCHEMA = "image_id long, det_id long, x1 double, y1 double, x2 double, y2 double, score double"


@pytest.mark.parametrize("tie,thr,dense_cell", [("keep", 0.3, 20), ("suppress", 0.5, 8), ("keep", 0.3, 512), ("keep", 0.01, 512)])
def test_level_grid_nms_of_sizes_from_specks_to_posters(spark, dense_cell, tie, thr):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(220):
        side = 2.0 ** rng.uniform(-1, 9, 2)
        x, y = rng.uniform(-300, 300, 2)
        if i % 3 == 0:  # whole numbers and powers of two, where cells meet
            x, y, side = float(int(x) // 32 * 32), float(int(y) // 32 * 32), np.array([63.0, 31.0])
        rows.append((i % 2, i, float(x), float(y), float(x + side[0]), float(y + side[1]), float(rng.integers(0, 9))))
    df = spark.createDataFrame(rows, BOX_SCHEMA)
    got = {(r.image_id, r.det_id) for r in
           S.box_nms(df, thr=thr, tie=tie, small_group=0, dense_cell=dense_cell).collect()}
    want = set()
    for img in (0, 1):
        want |= {(img, i) for i in seq_nms([(r[2], r[3], r[4], r[5], r[6], r[1]) for r in rows if r[0] == img], thr, tie)}
    assert got == want


def test_a_pile_of_a_hundred_thousand_boxes(spark):
    """No two alike and nearly all overlapping: 5 * 10^9 pairs, never formed."""
    n = 100_000
    i = F.col("id")
    df = spark.range(n).select(
        F.lit(1).cast("long").alias("image_id"), i.alias("det_id"), (i % 317 / 100).alias("x1"),
        (F.floor(i / 317) / 100).alias("y1"), (i % 317 / 100 + 100).alias("x2"),
        (F.floor(i / 317) / 100 + 80 + i % 7).alias("y2"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("score"))
    best = df.orderBy(F.col("score").desc(), "det_id").first().det_id
    assert [r.det_id for r in S.box_nms(df, thr=0.3).collect()] == [best]


def test_levels_of_sides_and_reach(spark):
    sides = [0.5, 1.0, 1.5, 2.0, 2.1, 4.0, 8.0, 8.001, 64.0, 65.0]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in sides], "s double").select(S._axis_level(F.col("s"))).collect()]
    assert got == [0, 0, 1, 1, 2, 2, 3, 4, 6, 7]
    assert [S.level_reach(t) for t in (1.0, 0.5, 0.3)] == [1, 2, 2]
