"""Suppression whose shuffles and rounds follow the rows, against plain walks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from posetide.operators import suppress as S
from posetide.schema import OKS_SIGMAS

SCHEMA = "image_id long, pose_id long, score double, area double, kx array<double>, ky array<double>, kv array<double>"


def _poses(sizes, seed=1, low=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for img, n in enumerate(sizes):
        for i in range(n):
            x, y = rng.uniform(0, 40, 2)
            rows.append((img, i, float(rng.integers(int(low * 20), 20)) / 20, float(rng.uniform(500, 9000)),
                         [float(x + 3 * j) for j in range(17)], [float(y + 2 * j) for j in range(17)],
                         [float(v) for v in rng.uniform(0, 1, 17)]))
    return rows


def _oks(a, b, vis_thr=None):
    t = [math.exp(-((b[4][j] - a[4][j]) ** 2 + (b[5][j] - a[5][j]) ** 2) / (2 * s) ** 2 / ((a[3] + b[3]) / 2 + 2.220446049250313e-16) / 2)
         for j, s in enumerate(OKS_SIGMAS) if vis_thr is None or b[6][j] > vis_thr]
    return sum(t) / len(t) if t else 0.0


def _soft(rows, thr, max_dets, kind, vis_thr):
    out = {}
    for img in {r[0] for r in rows}:
        rest = [[r[2], r] for r in rows if r[0] == img]
        for rank in range(1, min(max_dets, len(rest)) + 1):
            best = min(rest, key=lambda c: (-c[0], c[1][1]))
            rest.remove(best)
            out[img, rank] = (best[1][1], round(best[0], 9))
            for c in rest:
                o = _oks(best[1], c[1], vis_thr)
                c[0] = c[0] * math.exp(-o * o / thr) if kind == "gaussian" else (c[0] * (1 - o) if o >= thr else c[0])
    return out


def test_pairs_of_small_keys_need_no_grid(spark):
    """One join on the key; before, every pose had some 60 rows of joints and cells."""
    rows = _poses([1, 2, 5, 9, 32])
    df = S.oks_pairs(spark.createDataFrame(rows, SCHEMA), 0.3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "BroadcastHashJoin" not in plan
    got = {(r.image_id, min(r.src, r.dst), max(r.src, r.dst)) for r in df.where("oks > 0.3").collect()}
    assert got == {(a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and _oks(a, b) > 0.3}


@pytest.mark.parametrize("vis_thr", [None, 0.3])
def test_pairs_do_not_depend_on_the_grid(spark, vis_thr):
    df = spark.createDataFrame(_poses([3, 40, 12]), SCHEMA)
    got = [{(r.image_id, r.src, r.dst, round(r.oks, 9)) for r in
            S.oks_pairs(df, 0.3, vis_thr=vis_thr, pair_group=n).where("oks > 0.3").collect()} for n in (0, 12, 100)]
    assert got[0] and got[0] == got[1] == got[2]


def test_greedy_rounds_carry_edges_only(spark, monkeypatch):
    """No round holds the poses that no edge touches."""
    seen = []

    def cut(df):
        out = df.localCheckpoint()
        seen.append(out.count())
        return out
    monkeypatch.setattr(S, "cut_lineage", cut)
    nodes = spark.range(1000).select(F.lit(1).alias("k"), "id")
    edges = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (1, 3, 4), (1, 1, 4)], "k int, src long, dst long")
    kept = {r.id for r in S.resolve_greedy(nodes, edges, "k").collect()}
    assert kept == set(range(1000)) - {2, 4} and max(seen) <= 4


@pytest.mark.parametrize("kind,vis_thr,low", [("gaussian", None, 0.0), ("linear", 0.3, 0.0), ("gaussian", None, -0.5)])
def test_soft_walk_of_any_list_length(spark, kind, vis_thr, low):
    rows = _poses([1, 3, 3, 60], 4, low)
    df = spark.createDataFrame(rows, SCHEMA)
    want = _soft(rows, 0.3, 20, kind, vis_thr)
    for small, take in ((256, 32), (0, 12)):
        r = S.soft_oks_nms(df, 0.3, 20, kind=kind, vis_thr=vis_thr, small_group=small, pick_list=take).collect()
        assert {(x.image_id, x.rank): (x.pose_id, round(x.score, 9)) for x in r} == want


def test_soft_rounds_of_small_keys_end_at_once(spark, monkeypatch):
    """Before, every pick was a round that wrote all other poses again."""
    cuts, real = [], S.cut_lineage
    monkeypatch.setattr(S, "cut_lineage", lambda df: cuts.append(1) or real(df))
    rows = _poses([7] * 12, 2)
    got = S.soft_oks_nms(spark.createDataFrame(rows, SCHEMA), 0.3, 20, small_group=0).count()
    assert got == len(rows) and len(cuts) <= 2


def test_soft_walk_keeps_copies(spark):
    rows = _poses([24], 6)
    df = spark.createDataFrame(rows + rows[:6], SCHEMA)
    walks = [sorted((r.rank, r.pose_id, round(r.score, 9)) for r in
             S.soft_oks_nms(df, 0.3, 30, small_group=n, pick_list=12).collect()) for n in (256, 0)]
    assert walks[0] == walks[1] and len(walks[0]) == 30
