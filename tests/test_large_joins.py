"""Joins between pose rows: never a broadcast, whatever Spark estimates."""

import math

import pytest
from pyspark.sql import functions as F

from posetide.operators import metrics as M
from posetide.plans.q_flags import q_bone_segments
from posetide.schema import SKELETON


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _poses(spark, n=40):
    """n samples of 25 joints, exploded from one row a sample."""
    i, j = F.col("sample_id"), F.col("joint")
    return (spark.range(n).select(F.col("id").alias("sample_id"), F.explode(F.sequence(F.lit(0), F.lit(24))).alias("joint"))
            .select("sample_id", "joint", (i * 7 + j * j % 11).cast("double").alias("pred_x"),
                    (i * 5 + j * 3 % 13).cast("double").alias("pred_y"), (i * 7 + j).cast("double").alias("gt_x"),
                    (i * 5 + j * 2 % 7).cast("double").alias("gt_y"), (j % 4 > 0).alias("visible")))


def test_bone_segments_does_not_broadcast_poses(spark, tmp_path):
    spark.createDataFrame([(i, i * 3 + 1) for i in range(30)], "o_orderkey long, o_custkey long").write.parquet(
        str(tmp_path / "orders.parquet"))
    df = q_bone_segments(spark, str(tmp_path))
    assert _plan(df).count("BroadcastHashJoin") == 1 and "SortMergeJoin" in _plan(df)
    got = {(r.sample_id, r.bone) for r in df.collect()}
    score = [[((i * 3 + 1) * 11 + j * 53) % 100 / 100 for j in range(25)] for i in range(30)]
    assert got == {(i, b) for i in range(30) for b, (x, y) in enumerate(SKELETON) if score[i][x] > 0.5 and score[i][y] > 0.5}


def test_bone_bias_does_not_broadcast_poses(spark):
    parents = M.skeleton_parents()
    df = M.bone_bias(_poses(spark), parents)
    assert _plan(df).count("BroadcastHashJoin") == 1 and "SortMergeJoin" in _plan(df)
    rows = {(r.sample_id, r.joint): r for r in _poses(spark).collect()}
    bias = []
    for j, p in enumerate(parents):
        if j != p:
            both = [(rows[i, j], rows[i, p]) for i in range(40)]
            lo = sum(math.hypot(a.pred_x - b.pred_x, a.pred_y - b.pred_y) for a, b in both) / 40
            lt = sum(math.hypot(a.gt_x - b.gt_x, a.gt_y - b.gt_y) for a, b in both) / 40
            bias.append(abs(lo - lt))
    assert df.first().bone_bias == pytest.approx(sum(bias) / len(bias))


def test_root_aligned_error_does_not_broadcast_poses(spark):
    p = _poses(spark).withColumn("pred_z", F.lit(1.0)).withColumn("gt_z", F.lit(1.0))
    df = M.root_aligned_smooth_l1(p)
    assert "BroadcastHashJoin" not in _plan(df) and "SortMergeJoin" in _plan(df)
    rows = {(r.sample_id, r.joint): r for r in p.collect()}
    total = 0.0
    for (i, _), r in rows.items():
        for a in ("x", "y"):
            mid = {s: (rows[i, 2][f"{s}_{a}"] + rows[i, 3][f"{s}_{a}"]) / 2 for s in ("pred", "gt")}
            d = abs((r[f"pred_{a}"] - mid["pred"]) - (r[f"gt_{a}"] - mid["gt"]))
            total += (d * d / 2 if d < 1 else d - 0.5) / 3 if r.visible else 0.0
    assert df.first().error == pytest.approx(total / len(rows))
