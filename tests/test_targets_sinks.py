"""Targets inside the sample, peak windows of any size and result sinks."""
import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from posetide.functions import heatmap as H
from posetide.operators import samples as S
from posetide.schema import JOINT_NAMES, JOINT_WEIGHTS
from posetide.sources import sinks as A


def _joints(spark):
    rng = np.random.default_rng(3)
    rows = []
    for s in range(6):
        x, y = rng.uniform(-60, 250, 25), rng.uniform(-60, 320, 25)
        if s == 0:  # windows that touch the map's edges, and far away
            x[:8], y[:8] = [-38.0, -37.9, -42.0, 226.0, 225.9, 0.0, 191.0, 1e6], 100.0
        v = rng.integers(0, 2, 25).astype(float)
        v[:8] = 1.0
        rows += [(s, j, float(x[j]), float(y[j]), float(v[j])) for j in range(25)]
    return spark.createDataFrame(rows, "sample_id long, joint int, x double, y double, vis double")


def test_targets_of_a_sample_stand_for_the_same_cells(spark):
    long = _joints(spark)
    arrays = long.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("joint", "x", "y", "vis"))).alias("a"))
    arrays = arrays.select("sample_id", F.col("a.x").alias("jx"), F.col("a.y").alias("jy"), F.col("a.vis").alias("jv"))
    t = arrays.select("sample_id", S.target_structs("jx", "jy", "jv").alias("targets"))
    got = {(r.sample_id, r.joint, r.hx, r.hy): r.val for r in S.target_cells(t, "sample_id").collect()}
    want = {(r.sample_id, r.joint, r.hx, r.hy): r.val for r in S.gaussian_target_cells(long).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    weights = {(r.sample_id, r.joint): r.target_weight for r in S.target_weights(long).collect()}
    for r in t.select("sample_id", F.explode("targets").alias("t")).select("sample_id", "t.*").collect():
        assert r.weight == pytest.approx(weights[r.sample_id, r.joint] * JOINT_WEIGHTS[r.joint])


def test_targets_of_null_joints(spark):
    df = spark.createDataFrame([([None, 10.0], [5.0, 10.0], [1.0, None])], "jx array<double>, jy array<double>, jv array<double>")
    ts = df.select(S.target_structs("jx", "jy", "jv").alias("t")).first().t
    assert [(t.weight, t.wx, t.wy) for t in ts] == [(0.0, [], []), (0.0, [], [])]


@pytest.mark.parametrize("size", [1, 3, 5, 9, 11])
def test_peak_windows_equal_plain_maxima(spark, size):
    rng = np.random.default_rng(size)
    maps = [(5, 7), (1, 6), (6, 1), (3, 3)]
    rows = [(k, h, w, [float(v) for v in rng.integers(0, 30, h * w)]) for k, (h, w) in enumerate(maps)]
    df = spark.createDataFrame(rows, "k int, h int, w int, hm array<double>")
    got = df.select("k", H.local_peaks_window("hm", "h", "w", size).alias("p")).collect()
    r = size // 2
    for row in got:
        h, w = maps[row.k]
        m = np.array(rows[row.k][3]).reshape(h, w)
        want = [(y * w + x, m[y, x]) for y in range(h) for x in range(w)
                if m[y, x] == m[max(0, y - r):y + r + 1, max(0, x - r):x + r + 1].max()]
        assert [(p.cell, p.val) for p in row.p] == want


def test_pose_documents_keep_frames_in_order_and_bring_the_skeleton(spark):
    poses = spark.createDataFrame([(v, f, p, j, float(j), float(f), 0.5) for v in ("a", "b") for f in range(40)
                                   for p in (11, 2) for j in range(3)],
                                  "video_id string, frame_idx int, person_id int, joint int, x double, y double, score double")
    path = os.path.join(tempfile.mkdtemp(prefix="posetide-json-"), "out")
    A.write_pose_json(poses, path)
    docs = [json.loads(r.value) for r in spark.read.text(path + "/video_id=a").collect()]
    assert sorted(d["frame_idx"] for d in docs) == list(range(40))
    assert set(json.loads(docs[0]["keypoints"])) == {"2", "11"}
    assert spark.read.text(path).count() == 80  # the skeleton is no frame
    names = json.loads(spark.read.text(path + "/_skeleton").first().value)
    assert [names[str(i)] for i in range(25)] == JOINT_NAMES
