"""Heatmap decoding and keypoint geometry: properties against numpy."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from posetide.functions import heatmap as H
from posetide.functions import keypoints as K
from posetide.operators import heatmap as OH
from posetide.operators import samples as SA
from posetide.schema import flip_permutation


def _conv2d_reflect101(img, k):
    g = OH.gaussian_kernel_1d(k)
    kern = np.outer(g, g)
    p = k // 2
    idx_y = OH._reflect101_index(img.shape[0], p)
    idx_x = OH._reflect101_index(img.shape[1], p)
    pad = img[idx_y][:, idx_x]
    out = np.zeros_like(img, dtype=np.float64)
    for i in range(img.shape[0]):
        for j in range(img.shape[1]):
            out[i, j] = (pad[i:i + k, j:j + k] * kern).sum()
    return out


def test_separable_blur_equals_2d_convolution():
    rng = np.random.default_rng(0)
    img = rng.uniform(0, 1, (9, 7))
    for k in (3, 5, 11):
        assert np.allclose(OH.blur(img[None], k)[0], _conv2d_reflect101(img, k))


def _render(x, y, h=64, w=48, sigma=2.0):
    yy, xx = np.mgrid[0:h, 0:w]
    return np.exp(-((xx - x) ** 2 + (yy - y) ** 2) / (2 * sigma ** 2))


@pytest.mark.parametrize("mode,udp,tol", [(None, True, 0.1), ("unbiased", False, 0.1), ("default", False, 0.3)])
def test_decode_recovers_rendered_point(spark, mode, udp, tol):
    rng = np.random.default_rng(1)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform([8, 8], [40, 56], (40, 2)))]
    rows = [(i, 0, [float(v) for v in _render(x, y).ravel()]) for i, x, y in pts]
    df = spark.createDataFrame(rows, "person_id long, joint int, hm array<double>")
    out = {r.person_id: (r.px, r.py) for r in
           OH.decode_heatmaps(df, mode=mode or "default", udp=udp, kernel=11 if udp else 11, h=64, w=48).collect()}
    for i, x, y in pts:
        assert abs(out[i][0] - x) < tol and abs(out[i][1] - y) < tol


def test_native_argmax_and_flip_twice_identity(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.uniform(-1, 1, 48)]) for i in range(50)]
    df = spark.createDataFrame(rows, "pid long, hm array<double>").withColumn("w", F.lit(8)).withColumn("h", F.lit(6))
    am = H.argmax("hm", "w")
    got = {r.pid: (r.px, r.py) for r in df.select("pid", am["px"].alias("px"), am["py"].alias("py")).collect()}
    for i, hm in rows:
        a = np.asarray(hm).reshape(6, 8)
        if a.max() > 0:
            y, x = np.unravel_index(a.argmax(), a.shape)
            assert got[i] == (x, y)
    twice = df.select("pid", "hm", H.flip_back_cells(H.flip_back_cells("hm", "h", "w"), "h", "w").alias("b"))
    assert all(r.hm == r.b for r in twice.collect())


def test_affine_matches_three_point_solve_and_inverse(spark):
    rng = np.random.default_rng(3)
    rows = [(float(cx), float(cy), float(s), float(r)) for cx, cy, s, r in
            zip(rng.uniform(50, 300, 20), rng.uniform(50, 300, 20), rng.uniform(0.2, 2, 20), rng.uniform(-60, 60, 20))]
    df = spark.createDataFrame(rows, "cx double, cy double, s double, rot double")
    m = K.affine_matrix("cx", "cy", "s", "rot", F.lit(192.0), F.lit(256.0))
    mi = K.affine_matrix("cx", "cy", "s", "rot", F.lit(192.0), F.lit(256.0), inv=True)
    res = df.select(*[v.alias(k) for k, v in m.items()], *[v.alias("i" + k) for k, v in mi.items()]).collect()
    for (cx, cy, s, rot), r in zip(rows, res):
        src_w = s * 200
        th = np.deg2rad(rot)
        sd = np.array([src_w * 0.5 * np.sin(th), -src_w * 0.5 * np.cos(th)])
        c = np.array([cx, cy])
        src = np.array([c, c + sd, c + sd + np.array([sd[1], -sd[0]])])
        dst0 = np.array([96.0, 128.0])
        dd = np.array([0, -96.0])
        dst = np.array([dst0, dst0 + dd, dst0 + dd + np.array([dd[1], -dd[0]])])
        A = np.linalg.solve(np.hstack([src, np.ones((3, 1))]), dst).T
        M = np.array([[r.m00, r.m01, r.m02], [r.m10, r.m11, r.m12]])
        assert np.allclose(M, A, atol=1e-6)
        Mi = np.array([[r.im00, r.im01, r.im02], [r.im10, r.im11, r.im12], [0, 0, 1]])
        assert np.allclose(np.vstack([M, [0, 0, 1]]) @ Mi, np.eye(3), atol=1e-9)


def test_flip_joints_twice_is_identity_on_visible(spark):
    rng = np.random.default_rng(4)
    rows = [([float(v) for v in rng.uniform(0, 100, 25)], [float(v) for v in rng.uniform(0, 100, 25)],
             [1] * 25, 200) for _ in range(10)]
    df = spark.createDataFrame(rows, "jx array<double>, jy array<double>, jv array<int>, width int")
    f = K.flip_joints("jx", "jy", "jv", "width")
    once = df.select(f["jx"].alias("a"), f["jy"].alias("b"), f["jv"].alias("c"), "width")
    g = K.flip_joints("a", "b", "c", "width")
    back = once.select(g["jx"].alias("x"), g["jy"].alias("y")).collect()
    for r, (jx, jy, _, _) in zip(back, rows):
        assert np.allclose(r.x, jx) and np.allclose(r.y, jy)
    assert flip_permutation()[1] == 2 and flip_permutation()[19] == 22


def test_gaussian_cells_render_the_target(spark):
    df = spark.createDataFrame([(0, 0, 100.0, 120.0, True), (0, 1, 500.0, 10.0, True), (0, 2, 50.0, 50.0, False)],
                               "sample_id long, joint int, x double, y double, vis boolean")
    cells = SA.gaussian_target_cells(df)
    dense = {r.joint: np.asarray(r.target).reshape(64, 48) for r in SA.dense_targets(cells).collect()}
    assert set(dense) == {0}  # joint 1 misses the map, joint 2 is invisible
    y, x = np.unravel_index(dense[0].argmax(), (64, 48))
    assert (x, y) == (25, 30) and dense[0].max() == pytest.approx(1.0)
    w = {r.joint: r.target_weight for r in SA.target_weights(df).collect()}
    assert w == {0: 1.0, 1: 0.0, 2: 0.0}


def test_draws_of_salts_and_epochs_are_unrelated(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from posetide.functions import keypoints as K
    df = spark.range(20000).select(*(K.uniform_draw("id", F.lit(e), s).alias(f"u{e}_{s}") for e in (0, 1) for s in (1, 2, 5)))
    u = np.array([tuple(r) for r in df.collect()])
    assert u.min() >= 0 and u.max() < 1 and abs(u.mean() - 0.5) < 0.01
    c = np.corrcoef(u.T)
    assert np.abs(c - np.eye(len(c))).max() < 0.03
