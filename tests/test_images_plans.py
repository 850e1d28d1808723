"""Image sources, scoring stages and physical-plan checks."""
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions.flags import person_filter
from posetide.operators import score as P
from posetide.operators.suppress import box_nms
from posetide.plans import jobs as J
from posetide.sources import images as I
from posetide.sources import sinks as A


def test_png_roundtrip_and_grey_promotion():
    rng = np.random.default_rng(0)
    img = rng.integers(0, 255, (17, 23, 3), dtype=np.uint8)
    assert (I.decode_png(I.encode_png(img)) == img).all()
    g = rng.integers(0, 255, (5, 4), dtype=np.uint8)
    assert (I.decode_png(I.encode_png(g)) == np.repeat(g[..., None], 3, 2)).all()


def test_image_source_keeps_invalid_rows(spark):
    d = tempfile.mkdtemp(prefix="posetide-img-")
    for i in range(3):
        with open(os.path.join(d, f"p{i}.png"), "wb") as fh:
            fh.write(I.encode_png(np.full((10 + i, 8, 3), 40 * i, dtype=np.uint8)))
    with open(os.path.join(d, "bad.png"), "wb") as fh:
        fh.write(b"not an image")
    df = I.read_images(spark, d)
    rows = {os.path.basename(r.path): r for r in df.collect()}
    assert rows["bad.png"].ok is False and rows["p2.png"].height == 12
    rgb = I.image_struct_to_rgb(rows["p1"+".png"].height, rows["p1.png"].width, rows["p1.png"].channels,
                                bytes(rows["p1.png"].data))
    assert rgb.shape == (11, 8, 3) and int(rgb[0, 0, 0]) == 40


def test_fetch_dedupes_and_keeps_errors(spark):
    df = spark.createDataFrame([(1, "a.jpg"), (2, "a.jpg"), (3, "b.html"), (4, None)], "k long, u string")
    calls = []

    def fetch(u):
        calls.append(u)
        return I.synthetic_fetch(u)
    out = {r.k: (r.error, r.img_w) for r in I.fetch_images(df, "u", I.synthetic_fetch).collect()}
    assert out[1] == out[2] and out[1][0] is None and out[3][0] == "fetch" and out[4] == (None, None)


def test_person_flags_are_consistent_per_url(spark):
    wide = fx.fx_wide_images(spark, "/root/testdata/sf0.001")
    flags = J.person_flags(wide, "https://h", fetcher=I.synthetic_fetch).collect()
    assert len(flags) == wide.count()
    for r in flags:
        assert {r.model_flag1, r.model_flag2, r.model_flag3, r.model_flag4} <= {"true", "false", "NA"}
        assert r.model_flag4 in ("true", "false")  # .jpg variants decode


def test_score_images_finds_the_block(spark):
    img = np.full((120, 100, 3), 255, dtype=np.uint8)
    img[30:90, 20:50] = 10
    d = tempfile.mkdtemp(prefix="posetide-sc-")
    p = os.path.join(d, "x.png")
    with open(p, "wb") as fh:
        fh.write(I.encode_png(img))
    df = spark.createDataFrame([(1, p), (2, os.path.join(d, "missing.png"))], "k long, u string")
    r = {x.k: x for x in P.score_images(df, "u", ["k"], I.local_then_http, pose_model=P.GridPoseModel()).collect()}
    assert r[1].n_persons == 1 and (r[1].bx1, r[1].by1, r[1].bx2, r[1].by2) == (10, 20, 60, 100)
    assert len(r[1].jx) == 25 and all(10 <= x <= 60 for x in r[1].jx)
    assert r[2].error == "fetch"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_operators_have_no_python_and_scans_are_pruned(spark):
    dets = fx.fx_detections(spark, "/root/testdata/sf0.001")
    plan = _plan(person_filter(dets).groupBy("image_id").count())
    assert "Python" not in plan and "ArrowEval" not in plan
    sel = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("l_orderkey < 10").select("l_orderkey", "l_partkey")
    p = _plan(sel)
    assert "PushedFilters: [IsNotNull(l_orderkey), LessThan(l_orderkey,10)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p


def test_nms_small_path_is_single_pass_native(spark):
    dets = fx.fx_detections(spark, "/root/testdata/sf0.001")
    kept = box_nms(person_filter(dets), thr=0.3)
    plan = _plan(kept)
    assert "Python" not in plan


def test_pose_json_and_coco_rows(spark):
    poses = spark.createDataFrame([(1, 0, 7, j, float(j), float(2 * j), 0.5) for j in range(3)],
                                  "video_id long, frame_idx int, person_id long, joint int, x double, y double, score double")
    doc = A.pose_frames_json(poses).collect()[0].keypoints
    assert doc == '{"7":[[0.0,0.0,0.5],[2.0,1.0,0.5],[4.0,2.0,0.5]]}'
    coco = A.coco_keypoint_results(poses.withColumnRenamed("video_id", "image_id")).collect()[0]
    assert coco.keypoints == [0.0, 0.0, 0.5, 1.0, 2.0, 0.5, 2.0, 4.0, 0.5] and coco.category_id == 1
    n = spark.createDataFrame([("/a/b/clip.mp4",)], "p string").select(
        *[v.alias(k) for k, v in A.result_names("p").items()]).collect()[0]
    assert (n.media_out, n.json_out) == ("/a/b/clip_result.mp4", "/a/b/clip_result.json")


def test_checkpoint_dir_comes_from_the_session(spark):
    from posetide.session import ensure_checkpoint_dir
    d = ensure_checkpoint_dir(spark)
    assert d and not d.startswith("/tmp/spark-local")
