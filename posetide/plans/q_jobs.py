"""Registered queries: image, scoring and end-to-end jobs (A2-A15, D, P, L3).

No network and no model weights exist here, so pictures come from
deterministic stand-in fetchers driven by the tables' own URLs/boxes and the
models are the numpy stand-ins of ``operators.score``. The Spark plans are
the production ones; only the fetcher/predictor objects are swapped.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions.numeric import rnd, rnd_sql
from posetide.operators import images as D
from posetide.plans import jobs as J
from posetide.plans.registry import query
from posetide.sources import sinks as A
from posetide.sources.images import decode_any, frame_fetch, synthetic_fetch

HOST = "https://img.example.com"


@query("person_flag_job")
def q_person_flag_job(spark, d):
    """P5: four image columns -> model_flag1..4 (fetch, detect, count,
    flag, pivot) over the pages table's URLs."""
    return J.person_flags(fx.fx_wide_images(spark, d), HOST, fetcher=synthetic_fetch)


@query("cutout_job")
def q_cutout_job(spark, d):
    """Body-part cut-out summary per product (flag, crop manifest,
    size) over the product table."""
    summary, _ = J.cutouts(fx.fx_products(spark, d), HOST, fetcher=partial(synthetic_fetch, size=(400, 240)))
    return summary


@query("cutout_crops")
def q_cutout_crops(spark, d):
    """P6 + C8 + A13: crop boxes and manifest names per (product, part)."""
    _, crops = J.cutouts(fx.fx_products(spark, d), HOST, fetcher=partial(synthetic_fetch, size=(400, 240)))
    return crops.drop("img")


def _frames(spark, d):
    b = fx.fx_frame_boxes(spark, d).where(F.col("obj") == 0)
    url = F.format_string("frame://%d/%d?x=%d&y=%d&w=%d&h=%d", "video_id", "frame_idx",
                          F.col("x1").cast("int"), F.col("y1").cast("int"),
                          (F.col("x2") - F.col("x1")).cast("int"), (F.col("y2") - F.col("y1")).cast("int"))
    return b.select("video_id", "frame_idx", url.alias("url"))


@query("video_pose_job")
def q_video_pose_job(spark, d):
    """L3: frames -> detect -> track -> pose (DARK-UDP decode) -> back to
    image -> One-Euro, for every video of the events table."""
    j = J.video_poses(_frames(spark, d), "url", fetcher=frame_fetch, step=2)
    return j.select("video_id", "frame_idx", "track_id", "joint", rnd("x", 3).alias("x"), rnd("y", 3).alias("y"),
                    rnd("x_smooth", 3).alias("x_smooth"), rnd("y_smooth", 3).alias("y_smooth"),
                    rnd("score", 4).alias("score"))


@query("pose_json", fx.with_fixtures("""
select sample_id // 100 video_id, cast(sample_id % 100 as integer) frame_idx,
  '{"0":[' || string_agg('[' || pred_y || ',' || pred_x || ',' || score || ']', ',' order by joint) || ']}' keypoints
from fx_pose_pairs group by sample_id""", "fx_pose_pairs"))
def q_pose_json(spark, d):
    """Per-frame pose documents {"person": [[y, x, s], ...]} (B13
    order) for 100-frame clips of the pose table."""
    p = fx.fx_pose_pairs(spark, d).select(
        (F.col("sample_id") / 100).cast("long").alias("video_id"), (F.col("sample_id") % 100).cast("int").alias("frame_idx"),
        F.lit(0).alias("person_id"), "joint", F.col("pred_x").alias("x"), F.col("pred_y").alias("y"), "score")
    return A.pose_frames_json(p)


@query("coco_results", fx.with_fixtures(f"""
select sample_id image_id, cast(1 as integer) category_id,
  flatten(list([pred_x, pred_y, score] order by joint)) keypoints, {rnd_sql("avg(score)")} score,
  [max(norm_x) * 2, max(norm_y) * 2] center, [max(norm_x) / 200, max(norm_y) / 200] scale
from fx_pose_pairs group by sample_id""", "fx_pose_pairs"))
def q_coco_results(spark, d):
    """Keypoint results rows (flat [x, y, s] x 25, mean score, centre and
    scale of the person)."""
    p = fx.fx_pose_pairs(spark, d).select(
        F.col("sample_id").alias("image_id"), F.lit(0).alias("person_id"), "joint", F.col("pred_x").alias("x"),
        F.col("pred_y").alias("y"), "score", F.array(F.col("norm_x") * 2, F.col("norm_y") * 2).alias("center"),
        F.array(F.col("norm_x") / 200, F.col("norm_y") / 200).alias("scale"))
    r = A.coco_keypoint_results(p, center="center", scale="scale")
    return r.withColumn("score", rnd("score"))


@query("media_names", fx.with_fixtures(r"""
select product_id, regexp_extract(split_part(images, ',', 1), '^(.*?)(\.[^./]*)?$', 1) || '_result'
    || regexp_extract(split_part(images, ',', 1), '(\.[^./]*)$', 1) media_out,
  regexp_extract(split_part(images, ',', 1), '^(.*?)(\.[^./]*)?$', 1) || '_result.json' json_out
from fx_products""", "fx_products"))
def q_media_names(spark, d):
    """Output names next to the input (name_result.ext / .json)."""
    p = fx.fx_products(spark, d)
    n = A.result_names(F.split_part("images", F.lit(","), F.lit(1)))
    return p.select("product_id", n["media_out"].alias("media_out"), n["json_out"].alias("json_out"))


@query("image_preprocess")
def q_image_preprocess(spark, d):
    """Per fetched picture: network input (resize 192 x 256,
    normalise, CHW), rotations, grey promotion, crop, pad, composite and an
    affine warp — summarised as one row of statistics per URL of any image
    column. A URL that gives no picture keeps its row, with the error."""
    import pandas as pd
    from posetide.operators.score import spread
    wide = fx.fx_wide_images(spark, d)
    urls = F.explode(F.array(*[c for c in wide.columns if c.startswith("image_")]))
    w = spread(wide.select(urls.alias("url")).where("url IS NOT NULL AND url <> ''").dropDuplicates())

    def run(it):
        for pdf in it:
            rows = []
            for u in pdf["url"]:
                try:
                    img = decode_any(synthetic_fetch(u))
                except (OSError, ValueError) as e:
                    rows.append((u, *[None] * 7, str(e)))
                    continue
                net = D.to_network_input(img)
                r90 = D.rotate(img, 90)
                g = D.grey_to_rgb(img[..., 0])
                c = D.crop(img, 4, 4, 40, 60)
                pad = D.pad_to(c, 3, 0, 42, 56)
                comp = D.composite_on_white(img, np.where(D.darkest(img) < 240, 255, 0))
                warp = D.warp_affine(img, np.array([[0.5, 0.0, 10.0], [0.0, 0.5, 5.0]]), 64, 48)
                rows.append((u, float(net.mean()), r90.shape[0], r90.shape[1], int(g.sum() % 1000003),
                             pad.shape[1], int(comp.sum() % 1000003), int(warp.sum() % 1000003), None))
            yield pd.DataFrame(rows, columns=["url", "net_mean", "rot_h", "rot_w", "grey_sum", "pad_w",
                                              "comp_sum", "warp_sum", "error"])
    return w.mapInPandas(run, "url string, net_mean double, rot_h int, rot_w int, grey_sum long, pad_w int, "
                              "comp_sum long, warp_sum long, error string")
