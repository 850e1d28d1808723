"""Registered queries: box geometry (C1-C10) and annotation validity."""

from __future__ import annotations

from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions import boxes as C
from posetide.functions.numeric import rnd, rnd_sql
from posetide.plans.registry import query
from posetide.schema import PART_SPEC

_VALID_SQL = """
va as (
  select a.image_id, a.ann_id, a.area,
    greatest(0.0, a.box_x) cx1, greatest(0.0, a.box_y) cy1,
    least(i.width - 1.0, greatest(0.0, a.box_x) + greatest(0.0, a.box_w - 1)) cx2,
    least(i.height - 1.0, greatest(0.0, a.box_y) + greatest(0.0, a.box_h - 1)) cy2
  from fx_annotations a join fx_images i on i.image_id = a.image_id
  where a.iscrowd = 0 and a.category_id = 1 and not (a.max_kp = 0 and a.max_foot = 0)),
valid as (
  select image_id, ann_id, cx1 clean_x, cy1 clean_y, cx2 - cx1 clean_w, cy2 - cy1 clean_h
  from va where area > 0 and cx2 >= cx1 and cy2 >= cy1)
"""


def valid_annotations(spark, d):
    """A6 + B8 + C1: non-crowd person annotations with keypoints, boxes
    clipped to the image, invalid boxes dropped."""
    a = fx.fx_annotations(spark, d)
    i = fx.fx_images(spark, d).select("image_id", "width", "height")
    a = a.where((F.col("iscrowd") == 0) & (F.col("category_id") == 1)
                & ~((F.col("max_kp") == 0) & (F.col("max_foot") == 0)))
    clip = C.clip_xywh("box_x", "box_y", "box_w", "box_h", "width", "height")
    j = a.join(i, "image_id").select("image_id", "ann_id", "area", *[v.alias(k) for k, v in clip.items()])
    return j.where((F.col("area") > 0) & F.col("box_ok")).drop("box_ok", "area")


@query("valid_annotations", fx.with_fixtures("with " + _VALID_SQL.strip() + """
select * from valid""", "fx_annotations", "fx_images").replace("\nwith va as", ",\nva as"))
def q_valid_annotations(spark, d):
    """A6 + B8 + C1."""
    return valid_annotations(spark, d)


@query("box_center_scale", fx.with_fixtures("with " + _VALID_SQL.strip() + """
, cs as (
  select image_id, ann_id, clean_x + clean_w * 0.5 cx, clean_y + clean_h * 0.5 cy,
    case when clean_w < 0.75 * clean_h then clean_h * 0.75 else clean_w end w2,
    case when clean_w > 0.75 * clean_h then clean_w / 0.75 else clean_h end h2
  from valid)
select image_id, ann_id, """ + rnd_sql("cx") + """ center_x, """ + rnd_sql("cy") + """ center_y,
  """ + rnd_sql("w2 / 200.0 * (case when cx <> -1 then 1.25 else 1.0 end)") + """ scale_x,
  """ + rnd_sql("h2 / 200.0 * (case when cx <> -1 then 1.25 else 1.0 end)") + """ scale_y,
  """ + rnd_sql("(w2 / 200.0 * (case when cx <> -1 then 1.25 else 1.0 end) * 200.0) * (h2 / 200.0 * (case when cx <> -1 then 1.25 else 1.0 end) * 200.0)", 4) + """ area
from cs""", "fx_annotations", "fx_images").replace("\nwith va as", ",\nva as"))
def q_box_center_scale(spark, d):
    """C2 + C10: centre/scale at 3:4 aspect, /200, x1.25; result-box area."""
    v = valid_annotations(spark, d)
    cs = C.xywh_to_center_scale("clean_x", "clean_y", "clean_w", "clean_h")
    v = v.select("image_id", "ann_id", *[c.alias(k) for k, c in cs.items()])
    rb = C.result_box("center_x", "center_y", "scale_x", "scale_y", F.lit(1.0))
    return v.select("image_id", "ann_id", *[rnd(k).alias(k) for k in cs],
                    rnd(rb["area"], 4).alias("area"))


_PAD_SQL = """
pc as (
  select d.image_id, d.det_id,
    least(greatest(cast(round_even(d.x1, 0) as bigint) - 10, 0), i.width) bx1,
    least(greatest(cast(round_even(d.y1, 0) as bigint) - 10, 0), i.height) by1,
    least(greatest(cast(round_even(d.x2, 0) as bigint) + 10, 0), i.width) bx2,
    least(greatest(cast(round_even(d.y2, 0) as bigint) + 10, 0), i.height) by2
  from fx_detections d join fx_images i on i.image_id = d.image_id)
"""


def _pad_clip(spark, d):
    dets = fx.fx_detections(spark, d)
    img = fx.fx_images(spark, d).select("image_id", "width", "height")
    rp = C.round_pad_clip("x1", "y1", "x2", "y2", "width", "height")
    return dets.join(img, "image_id").select("image_id", "det_id", *[v.alias(k) for k, v in rp.items()])


@query("box_pad_clip", fx.with_fixtures(", " + _PAD_SQL.strip() + """
select * from pc""", "fx_detections", "fx_images").replace(")\n, pc as", "),\npc as"))
def q_box_pad_clip(spark, d):
    """Half-even rounding, 10 px padding, clip to the image."""
    return _pad_clip(spark, d)


@query("aspect_pad", fx.with_fixtures(", " + _PAD_SQL.strip() + """
, ap as (select image_id, det_id, bx1, by1, bx2 - bx1 bw, by2 - by1 bh from pc),
pads as (select image_id, det_id, bx1, by1, bw, bh,
  case when bh <= 0 then null when bw / bh < 0.75 then floor((cast(trunc(0.75 * bh) as bigint) - bw) / 2) else 0 end left_pad,
  case when bh <= 0 then null when bw / bh < 0.75 then 0 else floor((cast(trunc(bw / 0.75) as bigint) - bh) / 2) end top_pad
  from ap)
select image_id, det_id, cast(left_pad as bigint) left_pad, cast(top_pad as bigint) top_pad,
  cast(bx1 - left_pad as double) origin_x, cast(by1 - top_pad as double) origin_y from pads""",
                                     "fx_detections", "fx_images").replace(")\n, pc as", "),\npc as"))
def q_aspect_pad(spark, d):
    """C4 + C5: pad the crop to 3:4 and map the crop origin back to the image."""
    pc = _pad_clip(spark, d)
    ap = C.aspect_pad(F.col("bx2") - F.col("bx1"), F.col("by2") - F.col("by1"))
    pc = pc.select("image_id", "det_id", "bx1", "by1", ap["left_pad"].alias("left_pad"), ap["top_pad"].alias("top_pad"))
    back = C.crop_to_image(F.lit(0.0), F.lit(0.0), "bx1", "by1", "left_pad", "top_pad")
    return pc.select("image_id", "det_id", "left_pad", "top_pad",
                     back["img_x"].cast("double").alias("origin_x"), back["img_y"].cast("double").alias("origin_y"))


@query("box_z_roundtrip", fx.with_fixtures("""
select image_id, det_id, """ + rnd_sql("x1 + (x2 - x1) / 2.0") + """ zx, """ + rnd_sql("y1 + (y2 - y1) / 2.0") + """ zy,
  """ + rnd_sql("(x2 - x1) * (y2 - y1)") + """ zs, """ + rnd_sql("(x2 - x1) / (y2 - y1)") + """ zr,
  """ + rnd_sql("(x1 + (x2 - x1) / 2.0) - sqrt((x2 - x1) * (y2 - y1) * ((x2 - x1) / (y2 - y1))) / 2.0") + """ rx1,
  """ + rnd_sql("(y1 + (y2 - y1) / 2.0) + ((x2 - x1) * (y2 - y1)) / sqrt((x2 - x1) * (y2 - y1) * ((x2 - x1) / (y2 - y1))) / 2.0") + """ ry2
from fx_detections""", "fx_detections"))
def q_box_z_roundtrip(spark, d):
    """Box -> (cx, cy, area, ratio) -> box."""
    z = C.box_to_z("x1", "y1", "x2", "y2")
    dz = fx.fx_detections(spark, d).select("image_id", "det_id", *[v.alias(k) for k, v in z.items()])
    b = C.z_to_box("zx", "zy", "zs", "zr")
    return dz.select("image_id", "det_id", *[rnd(k).alias(k) for k in ("zx", "zy", "zs", "zr")],
                     rnd(b["x1"]).alias("rx1"), rnd(b["y2"]).alias("ry2"))


_PART_JOINTS = ", ".join(f"('{p}', {j}, {bl}, {bt}, {br}, {bb})"
                         for p, lo, hi, bl, bt, br, bb in PART_SPEC for j in range(lo, hi))


from posetide.schema import part_joint_dim  # noqa: E402


@query("part_crop_box", fx.with_fixtures(f"""
select s.sample_id, pj.part,
  greatest(0, cast(trunc(min(s.pred_x)) as bigint) - i.width // min(pj.bl)) crop_x1,
  greatest(0, cast(trunc(min(s.pred_y)) as bigint) - i.height // min(pj.bt)) crop_y1,
  least(i.width, cast(trunc(max(s.pred_x)) as bigint) + i.width // min(pj.br)) crop_x2,
  least(i.height, cast(trunc(max(s.pred_y)) as bigint) + i.height // min(pj.bb)) crop_y2
from fx_pose_pairs s join (values {_PART_JOINTS}) pj(part, joint, bl, bt, br, bb) on pj.joint = s.joint
join fx_images i on i.image_id = s.sample_id
group by s.sample_id, pj.part, i.width, i.height""", "fx_pose_pairs", "fx_images"))
def q_part_crop_box(spark, d):
    """Body-part crop per person: joint extents over the part's joints
    (equi-join to a 45-row part/joint table), buffer side // divisor."""
    s = fx.fx_pose_pairs(spark, d).select("sample_id", "joint", "pred_x", "pred_y")
    ext = (s.join(F.broadcast(part_joint_dim(spark)), "joint")
           .groupBy("sample_id", "part")
           .agg(F.min("pred_x").alias("min_x"), F.min("pred_y").alias("min_y"),
                F.max("pred_x").alias("max_x"), F.max("pred_y").alias("max_y"),
                F.min("bl").alias("bl"), F.min("bt").alias("bt"), F.min("br").alias("br"), F.min("bb").alias("bb")))
    img = fx.fx_images(spark, d).select(F.col("image_id").alias("sample_id"), "width", "height")
    crop = C.part_crop_box("min_x", "min_y", "max_x", "max_y", "width", "height", "bl", "bt", "br", "bb")
    return ext.join(img, "sample_id").select("sample_id", "part", *[v.alias(k) for k, v in crop.items()])
