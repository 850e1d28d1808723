"""Registered queries: scans, projections, predicates, flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions import flags as B
from posetide.plans.registry import query
from posetide.schema import bone_dim, category_part_dim, joint_dim

HOST = "https://img.example.com"
CROP_ROOT = "/tmp/crops/"
PUBLIC_ROOT = "https://cdn.example.com/crops/"


@query("product_image_url", fx.with_fixtures(f"""
select product_id, category_id, concat('{HOST}', split_part(images, ',', 1)) img
from fx_products where image_512 != ''""", "fx_products"))
def q_product_image_url(spark, d):
    """A1 + B1 + B3: product scan, first image with host, non-empty 512 variant."""
    p = fx.fx_products(spark, d)
    return p.where(B.nonempty("image_512")).select(
        "product_id", "category_id", B.first_image_url("images", HOST).alias("img"))


@query("size_variant_url", fx.with_fixtures(f"""
select product_id,
  '{HOST}' || regexp_replace(image_1, '.jpg', '_512.jpg', 'g') img1,
  '{HOST}' || regexp_replace(image_2, '.jpg', '_512.jpg', 'g') img2,
  '{HOST}' || regexp_replace(image_3, '.jpg', '_512.jpg', 'g') img3,
  '{HOST}' || regexp_replace(image_4, '.jpg', '_512.jpg', 'g') img4
from fx_wide_images""", "fx_wide_images"))
def q_size_variant_url(spark, d):
    """B2: 512-px URL variant of four image columns (regex dot, null stays null)."""
    w = fx.fx_wide_images(spark, d)
    return w.select("product_id", *[B.size_variant_url(f"image_{i}", HOST).alias(f"img{i}") for i in range(1, 5)])


@query("nonempty_filter", fx.with_fixtures("""
select category_id, count(*) n_products, count(image_512) n_with_512 from fx_products
where image_512 != '' group by category_id""", "fx_products"))
def q_nonempty_filter(spark, d):
    """``image_512 != ''`` drops empty and null rows (pushed to the scan's
    projection); counted per category."""
    p = fx.fx_products(spark, d).where(B.nonempty("image_512"))
    return p.groupBy("category_id").agg(F.count(F.lit(1)).alias("n_products"),
                                        F.count("image_512").alias("n_with_512"))


@query("link_rewrite", fx.with_fixtures(f"""
select product_id, replace(concat('{CROP_ROOT}', cast(product_id as varchar), '_top-wear.jpg'),
  '{CROP_ROOT}', '{PUBLIC_ROOT}') link from fx_products""", "fx_products"))
def q_link_rewrite(spark, d):
    """Storage path -> public link (native replace, no UDF)."""
    p = fx.fx_products(spark, d)
    path = F.concat(F.lit(CROP_ROOT), F.col("product_id").cast("string"), F.lit("_top-wear.jpg"))
    return p.select("product_id", B.rewrite_prefix(path, CROP_ROOT, PUBLIC_ROOT).alias("link"))


@query("person_filter", fx.with_fixtures("""
select image_id, det_id, score from fx_detections where class_id = 0 and score > 0.35""", "fx_detections"))
def q_person_filter(spark, d):
    """Class 0 and score > 0.35."""
    return B.person_filter(fx.fx_detections(spark, d)).select("image_id", "det_id", "score")


@query("face_visible", fx.with_fixtures("""
select image_id, pose_id, bool_or(joint < 5 and v > 0.3) face
from fx_pose_joints group by image_id, pose_id""", "fx_pose_joints"))
def q_face_visible(spark, d):
    """Any face joint (0-4) with score > 0.3."""
    p = fx.fx_poses(spark, d)
    return p.select("image_id", "pose_id", B.face_visible("kv").alias("face"))


@query("flag_from_counts", fx.with_fixtures("""
select i.image_id,
  case when i.width % 97 = 0 then 'NA' when coalesce(c.n, 0) > 0 then 'true' else 'false' end flag
from fx_images i left join (
  select image_id, count(*) n from fx_detections where class_id = 0 and score > 0.35 group by image_id) c
on c.image_id = i.image_id""", "fx_images", "fx_detections"))
def q_flag_from_counts(spark, d):
    """B12: 'true'/'false'/'NA' from person counts; images whose decode
    failed (here: width % 97 == 0 stands for an error row) are 'NA'."""
    img = fx.fx_images(spark, d)
    n = B.person_filter(fx.fx_detections(spark, d)).groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))
    err = F.when(F.col("width") % 97 == 0, F.lit("decode"))
    return img.join(n, "image_id", "left").select("image_id", B.flag_from_count(err, F.col("n")).alias("flag"))


@query("category_lookup", fx.with_fixtures("""
select p.product_id, p.category_id, c.part
from fx_products p left join (values (1005, 'top-wear'), (1005, 'bottom-wear'), (1004, 'top-wear'),
  (1004, 'bottom-wear'), (1001, 'top-wear'), (1001, 'bottom-wear'), (1391, 'blouse'), (1007, 'blouse'),
  (1522, 'top-wear'), (1522, 'bottom-wear'), (1853, 'top-wear'), (1853, 'bottom-wear'), (1002, 'top-wear'),
  (1002, 'bottom-wear'), (1003, 'top-wear'), (1003, 'bottom-wear')) c(category_id, part)
on c.category_id = p.category_id""", "fx_products"))
def q_category_lookup(spark, d):
    """Broadcast LEFT join to the category config; an unknown category
    keeps its row with a null part (Q2: no exception path)."""
    p = fx.fx_products(spark, d).select("product_id", "category_id")
    return p.join(F.broadcast(category_part_dim(spark)), "category_id", "left").select(
        "product_id", "category_id", "part")


@query("joint_names", fx.with_fixtures("""
select h.person_id, h.joint, j.joint_name from fx_heatmaps h join (values
  (0, 'nose'), (1, 'left_eye'), (2, 'right_eye'), (3, 'left_ear'), (4, 'right_ear'), (5, 'neck'),
  (6, 'left_shoulder'), (7, 'right_shoulder'), (8, 'left_elbow'), (9, 'right_elbow'), (10, 'left_wrist'),
  (11, 'right_wrist'), (12, 'left_hip'), (13, 'right_hip'), (14, 'hip'), (15, 'left_knee'), (16, 'right_knee'),
  (17, 'left_ankle'), (18, 'right_ankle'), (19, 'left_big toe'), (20, 'left_small_toe'), (21, 'left_heel'),
  (22, 'right_big_toe'), (23, 'right_small_toe'), (24, 'right_heel')) j(joint, joint_name)
on j.joint = h.joint""", "fx_heatmaps"))
def q_joint_names(spark, d):
    """Joint id -> name through a broadcast 25-row dimension."""
    h = fx.fx_heatmaps(spark, d).select("person_id", "joint")
    return h.join(F.broadcast(joint_dim(spark)), "joint").select("person_id", "joint", "joint_name")


_BONES_VALUES = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(
    __import__("posetide.schema", fromlist=["SKELETON"]).SKELETON))


@query("bone_segments", fx.with_fixtures(f"""
select a.sample_id, s.bone, a.pred_x ax, a.pred_y ay, b.pred_x bx, b.pred_y by_
from fx_pose_pairs a join (values {_BONES_VALUES}) s(bone, joint_a, joint_b) on s.joint_a = a.joint
join fx_pose_pairs b on b.sample_id = a.sample_id and b.joint = s.joint_b
where a.score > 0.5 and b.score > 0.5""", "fx_pose_pairs"))
def q_bone_segments(spark, d):
    """B11 + B15: skeleton segments whose two end joints both score > 0.5
    (overlay geometry; rasterising is out of scope). Both sides of the join
    have a row a joint, so it is a merge join: Spark sizes an exploded table
    by its source and would broadcast it."""
    p = fx.fx_pose_pairs(spark, d).where(F.col("score") > 0.5).select(
        "sample_id", "joint", "pred_x", "pred_y")
    a = p.select("sample_id", F.col("joint").alias("joint_a"), F.col("pred_x").alias("ax"), F.col("pred_y").alias("ay"))
    b = p.select("sample_id", F.col("joint").alias("joint_b"), F.col("pred_x").alias("bx"), F.col("pred_y").alias("by_"))
    return (a.join(F.broadcast(bone_dim(spark)), "joint_a").join(b.hint("merge"), ["sample_id", "joint_b"])
            .select("sample_id", "bone", "ax", "ay", "bx", "by_"))


@query("point_mask", fx.with_fixtures("""
select sample_id, joint, pred_x, pred_y from fx_pose_pairs where score > 0.5""", "fx_pose_pairs"))
def q_point_mask(spark, d):
    """Points drawn only above the confidence threshold (0.5)."""
    return fx.fx_pose_pairs(spark, d).where(F.col("score") > 0.5).select("sample_id", "joint", "pred_x", "pred_y")


@query("box_labels", fx.with_fixtures("""
select video_id, frame_idx, obj, printf('#%d: %.2f', obj + 1, score) label,
  case when y1 > 20 then y1 - 5 else y1 + 20 end label_y from fx_frame_boxes""", "fx_frame_boxes"))
def q_box_labels(spark, d):
    """Box caption text and its baseline."""
    b = fx.fx_frame_boxes(spark, d)
    return b.select("video_id", "frame_idx", "obj", B.box_label(F.col("obj") + 1, "score").alias("label"),
                    B.label_y("y1").alias("label_y"))
