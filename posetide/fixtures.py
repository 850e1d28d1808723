"""Pose-shaped views derived from the driver's TPC-H-ish tables.

Each view exists twice: a Spark DataFrame builder (used by ``queries()``)
and a DuckDB SQL text (used by the oracle in ``oracle_sql()``). Both read
the whole tables; no id subsets or row caps. Keys stay unique:
``(l_orderkey, l_linenumber, l_partkey, l_suppkey)`` is the lineitem key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Keys here are non-negative, so pmod equals %; it is used because ANSI-mode
# % is several times slower in generated code.


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_key() -> Column:
    # unique per lineitem row within an order: (partkey, suppkey, linenumber,
    # quantity) — the smoke tables repeat (order, line, part, supplier) once
    return (((F.col("l_partkey") * 1000003 + F.col("l_suppkey")) * 8 + F.col("l_linenumber")) * 64
            + F.pmod(F.col("l_quantity").cast("long"), F.lit(64))).cast("long")


LINEITEM_KEY_SQL = "(((l_partkey * 1000003 + l_suppkey) * 8 + l_linenumber) * 64 + cast(l_quantity as bigint) % 64)"

# ---------------------------------------------------------------------------
# Spark builders
# ---------------------------------------------------------------------------


def fx_products(spark, d):
    p = table(spark, d, "part")
    k = F.col("p_partkey").cast("string")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        (F.lit(1001) + F.pmod(F.col("p_partkey"), F.lit(6))).cast("int").alias("category_id"),
        F.concat(F.lit("/images/p/"), k, F.lit("/a.jpg,/images/p/"), k, F.lit("/b.jpg")).alias("images"),
        F.when(F.pmod(F.col("p_partkey"), F.lit(7)) == 0, F.lit(""))
         .when(F.pmod(F.col("p_partkey"), F.lit(11)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("/images/p/"), k, F.lit("/a_512.jpg"))).alias("image_512"),
    )


def fx_images(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("image_id"),
        (F.lit(200) + F.pmod(F.col("o_custkey"), F.lit(600))).cast("int").alias("width"),
        (F.lit(200) + F.pmod((F.col("o_custkey") * 7), F.lit(600))).cast("int").alias("height"),
        (F.pmod(F.col("o_orderkey"), F.lit(200))).alias("product_id"),
    )


def fx_detections(spark, d):
    li = table(spark, d, "lineitem")
    bx = (F.pmod(F.col("l_partkey"), F.lit(40))).cast("double")
    by = (F.pmod(F.col("l_suppkey"), F.lit(40))).cast("double")
    return li.select(
        F.col("l_orderkey").alias("image_id"),
        _lineitem_key().alias("det_id"),
        bx.alias("x1"), by.alias("y1"),
        (bx + 10 + F.col("l_quantity")).alias("x2"),
        (by + 10 + F.col("l_quantity")).alias("y2"),
        (F.pmod((F.col("l_partkey") * 37), F.lit(1000))).cast("double").__truediv__(1000).alias("score"),
        (F.pmod(F.col("l_linenumber"), F.lit(3))).cast("int").alias("class_id"),
    )


def fx_pose_pairs(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = F.col("joint")
    c = F.col("o_custkey")
    gx = (F.pmod((c * 31 + j * 17), F.lit(192))).cast("double")
    gy = (F.pmod((c * 13 + j * 29), F.lit(256))).cast("double")
    return (o.select("*", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("joint"))
            .select(
                F.col("o_orderkey").alias("sample_id"), j.cast("int").alias("joint"),
                gx.alias("gt_x"), gy.alias("gt_y"),
                (gx + (F.pmod((c + j * 7), F.lit(11)) - 5)).alias("pred_x"),
                (gy + (F.pmod((c * 3 + j * 5), F.lit(11)) - 5)).alias("pred_y"),
                (F.pmod((c * 11 + j * 53), F.lit(100))).cast("double").__truediv__(100).alias("score"),
                (F.pmod((F.col("o_orderkey") + j), F.lit(4)) > 0).alias("visible"),
                (F.lit(20) + F.pmod(c, F.lit(80))).cast("double").alias("norm_x"),
                (F.lit(20) + F.pmod(c, F.lit(60))).cast("double").alias("norm_y")))


def fx_frames(spark, d):
    from pyspark.sql import Window as W
    e = table(spark, d, "events")
    w = W.partitionBy("user_id").orderBy("event_id")
    return e.select(
        F.col("user_id").alias("video_id"), "event_id",
        (F.row_number().over(w) - 1).cast("int").alias("frame_idx"),
        "ts", F.col("value").alias("x"))


def fx_frame_boxes(spark, d):
    """Three objects per frame; boxes drift right by 2 px per frame."""
    from pyspark.sql import Window as W
    e = table(spark, d, "events")
    w = W.partitionBy("user_id").orderBy("event_id")
    rn = F.row_number().over(w) - 1
    base = e.select(F.col("user_id").alias("video_id"),
                    F.floor(rn / 3).cast("int").alias("frame_idx"),
                    (rn % 3).cast("int").alias("obj"), "ts", "event_id", "value")
    x1 = (F.col("obj") * 60 + F.col("frame_idx") * 2).cast("double") + F.pmod(F.floor("value"), F.lit(3)).cast("double")
    y1 = (F.lit(40) + F.col("obj") * 5).cast("double")
    return base.select("video_id", "frame_idx", "obj", "ts", "event_id",
                       x1.alias("x1"), y1.alias("y1"),
                       (x1 + 40).alias("x2"), (y1 + 80).alias("y2"),
                       F.lit(0.9).alias("score"))


def fx_heatmaps(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("person_id"), F.col("label").cast("int").alias("joint"),
                    F.lit(8).alias("h"), F.lit(8).alias("w"),
                    F.transform("embedding", lambda v: v.cast("double")).alias("hm"))


def fx_peaks(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("image_id"), (F.col("l_linenumber") - 1).cast("int").alias("joint"),
        _lineitem_key().alias("peak_id"),
        (F.pmod(F.col("l_partkey"), F.lit(48))).cast("int").alias("x"), (F.pmod(F.col("l_partkey"), F.lit(64))).cast("int").alias("y"),
        (F.pmod((F.col("l_partkey") * 37), F.lit(1000))).cast("double").__truediv__(1000).alias("val"),
        ((F.pmod(F.col("l_suppkey"), F.lit(3))).cast("double") + (F.pmod(F.col("l_partkey"), F.lit(10))).cast("double") / 100).alias("tag"))


def fx_multilabel(spark, d):
    lb = table(spark, d, "labels")
    return lb.select(
        F.col("doc_id").alias("sample_id"), F.col("quality").alias("gt_a"), F.col("toxic").alias("gt_b"),
        (F.pmod((F.col("doc_id") * 37), F.lit(100))).cast("double").__truediv__(100).alias("pred_a"),
        (F.pmod((F.col("doc_id") * 53), F.lit(100))).cast("double").__truediv__(100).alias("pred_b"),
        F.when(F.pmod(F.col("doc_id"), F.lit(5)) == 0, 0).otherwise(1).alias("mask_a"), F.lit(1).alias("mask_b"))


def fx_wide_images(spark, d):
    pg = table(spark, d, "pages")
    return pg.select(
        F.col("page_id").alias("product_id"), F.col("url").alias("image_1"),
        F.when(F.pmod(F.col("page_id"), F.lit(5)) == 0, F.lit(None).cast("string")).otherwise(F.col("url")).alias("image_2"),
        F.concat(F.col("url"), F.lit(".jpg")).alias("image_3"),
        F.replace(F.col("url"), F.lit(".html"), F.lit(".jpg")).alias("image_4"))


def fx_annotations(spark, d):
    li = table(spark, d, "lineitem")
    q = F.col("l_quantity")
    return li.select(
        F.col("l_orderkey").alias("image_id"), _lineitem_key().alias("ann_id"),
        (F.pmod(F.col("l_linenumber"), F.lit(2)) + 1).cast("int").alias("category_id"),
        F.when(F.col("l_linenumber") == 7, 1).otherwise(0).alias("iscrowd"),
        (F.pmod(F.col("l_partkey"), F.lit(300)) - 20).cast("double").alias("box_x"),
        (F.col("l_suppkey") * 3 - 20).cast("double").alias("box_y"),
        (q * 4).alias("box_w"), (q * 6 - 10).alias("box_h"), (q * q - 4).alias("area"),
        F.when(F.col("l_discount") == 0, 0.0).otherwise(2.0).alias("max_kp"),
        F.when(F.col("l_tax") == 0, 0.0).otherwise(2.0).alias("max_foot"))


def fx_ann_keypoints(spark, d):
    """Long form of the 23 source keypoints (17 body + 6 foot) per annotation."""
    li = table(spark, d, "lineitem")
    k = F.col("src")
    return (li.select(F.col("l_orderkey").alias("image_id"), _lineitem_key().alias("ann_id"),
                      "l_partkey", "l_suppkey", "l_quantity",
                      F.explode(F.sequence(F.lit(0), F.lit(22))).alias("src"))
            .select("image_id", "ann_id", k.cast("int").alias("src"),
                    ((F.pmod(F.col("l_partkey"), F.lit(300))) + F.pmod((F.col("l_partkey") + k * 7), F.lit(40))).cast("double").alias("x"),
                    ((F.col("l_suppkey") * 3) + F.pmod((F.col("l_suppkey") + k * 11), F.lit(60))).cast("double").alias("y"),
                    (F.pmod((F.col("l_partkey") + k), F.lit(3))).cast("double").alias("v")))


def _wrap(r, c: int, m: int) -> Column:
    """(r + c) mod m for 0 <= r < m: one compare instead of a division."""
    c = c % m
    return F.when(r + c >= m, r + (c - m)).otherwise(r + c)


def fx_ann_arrays(spark, d):
    """The same 23 source keypoints as arrays (the annotation JSON layout).
    Remainders are taken once per row; each element is a constant shift of
    it, so the generated code stays small."""
    li = table(spark, d, "lineitem")
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    base = li.select(F.col("l_orderkey").alias("image_id"), _lineitem_key().alias("ann_id"),
                     F.pmod(pk, F.lit(300)).alias("p300"), F.pmod(pk, F.lit(40)).alias("p40"),
                     (sk * 3).alias("s3"), F.pmod(sk, F.lit(60)).alias("s60"), F.pmod(pk, F.lit(3)).alias("p3"))
    p300, p40, s3, s60, p3 = (F.col(c) for c in ("p300", "p40", "s3", "s60", "p3"))
    return base.select(
        "image_id", "ann_id",
        F.array(*[(p300 + _wrap(p40, 7 * k, 40)).cast("double") for k in range(23)]).alias("kx"),
        F.array(*[(s3 + _wrap(s60, 11 * k, 60)).cast("double") for k in range(23)]).alias("ky"),
        F.array(*[_wrap(p3, k, 3).cast("double") for k in range(23)]).alias("kv"))


def fx_poses(spark, d, num_joints: int = 17):
    """One pose per lineitem: joint arrays kx, ky, kv plus score and area."""
    li = table(spark, d, "lineitem")
    base = li.select(
        F.col("l_orderkey").alias("image_id"), _lineitem_key().alias("pose_id"),
        (F.pmod(F.col("l_partkey") * 37, F.lit(1000))).cast("double").__truediv__(1000).alias("score"),
        (F.col("l_quantity") * 400).alias("area"),
        (F.pmod(F.col("l_partkey"), F.lit(40)) + F.pmod(F.col("l_linenumber"), F.lit(3))).alias("x0"),
        F.pmod(F.col("l_suppkey"), F.lit(40)).alias("y0"), F.pmod(F.col("l_partkey"), F.lit(4)).alias("p4"))
    x0, y0, p4 = F.col("x0"), F.col("y0"), F.col("p4")
    return base.select(
        "image_id", "pose_id", "score", "area",
        F.array(*[(x0 + j * 2).cast("double") for j in range(num_joints)]).alias("kx"),
        F.array(*[(y0 + j * 3).cast("double") for j in range(num_joints)]).alias("ky"),
        F.array(*[_wrap(p4, j, 4).cast("double") / 3 for j in range(num_joints)]).alias("kv"))


def fx_tags(spark, d):
    """Per (image, person, joint) embedding tags for the associative loss."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("image_id"), (F.pmod(F.col("l_suppkey"), F.lit(3))).cast("int").alias("person"),
        (F.col("l_linenumber") - 1).cast("int").alias("joint"),
        _lineitem_key().alias("tag_id"),
        ((F.pmod(F.col("l_suppkey"), F.lit(3))).cast("double") + (F.pmod(F.col("l_partkey"), F.lit(10))).cast("double") / 10).alias("tag"),
        F.when(F.col("l_discount") > 0, 1).otherwise(0).alias("visible"))


# ---------------------------------------------------------------------------
# DuckDB twins (CTE bodies)
# ---------------------------------------------------------------------------

SQL = {
    "fx_products": """
select p_partkey product_id, cast(1001 + (p_partkey % 6) as integer) category_id,
  concat('/images/p/', cast(p_partkey as varchar), '/a.jpg,/images/p/', cast(p_partkey as varchar), '/b.jpg') images,
  case when p_partkey % 7 = 0 then '' when p_partkey % 11 = 0 then null
       else concat('/images/p/', cast(p_partkey as varchar), '/a_512.jpg') end image_512
from part""",
    "fx_images": """
select o_orderkey image_id, cast(200 + (o_custkey % 600) as integer) width,
  cast(200 + ((o_custkey * 7) % 600) as integer) height, o_orderkey % 200 product_id from orders""",
    "fx_detections": f"""
select l_orderkey image_id, {LINEITEM_KEY_SQL} det_id,
  cast(l_partkey % 40 as double) x1, cast(l_suppkey % 40 as double) y1,
  cast(l_partkey % 40 as double) + 10 + l_quantity x2, cast(l_suppkey % 40 as double) + 10 + l_quantity y2,
  cast((l_partkey * 37) % 1000 as double) / 1000 score, cast(l_linenumber % 3 as integer) class_id from lineitem""",
    "fx_pose_pairs": """
select o_orderkey sample_id, cast(joint as integer) joint,
  cast((o_custkey * 31 + joint * 17) % 192 as double) gt_x, cast((o_custkey * 13 + joint * 29) % 256 as double) gt_y,
  cast((o_custkey * 31 + joint * 17) % 192 as double) + ((o_custkey + joint * 7) % 11 - 5) pred_x,
  cast((o_custkey * 13 + joint * 29) % 256 as double) + ((o_custkey * 3 + joint * 5) % 11 - 5) pred_y,
  cast((o_custkey * 11 + joint * 53) % 100 as double) / 100 score, (o_orderkey + joint) % 4 > 0 visible,
  cast(20 + o_custkey % 80 as double) norm_x, cast(20 + o_custkey % 60 as double) norm_y
from orders, (select unnest(range(25)) as joint) t""",
    "fx_frames": """
select user_id video_id, event_id,
  cast(row_number() over (partition by user_id order by event_id) - 1 as integer) frame_idx, ts, value x from events""",
    "fx_frame_boxes": """
select video_id, frame_idx, obj, ts, event_id,
  cast(obj * 60 + frame_idx * 2 as double) + cast(((floor(value)::bigint % 3) + 3) % 3 as double) x1,
  cast(40 + obj * 5 as double) y1,
  cast(obj * 60 + frame_idx * 2 as double) + cast(((floor(value)::bigint % 3) + 3) % 3 as double) + 40 x2,
  cast(40 + obj * 5 as double) + 80 y2, 0.9::double score
from (select user_id video_id,
  cast(floor((row_number() over (partition by user_id order by event_id) - 1) / 3) as integer) frame_idx,
  cast((row_number() over (partition by user_id order by event_id) - 1) % 3 as integer) obj, ts, event_id, value from events) b""",
    "fx_heatmaps": """
select vec_id person_id, cast(label as integer) joint, 8 h, 8 w,
  list_transform(embedding, lambda v: cast(v as double)) hm from embeddings""",
    "fx_peaks": f"""
select l_orderkey image_id, cast(l_linenumber - 1 as integer) joint, {LINEITEM_KEY_SQL} peak_id,
  cast(l_partkey % 48 as integer) x, cast(l_partkey % 64 as integer) y,
  cast((l_partkey * 37) % 1000 as double) / 1000 val,
  cast(l_suppkey % 3 as double) + cast(l_partkey % 10 as double) / 100 tag from lineitem""",
    "fx_multilabel": """
select doc_id sample_id, quality gt_a, toxic gt_b, cast((doc_id * 37) % 100 as double) / 100 pred_a,
  cast((doc_id * 53) % 100 as double) / 100 pred_b, case when doc_id % 5 = 0 then 0 else 1 end mask_a, 1 mask_b from labels""",
    "fx_wide_images": """
select page_id product_id, url image_1, case when page_id % 5 = 0 then null else url end image_2,
  concat(url, '.jpg') image_3, replace(url, '.html', '.jpg') image_4 from pages""",
    "fx_annotations": f"""
select l_orderkey image_id, {LINEITEM_KEY_SQL} ann_id, cast(l_linenumber % 2 + 1 as integer) category_id,
  case when l_linenumber = 7 then 1 else 0 end iscrowd,
  cast(l_partkey % 300 - 20 as double) box_x, cast(l_suppkey * 3 - 20 as double) box_y,
  l_quantity * 4 box_w, l_quantity * 6 - 10 box_h, l_quantity * l_quantity - 4 area,
  case when l_discount = 0 then 0.0 else 2.0 end max_kp, case when l_tax = 0 then 0.0 else 2.0 end max_foot from lineitem""",
    "fx_ann_keypoints": f"""
select l_orderkey image_id, {LINEITEM_KEY_SQL} ann_id, cast(src as integer) src,
  cast((l_partkey % 300) + (l_partkey + src * 7) % 40 as double) x,
  cast((l_suppkey * 3) + (l_suppkey + src * 11) % 60 as double) y,
  cast((l_partkey + src) % 3 as double) v
from lineitem, (select unnest(range(23)) as src) t""",
    "fx_pose_joints": f"""
select l_orderkey image_id, {LINEITEM_KEY_SQL} pose_id, cast(j as integer) joint,
  cast((l_partkey % 40) + j * 2 + l_linenumber % 3 as double) x,
  cast((l_suppkey % 40) + j * 3 as double) y,
  cast((l_partkey + j) % 4 as double) / 3 v
from lineitem, (select unnest(range(17)) as j) t""",
    "fx_pose_rows": f"""
select l_orderkey image_id, {LINEITEM_KEY_SQL} pose_id,
  cast((l_partkey * 37) % 1000 as double) / 1000 score, l_quantity * 400 area from lineitem""",
    "fx_tags": f"""
select l_orderkey image_id, cast(l_suppkey % 3 as integer) person, cast(l_linenumber - 1 as integer) joint,
  {LINEITEM_KEY_SQL} tag_id,
  cast(l_suppkey % 3 as double) + cast(l_partkey % 10 as double) / 10 tag,
  case when l_discount > 0 then 1 else 0 end visible from lineitem""",
}


def with_fixtures(body: str, *names: str, recursive: bool = False) -> str:
    """Prefix an oracle query with the CTEs of the fixture views it uses."""
    ctes = ",\n".join(f"{n} as ({SQL[n]}\n)" for n in names)
    kw = "with recursive" if recursive else "with"
    return f"{kw} {ctes}\n{body}"
