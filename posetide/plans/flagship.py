"""Flagship query: person flags per product category.

detections -> person filter (B7) -> greedy NMS (G1) -> persons per image ->
flag (B12) -> product (join) -> category config (broadcast B16) ->
counts per category and flag.

Scale notes: the NMS never groups an image's boxes into one task (pair graph,
see operators.suppress); persons per image and the final counts are partial
aggregates; the image<->product join is left to AQE (its size depends on the
data), while the category config is a fixed 16-row table and broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions.flags import flag_from_count, person_filter
from posetide.operators.suppress import box_nms
from posetide.schema import category_part_dim

NMS_THR = 0.3


def persons_per_image(dets: DataFrame, thr: float = NMS_THR) -> DataFrame:
    kept = box_nms(person_filter(dets), thr=thr)
    return kept.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_persons"))


def category_flags(images: DataFrame, dets: DataFrame, products: DataFrame,
                   thr: float = NMS_THR) -> DataFrame:
    counts = persons_per_image(dets, thr)
    cfg = (category_part_dim(images.sparkSession)
           .groupBy("category_id").agg(F.count(F.lit(1)).alias("n_parts")))
    flagged = (images.select("image_id", "product_id")
               .join(counts, "image_id", "left")
               .withColumn("flag", flag_from_count(F.lit(None), F.col("n_persons"))))
    prod = products.select("product_id", "category_id")
    return (flagged.join(prod, "product_id")
            .join(F.broadcast(cfg), "category_id", "left")
            .groupBy("category_id", "flag")
            .agg(F.count(F.lit(1)).alias("n_images"),
                 F.coalesce(F.sum("n_persons"), F.lit(0)).cast("long").alias("n_persons"),
                 F.max("n_parts").cast("long").alias("n_parts")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_flags(fx.fx_images(spark, sf_dir), fx.fx_detections(spark, sf_dir),
                          fx.fx_products(spark, sf_dir))


NMS_SQL_TEMPLATE = """
nms_in as ({source}),
nms_ranked as (
  select *, row_number() over (partition by image_id order by score desc, det_id) rk,
         count(*) over (partition by image_id) n
  from nms_in),
nms_walk as (
  select image_id, 0::bigint rk, max(n) n,
         []::struct(det_id bigint, x1 double, y1 double, x2 double, y2 double)[] kept
  from nms_ranked group by image_id
  union all
  select w.image_id, w.rk + 1, w.n,
    case when coalesce(list_bool_or(list_transform(w.kept, lambda k:
        greatest(0.0, least(k.x2, d.x2) - greatest(k.x1, d.x1) + 1) * greatest(0.0, least(k.y2, d.y2) - greatest(k.y1, d.y1) + 1)
        / ((k.x2 - k.x1 + 1) * (k.y2 - k.y1 + 1) + (d.x2 - d.x1 + 1) * (d.y2 - d.y1 + 1)
           - greatest(0.0, least(k.x2, d.x2) - greatest(k.x1, d.x1) + 1) * greatest(0.0, least(k.y2, d.y2) - greatest(k.y1, d.y1) + 1))
        {op} {thr})), false)
      then w.kept
      else list_append(w.kept, {{'det_id': d.det_id, 'x1': d.x1, 'y1': d.y1, 'x2': d.x2, 'y2': d.y2}}) end
  from nms_walk w join nms_ranked d on d.image_id = w.image_id and d.rk = w.rk + 1),
nms_kept as (
  select w.image_id, unnest(w.kept, recursive := true) from nms_walk w where w.rk = w.n)
"""


def nms_sql(source: str, thr: float = NMS_THR, op: str = ">") -> str:
    """DuckDB oracle text for greedy NMS: a recursive walk in score order per
    image that carries the list of kept boxes (independent of our pair-graph
    algorithm). Defines CTEs nms_in .. nms_kept (image_id, det_id, x1..y2)."""
    return NMS_SQL_TEMPLATE.format(source=source, thr=thr, op=op)


FLAGSHIP_SQL = fx.with_fixtures("", "fx_images", "fx_detections", "fx_products", recursive=True).rstrip() + ",\n" + nms_sql(
    "select image_id, det_id, x1, y1, x2, y2, score from fx_detections where class_id = 0 and score > 0.35"
) + """,
counts as (select image_id, count(*) n_persons from nms_kept group by image_id),
cfg as (select * from (values (1005), (1005), (1004), (1004), (1001), (1001), (1391), (1007), (1522), (1522),
        (1853), (1853), (1002), (1002), (1003), (1003)) t(category_id)),
cfg_n as (select category_id, count(*) n_parts from cfg group by category_id),
flagged as (
  select i.image_id, i.product_id, c.n_persons,
         case when coalesce(c.n_persons, 0) > 0 then 'true' else 'false' end flag
  from fx_images i left join counts c on c.image_id = i.image_id)
select p.category_id, f.flag, count(*) n_images, cast(coalesce(sum(f.n_persons), 0) as bigint) n_persons,
       cast(max(g.n_parts) as bigint) n_parts
from flagged f join fx_products p on p.product_id = f.product_id
left join cfg_n g on g.category_id = p.category_id
group by p.category_id, f.flag
"""
