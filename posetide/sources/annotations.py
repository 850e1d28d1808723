"""Annotation and external-detection sources.

The annotation file is the usual keypoint JSON: ``images`` and
``annotations`` arrays in one document. Spark reads such a file in one task
(``read_coco``); ``read_coco_blocks`` cuts it into blocks of bytes that many
tasks read, and ``read_annotation_lines`` reads the one-per-line form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posetide.sources.json_blocks import BLOCK_BYTES, read_json_array

ANN_STRUCT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("image_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()), T.StructField("iscrowd", T.IntegerType()),
    T.StructField("bbox", T.ArrayType(T.DoubleType())), T.StructField("area", T.DoubleType()),
    T.StructField("keypoints", T.ArrayType(T.DoubleType())),
    T.StructField("foot_kpts", T.ArrayType(T.DoubleType())),
])
IMG_STRUCT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("width", T.IntegerType()),
    T.StructField("height", T.IntegerType()), T.StructField("file_name", T.StringType()),
])
DOC = T.StructType([T.StructField("images", T.ArrayType(IMG_STRUCT)),
                    T.StructField("annotations", T.ArrayType(ANN_STRUCT))])


def read_coco(spark: SparkSession, path: str, non_crowd: bool = True) -> tuple[DataFrame, DataFrame]:
    """(images, annotations) from keypoint JSON documents; crowd
    annotations dropped when ``non_crowd`` (the reference's iscrowd=False)."""
    doc = spark.read.option("multiLine", True).schema(DOC).json(path)
    images = doc.select(F.inline("images")).withColumnRenamed("id", "image_id")
    anns = doc.select(F.inline("annotations")).withColumnRenamed("id", "ann_id")
    if non_crowd:
        anns = anns.where(F.coalesce(F.col("iscrowd"), F.lit(0)) == 0)
    return images, anns


def read_coco_blocks(spark: SparkSession, path: str, non_crowd: bool = True,
                     block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The rows of ``read_coco``, each file read by as many tasks as it has
    blocks."""
    images = read_json_array(spark, path, "images", IMG_STRUCT, block_bytes).withColumnRenamed("id", "image_id")
    anns = read_json_array(spark, path, "annotations", ANN_STRUCT, block_bytes).withColumnRenamed("id", "ann_id")
    if non_crowd:
        anns = anns.where(F.coalesce(F.col("iscrowd"), F.lit(0)) == 0)
    return images, anns


def read_annotation_lines(spark: SparkSession, path: str) -> DataFrame:
    """A6 at scale: one annotation object per line (splittable)."""
    return spark.read.schema(ANN_STRUCT).json(path).withColumnRenamed("id", "ann_id")


def annotation_table(images: DataFrame, anns: DataFrame) -> DataFrame:
    """A6 -> the flat annotation table used by B8/C1/I1 (box split out,
    joined to the image size)."""
    return anns.join(images.select("image_id", "width", "height"), "image_id").select(
        "image_id", "ann_id", "category_id", "iscrowd", F.col("bbox")[0].alias("box_x"), F.col("bbox")[1].alias("box_y"),
        F.col("bbox")[2].alias("box_w"), F.col("bbox")[3].alias("box_h"), "area",
        F.array_max("keypoints").alias("max_kp"), F.array_max("foot_kpts").alias("max_foot"),
        "keypoints", "foot_kpts", "width", "height")


def read_external_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Person boxes from another detector, as a JSON object
    ``{image_id: [{"id": .., "clean_bbox": [x, y, w, h]}, ...]}`` per file.
    Returns image_id, ann_id, clean x, y, w, h (keypoints are absent in
    this mode, Q17)."""
    raw = spark.read.text(path, wholetext=True)
    m = F.from_json("value", T.MapType(T.StringType(), T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("clean_bbox", T.ArrayType(T.DoubleType()))]))))
    e = raw.select(F.explode(m).alias("image_id", "boxes")).select(
        F.col("image_id").cast("long").alias("image_id"), F.explode("boxes").alias("b"))
    return e.select("image_id", F.col("b.id").alias("ann_id"),
                    *[F.col("b.clean_bbox")[i].alias(c) for i, c in enumerate(("clean_x", "clean_y", "clean_w", "clean_h"))])


def read_detections(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Detections in the Detection schema from parquet or JSON lines."""
    from posetide.schema import DETECTION
    r = spark.read.schema(DETECTION)
    return r.parquet(path) if fmt == "parquet" else r.json(path)
