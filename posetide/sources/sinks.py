"""Sinks (A9-A15).

Everything is written by Spark's committers straight to the target URI
(shared storage), so a retried task never leaves partial files and there is
no executor-local staging or driver-side upload (Q16, A14).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posetide.schema import JOINT_NAMES


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    """A9."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    """A10: append to a managed table."""
    df.write.mode("append").saveAsTable(table)


def pose_frames_json(poses: DataFrame, video="video_id", frame="frame_idx", person="person_id",
                     joint="joint", x="x", y="y", score="score") -> DataFrame:
    """One JSON document per (video, frame):
    ``{"<person>": [[y, x, score], ...]}`` with joints in order, the
    reference's per-frame entry (points are (y, x, score), B13). Grouping is
    per frame and per person — bounded — never per video. Persons come in the
    order of their names."""
    pts = poses.groupBy(video, frame, person).agg(
        F.array_sort(F.collect_list(F.struct(F.col(joint).alias("j"),
                                             F.array(F.col(y), F.col(x), F.col(score)).alias("p")))).alias("js"))
    per = pts.select(video, frame, F.col(person).cast("string").alias("pid"),
                     F.transform("js", lambda s: s["p"]).alias("pts"))
    fr = per.groupBy(video, frame).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("pid", "pts")))).alias("m"))
    return fr.select(video, frame, F.to_json("m").alias("keypoints"))


def skeleton_json(spark) -> str:
    """A11 header: joint id -> name, written once per job."""
    import json
    return json.dumps({str(i): n for i, n in enumerate(JOINT_NAMES)})


def write_pose_json(poses: DataFrame, path: str, video="video_id", frame="frame_idx") -> None:
    """A11 sink: per video a folder of JSON lines in frame order, and the
    skeleton once, as ``_skeleton``. Rows are dealt by ranges of (video,
    frame), so a long video is written by several tasks; its files hold
    frames in order, and so do their rows."""
    docs = pose_frames_json(poses, video=video, frame=frame)
    (docs.repartitionByRange(video, frame).sortWithinPartitions(video, frame)
         .select(video, F.to_json(F.struct(frame, F.col("keypoints"))).alias("value"))
         .write.mode("overwrite").partitionBy(video).text(path))
    spark = poses.sparkSession
    (spark.range(1).select(F.lit(skeleton_json(spark)).alias("value")).coalesce(1)
     .write.mode("overwrite").text(path.rstrip("/") + "/_skeleton"))


def coco_keypoint_results(poses: DataFrame, image="image_id", person="person_id", joint="joint",
                          x="x", y="y", score="score", center=None, scale=None, category_id: int = 1) -> DataFrame:
    """One row per person: flat [x, y, s] * K in joint order, the mean
    joint score as the person score. ``center`` and ``scale`` name array columns
    of the person (the same in all its rows) that the result carries."""
    g = poses.groupBy(image, person).agg(
        F.array_sort(F.collect_list(F.struct(F.col(joint).alias("j"), F.col(x).alias("x"), F.col(y).alias("y"),
                                             F.col(score).alias("s")))).alias("js"),
        F.avg(score).alias("score"),
        *[F.max(c).alias(n) for n, c in (("center", center), ("scale", scale)) if c is not None])
    kp = F.flatten(F.transform("js", lambda s: F.array(s["x"], s["y"], s["s"])))
    out = g.select(F.col(image).alias("image_id"), F.lit(category_id).alias("category_id"),
                   kp.alias("keypoints"), F.col("score"),
                   *[F.col(n) for n, c in (("center", center), ("scale", scale)) if c is not None])
    return out


def write_coco_results(results: DataFrame, path: str) -> None:
    """A12 sink (JSON lines; the committer makes the write atomic, so the
    reference's truncated-file repair is not needed)."""
    results.write.mode("overwrite").json(path)


def crop_name(product_id, part) -> Column:
    """``{product}_{part with spaces as _}.jpg``."""
    return F.concat(F.col(product_id).cast("string") if isinstance(product_id, str) else product_id.cast("string"),
                    F.lit("_"), F.regexp_replace(F.col(part) if isinstance(part, str) else part, " ", "_"),
                    F.lit(".jpg"))


def result_names(path) -> dict[str, Column]:
    """``name_result.ext`` for the annotated media and ``name_result.json``
    for the keypoints, next to the input."""
    p = F.col(path) if isinstance(path, str) else path
    stem = F.regexp_extract(p, r"^(.*?)(\.[^./]*)?$", 1)
    ext = F.regexp_extract(p, r"(\.[^./]*)$", 1)
    return {"media_out": F.concat(stem, F.lit("_result"), ext),
            "json_out": F.concat(stem, F.lit("_result.json"))}
