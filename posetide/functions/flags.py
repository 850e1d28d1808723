"""Projections, predicates and flags (B1-B16) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posetide.schema import FACE_JOINTS, FACE_SCORE_THR, PERSON_CLASS, PERSON_SCORE_THR, SMALL_IMAGE_SIDE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_image_url(images, host: str) -> Column:
    """B1: host + first entry of a comma-separated path list."""
    return F.concat(F.lit(host), F.split_part(_c(images), F.lit(","), F.lit(1)))


def size_variant_url(path, host: str, suffix: str = "_512.jpg", pattern: str = ".jpg") -> Column:
    """B2: host + path with every match of ``pattern`` (a regex: the dot
    matches any character, as in the reference) replaced. Null stays null."""
    return F.concat(F.lit(host), F.regexp_replace(_c(path), pattern, suffix))


def nonempty(col) -> Column:
    """``col != ''`` — false for empty, null (dropped by filter) for null."""
    return _c(col) != F.lit("")


def rewrite_prefix(path, old: str, new: str) -> Column:
    """Literal prefix rewrite of storage paths to public links."""
    return F.replace(_c(path), F.lit(old), F.lit(new))


def person_filter(dets: DataFrame, class_col: str = "class_id", score_col: str = "score",
                  person_class: int = PERSON_CLASS, thr: float = PERSON_SCORE_THR) -> DataFrame:
    """Person detections above the detector confidence (strict >)."""
    return dets.where((F.col(class_col) == person_class) & (F.col(score_col) > thr))


def flag_from_count(error, n) -> Column:
    """B12: 'NA' when the image failed (error not null), else 'true' when at
    least one person, else 'false' (quirk Q1: lower-case only)."""
    error, n = _c(error), _c(n)
    return (F.when(error.isNotNull(), F.lit("NA"))
             .when(F.coalesce(n, F.lit(0)) > 0, F.lit("true"))
             .otherwise(F.lit("false")))


def small_image(width, height, side: int = SMALL_IMAGE_SIDE) -> Column:
    """Both sides below ``side`` -> no crops are cut."""
    return (_c(width) < side) & (_c(height) < side)


def face_visible(scores, thr: float = FACE_SCORE_THR, joints=FACE_JOINTS) -> Column:
    """Any of the face joints scores above ``thr`` (array of scores)."""
    lo, hi = joints
    return F.exists(F.slice(_c(scores), lo + 1, hi - lo), lambda s: s > thr)


def bool_flag(b) -> Column:
    """Boolean -> 'true'/'false', null -> 'NA'."""
    b = _c(b)
    return F.when(b.isNull(), F.lit("NA")).when(b, F.lit("true")).otherwise(F.lit("false"))


def box_label(track_id, score) -> Column:
    """Box caption ``#id: score`` with two decimals."""
    return F.format_string("#%d: %.2f", _c(track_id).cast("long"), _c(score).cast("double"))


def label_y(y1) -> Column:
    """Caption baseline above the box, or inside it near the top edge."""
    y1 = _c(y1)
    return F.when(y1 > 20, y1 - 5).otherwise(y1 + 20)
