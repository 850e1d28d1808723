"""Schemas and small fixed dimension tables.

The constants below are FIXED VALUES that must equal the reference's for
results to match (joint names, skeleton edges, flip pairs, body-part crop
rules, normalisation constants, OKS sigmas). They are listed plainly, in
their natural order, and turned into tiny dimension DataFrames that are
broadcast by size (a few dozen rows, independent of data volume).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference)
# ---------------------------------------------------------------------------

# 25-joint body model: joint id -> name.
JOINT_NAMES = [
    "nose", "left_eye", "right_eye", "left_ear", "right_ear", "neck",
    "left_shoulder", "right_shoulder", "left_elbow", "right_elbow",
    "left_wrist", "right_wrist", "left_hip", "right_hip", "hip",
    "left_knee", "right_knee", "left_ankle", "right_ankle",
    "left_big toe", "left_small_toe", "left_heel",
    "right_big_toe", "right_small_toe", "right_heel",
]

# Skeleton edges (joint a, joint b) in the reference's order.
SKELETON = [
    (17, 15), (15, 12), (18, 16), (16, 13), (12, 14), (13, 14), (5, 14),
    (6, 5), (7, 5), (6, 8), (7, 9), (8, 10), (9, 11), (1, 2), (0, 1), (0, 2),
    (1, 3), (2, 4), (17, 21), (18, 24), (19, 20), (22, 23), (19, 21),
    (22, 24), (5, 0),
]

# Left/right joint pairs swapped by a horizontal mirror.
FLIP_PAIRS = [(1, 2), (3, 4), (6, 7), (8, 9), (10, 11), (12, 13),
              (15, 16), (17, 18), (19, 22), (20, 23), (21, 24)]

# Weight of each joint in the training loss, joints 0 to 24.
JOINT_WEIGHTS = [
    1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.2, 1.2, 1.5, 1.5, 1.0, 1.0, 1.0,
    1.2, 1.2, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5,
]

# Joints used for the half-body draw.
UPPER_BODY_IDS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
LOWER_BODY_IDS = [11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22]

# Per-joint loss weights of the 25-joint model.
JOINTS_WEIGHT = [1., 1., 1., 1., 1., 1., 1., 1., 1.2, 1.2, 1.5, 1.5, 1., 1.,
                 1., 1.2, 1.2, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5, 1.5]

# Source annotation (17 body + 6 foot = 23 values) -> 25-joint slot.
# Slots 5 (neck) and 14 (hip) are synthesised.
ANNOTATION_SLOTS = [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12, 13,
                    15, 16, 17, 18, 19, 20, 21, 22, 23, 24]

# Default OKS sigmas (17 body joints), before the /10.
OKS_SIGMAS_X10 = [.26, .25, .25, .35, .35, .79, .79, .72, .72, .62, .62,
                  1.07, 1.07, .87, .87, .89, .89]
OKS_SIGMAS = [s / 10.0 for s in OKS_SIGMAS_X10]

# Image normalisation for the pose network input.
PIXEL_MEAN = [0.485, 0.456, 0.406]
PIXEL_STD = [0.229, 0.224, 0.225]
POSE_INPUT_WH = (192, 256)
HEATMAP_WH = (48, 64)
PIXEL_STD_UNIT = 200.0

# Body-part crop rules: part -> (first joint, end joint exclusive,
# buffer divisors left, top, right, bottom).
PART_SPEC = [
    ("full body", 5, 15, 10, 10, 10, 10),
    ("top-wear", 5, 10, 5, 15, 5, 5),
    ("blouse", 5, 10, 5, 10, 5, 5),
    ("bottom-wear", 12, 22, 5, 15, 5, 5),
    ("zoom on fabric top", 5, 8, 5, 15, 5, 5),
    ("dupatta", 5, 13, 1, 5, 20, 5),
]
# Face check joints (half-open) and its score threshold.
FACE_JOINTS = (0, 5)
FACE_SCORE_THR = 0.3
# Category -> parts to cut out.
CATEGORY_PARTS = [
    (1005, "top-wear"), (1005, "bottom-wear"),
    (1004, "top-wear"), (1004, "bottom-wear"),
    (1001, "top-wear"), (1001, "bottom-wear"),
    (1391, "blouse"),
    (1007, "blouse"),
    (1522, "top-wear"), (1522, "bottom-wear"),
    (1853, "top-wear"), (1853, "bottom-wear"),
    (1002, "top-wear"), (1002, "bottom-wear"),
    (1003, "top-wear"), (1003, "bottom-wear"),
]
# Detector gate and small-image gate.
PERSON_CLASS = 0
PERSON_SCORE_THR = 0.35
SMALL_IMAGE_SIDE = 384
# Tracker defaults.
SORT_IOU = 0.3
BOX_PAD_PX = 10
POSE_ASPECT = 3 / 4

# ---------------------------------------------------------------------------
# Row schemas
# ---------------------------------------------------------------------------

DETECTION = T.StructType([
    T.StructField("image_id", T.LongType()),
    T.StructField("det_id", T.LongType()),
    T.StructField("x1", T.DoubleType()), T.StructField("y1", T.DoubleType()),
    T.StructField("x2", T.DoubleType()), T.StructField("y2", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("class_id", T.IntegerType()),
])

KEYPOINT = T.StructType([
    T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
])


# ---------------------------------------------------------------------------
# Dimension tables (tiny, fixed size -> safe to broadcast)
# ---------------------------------------------------------------------------

def joint_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(JOINT_NAMES)),
                                 "joint int, joint_name string")


def bone_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(SKELETON)],
                                 "bone int, joint_a int, joint_b int")


def flip_dim(spark: SparkSession, num_joints: int = 25) -> DataFrame:
    """joint -> mirrored joint (identity for unpaired joints)."""
    m = {j: j for j in range(num_joints)}
    for a, b in FLIP_PAIRS:
        if a < num_joints and b < num_joints:
            m[a], m[b] = b, a
    return spark.createDataFrame(sorted(m.items()), "joint int, flip_joint int")


def part_spec_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PART_SPEC, "part string, kp_from int, kp_to int, bl int, bt int, br int, bb int")


def part_joint_dim(spark: SparkSession) -> DataFrame:
    """(part, joint, divisors): one row per joint of each part (45 rows), so
    joint-range membership is an equi-join."""
    rows = [(p, j, bl, bt, br, bb) for p, lo, hi, bl, bt, br, bb in PART_SPEC for j in range(lo, hi)]
    return spark.createDataFrame(rows, "part string, joint int, bl int, bt int, br int, bb int")


def category_part_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_PARTS, "category_id int, part string")


def flip_permutation(num_joints: int = 25) -> list[int]:
    m = list(range(num_joints))
    for a, b in FLIP_PAIRS:
        if a < num_joints and b < num_joints:
            m[a], m[b] = b, a
    return m
