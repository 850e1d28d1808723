"""Training-sample preparation operators.

Targets are produced in long form — one row per heatmap cell inside the
3-sigma window — with ``explode(sequence)``, so a sample never becomes a
dense array unless a consumer asks for it (``dense_targets``). A sample can
also carry its targets itself (``target_structs``): the Gaussian is a product
of a row and a column, so a joint needs 6 sigma + 1 numbers an axis.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posetide.functions import keypoints as K
from posetide.schema import HEATMAP_WH, JOINT_WEIGHTS, POSE_INPUT_WH


def _mu(x, stride):
    # int(x / stride + 0.5): truncation toward zero
    return (F.col(x) / stride + 0.5).cast("long")


def _window_meets_map(x, y, sigma: float = 3.0, image_wh=POSE_INPUT_WH, heatmap_wh=HEATMAP_WH):
    """Whether the 3-sigma window around an image point reaches the map."""
    t, parts = int(sigma * 3), []
    for v, image, cells in ((x, image_wh[0], heatmap_wh[0]), (y, image_wh[1], heatmap_wh[1])):
        mu = (v / (image / cells) + 0.5).cast("long")
        parts.append((mu - t < cells) & (mu + t + 1 >= 0))
    return parts[0] & parts[1]


def target_weights(df: DataFrame, key="sample_id", joint="joint", x="x", y="y", vis="vis",
                   sigma: float = 3.0, image_wh=POSE_INPUT_WH, heatmap_wh=HEATMAP_WH) -> DataFrame:
    """I5 weights: visibility, zeroed when the 3-sigma window misses the map."""
    sx = image_wh[0] / heatmap_wh[0]
    sy = image_wh[1] / heatmap_wh[1]
    mx, my = _mu(x, sx), _mu(y, sy)
    out = ~_window_meets_map(F.col(x), F.col(y), sigma, image_wh, heatmap_wh)
    v = F.col(vis).cast("double") if dict(df.dtypes)[vis] != "boolean" else F.when(F.col(vis), 1.0).otherwise(0.0)
    return df.select(key, joint, mx.alias("mx"), my.alias("my"),
                     F.when(out, F.lit(0.0)).otherwise(v).alias("target_weight"))


def gaussian_target_cells(df: DataFrame, key="sample_id", joint="joint", x="x", y="y", vis="vis",
                          sigma: float = 3.0, image_wh=POSE_INPUT_WH, heatmap_wh=HEATMAP_WH) -> DataFrame:
    """Cells (hx, hy, val) of the unnormalised Gaussian (peak 1) around
    each joint with weight > 0.5, clipped to the map."""
    tmp = int(sigma * 3)
    w = target_weights(df, key, joint, x, y, vis, sigma, image_wh, heatmap_wh).where(F.col("target_weight") > 0.5)
    x0 = F.greatest(F.lit(0).cast("long"), F.col("mx") - tmp)
    x1 = F.least(F.col("mx") + tmp + 1, F.lit(heatmap_wh[0]).cast("long")) - 1
    y0 = F.greatest(F.lit(0).cast("long"), F.col("my") - tmp)
    y1 = F.least(F.col("my") + tmp + 1, F.lit(heatmap_wh[1]).cast("long")) - 1
    c = (w.withColumn("hx", F.explode(F.sequence(x0, F.greatest(x0, x1))))
          .withColumn("hy", F.explode(F.sequence(y0, F.greatest(y0, y1))))
          .where((F.col("hx") <= x1) & (F.col("hy") <= y1)))
    d2 = (F.col("hx") - F.col("mx")) * (F.col("hx") - F.col("mx")) + (F.col("hy") - F.col("my")) * (F.col("hy") - F.col("my"))
    return c.select(key, joint, "hx", "hy", F.exp(-(d2 / (2.0 * sigma * sigma))).alias("val"))


def target_mass(df: DataFrame, key="sample_id", joint="joint", x="x", y="y", vis="vis",
                sigma: float = 3.0, image_wh=POSE_INPUT_WH, heatmap_wh=HEATMAP_WH) -> DataFrame:
    """I5 summary per joint without materialising cells: number of target
    cells and their total value. The Gaussian is separable, so the sum over
    the clipped window is (sum over x) * (sum over y) — 2 x (6 sigma + 1)
    terms instead of (6 sigma + 1)^2 rows."""
    tmp = int(sigma * 3)
    w = target_weights(df, key, joint, x, y, vis, sigma, image_wh, heatmap_wh)
    x0 = F.greatest(F.lit(0).cast("long"), F.col("mx") - tmp)
    x1 = F.least(F.col("mx") + tmp + 1, F.lit(heatmap_wh[0]).cast("long")) - 1
    y0 = F.greatest(F.lit(0).cast("long"), F.col("my") - tmp)
    y1 = F.least(F.col("my") + tmp + 1, F.lit(heatmap_wh[1]).cast("long")) - 1
    # offsets o in [-3 sigma, 3 sigma] carry constant weights; the map bounds
    # clip the window to [max(-t, -mu), min(t, size - 1 - mu)], so each axis
    # sum is a difference of two prefix sums (two array reads, tiny code)
    cum = [0.0]
    for o in range(-tmp, tmp + 1):
        cum.append(cum[-1] + math.exp(-(o * o) / (2.0 * sigma * sigma)))
    prefix = F.array(*[F.lit(c) for c in cum])

    def axis_sum(mu, size):
        lo = F.greatest(F.lit(-tmp), -F.col(mu))
        hi = F.least(F.lit(tmp), F.lit(size - 1) - F.col(mu))
        val = F.element_at(prefix, (hi + tmp + 2).cast("int")) - F.element_at(prefix, (lo + tmp + 1).cast("int"))
        return F.when(hi >= lo, val).otherwise(F.lit(0.0))
    on = F.col("target_weight") > 0.5
    return w.select(key, joint, "target_weight",
                    F.when(on, (x1 - x0 + 1) * (y1 - y0 + 1)).otherwise(F.lit(0)).cast("long").alias("n_cells"),
                    F.when(on, axis_sum("mx", heatmap_wh[0]) * axis_sum("my", heatmap_wh[1])).otherwise(0.0).alias("mass"))


def dense_targets(cells: DataFrame, key="sample_id", joint="joint", heatmap_wh=HEATMAP_WH) -> DataFrame:
    """I5 dense form: one flat float array per (sample, joint), built from the
    long-form cells inside an Arrow batch grouped by (sample, joint) — a
    group is at most (6 sigma + 1)^2 cells, so it is bounded."""
    W, H = heatmap_wh

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        m = np.zeros(W * H, dtype=np.float32)
        m[(pdf["hy"].to_numpy() * W + pdf["hx"].to_numpy()).astype(np.int64)] = pdf["val"].to_numpy()
        return pd.DataFrame({key: [pdf[key].iloc[0]], joint: [pdf[joint].iloc[0]], "target": [m]})
    schema = f"{key} {dict(cells.dtypes)[key]}, {joint} {dict(cells.dtypes)[joint]}, target array<float>"
    return cells.groupBy(key, joint).applyInPandas(build, schema)


def target_structs(jx, jy, jv, sigma: float = 3.0, image_wh=POSE_INPUT_WH, heatmap_wh=HEATMAP_WH,
                   joint_weights: list[float] | None = JOINT_WEIGHTS) -> Column:
    """I5 in the sample: one struct a joint (joint, weight, x0, y0, wx, wy).

    The target of cell (x0 + a, y0 + b) is wx[a] * wy[b]; both are empty for a
    joint that is not visible or whose window misses the map. ``weight`` is
    the visibility (0 when the window misses the map) times the joint's own
    weight (None: no such weights). Null joints count as not visible. Row-local:
    the factors are slices of one constant array, cut where the map ends."""
    jx, jy, jv = (F.col(c) if isinstance(c, str) else c for c in (jx, jy, jv))
    t = int(sigma * 3)
    bell = F.array(*[F.lit(math.exp(-(o * o) / (2.0 * sigma * sigma))) for o in range(-t, t + 1)])
    own = None if joint_weights is None else F.array(*[F.lit(float(w)) for w in joint_weights])

    def axis(v, image, cells):
        mu = (v / (image / cells) + 0.5).cast("long")
        first = F.greatest(F.lit(0).cast("long"), mu - t)
        last = F.least(mu + t, F.lit(cells - 1).cast("long"))
        start = F.least(first - mu + t + 1, F.lit(2 * t + 2))
        return first, last >= first, F.slice(bell, start.cast("int"), F.greatest(last - first + 1, F.lit(0)).cast("int"))

    def one(z, j):
        seen = z["v"].cast("double")
        inside = F.coalesce(_window_meets_map(z["x"], z["y"], sigma, image_wh, heatmap_wh), F.lit(False))
        weight = F.when(inside, F.coalesce(seen, F.lit(0.0))).otherwise(F.lit(0.0))
        none = F.array().cast("array<double>")
        x0, some_x, wx = axis(z["x"], image_wh[0], heatmap_wh[0])
        y0, some_y, wy = axis(z["y"], image_wh[1], heatmap_wh[1])
        holds = F.coalesce(inside & (seen > 0.5) & some_x & some_y, F.lit(False))
        if own is not None:
            weight = weight * F.element_at(own, j + 1)
        return F.struct(j.cast("int").alias("joint"), weight.alias("weight"),
                        F.when(holds, x0).cast("int").alias("x0"), F.when(holds, y0).cast("int").alias("y0"),
                        F.when(holds, wx).otherwise(none).alias("wx"), F.when(holds, wy).otherwise(none).alias("wy"))
    return F.transform(F.arrays_zip(jx.alias("x"), jy.alias("y"), jv.alias("v")), one)


def target_cells(samples: DataFrame, *keys: str, targets: str = "targets") -> DataFrame:
    """The cells (joint, hx, hy, val) that ``target_structs`` stands for."""
    j = samples.select(*keys, F.explode(targets).alias("t")).select(*keys, "t.*")
    c = j.select(*keys, "joint", "x0", "y0", "wy", F.posexplode("wx").alias("a", "vx"))
    c = c.select(*keys, "joint", (F.col("x0") + F.col("a")).alias("hx"), "vx", "y0", F.posexplode("wy").alias("b", "vy"))
    return c.select(*keys, "joint", "hx", (F.col("y0") + F.col("b")).alias("hy"), (F.col("vx") * F.col("vy")).alias("val"))


def target_moments(target: Column) -> dict[str, Column]:
    """Summary of one joint's target over all of its cells: their number, the
    sums of the values, and of the values times the cell's x and y. Sums of a
    product of factors are products of sums, so no cell is written."""
    def total(w, first=None):
        term = w if first is None else F.transform(w, lambda v, i: v * (first + i))
        return F.aggregate(term, F.lit(0.0), lambda acc, v: acc + v)
    wx, wy = target["wx"], target["wy"]
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return {"n_cells": (F.size(wx) * F.size(wy)).cast("long"), "mass": total(wx) * total(wy),
            "mass_x": zero(total(wx, target["x0"]) * total(wy)), "mass_y": zero(total(wx) * total(wy, target["y0"]))}


def split_and_shard(df: DataFrame, key: str, n_shards: int = 16, valid_share: float = 0.2, seed: int = 0) -> DataFrame:
    """train/valid split and shard id from integer arithmetic on the key
    (stable across runs and partitionings)."""
    u = K.uniform_draw(key, F.lit(0), 99, seed)
    return df.withColumn("data_version", F.when(u < 1 - valid_share, F.lit("train")).otherwise(F.lit("val"))) \
             .withColumn("shard", F.pmod(F.col(key), F.lit(n_shards)).cast("int"))


def assemble_samples(prep: DataFrame, epoch: int = 0, train: bool = True, seed: int = 0,
                     image_wh=POSE_INPUT_WH) -> DataFrame:
    """One training sample per prepared annotation.

    prep: image_id, ann_id, width, height, jx, jy, jv (25 joints),
    center_x, center_y, scale_x, scale_y. Applies half body (C9), scale,
    rotation and flip draws (I9), the flip (I3) and the affine warp of the
    visible joints (I6/I7); adds the targets (``target_structs``) and the number
    of joints with a weight. Pixels are warped
    separately by the image job on the same matrix."""
    nv = F.aggregate("jv", F.lit(0).cast("long"), lambda a, v: a + v)
    p = prep.withColumn("n_vis", nv).withColumn("epoch", F.lit(epoch))
    if train:
        dr = K.augment_draw("ann_id", "epoch", "n_vis", seed)
        p = p.select("*", *[v.alias(f"d_{k}") for k, v in dr.items()])
        p = K.with_half_body(p, upper_first="d_upper_first")
        use_hb = F.col("d_half_body") & F.col("hb_center_x").isNotNull()
        for a, b in (("center_x", "hb_center_x"), ("center_y", "hb_center_y"),
                     ("scale_x", "hb_scale_x"), ("scale_y", "hb_scale_y")):
            p = p.withColumn(a, F.when(use_hb, F.col(b)).otherwise(F.col(a)))
        p = (p.withColumn("scale_x", F.col("scale_x") * F.col("d_scale_mult"))
              .withColumn("scale_y", F.col("scale_y") * F.col("d_scale_mult"))
              .withColumn("rotation", F.col("d_rotation"))
              .withColumn("flipped", F.col("d_flip")))
        f = K.flip_joints("jx", "jy", "jv", "width")
        # new arrays under temporary names, then swap in: every lambda reads
        # the pre-flip arrays
        fl = F.col("flipped")
        p = (p.select("*", F.when(fl, f["jx"]).otherwise(F.col("jx")).alias("_fx"),
                      F.when(fl, f["jy"]).otherwise(F.col("jy")).alias("_fy"),
                      F.when(fl, f["jv"]).otherwise(F.col("jv")).alias("_fv"))
              .drop("jx", "jy", "jv")
              .withColumnsRenamed({"_fx": "jx", "_fy": "jy", "_fv": "jv"})
              .withColumn("center_x", F.when(fl, F.col("width") - F.col("center_x") - 1)
                          .otherwise(F.col("center_x"))))
    else:
        p = p.withColumn("rotation", F.lit(0.0)).withColumn("flipped", F.lit(False))
    m = K.affine_matrix("center_x", "center_y", "scale_x", "rotation", F.lit(float(image_wh[0])),
                        F.lit(float(image_wh[1])))
    p = p.select("*", *[v.alias(k) for k, v in m.items()])
    t = K.apply_affine("jx", "jy", "jv", {k: F.col(k) for k in m})
    p = (p.select("*", t["jx"].alias("_tx"), t["jy"].alias("_ty")).drop("jx", "jy")
          .withColumnsRenamed({"_tx": "jx", "_ty": "jy"}))
    inside = F.transform(F.arrays_zip("jx", "jy", "jv"), lambda z: F.when(
        (z["jv"] > 0) & _window_meets_map(z["jx"], z["jy"]), 1).otherwise(0))
    p = p.withColumn("n_weighted", F.aggregate(inside, F.lit(0).cast("long"), lambda a, v: a + v))
    return p.select("image_id", "ann_id", "epoch", "center_x", "center_y", "scale_x", "scale_y", "rotation",
                    "flipped", "jx", "jy", "jv", *list(m), "n_weighted",
                    target_structs("jx", "jy", "jv", image_wh=image_wh).alias("targets"))
