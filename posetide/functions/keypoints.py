"""Keypoint and sample-preparation expressions.

A pose is three parallel arrays per row: ``jx``, ``jy`` and ``jv``
(visibility or score). Everything is a higher-order array function or
closed-form arithmetic, so sample preparation never leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from posetide.schema import ANNOTATION_SLOTS, LOWER_BODY_IDS, PIXEL_STD_UNIT, UPPER_BODY_IDS, flip_permutation

NUM_JOINTS = 25
MODULUS = 2147483647  # prime modulus of the integer draw


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _get(arr, idx) -> Column:
    return F.element_at(_c(arr), (_c(idx) + 1).cast("int"))


def src_of_slot() -> list[int]:
    m = [-1] * NUM_JOINTS
    for src, slot in enumerate(ANNOTATION_SLOTS):
        m[slot] = src
    return m


def reorder_annotation(kx, ky, kv) -> dict[str, Column]:
    """I1 + I2: 23 source keypoints (17 body + 6 foot) -> 25 slots; neck (5)
    and hip (14) are the midpoints of slots 6/7 and 12/13 with the smaller
    visibility; visibility clipped to 0/1 and truncated to int. Unrolled
    over the fixed 25 slots (plain element access, whole-stage codegen)."""
    kx, ky, kv = map(_c, (kx, ky, kv))
    src = src_of_slot()

    def raw(arr, slot):
        return F.element_at(arr, src[slot] + 1)

    def vis(slot):
        return F.least(F.greatest(raw(kv, slot), F.lit(0.0)), F.lit(1.0)).cast("int")

    def coord(arr, j):
        if j == 5:
            return (raw(arr, 6) + raw(arr, 7)) / 2
        if j == 14:
            return (raw(arr, 12) + raw(arr, 13)) / 2
        return raw(arr, j)

    def v(j):
        if j == 5:
            return F.least(vis(6), vis(7))
        if j == 14:
            return F.least(vis(12), vis(13))
        return vis(j)
    return {"jx": F.array(*[coord(kx, j) for j in range(NUM_JOINTS)]),
            "jy": F.array(*[coord(ky, j) for j in range(NUM_JOINTS)]),
            "jv": F.array(*[v(j) for j in range(NUM_JOINTS)])}


def flip_joints(jx, jy, jv, width, num_joints: int = NUM_JOINTS) -> dict[str, Column]:
    """Mirror x -> W - 1 - x, swap left/right joints, multiply the
    coordinates by visibility (invisible joints become 0). Unrolled."""
    jx, jy, jv, width = map(_c, (jx, jy, jv, width))
    perm = flip_permutation(num_joints)

    def at(a, j):
        return F.element_at(a, perm[j] + 1)
    return {
        "jx": F.array(*[(width - at(jx, j) - 1) * at(jv, j) for j in range(num_joints)]),
        "jy": F.array(*[at(jy, j) * at(jv, j) for j in range(num_joints)]),
        "jv": F.array(*[at(jv, j) for j in range(num_joints)]),
    }


def fliplr_regression(jx, jy, mode: str = "static", center_x: float = 0.5, center_index: int = 0,
                      num_joints: int = NUM_JOINTS) -> dict[str, Column]:
    """I4: mirror regression outputs about x = center_x ("static") or about
    the root joint's x ("root"), swapping left/right joints."""
    if mode not in ("static", "root"):
        raise ValueError("mode must be 'static' or 'root'")
    jx, jy = _c(jx), _c(jy)
    perm = flip_permutation(num_joints)
    xc = F.lit(center_x) if mode == "static" else F.element_at(jx, center_index + 1)
    return {"jx": F.array(*[xc * 2 - F.element_at(jx, perm[j] + 1) for j in range(num_joints)]),
            "jy": F.array(*[F.element_at(jy, perm[j] + 1) for j in range(num_joints)])}


def affine_matrix(center_x, center_y, scale_x, rot_deg, out_w, out_h, shift_x=0.0, shift_y=0.0,
                  inv: bool = False, unit: float = PIXEL_STD_UNIT) -> dict[str, Column]:
    """The 2x3 affine matrix that maps the box (centre, scale * unit
    wide, rotated by ``rot_deg``) onto an out_w x out_h crop.

    The three-point construction used by pose pipelines (centre, a point
    half a width 'up', and the point a right angle from it) always defines
    a similarity: A = k * R(-theta), k = out_w / (scale_x * unit), with the
    centre (+ shift) going to the crop centre. ``inv`` gives the inverse
    map. Closed form; no solver."""
    cx, cy, sx, rot, ow, oh = map(_c, (center_x, center_y, scale_x, rot_deg, out_w, out_h))
    src_w = sx * unit
    th = rot * (math.pi / 180.0)
    cs, sn = F.cos(th), F.sin(th)
    k = ow / src_w
    s0x = cx + src_w * F.lit(shift_x)
    s0y = cy + src_w * F.lit(shift_y)
    d0x, d0y = ow * 0.5, oh * 0.5
    if not inv:
        a, b, c, d = k * cs, k * sn, -k * sn, k * cs
        tx = d0x - (a * s0x + b * s0y)
        ty = d0y - (c * s0x + d * s0y)
    else:
        a, b, c, d = cs / k, -sn / k, sn / k, cs / k
        tx = s0x - (a * d0x + b * d0y)
        ty = s0y - (c * d0x + d * d0y)
    return {"m00": a, "m01": b, "m02": tx, "m10": c, "m11": d, "m12": ty}


def apply_affine(jx, jy, jv, m: dict, only_visible: bool = True, num_joints: int = NUM_JOINTS) -> dict[str, Column]:
    """Apply a 2x3 affine to every joint (only visible ones when
    ``only_visible``; the others keep their coordinates). Unrolled."""
    jx, jy, jv = map(_c, (jx, jy, jv))
    xs, ys = [], []
    for j in range(num_joints):
        x, y, v = F.element_at(jx, j + 1), F.element_at(jy, j + 1), F.element_at(jv, j + 1)
        tx = m["m00"] * x + m["m01"] * y + m["m02"]
        ty = m["m10"] * x + m["m11"] * y + m["m12"]
        xs.append(F.when(v > 0, tx).otherwise(x) if only_visible else tx)
        ys.append(F.when(v > 0, ty).otherwise(y) if only_visible else ty)
    return {"jx": F.array(*xs), "jy": F.array(*ys)}


def warp_matrix_udp(theta_deg, in_w, in_h, dst_w, dst_h, roi_w, roi_h) -> dict[str, Column]:
    """I8: unbiased (UDP) warp matrix from rotation and the three sizes."""
    t = _c(theta_deg) * (math.pi / 180.0)
    in_w, in_h, dst_w, dst_h, roi_w, roi_h = map(_c, (in_w, in_h, dst_w, dst_h, roi_w, roi_h))
    kx, ky = dst_w / roi_w, dst_h / roi_h
    cs, sn = F.cos(t), F.sin(t)
    return {"m00": cs * kx, "m01": -sn * kx,
            "m02": kx * (-0.5 * in_w * cs + 0.5 * in_h * sn + 0.5 * roi_w),
            "m10": sn * ky, "m11": cs * ky,
            "m12": ky * (-0.5 * in_w * sn - 0.5 * in_h * cs + 0.5 * roi_h)}


def uniform_draw(key, epoch, salt: int, seed: int = 0) -> Column:
    """Reproducible uniform in [0, 1): 52 bits of the MD5 of key, epoch,
    salt and seed. The same on every executor, on every retry and in SQL —
    unlike rand(), which depends on partitioning (Q8) — and draws of different
    salts or epochs have nothing to do with one another."""
    text = F.concat_ws(":", _c(key).cast("string"), _c(epoch).cast("string"), F.lit(str(salt)), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / float(1 << 52)


def uniform_draw_sql(key: str, epoch: str, salt: int, seed: int = 0) -> str:
    return (f"cast(cast('0x' || substr(md5(concat_ws(':', {key}, {epoch}, '{salt}', '{seed}')), 1, 13) as bigint) as double)"
            f" / cast({1 << 52} as double)")


def augment_draw(key, epoch, n_visible, seed: int = 0, half_body_prob=0.3, num_joints_half_body=15,
                 scale_factor=0.35, rotate_prob=0.5, rotation_factor=45.0, flip_prob=0.5) -> dict[str, Column]:
    """Half-body gate, scale multiplier, rotation and flip for one
    sample and epoch. As in the reference, the scale draw only enlarges and
    the rotation is only positive (Q8)."""
    u = {s: uniform_draw(key, epoch, s, seed) for s in range(1, 7)}
    return {
        "half_body": (u[1] < half_body_prob) & (_c(n_visible) > num_joints_half_body),
        "upper_first": u[2] < 0.5,
        "scale_mult": F.least(F.greatest(u[3] * scale_factor + 1, F.lit(1 - scale_factor)), F.lit(1 + scale_factor)),
        "rotation": F.when(u[4] < rotate_prob,
                           F.least(F.greatest(u[5] * rotation_factor, F.lit(-2 * rotation_factor)),
                                   F.lit(2 * rotation_factor))).otherwise(F.lit(0.0)),
        "flip": u[6] < flip_prob,
    }


def with_half_body(df, jx="jx", jy="jy", jv="jv", upper_first="upper_first", aspect: float = 0.75,
                   unit: float = PIXEL_STD_UNIT, num_joints: int = NUM_JOINTS):
    """Adds hb_center_x/y and hb_scale_x/y — centre/scale of the upper
    or lower visible joints (x1.5, grown to the aspect ratio); null when
    fewer than two joints are selected. Unrolled over the joints (sums in
    joint order) in two small projections so code generation stays within
    method limits."""
    up_ids = set(UPPER_BODY_IDS)
    stats = []
    for tag, upper in (("u", True), ("l", False)):
        idx = [j for j in range(num_joints) if (j in up_ids) == upper]
        on = [F.element_at(jv, j + 1) > 0 for j in idx]
        xs = [F.when(o, F.element_at(jx, j + 1)) for o, j in zip(on, idx)]
        ys = [F.when(o, F.element_at(jy, j + 1)) for o, j in zip(on, idx)]
        stats += [sum((F.when(o, 1).otherwise(0) for o in on), F.lit(0)).alias(f"_hb_n{tag}"),
                  sum((F.coalesce(x, F.lit(0.0)) for x in xs), F.lit(0.0)).alias(f"_hb_sx{tag}"),
                  sum((F.coalesce(y, F.lit(0.0)) for y in ys), F.lit(0.0)).alias(f"_hb_sy{tag}"),
                  F.least(*xs).alias(f"_hb_x0{tag}"), F.greatest(*xs).alias(f"_hb_x1{tag}"),
                  F.least(*ys).alias(f"_hb_y0{tag}"), F.greatest(*ys).alias(f"_hb_y1{tag}")]
    d = df.select("*", *stats)
    pick_u = (F.col(upper_first) & (F.col("_hb_nu") > 2)) | ~(F.col("_hb_nl") > 2)

    def sel(name):
        return F.when(pick_u, F.col(f"_hb_{name}u")).otherwise(F.col(f"_hb_{name}l"))
    d = d.select("*", sel("n").alias("_hb_n"), sel("sx").alias("_hb_sx"), sel("sy").alias("_hb_sy"),
                 (sel("x1") - sel("x0")).alias("_hb_w"), (sel("y1") - sel("y0")).alias("_hb_h"))
    n, w, h = F.col("_hb_n"), F.col("_hb_w"), F.col("_hb_h")
    w2 = F.when(w < aspect * h, h * aspect).otherwise(w)
    h2 = F.when(w > aspect * h, w / aspect).otherwise(h)
    ok = n >= 2
    out = d.select("*", F.when(ok, F.col("_hb_sx") / n).alias("hb_center_x"), F.when(ok, F.col("_hb_sy") / n).alias("hb_center_y"),
                   F.when(ok, w2 / unit * 1.5).alias("hb_scale_x"), F.when(ok, h2 / unit * 1.5).alias("hb_scale_y"))
    return out.drop(*[c for c in out.columns if c.startswith("_hb_")])


LOWER_BODY = LOWER_BODY_IDS  # documented alongside UPPER_BODY_IDS


def yx_to_xy(ky, kx, ks) -> Column:
    """(y, x, score) triplets -> array<struct<x, y, score>>."""
    return F.arrays_zip(_c(kx).alias("x"), _c(ky).alias("y"), _c(ks).alias("score"))
