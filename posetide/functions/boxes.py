"""Box geometry as Catalyst column expressions (no Python at run time).

Boxes are plain double columns. Every builder takes column names or Columns
and returns Columns, so operators stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from posetide.schema import BOX_PAD_PX, PIXEL_STD_UNIT, POSE_ASPECT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip_xywh(x, y, w, h, width, height) -> dict[str, Column]:
    """Clip an (x, y, w, h) box to the image; returns clean x, y, w, h and
    a validity flag (x2 >= x1 and y2 >= y1)."""
    x, y, w, h, width, height = map(_c, (x, y, w, h, width, height))
    x1 = F.greatest(F.lit(0.0), x)
    y1 = F.greatest(F.lit(0.0), y)
    x2 = F.least((width - 1).cast("double"), x1 + F.greatest(F.lit(0.0), w - 1))
    y2 = F.least((height - 1).cast("double"), y1 + F.greatest(F.lit(0.0), h - 1))
    return {"clean_x": x1, "clean_y": y1, "clean_w": x2 - x1, "clean_h": y2 - y1,
            "box_ok": (x2 >= x1) & (y2 >= y1)}


def xywh_to_center_scale(x, y, w, h, aspect=POSE_ASPECT, unit=PIXEL_STD_UNIT,
                         padding=1.25) -> dict[str, Column]:
    """Centre and scale of a box grown to the model aspect ratio, in
    units of ``unit`` pixels, enlarged by ``padding`` unless cx == -1."""
    x, y, w, h = map(_c, (x, y, w, h))
    cx = x + w * 0.5
    cy = y + h * 0.5
    w2 = F.when(w < aspect * h, h * aspect).otherwise(w)
    h2 = F.when(w > aspect * h, w / aspect).otherwise(h)
    grow = F.when(cx != -1, F.lit(padding)).otherwise(F.lit(1.0))
    return {"center_x": cx, "center_y": cy,
            "scale_x": w2 / unit * grow, "scale_y": h2 / unit * grow}


def round_pad_clip(x1, y1, x2, y2, width, height, pad=BOX_PAD_PX) -> dict[str, Column]:
    """Round half-to-even, pad by ``pad`` pixels, clip to [0, W] x [0, H]."""
    x1, y1, x2, y2, width, height = map(_c, (x1, y1, x2, y2, width, height))

    def clip(v, hi):
        return F.least(F.greatest(v, F.lit(0)), hi.cast("long"))
    r = lambda v: F.bround(v, 0).cast("long")
    return {"bx1": clip(r(x1) - pad, width), "by1": clip(r(y1) - pad, height),
            "bx2": clip(r(x2) + pad, width), "by2": clip(r(y2) + pad, height)}


def aspect_pad(bw, bh, aspect=POSE_ASPECT) -> dict[str, Column]:
    """C4: zero padding that brings a (bw x bh) crop to ``aspect`` (w/h).
    Integer truncation of the target side, floor half on the left/top.
    A zero-height crop is not paddable (null pads, Q15)."""
    bw, bh = _c(bw).cast("long"), _c(bh).cast("long")
    wide = bw.cast("double") / bh.cast("double") < aspect
    tw = (F.lit(aspect) * bh).cast("long")
    th = (bw.cast("double") / aspect).cast("long")
    pad_w = tw - bw
    pad_h = th - bh
    ok = bh > 0
    left = F.when(~ok, None).when(wide, F.floor(pad_w / 2)).otherwise(F.lit(0)).cast("long")
    top = F.when(~ok, None).when(wide, F.lit(0)).otherwise(F.floor(pad_h / 2)).cast("long")
    return {"left_pad": left, "top_pad": top,
            "padded_w": F.when(~ok, None).when(wide, tw).otherwise(bw),
            "padded_h": F.when(~ok, None).when(wide, bh).otherwise(th)}


def crop_to_image(kx, ky, bx1, by1, left_pad, top_pad) -> dict[str, Column]:
    """Keypoints from padded-crop coordinates back to the image."""
    kx, ky, bx1, by1, left_pad, top_pad = map(_c, (kx, ky, bx1, by1, left_pad, top_pad))
    return {"img_x": kx + bx1 - left_pad, "img_y": ky + by1 - top_pad}


def box_to_z(x1, y1, x2, y2) -> dict[str, Column]:
    """(x1,y1,x2,y2) -> centre, area, aspect ratio."""
    x1, y1, x2, y2 = map(_c, (x1, y1, x2, y2))
    w, h = x2 - x1, y2 - y1
    return {"zx": x1 + w / 2.0, "zy": y1 + h / 2.0, "zs": w * h, "zr": w / h}


def z_to_box(zx, zy, zs, zr) -> dict[str, Column]:
    """C6 inverse: centre, area, ratio -> (x1,y1,x2,y2)."""
    zx, zy, zs, zr = map(_c, (zx, zy, zs, zr))
    w = F.sqrt(zs * zr)
    h = zs / w
    return {"x1": zx - w / 2.0, "y1": zy - h / 2.0, "x2": zx + w / 2.0, "y2": zy + h / 2.0}


def iou(a: dict, b: dict, plus_one: bool = False) -> Column:
    """Intersection over union of two boxes given as dicts of
    x1,y1,x2,y2 columns. ``plus_one`` uses inclusive pixel areas."""
    p = 1.0 if plus_one else 0.0
    iw = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]) + p)
    ih = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]) + p)
    inter = iw * ih
    area_a = (a["x2"] - a["x1"] + p) * (a["y2"] - a["y1"] + p)
    area_b = (b["x2"] - b["x1"] + p) * (b["y2"] - b["y1"] + p)
    return inter / (area_a + area_b - inter)


def part_crop_box(min_x, min_y, max_x, max_y, width, height, bl, bt, br, bb) -> dict[str, Column]:
    """Body-part crop from joint extents; buffer = side // divisor,
    int() truncation of the extents, clamped to the image."""
    min_x, min_y, max_x, max_y, width, height, bl, bt, br, bb = map(
        _c, (min_x, min_y, max_x, max_y, width, height, bl, bt, br, bb))
    W, H = width.cast("long"), height.cast("long")
    t = lambda v: v.cast("long")  # noqa: E731  (truncation toward zero like int())
    return {"crop_x1": F.greatest(F.lit(0).cast("long"), t(min_x) - F.floor(W / bl).cast("long")),
            "crop_y1": F.greatest(F.lit(0).cast("long"), t(min_y) - F.floor(H / bt).cast("long")),
            "crop_x2": F.least(W, t(max_x) + F.floor(W / br).cast("long")),
            "crop_y2": F.least(H, t(max_y) + F.floor(H / bb).cast("long"))}


def result_box(center_x, center_y, scale_x, scale_y, score, unit=PIXEL_STD_UNIT) -> dict[str, Column]:
    """Result row of a decoded person: centre, scale, area, score."""
    center_x, center_y, scale_x, scale_y, score = map(_c, (center_x, center_y, scale_x, scale_y, score))
    return {"center_x": center_x, "center_y": center_y, "scale_x": scale_x, "scale_y": scale_y,
            "area": (scale_x * unit) * (scale_y * unit), "score": score}
