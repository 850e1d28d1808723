"""Pixel operations (D1-D7) — numpy helpers applied inside Arrow batches.

Catalyst has no pixel primitives, so these run in the same ``mapInPandas``
stage as the model call that needs them (scoring jobs), one image at a
time, never collecting images on the driver. Geometry (crop boxes, pads,
matrices) is computed natively before that stage.
"""

from __future__ import annotations

import numpy as np

from posetide.schema import PIXEL_MEAN, PIXEL_STD, POSE_INPUT_WH


def darkest(img: np.ndarray) -> np.ndarray:
    """Least channel of each pixel of an RGB picture."""
    return np.minimum(np.minimum(img[..., 0], img[..., 1]), img[..., 2]) if img.shape[2] == 3 else img.min(axis=2)


def extent(mask: np.ndarray) -> tuple[int, int, int, int]:
    """First and last column, first and last row with a set pixel."""
    xs, ys = np.flatnonzero(mask.any(axis=0)), np.flatnonzero(mask.any(axis=1))
    return xs[0], xs[-1], ys[0], ys[-1]


def dark_extent(img: np.ndarray, white: int) -> tuple[int, int, int, int] | None:
    """``extent`` of the pixels with a channel under ``white``, None without any:
    least values of whole rows, then of the columns of the rows in question."""
    rows = np.flatnonzero(img.reshape(len(img), -1).min(axis=1, initial=255) < white)
    if not len(rows):
        return None
    y0, y1 = rows[0], rows[-1]
    cols = img[y0:y1 + 1].reshape(y1 + 1 - y0, -1).min(axis=0).reshape(img.shape[1], -1).min(axis=1)
    xs = np.flatnonzero(cols < white)
    return xs[0], xs[-1], y0, y1


def resize_bilinear(img: np.ndarray, out_w: int, out_h: int) -> np.ndarray:
    """Bilinear resize with half-pixel centres (float32 output)."""
    h, w = img.shape[:2]
    ys = (np.arange(out_h) + 0.5) * (h / out_h) - 0.5
    xs = (np.arange(out_w) + 0.5) * (w / out_w) - 0.5
    y0 = np.clip(np.floor(ys).astype(int), 0, h - 1)
    x0 = np.clip(np.floor(xs).astype(int), 0, w - 1)
    y1 = np.clip(y0 + 1, 0, h - 1)
    x1 = np.clip(x0 + 1, 0, w - 1)
    wx = np.clip(xs - x0, 0, 1)[:, None, None]
    wy = np.clip(ys - y0, 0, 1)[None, :, None]
    a = img.astype(np.float32)
    if a.ndim == 2:
        a = a[..., None]
    a = a.transpose(1, 0, 2)
    rows = a[x0] * (1 - wx) + a[x1] * wx  # each source row once, however many rows take it
    out = rows.take(y0, axis=1) * (1 - wy) + rows.take(y1, axis=1) * wy
    return out.astype(np.float32).transpose(1, 0, 2)


def to_network_input(img: np.ndarray, size=POSE_INPUT_WH) -> np.ndarray:
    """Resize to 192 x 256, /255, mean/std normalise, CHW float32."""
    r = resize_bilinear(img, size[0], size[1]) / 255.0
    r = (r - np.asarray(PIXEL_MEAN, dtype=np.float32)) / np.asarray(PIXEL_STD, dtype=np.float32)
    return r.transpose(2, 0, 1).astype(np.float32)


def rotate(img: np.ndarray, degrees: int) -> np.ndarray:
    """Rotate by 0/90/180/270 degrees counter-clockwise (pixel permutation;
    width and height swap for 90/270, Q20)."""
    k = (degrees // 90) % 4
    return np.rot90(img, k=k).copy()


def grey_to_rgb(img: np.ndarray) -> np.ndarray:
    """D3."""
    return np.repeat(img[..., None], 3, axis=2) if img.ndim == 2 else img


def crop(img: np.ndarray, x1: int, y1: int, x2: int, y2: int) -> np.ndarray:
    """Crop [y1:y2, x1:x2] (box already clipped natively)."""
    return img[int(y1):int(y2), int(x1):int(x2)]


def pad_to(img: np.ndarray, left: int, top: int, out_w: int, out_h: int) -> np.ndarray:
    """Zero padding to (out_w, out_h) with the given left/top pads."""
    h, w = img.shape[:2]
    out = np.zeros((out_h, out_w) + img.shape[2:], dtype=img.dtype)
    out[top:top + h, left:left + w] = img
    return out


def _blended(img: np.ndarray, mask: np.ndarray) -> np.ndarray:
    m = mask.astype(np.float32)
    if m.max() > 1.0:
        m = m / 255.0
    m = m[..., None]
    return (img.astype(np.float32) * m + 255.0 * (1 - m)).round().astype(np.uint8)


def composite_on_white(img: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Keep pixels where the mask is set, white elsewhere (mask in [0,1]
    or 0/255, blended like an alpha paste)."""
    if img.dtype != np.uint8 or not (mask.dtype.kind in "bu" or mask.min(initial=0) >= 0):
        return _blended(img, mask)
    out = np.full(img.shape, 255, dtype=np.uint8)  # all white outside the mask's extent
    ys = np.flatnonzero(mask.max(axis=1, initial=0))
    if not len(ys):
        return out
    xs = np.flatnonzero(mask[ys[0]:ys[-1] + 1].max(axis=0))
    part = np.s_[ys[0]:ys[-1] + 1, xs[0]:xs[-1] + 1]
    m = mask[part]
    top, on = m.max(), m != 0
    if top not in (1, 255) or (m[on] != top).any():
        out[part] = _blended(img[part], m)
    elif on.all():  # all or nothing: no blending
        out[part] = img[part]
    else:
        for c in range(img.shape[2]):
            np.copyto(out[part][..., c], img[part][..., c], where=on)
    return out


def warp_affine(img: np.ndarray, m: np.ndarray, out_w: int, out_h: int) -> np.ndarray:
    """Bilinear inverse-mapped affine warp with a 2x3 forward matrix;
    outside pixels are 0."""
    a = np.vstack([np.asarray(m, dtype=np.float64), [0, 0, 1]])
    inv = np.linalg.inv(a)
    yy, xx = np.mgrid[0:out_h, 0:out_w]
    sx = inv[0, 0] * xx + inv[0, 1] * yy + inv[0, 2]
    sy = inv[1, 0] * xx + inv[1, 1] * yy + inv[1, 2]
    h, w = img.shape[:2]
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    fx, fy = sx - x0, sy - y0
    src = img.astype(np.float32)
    if src.ndim == 2:
        src = src[..., None]
    out = np.zeros((out_h, out_w, src.shape[2]), dtype=np.float32)
    for dy, wy in ((0, 1 - fy), (1, fy)):
        for dx, wx in ((0, 1 - fx), (1, fx)):
            xi, yi = x0 + dx, y0 + dy
            ok = (xi >= 0) & (xi < w) & (yi >= 0) & (yi < h)
            out[ok] += (src[yi[ok], xi[ok]] * (wx[ok] * wy[ok])[:, None])
    return out.round().clip(0, 255).astype(np.uint8).reshape(out_h, out_w, -1)
