"""Heatmap operators that need pixel neighbourhood filters.

Gaussian modulation is a 2-D convolution, which Catalyst has no primitive
for, so these run as Arrow-batched ``mapInPandas`` over independent rows
(one heatmap per row): no grouping, no shuffle, numpy vectorised over the
whole batch. Everything else in F is a native expression
(``posetide.functions.heatmap``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posetide.functions import heatmap as H


def gaussian_kernel_1d(k: int) -> np.ndarray:
    """Normalised 1-D Gaussian of odd size ``k`` with the usual automatic
    sigma: 0.3 * ((k - 1) * 0.5 - 1) + 0.8."""
    sigma = 0.3 * ((k - 1) * 0.5 - 1) + 0.8
    r = np.arange(k) - (k - 1) / 2.0
    g = np.exp(-(r * r) / (2 * sigma * sigma))
    return g / g.sum()


def _reflect101_index(n: int, pad: int) -> np.ndarray:
    """Source index of each padded position under reflect-101 borders."""
    idx = np.arange(-pad, n + pad)
    if n == 1:
        return np.zeros_like(idx)
    period = 2 * (n - 1)
    idx = np.mod(idx, period)
    return np.where(idx >= n, period - idx, idx)


def blur(batch: np.ndarray, k: int) -> np.ndarray:
    """Separable Gaussian blur of a batch [..., H, W], reflect-101 border."""
    g = gaussian_kernel_1d(k)
    p = k // 2
    H_, W_ = batch.shape[-2:]
    xs = batch[..., :, _reflect101_index(W_, p)]
    out = np.zeros(batch.shape[:-1] + (W_,), dtype=np.float64)
    for t in range(k):
        out += g[t] * xs[..., :, t:t + W_]
    ys = out[..., _reflect101_index(H_, p), :]
    out2 = np.zeros_like(out)
    for t in range(k):
        out2 += g[t] * ys[..., t:t + H_, :]
    return out2


def blur_at(batch: np.ndarray, k: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """``blur`` of [N, H, W] maps at the cells rows [N, R] x cols [N, C] only,
    tap by tap in the same order: [N, R, C]."""
    g, p, (n, h, w) = gaussian_kernel_1d(k), k // 2, batch.shape
    top, left = rows.min(axis=1, keepdims=True), cols.min(axis=1, keepdims=True)
    high, wide = (int((v - first).max(initial=0)) + 1 for v, first in ((rows, top), (cols, left)))
    # one window a map, which holds what all its cells read
    ys = _reflect101_index(h, p)[np.minimum(top + np.arange(high + k - 1), h + 2 * p - 1)]
    xs = _reflect101_index(w, p)[np.minimum(left + np.arange(wide + k - 1), w + 2 * p - 1)]
    at = np.arange(n)[:, None, None]
    window = batch[at, ys[:, :, None], xs[:, None, :]].astype(np.float64, copy=False)
    out = np.zeros((n, high + k - 1, wide))
    for t in range(k):
        out += g[t] * window[:, :, t:t + wide]
    out2 = np.zeros((n, high, wide))
    for t in range(k):
        out2 += g[t] * out[:, t:t + high]
    return out2[at, (rows - top)[:, :, None], (cols - left)[:, None, :]]


def modulate(batch: np.ndarray, k: int = 11) -> np.ndarray:
    """zero-pad by the kernel radius, blur, crop, rescale each map to its
    original maximum."""
    p = (k - 1) // 2
    padded = np.pad(batch, [(0, 0)] * (batch.ndim - 2) + [(p, p), (p, p)])
    b = blur(padded, k)[..., p:-p, p:-p]
    omax = batch.max(axis=(-2, -1), keepdims=True)
    bmax = b.max(axis=(-2, -1), keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return b * (omax / bmax)


def argmax_np(batch: np.ndarray):
    n, h, w = batch.shape
    flat = batch.reshape(n, -1)
    idx = flat.argmax(axis=1)
    mx = flat[np.arange(n), idx]
    px = (idx % w).astype(np.float64)
    py = (idx // w).astype(np.float64)
    neg = mx <= 0
    px[neg] = -1.0
    py[neg] = -1.0
    return px, py, mx


def dark_udp(batch: np.ndarray, px: np.ndarray, py: np.ndarray, k: int = 3):
    """DARK refinement in the UDP form: blur in place (no rescale), clip
    to [0.001, 50], log, edge-pad by 1, finite differences at the peak,
    Newton step with (Hessian + eps I)^-1. Only the 3 x 3 cells around each
    peak are blurred, as no others are read."""
    n, h, w = batch.shape
    near = np.arange(-1, 2)

    def cells(peak, size):  # places in the padded map, then the map's own
        return np.clip(np.clip(peak.astype(np.int64)[:, None] + 1 + near, 0, size + 1) - 1, 0, size - 1)
    lg = np.log(np.clip(blur_at(batch, k, cells(py, h), cells(px, w)), 0.001, 50))

    def v(dx_, dy_):
        return lg[:, 1 + dy_, 1 + dx_]
    i0 = v(0, 0)
    dx = 0.5 * (v(1, 0) - v(-1, 0))
    dy = 0.5 * (v(0, 1) - v(0, -1))
    dxx = v(1, 0) - 2 * i0 + v(-1, 0)
    dyy = v(0, 1) - 2 * i0 + v(0, -1)
    dxy = 0.5 * (v(1, 1) - v(1, 0) - v(0, 1) + i0 + i0 - v(-1, 0) - v(0, -1) + v(-1, -1))
    eps = np.finfo(np.float32).eps
    a, b_, c, d = dxx + eps, dxy, dxy, dyy + eps
    det = a * d - b_ * c
    with np.errstate(divide="ignore", invalid="ignore"):
        ox = (d * dx - b_ * dy) / det
        oy = (-c * dx + a * dy) / det
    return px - ox, py - oy


def _stack(hm_col: pd.Series, h: int, w: int) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in hm_col]).reshape(-1, h, w)


def decode_heatmaps(df: DataFrame, mode: str = "default", udp: bool = False, kernel: int = 11,
                    hm: str = "hm", h: int = 64, w: int = 48, keep=("person_id", "joint")) -> DataFrame:
    """heatmap -> (px, py, maxval) in heatmap coordinates.

    mode: None | "default" (quarter shift) | "unbiased" (modulate + log +
    Taylor) | "megvii" (modulate, shift + 0.5, score / 255 + 0.5).
    udp=True uses the DARK-UDP refinement and ignores ``mode`` (Q21).
    Map to image coordinates afterwards with ``functions.heatmap.to_image``
    (UDP form when udp=True). Rows are independent; the Arrow batch is
    decoded with numpy in one go."""
    if udp and mode == "megvii":
        raise ValueError("udp and megvii are exclusive")
    keep = list(keep)
    schema = ", ".join([f"{c} {t}" for c, t in zip(keep, [df.schema[c].dataType.simpleString() for c in keep])]
                       + ["px double", "py double", "maxval double"])

    def run(it):
        for pdf in it:
            if pdf.empty:
                yield pd.DataFrame({c: pd.Series(dtype="float64") for c in keep + ["px", "py", "maxval"]})
                continue
            b = _stack(pdf[hm], h, w)
            if mode == "megvii" and not udp:
                b = modulate(b, kernel)
            px, py, mx = argmax_np(b)
            if udp:
                px, py = dark_udp(b, px, py, kernel)
            elif mode == "unbiased":
                lg = np.log(np.maximum(modulate(b, kernel), 1e-10))
                px, py = _taylor_np(lg, px, py)
            elif mode in ("default", "megvii"):
                px, py = _shift_np(b, px, py, mode == "megvii")
            if mode == "megvii" and not udp:
                mx = mx / 255.0 + 0.5
            out = pdf[keep].copy()
            out["px"], out["py"], out["maxval"] = px, py, mx
            yield out
    return df.select(*keep, hm).mapInPandas(run, schema)


def _shift_np(b, px, py, megvii):
    n, h, w = b.shape
    x, y = px.astype(np.int64), py.astype(np.int64)
    ins = (x > 1) & (x < w - 1) & (y > 1) & (y < h - 1)
    r = np.arange(n)
    xc, yc = np.clip(x, 1, w - 2), np.clip(y, 1, h - 2)
    dx = b[r, yc, xc + 1] - b[r, yc, xc - 1]
    dy = b[r, yc + 1, xc] - b[r, yc - 1, xc]
    extra = 0.5 if megvii else 0.0
    return (np.where(ins, px + np.sign(dx) * 0.25 + extra, px),
            np.where(ins, py + np.sign(dy) * 0.25 + extra, py))


def _taylor_np(lg, px, py):
    n, h, w = lg.shape
    x, y = px.astype(np.int64), py.astype(np.int64)
    ins = (x > 1) & (x < w - 2) & (y > 1) & (y < h - 2)
    r = np.arange(n)
    xc, yc = np.clip(x, 2, w - 3), np.clip(y, 2, h - 3)

    def v(dx_, dy_):
        return lg[r, yc + dy_, xc + dx_]
    dx = 0.5 * (v(1, 0) - v(-1, 0))
    dy = 0.5 * (v(0, 1) - v(0, -1))
    dxx = 0.25 * (v(2, 0) - 2 * v(0, 0) + v(-2, 0))
    dxy = 0.25 * (v(1, 1) - v(1, -1) - v(-1, 1) + v(-1, -1))
    dyy = 0.25 * (v(0, 2) - 2 * v(0, 0) + v(0, -2))
    det = dxx * dyy - dxy * dxy
    ok = ins & (det != 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        ox = -(dyy * dx - dxy * dy) / det
        oy = -(-dxy * dx + dxx * dy) / det
    return np.where(ok, px + ox, px), np.where(ok, py + oy, py)


def decode_combined(df: DataFrame, kernel: int = 11, valid_radius_factor: float = 0.0546875,
                    heat: str = "heat", off_x: str = "off_x", off_y: str = "off_y",
                    h: int = 64, w: int = 48, keep=("person_id", "joint")) -> DataFrame:
    """combined-target decode (UDP): blur the response map with
    2k+1 and the offset maps with k, argmax the response, add the offsets
    at the peak scaled by valid_radius_factor * H."""
    keep = list(keep)
    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep]
                       + ["px double", "py double", "maxval double"])

    def run(it):
        for pdf in it:
            if pdf.empty:
                yield pd.DataFrame({c: pd.Series(dtype="float64") for c in keep + ["px", "py", "maxval"]})
                continue
            hb = blur(_stack(pdf[heat], h, w), 2 * kernel + 1)
            ox = blur(_stack(pdf[off_x], h, w), kernel)
            oy = blur(_stack(pdf[off_y], h, w), kernel)
            px, py, mx = argmax_np(hb)
            r = np.arange(len(px))
            xi, yi = px.astype(np.int64), py.astype(np.int64)
            rad = valid_radius_factor * h
            out = pdf[keep].copy()
            out["px"] = px + ox[r, yi, xi] * rad
            out["py"] = py + oy[r, yi, xi] * rad
            out["maxval"] = mx
            yield out
    return df.select(*keep, heat, off_x, off_y).mapInPandas(run, schema)


def modulate_rows(df: DataFrame, kernel: int = 11, hm: str = "hm", h: int = 64, w: int = 48) -> DataFrame:
    """F4 as an operator: replaces ``hm`` with its Gaussian-modulated map."""
    cols = df.columns
    schema = df.schema

    def run(it):
        for pdf in it:
            if pdf.empty:
                yield pdf
                continue
            b = modulate(_stack(pdf[hm], h, w), kernel)
            pdf = pdf.copy()
            pdf[hm] = list(b.reshape(len(pdf), -1))
            yield pdf
    return df.select(*cols).mapInPandas(run, schema)


def native_decode(df: DataFrame, hm="hm", h="h", w="w", mode: str = "default") -> DataFrame:
    """F1 + F3 fully in Catalyst (argmax and quarter shift)."""
    am = H.argmax(hm, w)
    df = df.withColumn("px", am["px"]).withColumn("py", am["py"]).withColumn("maxval", am["maxval"])
    if mode in ("default", "megvii"):
        q = H.quarter_shift(hm, "px", "py", h, w, megvii=(mode == "megvii"))
        df = df.withColumn("px2", q["px"]).withColumn("py2", q["py"]).drop("px", "py") \
               .withColumnRenamed("px2", "px").withColumnRenamed("py2", "py")
    return df
