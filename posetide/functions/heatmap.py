"""Heatmap decoding as Catalyst array expressions.

A heatmap is a flat row-major ``array<double>`` with ``h`` and ``w`` columns;
cell (x, y) is element ``y * w + x`` (0-based; ``element_at`` is 1-based).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def at(hm, idx) -> Column:
    """0-based element access; null outside the array (guards are evaluated
    eagerly in generated code, so out-of-range reads must not raise)."""
    hm, i = _c(hm), _c(idx).cast("int")
    return F.when((i >= 0) & (i < F.size(hm)), F.element_at(hm, i + 1))


def cell(hm, x, y, w) -> Column:
    return at(hm, _c(y) * _c(w) + _c(x))


def argmax(hm, w) -> dict[str, Column]:
    """first position of the maximum; (-1, -1) when max <= 0."""
    hm, w = _c(hm), _c(w)
    mx = F.array_max(hm)
    idx = F.array_position(hm, mx) - 1
    pos = mx > 0
    return {"maxval": mx,
            "px": F.when(pos, (idx % w).cast("double")).otherwise(F.lit(-1.0)),
            "py": F.when(pos, F.floor(idx / w).cast("double")).otherwise(F.lit(-1.0))}


def argmax_3d(hm, d, h, w) -> dict[str, Column]:
    """3-D argmax over a flat D x H x W volume."""
    hm, h, w = _c(hm), _c(h), _c(w)
    mx = F.array_max(hm)
    idx = F.array_position(hm, mx) - 1
    pos = mx > 0
    neg = F.lit(-1.0)
    return {"maxval": mx,
            "px": F.when(pos, (idx % w).cast("double")).otherwise(neg),
            "py": F.when(pos, (F.floor(idx / w) % h).cast("double")).otherwise(neg),
            "pz": F.when(pos, F.floor(idx / (h * w)).cast("double")).otherwise(neg)}


def quarter_shift(hm, px, py, h, w, megvii: bool = False) -> dict[str, Column]:
    """move 0.25 px toward the larger neighbour on each axis when the
    peak is strictly inside (1 < px < W-1, 1 < py < H-1); +0.5 for megvii."""
    hm, px, py, h, w = map(_c, (hm, px, py, h, w))
    ix, iy = px.cast("long"), py.cast("long")
    inside = (ix > 1) & (ix < w - 1) & (iy > 1) & (iy < h - 1)
    dx = cell(hm, ix + 1, iy, w) - cell(hm, ix - 1, iy, w)
    dy = cell(hm, ix, iy + 1, w) - cell(hm, ix, iy - 1, w)
    extra = 0.5 if megvii else 0.0
    return {"px": F.when(inside, px + F.signum(dx) * 0.25 + extra).otherwise(px),
            "py": F.when(inside, py + F.signum(dy) * 0.25 + extra).otherwise(py)}


def taylor(hm, px, py, h, w) -> dict[str, Column]:
    """second-order refinement at the integer peak of a (log) heatmap;
    needs 1 < px < W-2, 1 < py < H-2 and a non-singular Hessian. The 2x2
    system is solved in closed form."""
    hm, px, py, h, w = map(_c, (hm, px, py, h, w))
    x, y = px.cast("long"), py.cast("long")

    def v(dx_, dy_):
        return cell(hm, x + dx_, y + dy_, w)
    inside = (x > 1) & (x < w - 2) & (y > 1) & (y < h - 2)
    dx = 0.5 * (v(1, 0) - v(-1, 0))
    dy = 0.5 * (v(0, 1) - v(0, -1))
    dxx = 0.25 * (v(2, 0) - 2 * v(0, 0) + v(-2, 0))
    dxy = 0.25 * (v(1, 1) - v(1, -1) - v(-1, 1) + v(-1, -1))
    dyy = 0.25 * (v(0, 2) - 2 * v(0, 0) + v(0, -2))
    det = dxx * dyy - dxy * dxy
    ok = inside & (det != 0)
    ox = -(dyy * dx - dxy * dy) / det
    oy = -(-dxy * dx + dxx * dy) / det
    return {"px": F.when(ok, px + ox).otherwise(px), "py": F.when(ok, py + oy).otherwise(py)}


def to_image(px, py, center_x, center_y, scale_x, scale_y, out_w, out_h, udp: bool = False) -> dict[str, Column]:
    """F8: heatmap coordinates -> image coordinates. Scale is in pixels
    (the reference's x200 is commented out, Q9). UDP divides by (W-1, H-1)."""
    px, py, cx, cy, sx, sy, ow, oh = map(_c, (px, py, center_x, center_y, scale_x, scale_y, out_w, out_h))
    kx = sx / ((ow - 1.0) if udp else ow.cast("double"))
    ky = sy / ((oh - 1.0) if udp else oh.cast("double"))
    return {"x": px * kx + cx - sx * 0.5, "y": py * ky + cy - sy * 0.5}


def regression_to_image(rx, ry, center_x, center_y, scale_x, scale_y, img_w, img_h) -> dict[str, Column]:
    """normalised regression output -> image coordinates, score 1."""
    rx, ry, img_w, img_h = map(_c, (rx, ry, img_w, img_h))
    out = to_image(rx * img_w, ry * img_h, center_x, center_y, scale_x, scale_y, img_w, img_h)
    out["score"] = F.lit(1.0)
    return out


def flip_back_cells(hm, h, w, negate: bool = False) -> Column:
    """F11 (per channel): mirror a heatmap left-right; ``negate`` flips the
    sign too (x-offset channels of combined targets). The channel swap of
    left/right joints is a join to the flip dimension."""
    hm, h, w = _c(hm), _c(h), _c(w)
    n = F.size(hm)
    out = F.transform(F.sequence(F.lit(0), n - 1),
                      lambda i: at(hm, F.floor(i / w) * w + (w - 1 - i % w)))
    return F.transform(out, lambda v: -v) if negate else out


def local_peaks(hm, h, w) -> Column:
    """cells equal to the max of their 3x3 neighbourhood (outside
    cells ignored, as -inf padding). Returns array<struct<cell, val>>."""
    hm, h, w = _c(hm), _c(h), _c(w)
    n = F.size(hm)

    def neigh_max(i):
        x, y = i % w, F.floor(i / w)
        vals = []
        for dy_ in (-1, 0, 1):
            for dx_ in (-1, 0, 1):
                xx, yy = x + dx_, y + dy_
                ok = (xx >= 0) & (xx < w) & (yy >= 0) & (yy < h)
                vals.append(F.when(ok, cell(hm, xx, yy, w)))
        return F.greatest(*vals)
    cells = F.transform(F.sequence(F.lit(0), n - 1),
                        lambda i: F.struct(i.alias("cell"), at(hm, i).alias("val"), neigh_max(i).alias("mx")))
    return F.filter(cells, lambda s: s["val"] == s["mx"])


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: as a lambda's argument it
    is not written out again at each use."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sliding_max(hm, h, w, size: int, along: str) -> Column:
    """Maximum over windows of ``size`` (odd) cells around each cell along the
    rows (``x``) or columns (``y``); cells outside the map count as absent.

    Windows are built by doubling: a maximum over 2p cells is the greater of
    two over p, and any window is covered by two of the greatest power of two
    that fits it. That takes about log2(size) passes instead of size; only cells
    nearer to the map's edge than half a window look at their window's cells
    one by one."""
    hm, h, w = _c(hm), _c(h), _c(w)
    step, length, place = (F.lit(1), w, lambda i: i % w) if along == "x" else (w, h, lambda i: F.floor(i / w))
    cells = F.sequence(F.lit(0), F.size(hm) - 1)

    def ahead(m, n):  # the greater of each cell and the one n steps on
        return F.transform(cells, lambda i: F.greatest(
            at(m, i), F.when(place(i) + n < length, at(m, (i + step * n).cast("int")))))

    def grow(m, have):  # m: maxima over ``have`` cells from each on
        if have * 2 <= size:
            return _bind(ahead(m, have), lambda n: grow(n, have * 2))
        tail = size - have
        whole = ahead(m, tail) if tail else m
        half = size // 2

        # the window of a cell near the start begins at the map's edge, and
        # ends where it would: two windows of ``have`` cells cover it as well
        def around(full):
            def pick(i):
                start = place(i) - half
                inner = at(full, (i - step * F.least(F.lit(half), place(i))).cast("int"))
                return F.when(start >= 0, inner).otherwise(edge(i))
            return F.transform(cells, pick)

        def edge(i):  # fewer than ``size`` cells: from the edge to place + half
            best = at(hm, i)
            for n in range(1, half + 1):
                best = F.greatest(best, F.when(place(i) - n >= 0, at(hm, (i - step * n).cast("int"))),
                                  F.when(place(i) + n < length, at(hm, (i + step * n).cast("int"))))
            return best
        return _bind(whole, around)
    if size == 1:
        return hm
    return _bind(hm, lambda m: grow(m, 1))


def local_peaks_window(hm, h, w, size: int = 3) -> Column:
    """F12 with any odd window: cells equal to the maximum of the ``size`` x
    ``size`` cells around them, as array<struct<cell, val>>. The maximum is
    separable: along the rows first, then along the columns."""
    if size < 1 or size % 2 == 0:
        raise ValueError("size must be odd and positive")
    hm, h, w = _c(hm), _c(h), _c(w)
    rows = sliding_max(hm, h, w, size, "x")
    both = _bind(rows, lambda m: sliding_max(m, h, w, size, "y"))
    cells = _bind(both, lambda m: F.transform(F.sequence(F.lit(0), F.size(hm) - 1), lambda i: F.struct(
        i.alias("cell"), at(hm, i).alias("val"), at(m, i).alias("mx"))))
    return F.transform(F.filter(cells, lambda s: s["val"] == s["mx"]),
                       lambda s: F.struct(s["cell"].alias("cell"), s["val"].alias("val")))


def adjust(hm, px, py, h, w) -> dict[str, Column]:
    """bottom-up quarter adjust: +-0.25 toward the larger clamped
    neighbour (ties go negative), then +0.5 on both axes."""
    hm, px, py, h, w = map(_c, (hm, px, py, h, w))
    xx, yy = px.cast("long"), py.cast("long")
    down = cell(hm, xx, F.least(h - 1, yy + 1), w)
    up = cell(hm, xx, F.greatest(F.lit(0), yy - 1), w)
    right = cell(hm, F.least(w - 1, xx + 1), yy, w)
    left = cell(hm, F.greatest(F.lit(0), xx - 1), yy, w)
    ny = F.when(down > up, py + 0.25).otherwise(py - 0.25)
    nx = F.when(right > left, px + 0.25).otherwise(px - 0.25)
    return {"px": nx + 0.5, "py": ny + 0.5}
