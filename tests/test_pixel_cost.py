"""Pixel work that reads only what it needs, against the plain forms."""

import numpy as np
import pytest

from posetide.operators import heatmap as OH
from posetide.operators import images as D
from posetide.operators import score as P
from posetide.sources.images import decode_png, encode_png


@pytest.mark.parametrize("shape,k", [((64, 48), 11), ((8, 8), 11), ((1, 5), 3), ((9, 1), 5)])
def test_blur_at_cells_equals_blur(shape, k):
    rng = np.random.default_rng(3)
    b = rng.uniform(0, 1, (25, *shape))
    rows, cols = rng.integers(0, shape[0], (25, 3)), rng.integers(0, shape[1], (25, 3))
    assert np.array_equal(OH.blur_at(b, k, rows, cols), OH.blur(b, k)[np.arange(25)[:, None, None], rows[:, :, None], cols[:, None, :]])


def _plain_udp(batch, px, py, k):
    n, h, w = batch.shape
    pad = np.pad(np.log(np.clip(OH.blur(batch, k), 0.001, 50)), ((0, 0), (1, 1), (1, 1)), mode="edge")
    x, y, r = px.astype(np.int64) + 1, py.astype(np.int64) + 1, np.arange(n)

    def v(i, j):
        return pad[r, np.clip(y + j, 0, h + 1), np.clip(x + i, 0, w + 1)]
    dx, dy = 0.5 * (v(1, 0) - v(-1, 0)), 0.5 * (v(0, 1) - v(0, -1))
    b = 0.5 * (v(1, 1) - v(1, 0) - v(0, 1) + v(0, 0) + v(0, 0) - v(-1, 0) - v(0, -1) + v(-1, -1))
    eps = np.finfo(np.float32).eps
    a, d = v(1, 0) - 2 * v(0, 0) + v(-1, 0) + eps, v(0, 1) - 2 * v(0, 0) + v(0, -1) + eps
    return px - (d * dx - b * dy) / (a * d - b * b), py - (-b * dx + a * dy) / (a * d - b * b)


def test_dark_udp_blurs_only_around_the_peaks(monkeypatch):
    rng = np.random.default_rng(4)
    b = rng.uniform(0, 1, (40, 16, 12))
    b[3] = -1.0                                   # no peak: (-1, -1)
    b[4, 0, 0], b[5, 15, 11], b[6, 0, 11] = 9, 9, 9
    px, py, _ = OH.argmax_np(b)
    want = _plain_udp(b, px, py, 11)
    monkeypatch.setattr(OH, "blur", None)         # before, every map was blurred whole
    got = OH.dark_udp(b, px, py, 11)
    assert np.array_equal(got[0], want[0]) and np.array_equal(got[1], want[1])


def test_composite_equals_the_plain_form():
    rng = np.random.default_rng(5)
    img = rng.integers(0, 256, (30, 20, 3)).astype(np.uint8)
    for mask in (rng.integers(0, 2, (30, 20)), rng.integers(0, 2, (30, 20)) * 255, np.zeros((30, 20)), rng.integers(0, 256, (30, 20))):
        m = mask.astype(np.float32) / (255 if mask.max() > 1 else 1)
        want = (img.astype(np.float32) * m[..., None] + 255.0 * (1 - m[..., None])).round().astype(np.uint8)
        assert np.array_equal(D.composite_on_white(img, mask), want)


def test_png_and_dark_box():
    img = np.full((40, 30, 3), 255, dtype=np.uint8)
    img[5:30, 7:20] = (10, 200, 30)
    assert np.array_equal(decode_png(encode_png(img)), img)
    assert np.array_equal(decode_png(encode_png(img[..., 0])), np.repeat(img[..., :1], 3, axis=2))
    assert P.DarkBlobDetector().predict([img])[0].tolist() == [[7, 5, 20, 30, 0.9, 0]]


def test_resize_equals_the_plain_form_in_values_and_layout():
    """Sums over a picture follow its layout, so that is part of the result. The
    source rows are widened once: before, once for each row of the result."""
    rng = np.random.default_rng(5)
    for img in (rng.integers(0, 256, (30, 20, 3)).astype(np.uint8), rng.integers(0, 256, (30, 20)).astype(np.uint8)):
        a = img.astype(np.float32).reshape(30, 20, -1)
        ys, xs = (np.arange(50) + 0.5) * (30 / 50) - 0.5, (np.arange(33) + 0.5) * (20 / 33) - 0.5
        y0, x0 = np.clip(np.floor(ys).astype(int), 0, 29), np.clip(np.floor(xs).astype(int), 0, 19)
        y1, x1 = np.clip(y0 + 1, 0, 29), np.clip(x0 + 1, 0, 19)
        wy, wx = np.clip(ys - y0, 0, 1)[:, None, None], np.clip(xs - x0, 0, 1)[None, :, None]
        top = a[y0][:, x0] * (1 - wx) + a[y0][:, x1] * wx
        bot = a[y1][:, x0] * (1 - wx) + a[y1][:, x1] * wx
        want, got = (top * (1 - wy) + bot * wy).astype(np.float32), D.resize_bilinear(img, 33, 50)
        assert np.array_equal(got, want) and got.strides[:2] == want.strides[:2]
