"""Picture jobs: each box posed once, pictures posed together, series smoothed side by side."""

import os
import tempfile
from collections import Counter
from functools import partial

import numpy as np
import pytest

from posetide.operators import images as D
from posetide.operators import score as P
from posetide.operators.track import AdaptiveLowPass, AdaptiveLowPasses
from posetide.plans import jobs as J
from posetide.sources.images import block_png, decode_png, encode_png, frame_fetch, synthetic_fetch


def _logging_fetch(log, fetch):
    def run(url):  # a local function travels to the workers as it is
        with open(log, "a") as f:
            f.write(f"{url}\n")
        return fetch(url)
    return run


def _watched_model(log):
    class Watched(P.GridPoseModel):
        def predict(self, images):
            with open(log, "a") as f:
                f.write(f"{len(images)}\n")
            return P.GridPoseModel.predict(self, images)
    return Watched()


def _lines(log):
    with open(log) as f:
        return f.read().split()


def test_video_poses_fetches_a_frame_for_detection_and_once_a_box(spark):
    log = os.path.join(tempfile.mkdtemp(prefix="posetide-video-"), "urls")
    frames = spark.createDataFrame([(v, i, f"frame://{v}/{i}?x={20 + 2 * i}&y=40&w=40&h=80") for v in (1, 2) for i in range(6)],
                                   "video_id long, frame_idx int, url string")
    out = J.video_poses(frames, "url", fetcher=_logging_fetch(log, frame_fetch)).collect()
    assert len(out) == len(set((r.video_id, r.frame_idx, r.track_id, r.joint) for r in out)) == 2 * 6 * 25
    assert set(Counter(_lines(log)).values()) == {2}  # before: 3, the joints were counted in a run of their own


def test_long_series_of_joints_are_stored_not_posed_again(spark, monkeypatch):
    frames = spark.createDataFrame([(1, i, f"frame://1/{i}?x={20 + 2 * i}&y=40&w=40&h=80") for i in range(6)],
                                   "video_id long, frame_idx int, url string")
    want = sorted(J.video_poses(frames, "url", fetcher=frame_fetch).collect())
    log = os.path.join(tempfile.mkdtemp(prefix="posetide-video-"), "urls")
    monkeypatch.setattr(J.T, "LONG_SERIES", 3)
    assert sorted(J.video_poses(frames, "url", fetcher=_logging_fetch(log, frame_fetch)).select(*want[0].asDict()).collect()) == want
    assert set(Counter(_lines(log)).values()) == {2}


def test_pictures_are_posed_together(spark):
    log = os.path.join(tempfile.mkdtemp(prefix="posetide-cut-"), "calls")
    urls = [f"/p/{i}.jpg" for i in range(40)] + [None, "/p/page.html"]
    df = spark.createDataFrame(list(enumerate(urls)), "k long, u string").coalesce(1)
    fetch = partial(synthetic_fetch, size=(400, 240))
    got = {r.k: r for r in P.score_images(df, "u", ["k"], fetch, pose_model=_watched_model(log), segmenter=P.DarkMaskSegmenter(),
                                          num_partitions=1).collect()}
    assert sum(map(int, _lines(log))) == sum(r.jx is not None for r in got.values()) > 20
    assert max(map(int, _lines(log))) == P.POSE_BATCH  # before: a call a picture
    assert got[40].error == got[41].error == "fetch" and got[40].n_persons is None
    for k in range(40):
        img = decode_png(fetch(urls[k]))
        img = D.composite_on_white(img, P.DarkMaskSegmenter().predict([img])[0])
        d = P.DarkBlobDetector().predict([img])[0]
        assert got[k].n_persons == len(d) and (got[k].img_w, got[k].img_h) == (400, 240)
        if len(d):
            box = P._pad_clip_np(d[0], 400, 240)
            assert (got[k].bx1, got[k].by1, got[k].bx2, got[k].by2) == box
            assert [got[k].jx, got[k].jy, got[k].js] == [a.tolist() for a in P._pose_in_box(P.GridPoseModel(), img, box)]


def test_poses_of_maps_of_several_sizes_and_empty_boxes():
    class Model:
        def predict(self, images):
            return [P.GridPoseModel(hm_w=48 if i.shape[0] > 60 else 32).predict([i])[0] for i in images]
    img = decode_png(frame_fetch("frame://1/1?x=12&y=40&w=40&h=80"))
    boxes = [(2, 30, 62, 130), (5, 5, 5, 9), (10, 40, 50, 80), (0, 0, 320, 240)]
    for udp in (True, False):
        got = P._poses_in_boxes(Model(), [(img, b) for b in boxes], udp)
        assert got[1] is None
        for b, g in zip(boxes, got):
            one = P._pose_in_box(Model(), img, b, udp)
            assert (one is None and g is None) or all(np.array_equal(x, y) for x, y in zip(one, g))


def test_grid_model_equals_the_plain_gaussians():
    img = decode_png(frame_fetch("frame://1/1?x=12&y=40&w=40&h=80"))
    yy, xx = np.mgrid[0:64, 0:48]
    x0, x1, y0, y1 = 12 / 320, 52 / 320, 40 / 240, 120 / 240
    for j, hm in enumerate(P.GridPoseModel().predict([img])[0]):
        cx, cy = (x0 + (x1 - x0) * ((j % 5) + 0.5) / 5) * 47, (y0 + (y1 - y0) * ((j // 5) + 0.5) / 5) * 63
        assert np.allclose(hm, np.exp(-((xx - cx) ** 2 + (yy - cy) ** 2) / 8.0), rtol=2e-7, atol=1e-40)


def test_blank_and_small_masks_are_not_blended(monkeypatch):
    rng = np.random.default_rng(6)
    img = rng.integers(0, 256, (30, 20, 3)).astype(np.uint8)
    mask = np.zeros((30, 20), dtype=np.uint8)
    soft = mask.copy()
    soft[4:9, 3:7] = rng.integers(0, 256, (5, 4))
    m = soft.astype(np.float32)[..., None] / 255
    assert np.array_equal(D.composite_on_white(img, soft), (img.astype(np.float32) * m + 255.0 * (1 - m)).round().astype(np.uint8))
    monkeypatch.setattr(D, "_blended", None)
    assert (D.composite_on_white(img, mask) == 255).all()  # before: blended pixel by pixel
    mask[4:9, 3:7] = 255
    mask[6, 5] = 0
    assert np.array_equal(D.composite_on_white(img, mask), np.where(mask[..., None] > 0, img, 255))


@pytest.mark.parametrize("white", [240, 1])
def test_dark_extent_equals_the_mask(white):
    rng = np.random.default_rng(7)
    for shape in ((9, 7, 3), (9, 7), (9, 7, 4)):
        for share in (0.0, 0.02, 0.5):
            img = np.where(rng.random(shape) < share, 0, 255).astype(np.uint8)
            mask = (img if img.ndim == 2 else img.min(axis=2)) < white
            assert D.dark_extent(img, white) == (D.extent(mask) if mask.any() else None)


def test_stand_in_pictures_equal_the_encoded_pixels():
    rng = np.random.default_rng(8)
    for most in (3, 40, 500):
        for _ in range(60):
            w, h = (int(v) for v in rng.integers(1, most + 1, 2))
            (x0, x1), (y0, y1) = (rng.integers(-5, n + 5, 2).tolist() for n in (w, h))
            colour = tuple(rng.integers(0, 256, 3).tolist())
            img = np.full((h, w, 3), 255, dtype=np.uint8)
            img[max(0, y0):max(0, y1), max(0, x0):max(0, x1)] = colour
            assert np.array_equal(decode_png(block_png(w, h, x0, y0, x1, y1, colour)), img)
            assert np.array_equal(decode_png(encode_png(img)), img)


@pytest.mark.parametrize("gap", ["reset", "sentinel"])
@pytest.mark.parametrize("longest", [3, 30, 200])
def test_series_side_by_side_equal_one_by_one(gap, longest):
    rng = np.random.default_rng(9)
    for series in (1, 5, 60):
        key = np.repeat(np.arange(series), rng.integers(1, longest, series))
        n = len(key)
        t = np.cumsum(rng.integers(0, 3, n)).astype(float)
        x = rng.uniform(-3, 100, (n, 2))
        x[rng.random((n, 2)) < 0.2] = np.nan
        want, now = [], None
        for k, when, row in zip(key, t, x):
            if k != now:
                now, own = k, [AdaptiveLowPass(gap=gap) for _ in row]
            want.append([f.next(float(v), float(when)) for f, v in zip(own, row)])
        walk, got, now, i = AdaptiveLowPasses(1.7, 0.3, 30.0, gap), [], None, 0
        while i < n:  # batches cut series anywhere
            j = min(n, i + int(rng.integers(1, 400)))
            new = np.append(True, key[i + 1:j] != key[i:j - 1])
            got.append(walk.walk(np.flatnonzero(new), key[i] == now, t[i:j], x[i:j]))
            now, i = key[j - 1], j
        assert np.array_equal(np.concatenate(got), want, equal_nan=True)
