"""Model scoring (P1-P4, P7-P9): one predictor interface, batched per Arrow
batch, model loaded once per Python worker.

A predictor has ``load()`` and ``predict(images) -> list`` and is shipped to
executors by pickling its (small) configuration; the weights are opened on
the worker from a provisioned artifact (A8) and cached in the worker
process (P7: the Python worker is reused across tasks). Operators select
and filter their inputs before the Arrow stage, because ``mapInPandas`` is
opaque to Catalyst (no pruning or pushdown through it).

Built-in predictors are deterministic numpy models for tests and for jobs
without weights; ``OnnxPredictor`` runs a real network through onnxruntime.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posetide.operators import heatmap as OH
from posetide.operators.images import composite_on_white, dark_extent, darkest, pad_to, to_network_input
from posetide.sources.images import decode_any

_WORKER_CACHE: dict = {}


def spread(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Spread scoring input (small rows: keys + URL) over enough tasks
    before an Arrow model stage. A source of a few large files would
    otherwise score everything in one task. Default: twice the cluster's
    default parallelism."""
    n = num_partitions or max(1, 2 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n)


def keep_freed_memory() -> None:
    """Let this Python worker keep up to 32 MB of what it frees. The C library
    sets that limit by the largest block freed so far; below it, each picture and
    heatmap would be given back to the system and fetched page by page again."""
    if "kept" not in _WORKER_CACHE:
        _WORKER_CACHE["kept"] = np.empty(1 << 24, dtype=np.uint8).size  # freed at once, never touched


def cached(predictor):
    """One loaded model per Python worker and predictor configuration."""
    keep_freed_memory()
    key = (type(predictor).__name__, repr(sorted(vars(predictor).items())))
    m = _WORKER_CACHE.get(key)
    if m is None:
        predictor.load()
        _WORKER_CACHE[key] = m = predictor
    return m


class DarkBlobDetector:
    """P1 stand-in: one 'person' box around the non-white pixels of an image
    (score 0.9, class 0); no box on a blank picture."""

    def __init__(self, white: int = 240, min_pixels: int = 20):
        self.white, self.min_pixels = white, min_pixels

    def load(self):
        pass

    def predict(self, images):
        out = []
        for img in images:
            found = dark_extent(img, self.white)
            if found is None or (darkest(img[found[2]:found[3] + 1, found[0]:found[1] + 1]) < self.white).sum() < self.min_pixels:
                out.append(np.zeros((0, 6)))
                continue
            x0, x1, y0, y1 = found
            out.append(np.array([[x0, y0, x1 + 1, y1 + 1, 0.9, 0]], dtype=np.float64))
        return out


class GridPoseModel:
    """P2 stand-in: for a crop, Gaussian heatmaps (K x 64 x 48) peaking at K
    joints laid out on a grid inside the crop's dark region."""

    def __init__(self, num_joints: int = 25, hm_w: int = 48, hm_h: int = 64, sigma: float = 2.0):
        self.k, self.w, self.h, self.sigma = num_joints, hm_w, hm_h, sigma

    def load(self):
        pass

    def predict(self, images):
        j = np.arange(self.k)
        cells_x, cells_y = np.arange(self.w), np.arange(self.h)
        hms = np.empty((len(images), self.k, self.h, self.w), dtype=np.float32)
        product = np.empty(hms.shape[1:])
        for hm, img in zip(hms, images):
            found = dark_extent(img, 240)
            if found is not None:
                x0, x1, y0, y1 = found
                x0, x1 = x0 / img.shape[1], (x1 + 1) / img.shape[1]
                y0, y1 = y0 / img.shape[0], (y1 + 1) / img.shape[0]
            else:
                x0, x1, y0, y1 = 0.25, 0.75, 0.25, 0.75
            cx = (x0 + (x1 - x0) * ((j % 5) + 0.5) / 5) * (self.w - 1)
            cy = (y0 + (y1 - y0) * ((j // 5) + 0.5) / 5) * (self.h - 1)
            # a Gaussian is the product of its sections
            across = np.exp(-(cells_x - cx[:, None]) ** 2 / (2 * self.sigma ** 2))
            down = np.exp(-(cells_y - cy[:, None]) ** 2 / (2 * self.sigma ** 2))
            hm[...] = np.multiply(down[:, :, None], across[:, None, :], out=product)
        return list(hms)


class DarkMaskSegmenter:
    """P3 stand-in: foreground mask = non-white pixels (0/255)."""

    def load(self):
        pass

    def predict(self, images):
        out = []
        for img in images:
            mask, found = np.zeros(img.shape[:2], dtype=np.uint8), dark_extent(img, 240)
            if found is not None:
                part = np.s_[found[2]:found[3] + 1, found[0]:found[1] + 1]
                mask[part] = (darkest(img[part]) < 240) * np.uint8(255)
            out.append(mask)
        return out


class OnnxPredictor:
    """Runs an ONNX network (weights provisioned with A8); input is the
    normalised CHW batch, output the network's first tensor."""

    def __init__(self, artifact: str, input_name: str | None = None):
        self.artifact, self.input_name = artifact, input_name
        self.session = None

    def load(self):
        import onnxruntime as ort
        from posetide.sources.images import artifact_path
        self.session = ort.InferenceSession(artifact_path(self.artifact), providers=["CPUExecutionProvider"])
        if self.input_name is None:
            self.input_name = self.session.get_inputs()[0].name

    def predict(self, images):
        batch = np.stack([to_network_input(i) for i in images]).astype(np.float32)
        return list(self.session.run(None, {self.input_name: batch})[0])


DET_SCHEMA = "det_idx int, x1 double, y1 double, x2 double, y2 double, score double, class_id int"


def detect(df: DataFrame, content: str, keys: list[str], predictor=None) -> DataFrame:
    """Encoded images -> detection rows (keys..., det_idx, box, score,
    class). Images that fail to decode yield no rows."""
    predictor = predictor or DarkBlobDetector()
    kt = {c: t for c, t in df.dtypes}
    schema = ", ".join(f"{k} {kt[k]}" for k in keys) + ", " + DET_SCHEMA

    def run(it):
        model = cached(predictor)
        for pdf in it:
            rows = []
            imgs, metas = [], []
            for _, r in pdf.iterrows():
                if r[content] is None:
                    continue
                try:
                    imgs.append(decode_any(bytes(r[content])))
                    metas.append(tuple(r[k] for k in keys))
                except Exception:  # noqa: BLE001
                    continue
            for meta, dets in zip(metas, model.predict(imgs) if imgs else []):
                for i, d in enumerate(dets):
                    rows.append(meta + (i, float(d[0]), float(d[1]), float(d[2]), float(d[3]), float(d[4]), int(d[5])))
            yield pd.DataFrame(rows, columns=keys + [c.split()[0] for c in DET_SCHEMA.split(", ")])
    return df.select(*keys, content).where(F.col(content).isNotNull()).mapInPandas(run, schema)


def estimate_pose(crops: DataFrame, content: str, keys: list[str], box_cols=("bx1", "by1", "bx2", "by2"),
                  predictor=None, udp: bool = True, kernel: int = 11) -> DataFrame:
    """P2 + C4 + D4/D5 + F9 + C5 in one Arrow stage: crop the box from the
    image, pad it to 3:4, run the pose model, decode the heatmaps (DARK-UDP
    by default) and map joints back to image coordinates. Heatmaps are never
    materialised as rows. Output: keys..., joint, x, y, score."""
    predictor = predictor or GridPoseModel()
    kt = {c: t for c, t in crops.dtypes}
    schema = ", ".join(f"{k} {kt[k]}" for k in keys) + ", joint int, x double, y double, score double"

    def run(it):
        model = cached(predictor)
        for pdf in it:
            out = []
            for _, r in pdf.iterrows():
                img = decode_any(bytes(r[content]))
                x1, y1, x2, y2 = (int(r[c]) for c in box_cols)
                c = img[y1:y2, x1:x2]
                if c.size == 0 or c.shape[0] == 0:
                    continue  # Q15: degenerate crop
                h, w = c.shape[:2]
                if w / h < 0.75:
                    tw = int(0.75 * h)
                    left, top, pw, ph = (tw - w) // 2, 0, tw, h
                else:
                    th = int(w / 0.75)
                    left, top, pw, ph = 0, (th - h) // 2, w, th
                padded = pad_to(c, left, top, pw, ph)
                hms = model.predict([padded])[0]
                k, hh, ww = hms.shape
                b = hms.astype(np.float64)
                px, py, mx = OH.argmax_np(b)
                if udp:
                    px, py = OH.dark_udp(b.copy(), px, py, kernel)
                    sx, sy = pw / (ww - 1.0), ph / (hh - 1.0)
                else:
                    px, py = OH._shift_np(b, px, py, False)
                    sx, sy = pw / ww, ph / hh
                # heatmap -> padded crop (centre w//2, h//2; scale w, h) -> image
                cx, cy = pw // 2, ph // 2
                X = px * sx + cx - pw * 0.5 + x1 - left
                Y = py * sy + cy - ph * 0.5 + y1 - top
                meta = tuple(r[kk] for kk in keys)
                for j in range(k):
                    out.append(meta + (j, float(X[j]), float(Y[j]), float(mx[j])))
            yield pd.DataFrame(out, columns=keys + ["joint", "x", "y", "score"])
    return crops.select(*keys, content, *box_cols).mapInPandas(run, schema)


def segment_composite(df: DataFrame, content: str, keys: list[str], predictor=None) -> DataFrame:
    """P3 + D6: foreground mask, composite on white; returns keys + the
    composited PNG bytes (content_fg)."""
    from posetide.sources.images import encode_png
    predictor = predictor or DarkMaskSegmenter()
    kt = {c: t for c, t in df.dtypes}
    schema = ", ".join(f"{k} {kt[k]}" for k in keys) + ", content_fg binary"

    def run(it):
        model = cached(predictor)
        for pdf in it:
            rows = []
            for _, r in pdf.iterrows():
                img = decode_any(bytes(r[content]))
                mask = model.predict([img])[0]
                rows.append(tuple(r[k] for k in keys) + (encode_png(composite_on_white(img, mask)),))
            yield pd.DataFrame(rows, columns=keys + ["content_fg"])
    return df.select(*keys, content).where(F.col(content).isNotNull()).mapInPandas(run, schema)


def mirror_average(hm: np.ndarray, hm_flipped: np.ndarray, flip_perm: list[int], shift: bool = True,
                   average: bool = True) -> np.ndarray:
    """Un-flip the heatmaps of the mirrored input (swap channels, reverse
    x, optional 1-px shift right) and average with the direct ones. The
    reference returns only the flipped-back map (``average=False``)."""
    back = hm_flipped[..., flip_perm, :, :][..., ::-1]
    if shift:
        back = np.concatenate([back[..., :1], back[..., :-1]], axis=-1)
    return (hm + back) * 0.5 if average else back


# ---------------------------------------------------------------------------
# One-pass image scoring (P4 chain inside one Arrow stage)
# ---------------------------------------------------------------------------

SCORED_FIELDS = ("img_w int, img_h int, error string, n_persons int, bx1 long, by1 long, bx2 long, by2 long, "
                 "jx array<double>, jy array<double>, js array<double>")


def _pad_clip_np(b, w, h, pad=10):
    """C3 in numpy (same rule as the native expression: half-even rounding,
    pad, clip to [0, W] x [0, H])."""
    x1, y1, x2, y2 = (round(float(v)) for v in b[:4])
    return (min(max(x1 - pad, 0), w), min(max(y1 - pad, 0), h),
            min(max(x2 + pad, 0), w), min(max(y2 + pad, 0), h))


#: Pictures of which the poses are found together: so many, fewer if they are large.
POSE_BATCH, POSE_BYTES = 8, 1 << 24


def _stacked(maps: list[np.ndarray]) -> np.ndarray:
    """Maps of one shape end to end, not copied if they are the parts of one array
    in order, as most models give them."""
    whole = maps[0].base
    if (isinstance(whole, np.ndarray) and whole.shape == (len(maps), *maps[0].shape)
            and all(m.__array_interface__ == part.__array_interface__ for m, part in zip(maps, whole))):
        return whole.reshape(-1, *whole.shape[2:])
    return np.concatenate(maps)


def _poses_in_boxes(model, pictures, udp=True, kernel=11):
    """C4 + D4/D5 + P2 + F9 + C5 for (picture, box) pairs, one model call:
    (x, y, score) arrays of each, None for an empty box (Q15)."""
    found: list = [None] * len(pictures)
    crops, places = [], []
    for i, (img, (x1, y1, x2, y2)) in enumerate(pictures):
        c = img[y1:y2, x1:x2]
        if c.size == 0:
            continue  # Q15: degenerate crop
        h, w = c.shape[:2]
        if w / h < 0.75:
            tw = int(0.75 * h)
            left, top, pw, ph = (tw - w) // 2, 0, tw, h
        else:
            th = int(w / 0.75)
            left, top, pw, ph = 0, (th - h) // 2, w, th
        crops.append(pad_to(c, left, top, pw, ph))
        places.append((i, x1, y1, left, top, pw, ph))
    maps = [np.asarray(m) for m in model.predict(crops)] if crops else []
    for shape in dict.fromkeys(m.shape for m in maps):
        same = [n for n, m in enumerate(maps) if m.shape == shape]
        k, hh, ww = shape
        hms = _stacked([maps[n] for n in same])
        at, x1, y1, left, top, pw, ph = np.array([places[n] for n in same]).T[:, :, None]
        px, py, mx = OH.argmax_np(hms)
        if udp:
            px, py = OH.dark_udp(hms, px, py, kernel)
            sx, sy = pw / (ww - 1.0), ph / (hh - 1.0)
        else:
            px, py = OH._shift_np(hms.astype(np.float64), px, py, False)
            sx, sy = pw / ww, ph / hh
        X = px.reshape(-1, k) * sx + pw // 2 - pw * 0.5 + x1 - left
        Y = py.reshape(-1, k) * sy + ph // 2 - ph * 0.5 + y1 - top
        for i, *pose in zip(at[:, 0].tolist(), X, Y, mx.astype(np.float64).reshape(-1, k)):
            found[i] = tuple(pose)
    return found


def _posed(model, pictures):
    """(key, pose) of each of (key, picture, box); a batch of pictures is held."""
    held: list = []
    size = 0
    for key, img, box in pictures:
        held.append((key, img, box))
        size += img.nbytes
        if len(held) == POSE_BATCH or size >= POSE_BYTES:
            yield from zip([h[0] for h in held], _poses_in_boxes(model, [h[1:] for h in held]))
            held, size = [], 0
    yield from zip([h[0] for h in held], _poses_in_boxes(model, [h[1:] for h in held]))


def _pose_in_box(model, img, box, udp=True, kernel=11):
    """The pose in one box: (x, y, score) arrays."""
    return _poses_in_boxes(model, [(img, box)], udp, kernel)[0]


def score_images(df: DataFrame, url_col: str, keys: list[str], fetcher, detector=None, pose_model=None,
                 segmenter=None, class_id: int = 0, score_thr: float = 0.35,
                 num_partitions: int | None = None) -> DataFrame:
    """P4 (+P3/D6 when a segmenter is given) in a single Arrow stage per
    image: fetch (A3), decode, optional foreground composite, detect (P1),
    person gate (B7), first person's padded box (C3), pose + decode + map
    back (P2, F9, C5). Emits one small row per image — never the pixels —
    so downstream gates and geometry stay native and nothing is recomputed.
    Errors are data ('fetch' / 'decode')."""
    import pandas as pd
    detector = detector or DarkBlobDetector()
    kt = {c: t for c, t in df.dtypes}
    schema = ", ".join(f"{k} {kt[k]}" for k in keys) + ", " + SCORED_FIELDS
    fields = [f.split()[0] for f in SCORED_FIELDS.split(", ")]

    def run(it):
        det = cached(detector)
        pose = cached(pose_model) if pose_model is not None else None
        seg = cached(segmenter) if segmenter is not None else None
        def persons(urls, rows):
            """A row a URL; (place, picture, box) of those with a person."""
            for url in urls:
                row = [None] * len(fields)
                rows.append(row)
                try:
                    data = fetcher(url)
                except Exception:  # noqa: BLE001
                    row[2] = "fetch"
                    continue
                try:
                    img = decode_any(data)
                except Exception:  # noqa: BLE001
                    row[2] = "decode"
                    continue
                h, w = img.shape[:2]
                if seg is not None:
                    img = composite_on_white(img, seg.predict([img])[0])
                d = det.predict([img])[0]
                d = d[(d[:, 5] == class_id) & (d[:, 4] > score_thr)] if len(d) else d
                row[0], row[1], row[3] = w, h, len(d)
                if len(d):
                    row[4:8] = _pad_clip_np(d[0], w, h)
                    yield len(rows) - 1, img, tuple(row[4:8])

        for pdf in it:
            rows: list = []
            found = persons(pdf[url_col], rows)
            for n, res in (_posed(pose, found) if pose is not None else ((n, None) for n, _, _ in found)):
                if res is not None:
                    rows[n][-3:] = res
            out = pd.DataFrame(rows, columns=fields, index=pdf.index)
            yield pd.concat([pdf[keys], out], axis=1)
    return spread(df.select(*dict.fromkeys(keys + [url_col])), num_partitions).mapInPandas(run, schema)


def detect_urls(df: DataFrame, url_col: str, keys: list[str], fetcher, detector=None,
                num_partitions: int | None = None) -> DataFrame:
    """P1 from URLs in one stage: keys + detection rows (all boxes), plus
    img_w/img_h on every row."""
    import pandas as pd
    detector = detector or DarkBlobDetector()
    kt = {c: t for c, t in df.dtypes}
    schema = ", ".join(f"{k} {kt[k]}" for k in keys) + ", img_w int, img_h int, " + DET_SCHEMA
    names = keys + ["img_w", "img_h"] + [c.split()[0] for c in DET_SCHEMA.split(", ")]

    def run(it):
        det = cached(detector)
        for pdf in it:
            rows = []
            for url, *meta in zip(pdf[url_col], *(pdf[k] for k in keys)):
                try:
                    img = decode_any(fetcher(url))
                except Exception:  # noqa: BLE001
                    continue
                h, w = img.shape[:2]
                for i, b in enumerate(det.predict([img])[0]):
                    rows.append((*meta, w, h, i) + tuple(float(v) for v in b[:5]) + (int(b[5]),))
            yield pd.DataFrame(rows, columns=names)
    return spread(df.select(*dict.fromkeys(keys + [url_col])), num_partitions).mapInPandas(run, schema)


def pose_urls(df: DataFrame, url_col: str, keys: list[str], fetcher, pose_model=None,
              box_cols=("bx1", "by1", "bx2", "by2"), num_partitions: int | None = None) -> DataFrame:
    """P2 + F9 + C5 for boxes of pictures given by URL (second Arrow stage of
    the video job): long-form joints keys + joint, x, y, score."""
    import pandas as pd
    pose_model = pose_model or GridPoseModel()
    kt = {c: t for c, t in df.dtypes}
    schema = ", ".join(f"{k} {kt[k]}" for k in keys) + ", joint int, x double, y double, score double"

    def run(it):
        model = cached(pose_model)
        for pdf in it:
            boxes = (tuple(map(int, b)) for b in zip(*(pdf[c] for c in box_cols)))
            pictures = ((n, decode_any(fetcher(u)), b) for n, (u, b) in enumerate(zip(pdf[url_col], boxes)))
            done = ((n, res) for n, res in _posed(model, pictures) if res is not None)
            while part := list(islice(done, 1000)):
                rows, poses = zip(*part)
                sizes = [len(p[0]) for p in poses]
                out = pdf[keys].iloc[np.repeat(rows, sizes)].reset_index(drop=True)
                out["joint"] = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
                for c, values in zip(("x", "y", "score"), zip(*poses)):
                    out[c] = np.concatenate(values)
                yield out
    return spread(df.select(*dict.fromkeys(keys + [url_col, *box_cols])), num_partitions).mapInPandas(run, schema)
