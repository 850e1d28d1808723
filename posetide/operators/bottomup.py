"""Bottom-up multi-person parsing.

F12 (peak NMS) and F13 (top-M per joint) are native. Grouping peaks into
people by their embedding tags (F14) is a sequential assignment over the
joints of one image; its input is bounded by construction (K joints x the
top-M peaks). Images do not depend on each other, so numpy takes each step of
that walk in all images of some Arrow batches at once. Refinement (F16) needs the image's K maps,
again bounded by the network's output size. Scores (F17) cover every image
(the reference scores only the first image of a batch, Q10).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posetide.operators.track import min_cost_assignments

# Joint visiting order of the 17-joint body model (1-based in the source
# convention, listed here 0-based); other joint counts use 0..K-1.
JOINT_ORDER_17 = [0, 1, 2, 3, 4, 5, 6, 11, 12, 7, 8, 9, 10, 13, 14, 15, 16]


def top_peaks(peaks: DataFrame, m: int, image="image_id", joint="joint", val="val", tie="peak_id") -> DataFrame:
    """the M strongest peaks per (image, joint) (total tie-break)."""
    w = Window.partitionBy(image, joint).orderBy(F.col(val).desc(), F.col(tie))
    return peaks.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= m)


class Places(NamedTuple):
    """Filled joints of the people found, by image, person and joint: the row of
    each one's candidate, and the person's score (mean value of all K joints)."""
    image: np.ndarray
    person: np.ndarray
    joint: np.ndarray
    row: np.ndarray
    score: np.ndarray


class _Groups:
    """People under construction in many images, as tables: the candidate at
    each joint (slot [B, P, K], -1 for none), and for each person the tag that
    opened it, the sum of the tags since then, and their number."""

    def __init__(self, images: int, people: int, num_joints: int, tag_size: int):
        self.slot = np.full((images, people, num_joints), -1)
        self.opened = np.full((images, people, tag_size), np.nan)
        self.sums, self.seen = np.zeros((images, people, tag_size)), np.zeros((images, people))
        self.count = np.zeros(images, int)

    def means(self, at: np.ndarray, limit: int) -> np.ndarray:
        return self.sums[at, :limit] / np.maximum(self.seen[at, :limit, None], 1)

    def put(self, at: np.ndarray, person: np.ndarray, joint: int, row: np.ndarray, tag: np.ndarray) -> None:
        """One candidate for each image ``at``: it joins its person, or opens one
        if that is -1. A person that the same tag opened starts again from it
        and keeps its other joints."""
        new = np.flatnonzero(person < 0)
        if len(new):
            i = at[new]
            same = (self.opened[i, :max(self.count[i].max(), 1)] == tag[new, None]).all(axis=2)
            known = same.any(axis=1)
            who = self.count[i]
            who[known] = same[known].argmax(axis=1)
            self.count[i] += ~known
            self.opened[i, who] = tag[new]
            self.sums[i, who], self.seen[i, who] = 0.0, 0.0
            person = person.copy()
            person[new] = who
        self.slot[at, person, joint] = row
        self.sums[at, person] += tag
        self.seen[at, person] += 1


def _size_classes(*sizes: np.ndarray) -> list[np.ndarray]:
    """Positions with sizes of the same powers of two."""
    _, of = np.unique(np.stack([np.frexp(s)[1] for s in sizes]), axis=1, return_inverse=True)
    order = np.argsort(of.ravel(), kind="stable")
    return np.split(order, np.cumsum(np.bincount(of.ravel()))[:-1])


def assign_by_tag(candidates: np.ndarray, number: np.ndarray, means: np.ndarray, known: np.ndarray,
                  tag_threshold: float, by_value: bool) -> np.ndarray:
    """Person of each candidate (x, y, value, tag...), -1 for none, by the
    cheapest one-to-one assignment in each image; image b has ``number[b]``
    candidates and ``known[b]`` people, what follows them is padding. The cost is
    the tag distance; ``by_value`` rounds it and lets the stronger candidate win
    among equals."""
    distance = np.linalg.norm(candidates[:, :, None, 3:] - means[:, None], axis=3)
    cost = np.round(distance) * 100 - candidates[:, :, 2:3] if by_value else distance
    # candidates without a person get places of their own that no one prefers
    wide = max(means.shape[1], int(number.max()))
    cost = np.pad(cost, ((0, 0), (0, 0), (0, wide - means.shape[1])))
    column = np.arange(wide)
    padding = np.where(column < np.maximum(number, known)[:, None], 1e10, np.inf)[:, None]
    place = min_cost_assignments(np.where((column < known[:, None])[:, None], cost, padding), number)
    person = np.where((place >= 0) & (place < known[:, None]), place, -1)
    near = np.take_along_axis(distance, np.maximum(person, 0)[:, :, None], axis=2)[:, :, 0] < tag_threshold
    return np.where(near, person, -1)


def group_by_tag(rows: np.ndarray, image: np.ndarray, joint: np.ndarray, num_joints: int,
                 detection_threshold: float = 0.1, tag_threshold: float = 1.0, use_detection_val: bool = True,
                 ignore_too_much: bool = False, max_num_people: int = 30) -> Places:
    """F14 for many images at once: candidates joint by joint join the person
    whose mean tag is near or open a new one. ``rows``: [N, 3 + T] (x, y, value,
    tag of T numbers), strongest first within (``image``, ``joint``), images in
    order. Images of like size take each step together."""
    strong = np.flatnonzero(rows[:, 2] > detection_threshold)
    image, joint = image[strong], joint[strong]
    start = np.flatnonzero(np.r_[True, image[1:] != image[:-1]]) if len(image) else np.zeros(0, int)
    size = np.diff(np.r_[start, len(image)])
    found = []
    for like in _size_classes(size) if len(start) else []:
        people = int(size[like].max())
        # the tables of a step hold some four million cells at most, or one image
        cells = people * (num_joints + min(people, max(max_num_people, 1)))
        for part in np.array_split(like, -(-len(like) * cells // (1 << 22))):
            number = size[part]
            own = np.repeat(np.arange(len(part)), number)
            at = np.repeat(start[part] - np.r_[0, np.cumsum(number)[:-1]], number) + np.arange(number.sum())
            groups = _Groups(len(part), people, num_joints, rows.shape[1] - 3)
            for k in JOINT_ORDER_17 if num_joints == 17 else range(num_joints):
                here = joint[at] == k
                if here.any():
                    _visit(groups, k, rows, own[here], strong[at[here]], tag_threshold, use_detection_val,
                           ignore_too_much, max_num_people)
            i, person, k = np.nonzero(groups.slot >= 0)
            value = np.zeros(groups.slot.shape)
            value[i, person, k] = rows[groups.slot[i, person, k], 2]
            found.append(Places(image[start[part]][i], person, k, groups.slot[i, person, k], value.mean(axis=2)[i, person]))
    if not found:
        return Places(*[np.zeros(0, int)] * 4, np.zeros(0))
    every = Places(*map(np.concatenate, zip(*found)))
    order = np.lexsort((every.joint, every.person, every.image))
    return Places(*(c[order] for c in every))


def _visit(groups: _Groups, k: int, rows: np.ndarray, own: np.ndarray, row: np.ndarray, tag_threshold: float,
           by_value: bool, ignore_too_much: bool, max_num_people: int) -> None:
    """One joint in all images: ``row`` are its candidates, ``own`` their images."""
    at, first, number = np.unique(own, return_index=True, return_counts=True)
    known = np.minimum(groups.count[at], max_num_people)
    if ignore_too_much:
        open_ = (known == 0) | (known < max_num_people)
        at, first, number, known = at[open_], first[open_], number[open_], known[open_]
        if not len(at):
            return
    rank = np.arange(number.max())
    there = rank < number[:, None]
    candidate = row[np.where(there, first[:, None] + rank, first[:, None])]
    person = np.full(candidate.shape, -1)
    some = np.flatnonzero(known > 0)
    for like in _size_classes(number[some], np.maximum(number, known)[some]) if len(some) else []:
        c = some[like]
        most = int(number[c].max())
        person[c, :most] = assign_by_tag(rows[candidate[c, :most]], number[c], groups.means(at[c], int(known[c].max())),
                                         known[c], tag_threshold, by_value)
    for r in rank:
        i = np.flatnonzero(there[:, r])
        groups.put(at[i], person[i, r], k, candidate[i, r], rows[candidate[i, r], 3:])


def match_by_tag(joints_in: list[np.ndarray], num_joints: int, **params) -> np.ndarray:
    """F14 for one image. ``joints_in[k]``: [M, 3 + T] rows (x, y, value, tag of
    T numbers). Returns [P, K, 3 + T] people; ``params`` as in group_by_tag."""
    given = [(k, np.asarray(c, np.float64)) for k, c in enumerate(joints_in[:num_joints]) if c is not None and len(c)]
    rows = np.concatenate([c for _, c in given]) if given else np.zeros((0, 4))
    joint = np.repeat([k for k, _ in given], [len(c) for _, c in given]).astype(int)
    found = group_by_tag(rows, np.zeros(len(rows), int), joint, num_joints, **params)
    people = np.zeros((found.person.max(initial=-1) + 1, num_joints, rows.shape[1]))
    people[found.person, found.joint] = rows[found.row]
    return people


def _quarter(maps: np.ndarray, joint: np.ndarray, y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(dx, dy): a quarter cell towards the larger neighbour, down and right
    only if it is strictly larger; neighbours beyond the edge are the cell."""
    _, h, w = maps.shape
    right, left = maps[joint, y, np.minimum(x + 1, w - 1)], maps[joint, y, np.maximum(x - 1, 0)]
    below, above = maps[joint, np.minimum(y + 1, h - 1), x], maps[joint, np.maximum(y - 1, 0), x]
    return np.where(right > left, 0.25, -0.25), np.where(below > above, 0.25, -0.25)


def adjust_people(hm: np.ndarray, people: np.ndarray, udp: bool = False) -> np.ndarray:
    """F15 for all people and joints at once: found joints move a quarter cell
    and to the cell's centre (not with UDP coding)."""
    out = people.copy()
    p, k = np.nonzero(people[:, :, 2] > 0)
    x, y = people[p, k, 0].astype(int), people[p, k, 1].astype(int)
    dx, dy = _quarter(hm, k, y, x)
    centre = 0.0 if udp else 0.5
    out[p, k, 0] += dx + centre
    out[p, k, 1] += dy + centre
    return out


def refine_people(hm: np.ndarray, tg: np.ndarray, people: np.ndarray, udp: bool = False) -> np.ndarray:
    """F16 for all people and joints at once: a missing joint is put where its
    map, less the rounded tag distance to the person's mean tag, is largest,
    if the map is positive there. hm: [K, H, W]; tg: [K, H, W] or [K, H, W, T],
    or [1, ...] for one tag map that all joints share."""
    count, joints, h, w = len(people), *hm.shape
    tg = np.broadcast_to(tg[..., None] if tg.ndim == 3 else tg, (joints, h, w, tg.shape[3] if tg.ndim == 4 else 1))
    found = people[:, :, 2] > 0
    x = np.clip(people[:, :, 0].astype(int), 0, w - 1)
    y = np.clip(people[:, :, 1].astype(int), 0, h - 1)
    tags = tg[np.arange(joints)[None], y, x]
    number = found.sum(axis=1)
    mean = (tags * found[:, :, None]).sum(axis=1) / np.maximum(number, 1)[:, None]
    out = people.copy()
    for p in np.flatnonzero(number):  # one person's maps at a time bound the memory
        score = hm - np.round(np.linalg.norm(tg - mean[p], axis=3))
        cell = score.reshape(joints, -1).argmax(axis=1)
        ys, xs = cell // w, cell % w
        k = np.arange(joints)
        dx, dy = _quarter(hm, k, ys, xs)
        centre = 0.0 if udp else 0.5
        fill = ~found[p] & (hm[k, ys, xs] > 0)
        put = np.stack([xs + centre + dx, ys + centre + dy, hm[k, ys, xs]], axis=1)
        out[p, fill, :3] = put[fill]
    return out


PEOPLE_SCHEMA = "image_id long, person int, joint int, x double, y double, val double, tag double, person_score double"


# candidates that are grouped in one go: enough that numpy's cost a call is small
CANDIDATES_AT_ONCE = 1 << 16


def _new_image(image: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before (nulls are equal)."""
    a, b = image[1:], image[:-1]
    differs = pc.if_else(pc.and_(pc.is_valid(a), pc.is_valid(b)), pc.not_equal(a, b), pc.xor(pc.is_valid(a), pc.is_valid(b)))
    return np.r_[True, differs.to_numpy(zero_copy_only=False)]


def _whole_images(batches):
    """Rows in order of their image, some CANDIDATES_AT_ONCE at a time, without
    cutting an image."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(len(t) for t in held) >= CANDIDATES_AT_ONCE:
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(np.flatnonzero(_new_image(table.column(0).combine_chunks())).max())
            if last:
                yield table.slice(0, last)
            held = table.slice(last).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def group_people(peaks: DataFrame, num_joints: int, m: int = 30, image="image_id", **params) -> DataFrame:
    """F13 + F14: top-M peaks per joint -> people per image (no maps).
    Output: image, person, joint, x, y, val, tag, person_score (mean val).
    Peaks are dealt by image and sorted; a task walks them many images at once."""
    top = top_peaks(peaks.where(F.col("joint").between(0, num_joints - 1)), m, image=image)
    dealt = top.repartition(image).sortWithinPartitions(image, "joint", "rk").select(
        image, F.col("joint").cast("int"), *(F.col(c).cast("double") for c in ("x", "y", "val", "tag")))

    def run(it):
        for table in _whole_images(it):
            ids = table.column(0).combine_chunks()
            joint, *values = (c.to_numpy() for c in table.columns[1:])
            rows = np.stack(values, axis=1)
            found = group_by_tag(rows, np.cumsum(_new_image(ids)), joint, num_joints, **params)
            shown = rows[found.row, 2] > 0
            row = found.row[shown]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row)).cast(pa.int64(), safe=False), pa.array(found.person[shown], pa.int32()),
                 pa.array(found.joint[shown], pa.int32()),
                 *(pa.array(c, from_pandas=True) for c in (*rows[row].T, found.score[shown]))],
                names=[c.split()[0] for c in PEOPLE_SCHEMA.split(", ")])
    return dealt.mapInArrow(run, PEOPLE_SCHEMA)


def people_of(packed, num_joints: int, **params) -> list[np.ndarray]:
    """F14 of packed candidates (structs by joint and rank), one array of people
    [P, K, 4] for each image."""
    flat = [(i, r["joint"], r["x"], r["y"], r["val"], r["tag"]) for i, c in enumerate(packed) for r in c]
    rows = np.array([r[2:] for r in flat], np.float64).reshape(-1, 4)
    image, joint = (np.array([r[n] for r in flat], int) for n in (0, 1))
    found = group_by_tag(rows, image, joint, num_joints, **params)
    cuts = np.searchsorted(found.image, np.arange(len(packed) + 1))
    people = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        people.append(np.zeros((found.person[a:b].max(initial=-1) + 1, num_joints, 4)))
        people[-1][found.person[a:b], found.joint[a:b]] = rows[found.row[a:b]]
    return people


def parse_bottom_up(maps: DataFrame, num_joints: int, h: int, w: int, m: int = 30, adjust: bool = True,
                    refine: bool = True, score_per_joint: bool = False, udp: bool = False, image="image_id", **params) -> DataFrame:
    """Per image heatmaps + tag maps (rows image, joint, hm, tag as
    flat arrays) -> peak NMS -> top-M -> tag grouping -> adjust -> refine.
    One packed row per image (bounded: K maps of H x W)."""
    from posetide.functions.heatmap import local_peaks
    pk = maps.select(image, "joint", "tag", F.explode(local_peaks("hm", F.lit(h), F.lit(w))).alias("p"))
    cand = pk.select(image, "joint", (F.col("p.cell") % w).cast("double").alias("x"),
                     F.floor(F.col("p.cell") / w).cast("double").alias("y"), F.col("p.val").alias("val"),
                     F.element_at("tag", (F.col("p.cell") + 1).cast("int")).alias("tag"),
                     F.col("p.cell").alias("peak_id"))
    top = top_peaks(cand, m, image=image)
    packed_c = top.groupBy(image).agg(F.array_sort(F.collect_list(F.struct("joint", "rk", "x", "y", "val", "tag"))).alias("c"))
    packed_m = maps.groupBy(image).agg(F.collect_list(F.struct("joint", "hm", "tag")).alias("maps"))
    j = packed_c.join(packed_m, image)

    def run(it):
        for pdf in it:
            rows = []
            for img, ppl, mp in zip(pdf[image], people_of(pdf["c"], num_joints, **params), pdf["maps"]):
                hm = np.zeros((num_joints, h, w))
                tg = np.zeros((num_joints, h, w))
                for r in mp:
                    hm[r["joint"]] = np.asarray(r["hm"]).reshape(h, w)
                    tg[r["joint"]] = np.asarray(r["tag"]).reshape(h, w)
                found = adjust_people(hm, ppl, udp) if adjust else ppl
                full = refine_people(hm, tg, found, udp) if refine else found
                for pi, p in enumerate(full):
                    s = found[pi, :, 2].mean()
                    for k in range(num_joints):
                        if p[k, 2] > 0:
                            rows.append((int(img), pi, k, *map(float, p[k]),
                                         float(p[k, 2] if score_per_joint else s)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PEOPLE_SCHEMA.split(", ")])
    return j.mapInPandas(run, PEOPLE_SCHEMA)
