"""Grouping by tags takes each step in many images at once: the people are those
of a plain walk image by image, and the steps do not grow with the images."""
import numpy as np
import pyarrow as pa
import pytest

from posetide.operators import bottomup as BU
from posetide.operators import track as T


def _plain_walk(per_joint, num_joints, detection_threshold=0.1, tag_threshold=1.0, use_detection_val=True,
                ignore_too_much=False, max_num_people=30):
    """One image with dictionaries, joint by joint and candidate by candidate."""
    joints, tags = {}, {}
    for k in range(num_joints):
        rows = [r for r in per_joint[k] if r[2] > detection_threshold]
        keys = list(joints)[:max_num_people]
        if not rows or (keys and ignore_too_much and len(keys) == max_num_people):
            continue
        person = {}
        if keys:
            distance = np.array([[abs(r[3] - np.mean(tags[p])) for p in keys] for r in rows])
            cost = np.round(distance) * 100 - np.array(rows)[:, 2:3] if use_detection_val else distance
            cost = np.pad(cost, ((0, 0), (0, max(0, len(rows) - len(keys)))), constant_values=1e10)
            person = {r: c for r, c in T.min_cost_assignment(cost) if c < len(keys) and distance[r, c] < tag_threshold}
        for i, r in enumerate(rows):
            key = keys[person[i]] if i in person else r[3]
            tags[key] = tags[key] + [r[3]] if i in person else [r[3]]
            joints.setdefault(key, {})[k] = tuple(r)
    return list(joints.values())


def _candidates(images, num_joints, most, seed):
    rng = np.random.default_rng(seed)
    images = [[sorted(([float(rng.integers(48)), float(rng.integers(64)), rng.integers(12) / 11,
                        float(rng.integers(4)) + rng.integers(8) / 8] for _ in range(rng.integers(most + 1))),
                      key=lambda r: -r[2]) for _ in range(num_joints)] for _ in range(images)]
    flat = [(i, k, *r) for i, per in enumerate(images) for k, rows in enumerate(per) for r in rows]
    table = np.array(flat)
    return images, table[:, 2:], table[:, 0].astype(int), table[:, 1].astype(int)


@pytest.mark.parametrize("most, params", [
    (2, {}), (5, {"use_detection_val": False, "tag_threshold": 0.4}), (9, {"max_num_people": 4}),
    (9, {"max_num_people": 4, "ignore_too_much": True}), (12, {"detection_threshold": 0.5})])
def test_many_images_equal_a_plain_walk(most, params):
    images, rows, image, joint = _candidates(60, 7, most, most)
    found = BU.group_by_tag(rows, image, joint, 7, **params)
    got = [{} for _ in images]
    for i, p, k, r in zip(found.image, found.person, found.joint, found.row):
        got[i].setdefault(int(p), {})[int(k)] = tuple(rows[r])
    assert got == [dict(enumerate(_plain_walk(per, 7, **params))) for per in images]


def test_assignments_side_by_side_equal_one_by_one():
    rng = np.random.default_rng(3)
    number, wide = rng.integers(1, 6, 200), rng.integers(0, 4, 200)
    cost = np.full((200, 5, 9), np.inf)
    for b, (r, w) in enumerate(zip(number, number + wide)):
        cost[b, :r, :w] = rng.integers(0, 4, (r, w))  # many ties
    got = T.min_cost_assignments(cost, number)
    for b, (r, w) in enumerate(zip(number, number + wide)):
        assert list(enumerate(got[b, :r].tolist())) == T.min_cost_assignment(cost[b, :r, :w])
        assert (got[b, r:] == -1).all()


def test_steps_do_not_grow_with_the_images(monkeypatch):
    calls = []
    solve = T.min_cost_assignments
    monkeypatch.setattr(BU, "min_cost_assignments", lambda *a: calls.append(1) or solve(*a))
    BU.group_by_tag(*_candidates(100, 7, 2, 5)[1:], 7)
    few = len(calls)
    BU.group_by_tag(*_candidates(2000, 7, 2, 5)[1:], 7)
    assert len(calls) - few < 2 * few + 10


def test_images_are_not_cut_between_batches(monkeypatch):
    monkeypatch.setattr(BU, "CANDIDATES_AT_ONCE", 6)
    ids = [None, None, 1, 1, 1, 2, 3, 3, 3, 3, 3, 3, 3, 3, 4, 5]
    batches = [pa.record_batch({"image_id": pa.array(ids[i:i + 3], pa.int64())}) for i in range(0, len(ids), 3)]
    tables = [t.column(0).to_pylist() for t in BU._whole_images(iter(batches))]
    assert sum(tables, []) == ids and len(tables) > 1
    assert all(a[-1] != b[0] for a, b in zip(tables, tables[1:]))


def test_odd_peaks(spark):
    schema = "image_id long, joint int, peak_id long, x double, y double, val double, tag double"
    rows = [(1, 0, 1, 1.0, 2.0, 0.9, 0.5), (1, 1, 2, 3.0, 4.0, 0.8, 0.6), (1, None, 3, 5.0, 6.0, 0.9, 0.5),
            (1, 9, 4, 5.0, 6.0, 0.9, 0.5), (1, 2, 5, 7.0, 8.0, None, 0.5), (2, 0, 6, 1.0, None, 0.7, None),
            (None, 0, 7, 1.0, 1.0, 0.6, 0.0), (None, 1, 8, 1.0, 1.0, 0.4, 0.0), (3, 0, 9, 1.0, 1.0, 0.05, 0.0)]
    got = sorted((tuple(r) for r in BU.group_people(spark.createDataFrame(rows, schema), num_joints=2).collect()), key=str)
    assert got == sorted([(1, 0, 0, 1.0, 2.0, 0.9, 0.5, pytest.approx(0.85)), (1, 0, 1, 3.0, 4.0, 0.8, 0.6, pytest.approx(0.85)),
                          (2, 0, 0, 1.0, None, 0.7, None, pytest.approx(0.35)),
                          (None, 0, 0, 1.0, 1.0, 0.6, 0.0, pytest.approx(0.5)),
                          (None, 0, 1, 1.0, 1.0, 0.4, 0.0, pytest.approx(0.5))], key=str)
