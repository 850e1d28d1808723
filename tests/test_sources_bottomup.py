"""Annotation/detection sources, mirror scoring and bottom-up grouping."""
import json
import os
import tempfile

import numpy as np

from posetide.operators import bottomup as BU
from posetide.operators.score import mirror_average
from posetide.schema import flip_permutation
from posetide.sources import annotations as AN


def test_read_coco_and_external_boxes(spark):
    d = tempfile.mkdtemp(prefix="posetide-coco-")
    doc = {"images": [{"id": 1, "width": 640, "height": 480, "file_name": "a.jpg"}],
           "annotations": [{"id": 10, "image_id": 1, "category_id": 1, "iscrowd": 0, "bbox": [1, 2, 30, 40],
                            "area": 900.0, "keypoints": [0.0] * 50 + [2.0], "foot_kpts": [0.0] * 18},
                           {"id": 11, "image_id": 1, "category_id": 1, "iscrowd": 1, "bbox": [0, 0, 1, 1],
                            "area": 1.0, "keypoints": [0.0] * 51, "foot_kpts": [0.0] * 18}]}
    with open(os.path.join(d, "ann.json"), "w") as fh:
        json.dump(doc, fh)
    imgs, anns = AN.read_coco(spark, os.path.join(d, "ann.json"))
    t = AN.annotation_table(imgs, anns).collect()
    assert len(t) == 1 and t[0].ann_id == 10 and t[0].box_w == 30.0 and t[0].max_kp == 2.0 and t[0].width == 640
    with open(os.path.join(d, "boxes.json"), "w") as fh:
        json.dump({"1": [{"id": 5, "clean_bbox": [1, 2, 3, 4]}], "7": [{"id": 6, "clean_bbox": [0, 0, 9, 9]}]}, fh)
    b = sorted(AN.read_external_boxes(spark, os.path.join(d, "boxes.json")).collect())
    assert [(r.image_id, r.ann_id, r.clean_w) for r in b] == [(1, 5, 3.0), (7, 6, 9.0)]


def test_mirror_average_flips_back():
    rng = np.random.default_rng(0)
    hm = rng.uniform(0, 1, (25, 8, 6))
    perm = flip_permutation(25)
    mirrored = hm[perm][..., ::-1]
    back = mirror_average(hm, mirrored, perm, shift=False, average=False)
    assert np.allclose(back, hm)
    assert np.allclose(mirror_average(hm, mirrored, perm, shift=False), hm)


def test_match_by_tag_groups_by_tag():
    # two people with tags 0 and 5; every joint has one candidate per person
    joints = [np.array([[1.0, 1.0, 0.9, 0.1], [10.0, 10.0, 0.8, 5.05]]) for _ in range(4)]
    ppl = BU.match_by_tag(joints, 4, detection_threshold=0.1, tag_threshold=1.0)
    assert ppl.shape == (2, 4, 4)
    for p in ppl:
        assert np.ptp(p[:, 3]) < 0.1  # all joints of a person share the tag


def test_group_people_on_table(spark):
    rows = [(1, j, j * 10 + p, float(p * 20 + j), float(p * 20 + j), 0.9, float(p * 5) + 0.01 * j)
            for p in range(3) for j in range(5)]
    df = spark.createDataFrame(rows, "image_id long, joint int, peak_id long, x double, y double, val double, tag double")
    out = BU.group_people(df, num_joints=5, m=10).collect()
    people = {}
    for r in out:
        people.setdefault(r.person, set()).add(round(r.tag))
    assert len(people) == 3 and all(len(t) == 1 for t in people.values())


def test_frame_files_become_a_frame_table(spark):
    from posetide.sources.frames import read_frames
    from posetide.sources.images import encode_png
    d = tempfile.mkdtemp(prefix="posetide-frames-")
    for v in ("camA", "camB"):
        os.makedirs(os.path.join(d, v))
        for f in range(3):
            with open(os.path.join(d, v, f"{f:05d}.png"), "wb") as fh:
                fh.write(encode_png(np.zeros((4, 4, 3), dtype=np.uint8)))
    rows = sorted((r.video_id, r.frame_idx, r.ts.timestamp()) for r in read_frames(spark, d, fps=2.0).collect())
    assert rows[:3] == [("camA", 0, 0.0), ("camA", 1, 0.5), ("camA", 2, 1.0)] and len(rows) == 6
