"""Headline-query benchmark.

Runs a representative query per operator family at $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is forced end to end with the ``noop`` sink (full execution, no
collect to the driver). A warm-up query starts the JVM and Python workers
first and is not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_category_flags",  # B7 + G1 + B12 + joins + aggregate
    "nms_greedy",               # G1 (bounded-group fold)
    "nms_pair_graph",           # G1 distributed pair graph
    "box_iou_pairs",            # C7 grid join
    "oks_nms",                  # G4 + G5
    "soft_oks_nms",             # G7
    "pck",                      # J1-J3
    "pck_auc",                  # J5
    "coord_errors",             # J9
    "tag_push_pull",            # J12
    "heatmap_taylor",           # F1 + F5
    "heatmap_dark_udp",         # F6 + F9 (Arrow)
    "joint_reorder",            # I1 + I2
    "affine_points",            # I6 + I7
    "gaussian_target",          # I5
    "sample_assembly",          # I10
    "sort_track",               # H2
    "one_euro",                 # H6
    "video_summary",            # H9
    "person_flag_job",          # P5
    "cutout_job",               # P6
    "video_pose_job",           # L3
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ["POSETIDE_MASTER"] = f"local[{cpus}]"
    from posetide.plans.registry import QUERIES, load_all
    from posetide.session import get_spark
    load_all()
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    names = [a for a in sys.argv[1:] if a in QUERIES] or HEADLINE

    QUERIES["heatmap_argmax"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
