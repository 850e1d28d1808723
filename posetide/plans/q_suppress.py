"""Registered queries: flagship, suppression and similarity (G, C7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions.flags import person_filter
from posetide.functions.numeric import rnd, rnd_sql
from posetide.operators import suppress as S
from posetide.plans.flagship import FLAGSHIP_SQL, flagship, nms_sql
from posetide.plans.registry import query

query("flagship_category_flags", FLAGSHIP_SQL)(flagship)

_PERSONS = "select image_id, det_id, x1, y1, x2, y2, score from fx_detections where class_id = 0 and score > 0.35"


@query("nms_greedy", fx.with_fixtures("", "fx_detections", recursive=True).rstrip() + ",\n"
       + nms_sql(_PERSONS, 0.3, ">") + "select image_id, det_id from nms_kept")
def q_nms_greedy(spark, d):
    """G1: greedy NMS (+1 areas, keep overlap <= 0.3) over person boxes."""
    return S.box_nms(person_filter(fx.fx_detections(spark, d)), thr=0.3).select("image_id", "det_id")


@query("nms_pair_graph", fx.with_fixtures("", "fx_detections", recursive=True).rstrip() + ",\n"
       + nms_sql(_PERSONS, 0.3, ">") + "select image_id, det_id from nms_kept")
def q_nms_pair_graph(spark, d):
    """G1 through the distributed path only (grid pair join + greedy rounds),
    as used for images above the bounded-group size."""
    return S.box_nms(person_filter(fx.fx_detections(spark, d)), thr=0.3, small_group=0).select("image_id", "det_id")


@query("nms_tie_suppress", fx.with_fixtures("", "fx_detections", recursive=True).rstrip() + ",\n"
       + nms_sql("select image_id, det_id, x1, y1, x2, y2, score from fx_detections", 0.5, ">=")
       + "select image_id, det_id from nms_kept")
def q_nms_tie_suppress(spark, d):
    """Greedy NMS that also suppresses at overlap == thr, all classes."""
    return S.box_nms(fx.fx_detections(spark, d), thr=0.5, tie="suppress").select("image_id", "det_id")


@query("box_iou_pairs", fx.with_fixtures("""
select a.image_id, a.det_id id_a, b.det_id id_b, cast(floor((
  greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1))
  / ((a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1)
     - greatest(0.0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0.0, least(a.y2, b.y2) - greatest(a.y1, b.y1)))) * 1000000.0 + 0.5) / 1000000.0 as double) iou
from fx_detections a join fx_detections b on a.image_id = b.image_id and a.det_id < b.det_id
where least(a.x2, b.x2) > greatest(a.x1, b.x1) and least(a.y2, b.y2) > greatest(a.y1, b.y1)
""", "fx_detections"))
def q_box_iou_pairs(spark, d):
    """IoU (no +1) of every overlapping pair of boxes in an image."""
    p = S.overlap_pairs(fx.fx_detections(spark, d), plus_one=False)
    return p.select("image_id", "id_a", "id_b", rnd("iou").alias("iou"))


# ---------------------------------------------------------------------------
# OKS similarity and suppression
# ---------------------------------------------------------------------------

OKS_THR = 0.5
_SIG = ", ".join(repr((2.0 * s) ** 2) for s in S.OKS_SIGMAS)
_EPS = "2.220446049250313e-16"

_POSE_LISTS = f"""
, pl as (select image_id, pose_id, score, area,
    list_transform(range(17), lambda j: cast((l_partkey % 40) + j * 2 + l_linenumber % 3 as double)) kx,
    list_transform(range(17), lambda j: cast((l_suppkey % 40) + j * 3 as double)) ky
  from (select l_orderkey image_id, {fx.LINEITEM_KEY_SQL} pose_id, l_partkey, l_suppkey, l_linenumber,
          cast((l_partkey * 37) % 1000 as double) / 1000 score, l_quantity * 400 area from lineitem) t),
vars as (select [{_SIG}] v)
"""


def _oks_lambda(g: str, d: str) -> str:
    return (f"list_avg(list_transform(range(1, 18), lambda i: exp(-(((({d}.kx[i] - {g}.kx[i]) * ({d}.kx[i] - {g}.kx[i]) "
            f"+ ({d}.ky[i] - {g}.ky[i]) * ({d}.ky[i] - {g}.ky[i])) / vars.v[i] / (({g}.area + {d}.area) / 2 + {_EPS}) / 2)))))")


@query("oks_pairs", "with " + _POSE_LISTS.strip()[1:].strip() + f"""
, pr as (select a.image_id, a.pose_id id_a, b.pose_id id_b, {_oks_lambda('a', 'b')} oks
  from pl a join pl b on a.image_id = b.image_id and a.pose_id < b.pose_id, vars)
select image_id, id_a, id_b, {rnd_sql('oks')} oks from pr where oks > {OKS_THR}""")
def q_oks_pairs(spark, d):
    """OKS of every pose pair of an image that exceeds 0.5. Small images
    pair their poses on the key, larger ones by the exact radius-bounded grid."""
    p = S.oks_pairs(fx.fx_poses(spark, d), OKS_THR)
    return p.where(F.col("oks") > OKS_THR).select(
        "image_id", F.least("src", "dst").alias("id_a"), F.greatest("src", "dst").alias("id_b"),
        rnd("oks").alias("oks"))


ORACLE_OKS_NMS = ("with recursive " + _POSE_LISTS.strip()[1:].strip() + f"""
, rk as (select *, row_number() over (partition by image_id order by score desc, pose_id) r,
    count(*) over (partition by image_id) n from pl),
walk as (
  select image_id, 0::bigint r, max(n) n,
    []::struct(pose_id bigint, area double, kx double[], ky double[])[] kept from rk group by image_id
  union all
  select w.image_id, w.r + 1, w.n,
    case when coalesce(list_bool_or(list_transform(w.kept, lambda g: {_oks_lambda('g', 'd')} > {OKS_THR})), false)
      then w.kept
      else list_append(w.kept, {{'pose_id': d.pose_id, 'area': d.area, 'kx': d.kx, 'ky': d.ky}}) end
  from walk w join rk d on d.image_id = w.image_id and d.r = w.r + 1, vars),
kept as (select w.image_id, unnest(w.kept, recursive := true) from walk w where w.r = w.n)
select image_id, pose_id from kept""")


@query("oks_nms", ORACLE_OKS_NMS)
def q_oks_nms(spark, d):
    """Greedy OKS NMS (thr 0.5) per image over the pair graph."""
    return S.oks_nms(fx.fx_poses(spark, d), OKS_THR).select("image_id", "pose_id")


@query("oks_rescore", "with " + _POSE_LISTS.strip()[1:].strip() + f"""
, pr as (select a.image_id, a.pose_id id_a, b.pose_id id_b, b.score sb, {_oks_lambda('a', 'b')} oks
  from pl a join pl b on a.image_id = b.image_id and a.pose_id < b.pose_id, vars)
select image_id, id_a, id_b, {rnd_sql('sb * exp(-(oks * oks) / 0.3)')} gauss,
  {rnd_sql(f'case when oks >= 0.3 then sb * (1 - oks) else sb end')} linear
from pr where oks > {OKS_THR}""")
def q_oks_rescore(spark, d):
    """Soft-NMS re-scoring (gaussian and linear, thr 0.3) of the later
    pose of each overlapping pair."""
    poses = fx.fx_poses(spark, d)
    p = S.oks_pairs(poses, OKS_THR).where(F.col("oks") > OKS_THR)
    hi = F.greatest("src", "dst")
    sc = poses.select("image_id", F.col("pose_id").alias("id_b"), F.col("score").alias("sb"))
    p = p.select("image_id", F.least("src", "dst").alias("id_a"), hi.alias("id_b"), "oks").join(sc, ["image_id", "id_b"])
    return p.select("image_id", "id_a", "id_b",
                    rnd(S.rescore(F.col("oks"), F.col("sb"), 0.3, "gaussian")).alias("gauss"),
                    rnd(S.rescore(F.col("oks"), F.col("sb"), 0.3, "linear")).alias("linear"))


@query("soft_oks_nms")
def q_soft_oks_nms(spark, d):
    """Soft OKS NMS, at most 20 picks per image (rounds of per-image
    argmax + re-score join). Checked against a brute-force walk in tests."""
    r = S.soft_oks_nms(fx.fx_poses(spark, d), thr=0.3, max_dets=20)
    return r.select("image_id", "pose_id", "rank", rnd("score").alias("score"))


@query("oks_nms_pair_graph", ORACLE_OKS_NMS)
def q_oks_nms_pair_graph(spark, d):
    """G5 through the distributed path only (pair join, by the grid in large
    images, + greedy rounds)."""
    return S.oks_nms(fx.fx_poses(spark, d), OKS_THR, small_group=0).select("image_id", "pose_id")


@query("soft_oks_nms_rounds")
def q_soft_oks_nms_rounds(spark, d):
    """G7 through the distributed rounds only (same result as soft_oks_nms)."""
    r = S.soft_oks_nms(fx.fx_poses(spark, d), thr=0.3, max_dets=20, small_group=0)
    return r.select("image_id", "pose_id", "rank", rnd("score").alias("score"))
