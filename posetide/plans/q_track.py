"""Registered queries: cadence, tracking, smoothing, run summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions.numeric import rnd, rnd_sql
from posetide.operators import track as T
from posetide.plans.registry import query

STEP = 2


@query("detect_cadence", fx.with_fixtures(f"""
select video_id, count(*) n_frames, count(case when frame_idx % {STEP} = 0 or frame_idx < 3 then 1 end) n_detect
from fx_frames group by video_id""", "fx_frames"))
def q_detect_cadence(spark, d):
    """H1: frames on which the detector runs (every 2nd frame, first 3)."""
    f = T.detect_cadence(fx.fx_frames(spark, d), STEP)
    return f.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_frames"),
                                     F.count(F.when(F.col("run_detector"), 1)).alias("n_detect"))


def _tracked(spark, d, cadence: bool):
    b = fx.fx_frame_boxes(spark, d)
    frames = b.select("video_id", "frame_idx").distinct()
    if cadence:
        b = T.detect_cadence(b, STEP).where("run_detector")
    max_age = STEP if cadence else 1
    min_hits = 1 if cadence else 3
    return T.track_boxes(b, frames, max_age=max_age, min_hits=min_hits, iou_threshold=0.3, order_by=["obj"])


def _track_out(t):
    return t.select("video_id", "frame_idx", "emit_rank", "track_id",
                    *[rnd(c, 4).alias(c) for c in ("x1", "y1", "x2", "y2")], "score")


@query("sort_track")
def q_sort_track(spark, d):
    """H2-H5: SORT tracking per video (max_age 1, min_hits 3, IoU 0.3).
    Order-dependent state: checked against a brute-force walk in tests."""
    return _track_out(_tracked(spark, d, cadence=False))


@query("sort_track_cadence")
def q_sort_track_cadence(spark, d):
    """H1 + H2 + H10: detector every 2nd frame (and the first three);
    frames without detections emit the predicted boxes of all tracks."""
    return _track_out(_tracked(spark, d, cadence=True))


_TWO_PI = "2 * pi()"
_AD = f"(({_TWO_PI} * 30.0 * 1.0) / (({_TWO_PI} * 30.0 * 1.0) + 1))"

ONE_EURO_SQL = fx.with_fixtures(f"""
, s as (select video_id, frame_idx, x from fx_frames),
w as (
  select video_id, frame_idx, cast(cast(x as float) as double) xh, 0.0::double dxh from s where frame_idx = 0
  union all
  select q.video_id, q.frame_idx,
    case when q.x <= 0 then -10.0 else
      (({_TWO_PI} * (1.7 + 0.3 * abs(q.dxh)) * 1.0) / (({_TWO_PI} * (1.7 + 0.3 * abs(q.dxh)) * 1.0) + 1)) * q.x
      + (1 - (({_TWO_PI} * (1.7 + 0.3 * abs(q.dxh)) * 1.0) / (({_TWO_PI} * (1.7 + 0.3 * abs(q.dxh)) * 1.0) + 1))) * q.xprev
    end xh,
    q.dxh
  from (select s.video_id, s.frame_idx, s.x, w.xh xprev,
          {_AD} * ((s.x - w.xh) / 1.0) + (1 - {_AD}) * w.dxh dxh
        from w join s on s.video_id = w.video_id and s.frame_idx = w.frame_idx + 1) q)
select video_id, frame_idx, {rnd_sql("xh")} smoothed from w""", "fx_frames", recursive=True).replace(")\n, s as", "),\ns as")


@query("one_euro", ONE_EURO_SQL)
def q_one_euro(spark, d):
    """H6 + H7: One-Euro smoothing per video over frame steps (fps mode,
    d_cutoff = 30); values <= 0 become -10 and feed back (Q7)."""
    f = fx.fx_frames(spark, d)
    s = T.one_euro(f, ["video_id"], "frame_idx", "x", fps=30.0, gap="sentinel")
    return s.select("video_id", "frame_idx", rnd("smoothed").alias("smoothed"))


@query("video_summary", fx.with_fixtures(f"""
, pf as (select video_id, frame_idx, count(*) n, min(ts) t from fx_frame_boxes group by video_id, frame_idx),
s as (select video_id, count(*) n_frames, sum(n) n_poses, (epoch_us(max(t)) - epoch_us(min(t))) / 1e6 secs
  from pf group by video_id)
select video_id, n_frames, cast(n_poses as bigint) n_poses, {rnd_sql("n_poses / n_frames")} poses_per_frame,
  case when secs > 0 then {rnd_sql("n_frames / secs", 9)} end fps,
  case when secs > 0 then {rnd_sql("(n_frames / secs) / (n_poses / n_frames)", 9)} end fps_per_pose
from s""", "fx_frame_boxes").replace(")\n, pf as", "),\npf as"))
def q_video_summary(spark, d):
    """H9: frames, poses, poses per frame and event-time fps per video."""
    s = T.video_summary(fx.fx_frame_boxes(spark, d))
    return s.select("video_id", "n_frames", F.col("n_poses").cast("long").alias("n_poses"),
                    rnd("poses_per_frame").alias("poses_per_frame"), rnd("fps", 9).alias("fps"),
                    rnd("fps_per_pose", 9).alias("fps_per_pose"))
