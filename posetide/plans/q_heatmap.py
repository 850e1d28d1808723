"""Registered queries: heatmap decoding."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions import heatmap as H
from posetide.functions.numeric import rnd, rnd_sql
from posetide.operators import heatmap as OH
from posetide.plans.registry import query
from posetide.schema import flip_dim, flip_permutation

_ARGMAX_SQL = """
, am as (select person_id, joint, h, w, hm, list_max(hm) maxval, list_position(hm, list_max(hm)) - 1 idx from fx_heatmaps),
amx as (select person_id, joint, h, w, hm, maxval,
  case when maxval > 0 then cast(idx % w as double) else -1.0 end px,
  case when maxval > 0 then cast(idx // w as double) else -1.0 end py from am)
"""


def _hm_sql(body: str) -> str:
    return fx.with_fixtures(_ARGMAX_SQL + body, "fx_heatmaps").replace(")\n\n, am as", "),\nam as")


def _argmax(spark, d):
    h = fx.fx_heatmaps(spark, d)
    am = H.argmax("hm", "w")
    return h.select("person_id", "joint", "h", "w", "hm", *[v.alias(k) for k, v in am.items()])


@query("heatmap_argmax", _hm_sql("select person_id, joint, px, py, maxval from amx"))
def q_heatmap_argmax(spark, d):
    """2-D argmax and max per heatmap; (-1, -1) when max <= 0."""
    return _argmax(spark, d).select("person_id", "joint", "px", "py", "maxval")


@query("heatmap_argmax_3d", fx.with_fixtures("""
, am as (select person_id, joint, list_max(hm) maxval, list_position(hm, list_max(hm)) - 1 idx from fx_heatmaps)
select person_id, joint, maxval,
  case when maxval > 0 then cast(idx % 4 as double) else -1.0 end px,
  case when maxval > 0 then cast((idx // 4) % 4 as double) else -1.0 end py,
  case when maxval > 0 then cast(idx // 16 as double) else -1.0 end pz from am""", "fx_heatmaps").replace(")\n, am as", "),\nam as"))
def q_heatmap_argmax_3d(spark, d):
    """3-D argmax, the 64 cells read as a 4 x 4 x 4 volume."""
    h = fx.fx_heatmaps(spark, d)
    am = H.argmax_3d("hm", F.lit(4), F.lit(4), F.lit(4))
    return h.select("person_id", "joint", *[v.alias(k) for k, v in am.items()])


_SHIFT_SQL = """
, sh as (select person_id, joint, maxval, h, w, hm, px, py,
  cast(px as bigint) ix, cast(py as bigint) iy from amx),
q as (select person_id, joint, maxval, h, w, hm,
  case when ix > 1 and ix < w - 1 and iy > 1 and iy < h - 1
    then px + sign(hm[iy * w + ix + 1 + 1] - hm[iy * w + ix - 1 + 1]) * 0.25 else px end qx,
  case when ix > 1 and ix < w - 1 and iy > 1 and iy < h - 1
    then py + sign(hm[(iy + 1) * w + ix + 1] - hm[(iy - 1) * w + ix + 1]) * 0.25 else py end qy
  from sh)
"""


@query("heatmap_quarter_shift", _hm_sql(_SHIFT_SQL + "select person_id, joint, qx px, qy py from q"))
def q_heatmap_quarter_shift(spark, d):
    """default post-process: quarter-pixel shift toward the larger
    neighbour."""
    a = _argmax(spark, d)
    q = H.quarter_shift("hm", "px", "py", "h", "w")
    return a.select("person_id", "joint", q["px"].alias("px"), q["py"].alias("py"))


@query("heatmap_taylor", _hm_sql(f"""
, lg as (select person_id, joint, h, w, px, py, cast(px as bigint) x, cast(py as bigint) y,
  list_transform(hm, lambda v: ln(greatest(v + 1.0, 1e-10))) L from amx),
dv as (select *,
  0.5 * (L[y * w + x + 2] - L[y * w + x]) dx,
  0.5 * (L[(y + 1) * w + x + 1] - L[(y - 1) * w + x + 1]) dy,
  0.25 * (L[y * w + x + 3] - 2 * L[y * w + x + 1] + L[y * w + x - 1]) dxx,
  0.25 * (L[(y + 1) * w + x + 2] - L[(y - 1) * w + x + 2] - L[(y + 1) * w + x] + L[(y - 1) * w + x]) dxy,
  0.25 * (L[(y + 2) * w + x + 1] - 2 * L[y * w + x + 1] + L[(y - 2) * w + x + 1]) dyy,
  x > 1 and x < w - 2 and y > 1 and y < h - 2 inside from lg),
dt as (select *, dxx * dyy - dxy * dxy det from dv)
select person_id, joint,
  {rnd_sql("case when inside and det <> 0 then px + (-(dyy * dx - dxy * dy) / det) else px end")} px,
  {rnd_sql("case when inside and det <> 0 then py + (-(-dxy * dx + dxx * dy) / det) else py end")} py
from dt"""))
def q_heatmap_taylor(spark, d):
    """Taylor refinement at the argmax on log(max(hm + 1, 1e-10))."""
    a = _argmax(spark, d).withColumn(
        "L", F.transform("hm", lambda v: F.log(F.greatest(v + 1.0, F.lit(1e-10)))))
    t = H.taylor("L", "px", "py", "h", "w")
    return a.select("person_id", "joint", rnd(t["px"]).alias("px"), rnd(t["py"]).alias("py"))


@query("heatmap_to_image", _hm_sql(_SHIFT_SQL + f"""
, sz as (select person_id, joint, qx, qy, maxval, cast(192 + person_id % 64 as double) ow, cast(256 + person_id % 32 as double) oh from q)
select person_id, joint,
  {rnd_sql("qx * (ow / 8.0) + cast(cast(ow as bigint) // 2 as double) - ow * 0.5")} x,
  {rnd_sql("qy * (oh / 8.0) + cast(cast(oh as bigint) // 2 as double) - oh * 0.5")} y,
  maxval score from sz"""))
def q_heatmap_to_image(spark, d):
    """F1 + F3 + F8: decode and map to an image of size
    (192 + id % 64, 256 + id % 32): centre (w // 2, h // 2), scale (w, h)
    in pixels."""
    a = _argmax(spark, d)
    q = H.quarter_shift("hm", "px", "py", "h", "w")
    ow = (F.lit(192) + F.col("person_id") % 64).cast("double")
    oh = (F.lit(256) + F.col("person_id") % 32).cast("double")
    a = a.select("person_id", "joint", "maxval", q["px"].alias("qx"), q["py"].alias("qy"), ow.alias("ow"), oh.alias("oh"))
    img = H.to_image("qx", "qy", F.floor(F.col("ow") / 2).cast("double"), F.floor(F.col("oh") / 2).cast("double"),
                     "ow", "oh", F.lit(8), F.lit(8))
    return a.select("person_id", "joint", rnd(img["x"]).alias("x"), rnd(img["y"]).alias("y"),
                    F.col("maxval").alias("score"))


@query("regression_decode", fx.with_fixtures(f"""
select p.sample_id, p.joint,
  {rnd_sql("(p.pred_x / 192.0 * 192.0) * (cast(i.width as double) / 192.0) + cast(i.width // 2 as double) - i.width * 0.5")} x,
  {rnd_sql("(p.pred_y / 256.0 * 256.0) * (cast(i.height as double) / 256.0) + cast(i.height // 2 as double) - i.height * 0.5")} y,
  1.0 score
from fx_pose_pairs p join fx_images i on i.image_id = p.sample_id""", "fx_pose_pairs", "fx_images"))
def q_regression_decode(spark, d):
    """normalised regression output (pred / input size) -> image."""
    p = fx.fx_pose_pairs(spark, d)
    i = fx.fx_images(spark, d).select(F.col("image_id").alias("sample_id"), "width", "height")
    j = p.join(i, "sample_id")
    r = H.regression_to_image(F.col("pred_x") / 192.0, F.col("pred_y") / 256.0,
                              F.floor(F.col("width") / 2).cast("double"), F.floor(F.col("height") / 2).cast("double"),
                              F.col("width").cast("double"), F.col("height").cast("double"), F.lit(192), F.lit(256))
    return j.select("sample_id", "joint", rnd(r["x"]).alias("x"), rnd(r["y"]).alias("y"), r["score"].alias("score"))


_FLIP_VALUES = ", ".join(f"({j}, {f})" for j, f in enumerate(flip_permutation(25)))


@query("heatmap_flip_back", fx.with_fixtures(f"""
select h.person_id, f.flip_joint joint, cast(c.i - 1 as integer) cell,
  h.hm[((c.i - 1) // h.w) * h.w + (h.w - 1 - (c.i - 1) % h.w) + 1] value
from fx_heatmaps h join (values {_FLIP_VALUES}) f(joint, flip_joint) on f.joint = h.joint,
  generate_series(1, 64) c(i)""", "fx_heatmaps"))
def q_heatmap_flip_back(spark, d):
    """un-flip heatmaps: swap left/right channels (broadcast flip
    table) and mirror each map in x; long form (cell, value)."""
    h = fx.fx_heatmaps(spark, d).join(F.broadcast(flip_dim(spark)), "joint")
    fb = h.select("person_id", F.col("flip_joint").alias("joint"), H.flip_back_cells("hm", "h", "w").alias("m"))
    return fb.select("person_id", "joint", F.posexplode("m").alias("cell", "value")).select(
        "person_id", "joint", F.col("cell").cast("int").alias("cell"), "value")


@query("heatmap_local_peaks", fx.with_fixtures("""
, cells as (select person_id, joint, h, w, cast(c.i - 1 as integer) cell, hm[c.i] val,
  (c.i - 1) % w x, (c.i - 1) // w y from fx_heatmaps, generate_series(1, 64) c(i)),
nb as (select a.person_id, a.joint, a.cell, a.val, max(b.val) mx
  from cells a join cells b on a.person_id = b.person_id and a.joint = b.joint
  and b.x between a.x - 1 and a.x + 1 and b.y between a.y - 1 and a.y + 1
  group by a.person_id, a.joint, a.cell, a.val)
select person_id, joint, cell, val from nb where val = mx""", "fx_heatmaps").replace(")\n, cells as", "),\ncells as"))
def q_heatmap_local_peaks(spark, d):
    """heatmap NMS — cells equal to their 3 x 3 max (array
    expression, no shuffle)."""
    h = fx.fx_heatmaps(spark, d)
    p = h.select("person_id", "joint", F.explode(H.local_peaks("hm", "h", "w")).alias("c"))
    return p.select("person_id", "joint", F.col("c.cell").cast("int").alias("cell"), F.col("c.val").alias("val"))


TOP_M = 2


_WINDOWS = (3, 5, 7)


@query("heatmap_peaks_window", fx.with_fixtures(f"""
select person_id, joint, cast(k as integer) size, cast(i as integer) cell, hm[i + 1] val
from fx_heatmaps, (values {", ".join(f"({k})" for k in _WINDOWS)}) s(k), range(64) c(i)
where hm[i + 1] = list_max(list_transform(list_filter(range(64),
    lambda q: abs(q % 8 - i % 8) <= k // 2 and abs(q // 8 - i // 8) <= k // 2), lambda q: hm[q + 1]))""", "fx_heatmaps"))
def q_heatmap_peaks_window(spark, d):
    """local maxima of windows of 3, 5 and 7 cells a side."""
    h = fx.fx_heatmaps(spark, d)
    sizes = F.array(*[F.struct(F.lit(k).alias("size"), H.local_peaks_window("hm", "h", "w", k).alias("peaks"))
                      for k in _WINDOWS])
    z = h.select("person_id", "joint", F.explode(sizes).alias("s")).select("person_id", "joint", "s.size", F.explode("s.peaks").alias("c"))
    return z.select("person_id", "joint", "size", F.col("c.cell").alias("cell"), F.col("c.val").alias("val"))


@query("heatmap_peaks_topk", fx.with_fixtures(f"""
select image_id, joint, peak_id, x, y, val, tag, rk from (
  select *, row_number() over (partition by image_id, joint order by val desc, peak_id) rk from fx_peaks) t
where rk <= {TOP_M}""", "fx_peaks"))
def q_heatmap_peaks_topk(spark, d):
    """top-M peaks per (image, joint) with their tags (rank window,
    total tie-break on the peak id)."""
    w = Window.partitionBy("image_id", "joint").orderBy(F.col("val").desc(), F.col("peak_id"))
    p = fx.fx_peaks(spark, d).withColumn("rk", F.row_number().over(w))
    return p.where(F.col("rk") <= TOP_M).select("image_id", "joint", "peak_id", "x", "y", "val", "tag", "rk")


@query("heatmap_adjust", _hm_sql("""
, a as (select person_id, joint, px, py, maxval, h, w, hm, cast(px as bigint) xx, cast(py as bigint) yy from amx where maxval > 0)
select person_id, joint,
  case when hm[xx + least(h - 1, yy + 1) * w + 1] > hm[xx + greatest(0, yy - 1) * w + 1] then px else px end
    + (case when hm[least(w - 1, xx + 1) + yy * w + 1] > hm[greatest(0, xx - 1) + yy * w + 1] then 0.25 else -0.25 end) + 0.5 px,
  py + (case when hm[xx + least(h - 1, yy + 1) * w + 1] > hm[xx + greatest(0, yy - 1) * w + 1] then 0.25 else -0.25 end) + 0.5 py
from a"""))
def q_heatmap_adjust(spark, d):
    """bottom-up quarter adjust (+0.5) at positive peaks."""
    a = _argmax(spark, d).where(F.col("maxval") > 0)
    adj = H.adjust("hm", "px", "py", "h", "w")
    return a.select("person_id", "joint", adj["px"].alias("px"), adj["py"].alias("py"))


def _decode_rows(spark, d, **kw):
    h = fx.fx_heatmaps(spark, d).withColumn("hm", F.transform("hm", lambda v: v + 1.0))
    return OH.decode_heatmaps(h, h=8, w=8, **kw)


@query("heatmap_dark_udp")
def q_heatmap_dark_udp(spark, d):
    """F6 + F9 (product path): DARK-UDP decode, kernel 11, 8 x 8 maps
    (shifted by +1 so logs are defined). Arrow batch, rows independent."""
    r = _decode_rows(spark, d, udp=True, kernel=11)
    return r.select("person_id", "joint", rnd("px", 4).alias("px"), rnd("py", 4).alias("py"), rnd("maxval").alias("maxval"))


@query("heatmap_decode_unbiased")
def q_heatmap_decode_unbiased(spark, d):
    """F4 + F5 + F9: unbiased decode (modulate, log, Taylor)."""
    r = _decode_rows(spark, d, mode="unbiased", kernel=3)
    return r.select("person_id", "joint", rnd("px", 4).alias("px"), rnd("py", 4).alias("py"), rnd("maxval").alias("maxval"))


@query("heatmap_decode_megvii")
def q_heatmap_decode_megvii(spark, d):
    """F4 + F3 + F9: megvii decode (modulate, shift + 0.5, score/255 + 0.5)."""
    r = _decode_rows(spark, d, mode="megvii", kernel=3)
    return r.select("person_id", "joint", "px", "py", rnd("maxval").alias("maxval"))


@query("heatmap_combined_decode")
def q_heatmap_combined_decode(spark, d):
    """combined-target decode; response = map, offsets = mirrored maps."""
    h = fx.fx_heatmaps(spark, d).select(
        "person_id", "joint", F.transform("hm", lambda v: v + 1.0).alias("heat"),
        F.reverse("hm").alias("off_x"), F.transform("hm", lambda v: -v).alias("off_y"))
    r = OH.decode_combined(h, kernel=3, h=8, w=8)
    return r.select("person_id", "joint", rnd("px", 4).alias("px"), rnd("py", 4).alias("py"), rnd("maxval").alias("maxval"))


@query("tag_grouping")
def q_tag_grouping(spark, d):
    """F13 + F14: top-30 peaks per (image, joint) grouped into people by
    their tags (7 joint types per image in this table)."""
    from posetide.operators.bottomup import group_people
    g = group_people(fx.fx_peaks(spark, d), num_joints=7, m=30)
    return g.select("image_id", "person", "joint", "x", "y", "val", rnd("tag", 4).alias("tag"),
                    rnd("person_score").alias("person_score"))


@query("bottom_up_parse")
def q_bottom_up_parse(spark, d):
    """Bottom-up parse of per-image maps (10 joints of 8 x 8 per
    image built from the embeddings: heatmap = vector + 0.5, tag map = 3 x
    the reversed vector): peak NMS, top-M, grouping, adjust, refine."""
    from posetide.operators.bottomup import parse_bottom_up
    e = fx.table(spark, d, "embeddings")
    maps = e.select((F.col("vec_id") / 10).cast("long").alias("image_id"), (F.col("vec_id") % 10).cast("int").alias("joint"),
                    F.transform("embedding", lambda v: v.cast("double") + 0.5).alias("hm"),
                    F.transform(F.reverse("embedding"), lambda v: v.cast("double") * 3).alias("tag"))
    p = parse_bottom_up(maps, num_joints=10, h=8, w=8, m=5, detection_threshold=0.1, tag_threshold=1.0)
    return p.select("image_id", "person", "joint", rnd("x", 4).alias("x"), rnd("y", 4).alias("y"),
                    rnd("val", 6).alias("val"), rnd("person_score").alias("person_score"))
