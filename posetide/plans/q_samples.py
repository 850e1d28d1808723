"""Registered queries: annotation and sample preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions import boxes as C
from posetide.functions import keypoints as K
from posetide.functions.numeric import rnd, rnd_sql
from posetide.operators import samples as S
from posetide.plans.q_boxes import _VALID_SQL, valid_annotations
from posetide.plans.registry import query
from posetide.schema import ANNOTATION_SLOTS, JOINT_WEIGHTS

_SLOTS = ", ".join(f"({src}, {slot})" for src, slot in enumerate(ANNOTATION_SLOTS))

_J25_SQL = _VALID_SQL.rstrip() + f""",
slots as (select * from (values {_SLOTS}) t(src, slot)),
b23 as (select k.image_id, k.ann_id, s.slot joint, k.x, k.y, cast(trunc(least(greatest(k.v, 0.0), 1.0)) as integer) vis
  from fx_ann_keypoints k join slots s on s.src = k.src
  join valid v on v.image_id = k.image_id and v.ann_id = k.ann_id),
j25 as (
  select * from b23
  union all select image_id, ann_id, 5, avg(x), avg(y), min(vis) from b23 where joint in (6, 7) group by image_id, ann_id
  union all select image_id, ann_id, 14, avg(x), avg(y), min(vis) from b23 where joint in (12, 13) group by image_id, ann_id)
"""


def _sql(body: str, *extra: str) -> str:
    return fx.with_fixtures("with " + _J25_SQL.strip() + "\n" + body,
                            "fx_annotations", "fx_images", "fx_ann_keypoints", *extra).replace("\nwith va as", ",\nva as")


def prepared(spark, d):
    """Valid annotations with their 25-joint arrays, image size and the
    box centre/scale (A6 + B8 + C1 + I1 + I2 + C2)."""
    v = valid_annotations(spark, d)
    a = fx.fx_ann_arrays(spark, d)
    img = fx.fx_images(spark, d).select("image_id", "width", "height")
    j = K.reorder_annotation("kx", "ky", "kv")
    cs = C.xywh_to_center_scale("clean_x", "clean_y", "clean_w", "clean_h")
    return (v.join(a, ["image_id", "ann_id"]).join(img, "image_id")
            .select("image_id", "ann_id", "width", "height",
                    *[c.alias(k) for k, c in j.items()], *[c.alias(k) for k, c in cs.items()]))


@query("joint_reorder", _sql("select image_id, ann_id, cast(joint as integer) joint, x, y, vis from j25"))
def q_joint_reorder(spark, d):
    """I1 + I2: 17 + 6 source keypoints -> 25 joints with synthetic neck
    and hip; long form."""
    p = prepared(spark, d)
    z = p.select("image_id", "ann_id", F.posexplode(F.arrays_zip("jx", "jy", "jv")).alias("joint", "j"))
    return z.select("image_id", "ann_id", F.col("joint").cast("int").alias("joint"),
                    F.col("j.jx").alias("x"), F.col("j.jy").alias("y"), F.col("j.jv").alias("vis"))


@query("flip_joints", _sql(f"""
select j.image_id, j.ann_id, {rnd_sql("sum((i.width - j.x - 1) * j.vis)")} sx, {rnd_sql("sum(j.y * j.vis)")} sy,
  cast(sum(j.vis) as bigint) sv
from j25 j join fx_images i on i.image_id = j.image_id group by j.image_id, j.ann_id"""))
def q_flip_joints(spark, d):
    """Mirror joints in the image width; per-annotation sums of the
    mirrored, visibility-masked coordinates."""
    p = prepared(spark, d)
    f = K.flip_joints("jx", "jy", "jv", "width")
    s = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)
    return p.select("image_id", "ann_id", rnd(s(f["jx"])).alias("sx"), rnd(s(f["jy"])).alias("sy"),
                    F.aggregate(f["jv"], F.lit(0).cast("long"), lambda acc, v: acc + v).alias("sv"))


def _cs_sql():
    return """
, cs as (select image_id, ann_id, clean_x + clean_w * 0.5 cx, clean_y + clean_h * 0.5 cy,
    (case when clean_w < 0.75 * clean_h then clean_h * 0.75 else clean_w end) / 200.0
      * (case when clean_x + clean_w * 0.5 <> -1 then 1.25 else 1.0 end) sx,
    (case when clean_w > 0.75 * clean_h then clean_w / 0.75 else clean_h end) / 200.0
      * (case when clean_x + clean_w * 0.5 <> -1 then 1.25 else 1.0 end) sy
  from valid)"""


def _rot_sql(key="ann_id", epoch="0"):
    u4 = K.uniform_draw_sql(key, epoch, 4)
    u5 = K.uniform_draw_sql(key, epoch, 5)
    return f"(case when {u4} < 0.5 then least(greatest({u5} * 45.0, -90.0), 90.0) else 0.0 end)"


@query("affine_points", _sql(_cs_sql() + f"""
, m as (select image_id, ann_id, cx, cy, sx, {_rot_sql()} * (pi() / 180.0) th, 192.0 / (sx * 200.0) k from cs),
mm as (select image_id, ann_id, k * cos(th) m00, k * sin(th) m01, -k * sin(th) m10, k * cos(th) m11,
  192.0 * 0.5 - (k * cos(th) * cx + k * sin(th) * cy) m02, 256.0 * 0.5 - (-k * sin(th) * cx + k * cos(th) * cy) m12 from m)
select mm.image_id, mm.ann_id, {rnd_sql("m00")} m00, {rnd_sql("m01")} m01, {rnd_sql("m02", 4)} m02,
  {rnd_sql("m10")} m10, {rnd_sql("m11")} m11, {rnd_sql("m12", 4)} m12,
  sum(cast(floor((case when j.vis > 0 then m00 * j.x + m01 * j.y + m02 else j.x end) * 10000.0 + 0.5) as bigint)) sum_x_e4,
  sum(cast(floor((case when j.vis > 0 then m10 * j.x + m11 * j.y + m12 else j.y end) * 10000.0 + 0.5) as bigint)) sum_y_e4
from mm join j25 j on j.image_id = mm.image_id and j.ann_id = mm.ann_id
group by mm.image_id, mm.ann_id, m00, m01, m02, m10, m11, m12"""))
def q_affine_points(spark, d):
    """I6 + I7: affine matrix of the box (rotation from the epoch-0 draw)
    onto a 192 x 256 crop, applied to the visible joints."""
    p = prepared(spark, d)
    rot = K.augment_draw("ann_id", F.lit(0), F.lit(0))["rotation"]
    m = K.affine_matrix("center_x", "center_y", "scale_x", rot, F.lit(192.0), F.lit(256.0))
    p = p.select("image_id", "ann_id", "jx", "jy", "jv", *[v.alias(k) for k, v in m.items()])
    # transformed joints (I7), each quantised to 1e-4 and summed as integers
    # (exact in any order); unrolled over the 25 joints. Sums are added in
    # their own projection: an expression reading m02 must not see a
    # same-named alias of the same select list (lateral column alias).
    def qsum(row):
        total = F.lit(0).cast("long")
        for j in range(25):
            x, y, v = (F.element_at(c, j + 1) for c in ("jx", "jy", "jv"))
            t = F.col(f"m{row}0") * x + F.col(f"m{row}1") * y + F.col(f"m{row}2")
            val = F.when(v > 0, t).otherwise(x if row == 0 else y)
            total = total + F.floor(val * 10000.0 + 0.5).cast("long")
        return total
    p = p.select("*", qsum(0).alias("sum_x_e4"), qsum(1).alias("sum_y_e4"))
    return p.select("image_id", "ann_id", rnd("m00").alias("m00"), rnd("m01").alias("m01"), rnd("m02", 4).alias("m02"),
                    rnd("m10").alias("m10"), rnd("m11").alias("m11"), rnd("m12", 4).alias("m12"),
                    "sum_x_e4", "sum_y_e4")


@query("warp_matrix_udp", _sql(_cs_sql() + f"""
, w as (select c.image_id, c.ann_id, {_rot_sql('c.ann_id')} * (pi() / 180.0) t, cast(i.width as double) iw, cast(i.height as double) ih,
  192.0 / (c.sx * 200.0) kx, 256.0 / (c.sy * 200.0) ky, c.sx * 200.0 rw, c.sy * 200.0 rh
  from cs c join fx_images i on i.image_id = c.image_id)
select image_id, ann_id, {rnd_sql("cos(t) * kx")} m00, {rnd_sql("-sin(t) * kx")} m01,
  {rnd_sql("kx * (-0.5 * iw * cos(t) + 0.5 * ih * sin(t) + 0.5 * rw)", 4)} m02,
  {rnd_sql("sin(t) * ky")} m10, {rnd_sql("cos(t) * ky")} m11,
  {rnd_sql("ky * (-0.5 * iw * sin(t) - 0.5 * ih * cos(t) + 0.5 * rh)", 4)} m12 from w"""))
def q_warp_matrix_udp(spark, d):
    """I8: UDP warp matrix for the rotated box onto a 192 x 256 input."""
    p = prepared(spark, d)
    rot = K.augment_draw("ann_id", F.lit(0), F.lit(0))["rotation"]
    m = K.warp_matrix_udp(rot, F.col("width").cast("double"), F.col("height").cast("double"), F.lit(192.0),
                          F.lit(256.0), F.col("scale_x") * 200.0, F.col("scale_y") * 200.0)
    dp = {"m02": 4, "m12": 4}
    return p.select("image_id", "ann_id", *[rnd(v, dp.get(k, 6)).alias(k) for k, v in m.items()])


def _draw_sql():
    u = {s: K.uniform_draw_sql("ann_id", "epoch", s) for s in range(1, 7)}
    return _sql(f"""
, nv as (select image_id, ann_id, sum(vis) n_vis from j25 group by image_id, ann_id),
e as (select nv.*, ep.epoch from nv, (values (0), (1)) ep(epoch))
select image_id, ann_id, cast(epoch as integer) epoch,
  {u[1]} < 0.3 and n_vis > 15 half_body, {u[2]} < 0.5 upper_first,
  {rnd_sql(f"least(greatest({u[3]} * 0.35 + 1, 0.65), 1.35)")} scale_mult,
  {rnd_sql(f"case when {u[4]} < 0.5 then least(greatest({u[5]} * 45.0, -90.0), 90.0) else 0.0 end")} rotation,
  {u[6]} < 0.5 flip
from e""")


@query("augment_draw", _draw_sql())
def q_augment_draw(spark, d):
    """Deterministic augmentation draws for epochs 0 and 1."""
    p = prepared(spark, d)
    nv = F.aggregate("jv", F.lit(0).cast("long"), lambda a, v: a + v)
    p = p.select("image_id", "ann_id", nv.alias("n_vis"), F.explode(F.array(F.lit(0), F.lit(1))).alias("epoch"))
    dr = K.augment_draw("ann_id", "epoch", "n_vis")
    return p.select("image_id", "ann_id", F.col("epoch").cast("int").alias("epoch"),
                    dr["half_body"].alias("half_body"), dr["upper_first"].alias("upper_first"),
                    rnd(dr["scale_mult"]).alias("scale_mult"), rnd(dr["rotation"]).alias("rotation"),
                    dr["flip"].alias("flip"))


@query("half_body", _sql(f"""
, st as (select image_id, ann_id,
  count(case when vis > 0 and joint <= 11 then 1 end) nu, count(case when vis > 0 and joint > 11 then 1 end) nl,
  avg(case when vis > 0 and joint <= 11 then x end) ux, avg(case when vis > 0 and joint <= 11 then y end) uy,
  max(case when vis > 0 and joint <= 11 then x end) - min(case when vis > 0 and joint <= 11 then x end) uw,
  max(case when vis > 0 and joint <= 11 then y end) - min(case when vis > 0 and joint <= 11 then y end) uh,
  avg(case when vis > 0 and joint > 11 then x end) lx, avg(case when vis > 0 and joint > 11 then y end) ly,
  max(case when vis > 0 and joint > 11 then x end) - min(case when vis > 0 and joint > 11 then x end) lw,
  max(case when vis > 0 and joint > 11 then y end) - min(case when vis > 0 and joint > 11 then y end) lh
  from j25 group by image_id, ann_id),
pick as (select image_id, ann_id,
  case when {K.uniform_draw_sql("ann_id", "0", 2)} < 0.5 and nu > 2 then 'u' when nl > 2 then 'l' else 'u' end s,
  nu, nl, ux, uy, uw, uh, lx, ly, lw, lh from st),
sel as (select image_id, ann_id, case when s = 'u' then nu else nl end n, case when s = 'u' then ux else lx end cx,
  case when s = 'u' then uy else ly end cy, case when s = 'u' then uw else lw end w, case when s = 'u' then uh else lh end h from pick)
select image_id, ann_id,
  case when n >= 2 then {rnd_sql("cx")} end hb_center_x, case when n >= 2 then {rnd_sql("cy")} end hb_center_y,
  case when n >= 2 then {rnd_sql("(case when w < 0.75 * h then h * 0.75 else w end) / 200.0 * 1.5")} end hb_scale_x,
  case when n >= 2 then {rnd_sql("(case when w > 0.75 * h then w / 0.75 else h end) / 200.0 * 1.5")} end hb_scale_y
from sel"""))
def q_half_body(spark, d):
    """Half-body centre/scale (upper or lower visible joints)."""
    p = prepared(spark, d).withColumn("upper_first", K.augment_draw("ann_id", F.lit(0), F.lit(0))["upper_first"])
    hb = K.with_half_body(p)
    return hb.select("image_id", "ann_id", *[rnd(k).alias(k) for k in ("hb_center_x", "hb_center_y", "hb_scale_x", "hb_scale_y")])


@query("gaussian_target", fx.with_fixtures(f"""
, mu as (select sample_id, joint, visible,
  cast(trunc(gt_x / 4.0 + 0.5) as bigint) mx, cast(trunc(gt_y / 4.0 + 0.5) as bigint) my from fx_pose_pairs),
w as (select *, case when mx - 9 >= 48 or my - 9 >= 64 or mx + 10 < 0 or my + 10 < 0 then 0
                     when visible then 1 else 0 end wt from mu),
c as (select w.sample_id, w.joint, w.mx, w.my, cx.x, cy.y
  from w, range(greatest(0, w.mx - 9), least(w.mx + 10, 48)) cx(x), range(greatest(0, w.my - 9), least(w.my + 10, 64)) cy(y)
  where w.wt > 0.5),
cells as (select sample_id, count(*) n_cells, sum(exp(-(((x - mx) * (x - mx) + (y - my) * (y - my)) / 18.0))) mass
  from c group by sample_id),
wts as (select sample_id, sum(wt) weight from w group by sample_id)
select wts.sample_id, cast(wts.weight as bigint) weight, coalesce(cells.n_cells, 0) n_cells,
  {rnd_sql("coalesce(cells.mass, 0.0)")} mass
from wts left join cells on cells.sample_id = wts.sample_id""", "fx_pose_pairs").replace(")\n, mu as", "),\nmu as"))
def q_gaussian_target(spark, d):
    """Gaussian target heatmaps (sigma 3, 48 x 64 maps, stride 4),
    summarised per sample (cells, mass, target weight); the oracle sums
    every cell, ours uses the separable closed form."""
    p = fx.fx_pose_pairs(spark, d)
    m = S.target_mass(p, key="sample_id", x="gt_x", y="gt_y", vis="visible")
    return m.groupBy("sample_id").agg(
        F.sum("target_weight").cast("long").alias("weight"), F.sum("n_cells").cast("long").alias("n_cells"),
        rnd(F.sum("mass")).alias("mass"))


@query("split_shard", fx.with_fixtures(f"""
select case when {K.uniform_draw_sql("ann_id", "0", 99)} < 0.8 then 'train' else 'val' end data_version,
  cast(((ann_id % 16) + 16) % 16 as integer) shard, count(*) n
from fx_annotations group by 1, 2""", "fx_annotations"))
def q_split_shard(spark, d):
    """Deterministic train/valid split and shard assignment."""
    a = fx.fx_annotations(spark, d)
    s = S.split_and_shard(a, "ann_id", n_shards=16, valid_share=0.2)
    return s.groupBy("data_version", "shard").agg(F.count(F.lit(1)).alias("n"))


@query("sample_assembly")
def q_sample_assembly(spark, d):
    """Full training-sample assembly (valid annotations -> 25 joints ->
    centre/scale -> half body / scale / rotation / flip draws -> affine ->
    target weights), one row per annotation and epoch 0."""
    return S.assemble_samples(prepared(spark, d), epoch=0).select(
        "image_id", "ann_id", rnd("center_x").alias("center_x"), rnd("center_y").alias("center_y"),
        rnd("scale_x").alias("scale_x"), rnd("scale_y").alias("scale_y"), rnd("rotation").alias("rotation"),
        "flipped", "n_weighted")


_WEIGHTS = ", ".join(f"({j}, {w})" for j, w in enumerate(JOINT_WEIGHTS))


@query("sample_targets", _sql(_cs_sql() + f"""
, m as (select image_id, ann_id, cx, cy, 192.0 / (sx * 200.0) k from cs),
t as (select j.image_id, j.ann_id, j.joint, j.vis,
    case when j.vis > 0 then k * j.x + k * 0.0 * j.y + (192.0 * 0.5 - (k * cx + k * 0.0 * cy)) else j.x end x,
    case when j.vis > 0 then -k * 0.0 * j.x + k * j.y + (256.0 * 0.5 - (-k * 0.0 * cx + k * cy)) else j.y end y
  from m join j25 j on j.image_id = m.image_id and j.ann_id = m.ann_id),
mu as (select *, cast(trunc(x / 4.0 + 0.5) as bigint) mx, cast(trunc(y / 4.0 + 0.5) as bigint) my from t),
w as (select *, case when mx - 9 >= 48 or my - 9 >= 64 or mx + 10 < 0 or my + 10 < 0 then 0 else vis end wt from mu),
c as (select w.image_id, w.ann_id, w.joint, hx, hy, exp(-(((hx - mx) * (hx - mx) + (hy - my) * (hy - my)) / 18.0)) val
  from w, range(greatest(0, w.mx - 9), least(w.mx + 10, 48)) cx(hx), range(greatest(0, w.my - 9), least(w.my + 10, 64)) cy(hy)
  where w.wt > 0.5),
s as (select image_id, ann_id, joint, count(*) n, sum(val) v, sum(val * hx) vx, sum(val * hy) vy from c group by all),
jw as (select * from (values {_WEIGHTS}) t(joint, own))
select w.image_id, w.ann_id, cast(w.joint as integer) joint, cast(w.wt * jw.own as double) weight,
  coalesce(n, 0) n_cells, {rnd_sql("coalesce(v, 0.0)", 3)} mass, {rnd_sql("coalesce(vx, 0.0)", 3)} mass_x,
  {rnd_sql("coalesce(vy, 0.0)", 3)} mass_y
from w join jw on jw.joint = w.joint
left join s on s.image_id = w.image_id and s.ann_id = w.ann_id and s.joint = w.joint"""))
def q_sample_targets(spark, d):
    """I5 + I10: targets and weights that an assembled sample carries (no
    augmentation), one row a joint; moments over all cells of its target."""
    s = S.assemble_samples(prepared(spark, d), train=False)

    def row(t):
        m = S.target_moments(t)
        return F.struct(t["joint"].alias("joint"), t["weight"].alias("weight"), m["n_cells"].alias("n_cells"),
                        *[rnd(m[k], 3).alias(k) for k in ("mass", "mass_x", "mass_y")])
    return s.select("image_id", "ann_id", F.inline(F.transform("targets", row)))


_FLIP25 = ", ".join(f"({j}, {f})" for j, f in enumerate(__import__("posetide.schema", fromlist=["x"]).flip_permutation(25)))


@query("flip_regression", fx.with_fixtures(f"""
, fl as (select * from (values {_FLIP25}) t(joint, partner)),
root as (select sample_id, pred_x / 192.0 rx from fx_pose_pairs where joint = 14)
select p.sample_id, f.joint, {rnd_sql("2 * 0.5 - q.pred_x / 192.0")} sx, {rnd_sql("2 * r.rx - q.pred_x / 192.0")} rx,
  {rnd_sql("q.pred_y / 256.0")} y
from fx_pose_pairs p join fl f on f.joint = p.joint
join fx_pose_pairs q on q.sample_id = p.sample_id and q.joint = f.partner
join root r on r.sample_id = p.sample_id""", "fx_pose_pairs").replace(")\n, fl as", "),\nfl as"))
def q_flip_regression(spark, d):
    """I4: regression outputs (pred / input size) mirrored about x = 0.5
    (static) and about the hip joint 14 (root)."""
    p = fx.fx_pose_pairs(spark, d)
    arr = (p.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("joint", "pred_x", "pred_y"))).alias("a"))
           .select("sample_id", F.transform("a", lambda s: s["pred_x"] / 192.0).alias("jx"),
                   F.transform("a", lambda s: s["pred_y"] / 256.0).alias("jy")))
    st = K.fliplr_regression("jx", "jy", "static", 0.5)
    rt = K.fliplr_regression("jx", "jy", "root", center_index=14)
    z = arr.select("sample_id", F.posexplode(F.arrays_zip(st["jx"].alias("sx"), rt["jx"].alias("rx"),
                                                          st["jy"].alias("y"))).alias("joint", "z"))
    return z.select("sample_id", F.col("joint").cast("int").alias("joint"), rnd("z.sx").alias("sx"),
                    rnd("z.rx").alias("rx"), rnd("z.y").alias("y"))
