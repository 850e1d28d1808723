"""Registered queries: metrics and error reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from posetide import fixtures as fx
from posetide.functions.numeric import rnd, rnd_sql
from posetide.operators import metrics as M
from posetide.plans.registry import query
from posetide.schema import JOINTS_WEIGHT

PCK_THR = 0.1
AUC_NORM = 30.0

_DIST = """
dist as (
  select sample_id, joint,
    case when visible and not (norm_x = 0 or norm_y = 0) then
      sqrt(((pred_x - gt_x) / (case when norm_x <= 0 then 1e6 else norm_x end)) * ((pred_x - gt_x) / (case when norm_x <= 0 then 1e6 else norm_x end))
         + ((pred_y - gt_y) / (case when norm_y <= 0 then 1e6 else norm_y end)) * ((pred_y - gt_y) / (case when norm_y <= 0 then 1e6 else norm_y end)))
    end dist
  from fx_pose_pairs)"""


def _with_dist(body: str) -> str:
    return fx.with_fixtures(", " + _DIST.strip() + "\n" + body, "fx_pose_pairs").replace(")\n, dist as", "),\ndist as")


def _dist(spark, d):
    return M.normalized_distance(fx.fx_pose_pairs(spark, d))


@query("normalized_distance", _with_dist(f"select sample_id, joint, {rnd_sql('dist')} dist from dist"))
def q_normalized_distance(spark, d):
    """Normalised distance per (sample, joint); null when masked."""
    return _dist(spark, d).select("sample_id", "joint", rnd("dist").alias("dist"))


@query("pck", _with_dist(f"""
select joint, {rnd_sql(f"avg(case when dist is null then null when dist < {PCK_THR} then 1.0e0 else 0.0e0 end)")} acc,
  count(dist) n_valid from dist group by joint"""))
def q_pck(spark, d):
    """PCK per joint at threshold 0.1."""
    return M.pck_per_joint(_dist(spark, d), PCK_THR).select("joint", rnd("acc").alias("acc"), "n_valid")


@query("pck_mean", _with_dist(f"""
, pj as (select joint, avg(case when dist is null then null when dist < {PCK_THR} then 1.0e0 else 0.0e0 end) acc
  from dist group by joint)
select {rnd_sql("coalesce(avg(acc), 0.0)")} avg_acc, count(acc) cnt from pj"""))
def q_pck_mean(spark, d):
    """Mean PCK over joints with data, and their count."""
    s = M.pck_summary(_dist(spark, d), PCK_THR)
    return s.select(rnd("avg_acc").alias("avg_acc"), "cnt")


_AUC_SQL = fx.with_fixtures(f"""
, dn as (
  select joint, case when visible then sqrt(((pred_x - gt_x) / {AUC_NORM}) * ((pred_x - gt_x) / {AUC_NORM})
      + ((pred_y - gt_y) / {AUC_NORM}) * ((pred_y - gt_y) / {AUC_NORM})) end dist
  from fx_pose_pairs),
thr as (select i, i / 20.0 t from range(20) r(i)),
pj as (select t.i, d.joint, avg(case when d.dist < t.t then 1.0e0 else 0.0e0 end) acc
       from dn d, thr t where d.dist is not null group by t.i, d.joint),
curve as (select i, avg(acc) y from pj group by i)
select {rnd_sql("sum(y) / 20.0")} auc from curve""", "fx_pose_pairs").replace(")\n, dn as", "),\ndn as")


@query("pck_auc", _AUC_SQL)
def q_pck_auc(spark, d):
    """AUC of PCK over 20 thresholds, scalar normaliser 30."""
    p = fx.fx_pose_pairs(spark, d).withColumn("nrm", F.lit(AUC_NORM))
    dist = M.normalized_distance(p, norm=("nrm", "nrm"))
    return M.auc(dist, 20).select(rnd("auc").alias("auc"))


@query("nme", _with_dist(f"select {rnd_sql('coalesce(sum(dist), 0.0) / greatest(1, count(dist))')} nme from dist"))
def q_nme(spark, d):
    """Normalised mean error."""
    return M.nme(_dist(spark, d)).select(rnd("nme").alias("nme"))


@query("epe", fx.with_fixtures(f"""
select {rnd_sql("coalesce(sum(case when visible then sqrt((pred_x - gt_x) * (pred_x - gt_x) + (pred_y - gt_y) * (pred_y - gt_y)) end), 0.0) / greatest(1, count(case when visible then 1 end))")} epe
from fx_pose_pairs""", "fx_pose_pairs"))
def q_epe(spark, d):
    """End-point error over visible joints."""
    return M.epe(fx.fx_pose_pairs(spark, d)).select(rnd("epe").alias("epe"))


@query("multilabel_accuracy", fx.with_fixtures(f"""
select {rnd_sql("coalesce(avg(case when (pred_a - 0.5) * (gt_a - 0.5) > 0 and (pred_b - 0.5) * (gt_b - 0.5) > 0 then 1.0e0 else 0.0e0 end), 0.0)")} accuracy
from fx_multilabel where mask_a > 0 and mask_b > 0""", "fx_multilabel"))
def q_multilabel_accuracy(spark, d):
    """Exact-match multi-label accuracy on fully labelled samples."""
    m = fx.fx_multilabel(spark, d)
    return M.multilabel_accuracy(m, ["pred_a", "pred_b"], ["gt_a", "gt_b"], ["mask_a", "mask_b"]).select(
        rnd("accuracy").alias("accuracy"))


_JW_VALUES = ", ".join(f"({j}, {w})" for j, w in enumerate(JOINTS_WEIGHT))
_WING_C = 10.0 * (1.0 - __import__("math").log(1.0 + 10.0 / 2.0))
_SW_B = 2.0 - 20.0 * __import__("math").log(1.0 + 2.0 / 0.5)


def _ce_sql():
    ex = "(pred_x * w - gt_x * w)"
    ey = "(pred_y * w - gt_y * w)"

    def sm(a):
        return f"(case when abs({a}) < 1.0 then 0.5 * abs({a}) * abs({a}) else abs({a}) - 0.5 end)"

    def wg(a):
        return f"(case when abs({a}) < 10.0 then 10.0 * ln(1.0 + abs({a}) / 2.0) else abs({a}) - ({_WING_C!r}) end)"

    def sw(a):
        return f"(case when abs({a}) < 2.0 then abs({a}) else 20.0 * ln(1.0 + abs({a}) / 0.5) + ({_SW_B!r}) end)"
    return fx.with_fixtures(f"""
, pw as (select p.*, cast(w.weight as double) w from fx_pose_pairs p join (values {_JW_VALUES}) w(joint, weight) on w.joint = p.joint),
ps as (select sample_id, sum(abs({ex}) + abs({ey})) l1, sum({ex} * {ex} + {ey} * {ey}) se,
  sum({sm(ex)} + {sm(ey)}) sl1, sum({wg(ex)} + {wg(ey)}) wing, sum({sw(ex)} + {sw(ey)}) soft,
  sum(sqrt({ex} * {ex} + {ey} * {ey})) dist, count(*) k from pw group by sample_id)
select {rnd_sql("sum(l1) / (sum(k) * 2)")} l1, {rnd_sql("sum(se) / (sum(k) * 2)")} mse,
  {rnd_sql("sum(sl1) / (sum(k) * 2)")} smooth_l1, {rnd_sql("avg(wing)")} wing, {rnd_sql("avg(soft)")} soft_wing,
  {rnd_sql("sum(dist) / sum(k)")} mpjpe from ps""", "fx_pose_pairs").replace(")\n, pw as", "),\npw as")


def joint_weight_dim(spark):
    return spark.createDataFrame(list(enumerate(JOINTS_WEIGHT)), "joint int, weight double")


@query("coord_errors", _ce_sql())
def q_coord_errors(spark, d):
    """Coordinate error report with the per-joint weights applied to
    both sides (broadcast 25-row weight table)."""
    p = fx.fx_pose_pairs(spark, d).join(F.broadcast(joint_weight_dim(spark)), "joint")
    r = M.coordinate_errors(p, weight="weight")
    return r.select(*[rnd(c).alias(c) for c in r.columns])


_PARENTS = M.skeleton_parents()
_PARENT_VALUES = ", ".join(f"({j}, {p})" for j, p in enumerate(_PARENTS) if j != p)


@query("bone_bias", fx.with_fixtures(f"""
, par as (select * from (values {_PARENT_VALUES}) t(joint, parent)),
bl as (select c.joint,
  sqrt((c.pred_x - p.pred_x) * (c.pred_x - p.pred_x) + (c.pred_y - p.pred_y) * (c.pred_y - p.pred_y)) lo,
  sqrt((c.gt_x - p.gt_x) * (c.gt_x - p.gt_x) + (c.gt_y - p.gt_y) * (c.gt_y - p.gt_y)) lt
  from fx_pose_pairs c join par on par.joint = c.joint
  join fx_pose_pairs p on p.sample_id = c.sample_id and p.joint = par.parent),
pb as (select joint, abs(avg(lo) - avg(lt)) bias from bl group by joint)
select {rnd_sql("avg(bias)")} bone_bias from pb""", "fx_pose_pairs").replace(")\n, par as", "),\npar as"))
def q_bone_bias(spark, d):
    """Bone-length bias over a skeleton tree rooted at the hip."""
    return M.bone_bias(fx.fx_pose_pairs(spark, d), _PARENTS).select(rnd("bone_bias").alias("bone_bias"))


def fx_heatmap_pairs(spark, d):
    """Pred/target heatmap pairs: 10 joints per sample (from embeddings)."""
    h = fx.fx_heatmaps(spark, d)
    return h.select((F.col("person_id") / 10).cast("long").alias("sample_id"),
                    (F.col("person_id") % 10).cast("int").alias("joint"),
                    F.col("hm").alias("pred"), F.reverse("hm").alias("gt"),
                    (1.0 + (F.col("person_id") % 3) / 2.0).alias("weight"))


_HMP = """
, hp as (select person_id // 10 sample_id, person_id % 10 joint, hm pred, list_reverse(hm) gt,
  1.0 + (person_id % 3) / 2.0 weight from fx_heatmaps),
rows_ as (select sample_id, joint,
  list_sum(list_transform(range(1, len(pred) + 1), lambda i: (pred[i] * weight - gt[i] * weight) * (pred[i] * weight - gt[i] * weight))) / len(pred) m,
  list_sum(list_transform(range(1, len(pred) + 1), lambda i:
    case when abs(gt[i] - pred[i]) < 0.5
      then 14.0 * ln(1 + pow(abs(gt[i] - pred[i]) / 1.0, 2.1 - gt[i]))
      else (14.0 * (1 / (1 + pow(0.5, 2.1 - gt[i]))) * (2.1 - gt[i]) * pow(0.5, 2.1 - gt[i] - 1) * (1 / 1.0)) * abs(gt[i] - pred[i])
         - (0.5 * (14.0 * (1 / (1 + pow(0.5, 2.1 - gt[i]))) * (2.1 - gt[i]) * pow(0.5, 2.1 - gt[i] - 1) * (1 / 1.0))
            - 14.0 * ln(1 + pow(0.5, 2.1 - gt[i]))) end)) / len(pred) aw
  from hp)
"""


def _hm_sql(body):
    return fx.with_fixtures(_HMP + body, "fx_heatmaps").replace(")\n\n, hp as", "),\nhp as")


@query("heatmap_mse", _hm_sql(f"select {rnd_sql('avg(m)')} mse, {rnd_sql('avg(aw)', 5)} adaptive_wing from rows_"))
def q_heatmap_mse(spark, d):
    """Weighted heatmap MSE and adaptive-wing loss."""
    rows = M.heatmap_row_errors(fx_heatmap_pairs(spark, d))
    r = M.heatmap_mse(rows)
    return r.select(rnd("mse").alias("mse"), rnd("adaptive_wing", 5).alias("adaptive_wing"))


@query("hard_joint_topk", _hm_sql(f"""
, rk as (select sample_id, m, row_number() over (partition by sample_id order by m desc) r from rows_),
h as (select sample_id, sum(m) / 8 h from rk where r <= 8 group by sample_id)
select {rnd_sql('avg(h)')} ohkm from h"""))
def q_hard_joint_topk(spark, d):
    """J11 OHKM: mean of the 8 hardest joints per sample."""
    rows = M.heatmap_row_errors(fx_heatmap_pairs(spark, d))
    return M.hard_joint_topk(rows, 8).select(rnd("ohkm").alias("ohkm"))


@query("tag_push_pull", fx.with_fixtures(f"""
, vis as (select * from fx_tags where visible > 0),
pm as (select image_id, person, avg(tag) m from vis group by image_id, person),
pull_p as (select v.image_id, v.person, avg((v.tag - pm.m) * (v.tag - pm.m)) var
  from vis v join pm on pm.image_id = v.image_id and pm.person = v.person group by v.image_id, v.person),
st as (select image_id, count(*) n, sum(var) pull_sum from pull_p group by image_id),
push as (select a.image_id, sum(exp(-((a.m - b.m) * (a.m - b.m)))) push_sum
  from pm a join pm b on a.image_id = b.image_id and a.person <> b.person group by a.image_id)
select st.image_id, st.n n_persons,
  {rnd_sql("case when st.n <= 1 then 0.0 else coalesce(push.push_sum, 0.0) / ((st.n - 1) * st.n) * 0.5 end", 9)} push,
  {rnd_sql("st.pull_sum / st.n", 9)} pull
from st left join push on push.image_id = st.image_id""", "fx_tags").replace(")\n, vis as", "),\nvis as"))
def q_tag_push_pull(spark, d):
    """Associative-embedding pull and push per image."""
    r = M.tag_push_pull(fx.fx_tags(spark, d))
    return r.select("image_id", "n_persons", rnd("push", 9).alias("push"), rnd("pull", 9).alias("pull"))


@query("bce", fx.with_fixtures(f"""
, t as (select
  -(gt_a * (case when pred_a > 0 then greatest(ln(pred_a), -100.0) else -100.0 end)
    + (1 - gt_a) * (case when pred_a < 1 then greatest(ln(1 - pred_a), -100.0) else -100.0 end)) * mask_a
  - (gt_b * (case when pred_b > 0 then greatest(ln(pred_b), -100.0) else -100.0 end)
    + (1 - gt_b) * (case when pred_b < 1 then greatest(ln(1 - pred_b), -100.0) else -100.0 end)) * mask_b s
  from fx_multilabel)
select {rnd_sql("sum(s) / (count(*) * 2)")} bce from t""", "fx_multilabel").replace(")\n, t as", "),\nt as"))
def q_bce(spark, d):
    """Weighted binary cross-entropy over two labels."""
    m = fx.fx_multilabel(spark, d)
    return M.bce(m, ["pred_a", "pred_b"], ["gt_a", "gt_b"], ["mask_a", "mask_b"]).select(rnd("bce").alias("bce"))


@query("reprojection_error", fx.with_fixtures(f"""
, c as (select sample_id, joint, pred_x, pred_y,
  least(1.0, greatest(-1.0, (gt_x - 96.0) / (400.0 + joint * 10.0))) u,
  least(1.0, greatest(-1.0, (gt_y - 128.0) / (400.0 + joint * 10.0))) v,
  500.0 + sample_id % 100 f from fx_pose_pairs),
r as (select *, u * u + v * v r2 from c),
d as (select *, 1 + 0.01 * r2 + 0.001 * r2 * r2 + 0.0001 * r2 * r2 * r2 radial, 0.001 * u + 0.002 * v tan from r),
p as (select pred_x, pred_y, f * (u * (radial + tan) + 0.001 * r2) + 96.0 px,
  f * (v * (radial + tan) + 0.002 * r2) + 128.0 py from d)
select {rnd_sql("avg(sqrt((px - pred_x) * (px - pred_x) + (py - pred_y) * (py - pred_y)))", 4)} reproj_error from p""",
                                             "fx_pose_pairs").replace(")\n, c as", "),\nc as"))
def q_reprojection_error(spark, d):
    """3-D joints (truth lifted to depth 400 + 10*joint, centred on
    (96, 128)) projected with f, c, k1..k3, p1..p2 versus the 2-D
    predictions: mean pixel distance."""
    p = fx.fx_pose_pairs(spark, d)
    X = F.col("gt_x") - 96.0
    Y = F.col("gt_y") - 128.0
    Z = F.lit(400.0) + F.col("joint") * 10.0
    f = F.lit(500.0) + F.col("sample_id") % 100
    u, v = M.project_points(X, Y, Z, f, f, F.lit(96.0), F.lit(128.0),
                            k=(F.lit(0.01), F.lit(0.001), F.lit(0.0001)), p=(F.lit(0.001), F.lit(0.002)))
    e = F.sqrt((u - F.col("pred_x")) * (u - F.col("pred_x")) + (v - F.col("pred_y")) * (v - F.col("pred_y")))
    return p.agg(rnd(F.avg(e), 4).alias("reproj_error"))


@query("root_aligned_error", fx.with_fixtures(f"""
, p3 as (select *, (pred_x + pred_y) / 2 pred_z, (gt_x + gt_y) / 2 gt_z from fx_pose_pairs),
root as (select sample_id, avg(pred_x) px, avg(pred_y) py, avg(pred_z) pz, avg(gt_x) gx, avg(gt_y) gy, avg(gt_z) gz
  from p3 where joint in (2, 3) group by sample_id),
d as (select visible, abs((pred_x - px) - (gt_x - gx)) dx, abs((pred_y - py) - (gt_y - gy)) dy, abs((pred_z - pz) - (gt_z - gz)) dz
  from p3 join root r on r.sample_id = p3.sample_id)
select {rnd_sql("avg(case when visible then ((case when dx < 1 then dx * dx * 0.5 else dx - 0.5 end) + (case when dy < 1 then dy * dy * 0.5 else dy - 0.5 end) + (case when dz < 1 then dz * dz * 0.5 else dz - 0.5 end)) / 3 else 0.0 end)")} root_aligned_error
from d""", "fx_pose_pairs").replace(")\n, p3 as", "),\np3 as"))
def q_root_aligned_error(spark, d):
    """Pelvis-aligned (mid of joints 2, 3) masked smooth-L1 error of 3-D
    joints, averaged over all rows and axes (masked rows count as 0). The pose
    table has no depth; the mean of x and y stands in for it."""
    p = (fx.fx_pose_pairs(spark, d).withColumn("pred_z", (F.col("pred_x") + F.col("pred_y")) / 2)
         .withColumn("gt_z", (F.col("gt_x") + F.col("gt_y")) / 2))
    return M.root_aligned_smooth_l1(p).select(rnd(F.col("error")).alias("root_aligned_error"))


@query("epoch_loss", fx.with_fixtures(f"""
, b as (select sample_id // 64 batch, count(*) n,
  avg((pred_x - gt_x) * (pred_x - gt_x) + (pred_y - gt_y) * (pred_y - gt_y)) loss from fx_pose_pairs group by 1)
select {rnd_sql("sum(loss * n) / sum(n)", 4)} mean_loss, count(*) n_batches from b""", "fx_pose_pairs").replace(")\n, b as", "),\nb as"))
def q_epoch_loss(spark, d):
    """Epoch loss = size-weighted mean of batch losses (the true
    per-row mean, Q12), batches of 64 samples."""
    p = fx.fx_pose_pairs(spark, d)
    se = (F.col("pred_x") - F.col("gt_x")) * (F.col("pred_x") - F.col("gt_x")) + \
         (F.col("pred_y") - F.col("gt_y")) * (F.col("pred_y") - F.col("gt_y"))
    b = p.groupBy((F.col("sample_id") / 64).cast("long").alias("batch")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(se).alias("loss"))
    return b.agg(rnd(F.sum(F.col("loss") * F.col("n")) / F.sum("n"), 4).alias("mean_loss"),
                 F.count(F.lit(1)).alias("n_batches"))


@query("category_summary", fx.with_fixtures("""
select p.category_id, count(distinct p.product_id) n_products, count(i.image_id) n_images
from fx_products p left join fx_images i on i.product_id = p.product_id group by p.category_id""",
                                            "fx_products", "fx_images"))
def q_category_summary(spark, d):
    """Products and images per category."""
    p = fx.fx_products(spark, d).select("product_id", "category_id")
    i = fx.fx_images(spark, d).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    return (p.join(i, "product_id", "left").groupBy("category_id")
            .agg(F.count(F.lit(1)).alias("n_products"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_images")))


@query("pose_pck_heatmap", fx.with_fixtures(f"""
, hp as (select person_id // 10 sample_id, cast(person_id % 10 as integer) joint, hm p, list_reverse(hm) g from fx_heatmaps),
am as (select sample_id, joint, list_max(p) pm, list_position(p, list_max(p)) - 1 pi,
  list_max(g) gm, list_position(g, list_max(g)) - 1 gi from hp),
xy as (select sample_id, joint,
  case when pm > 0 then cast(pi % 8 as double) else -1.0 end px, case when pm > 0 then cast(pi // 8 as double) else -1.0 end py,
  case when gm > 0 then cast(gi % 8 as double) else -1.0 end gx, case when gm > 0 then cast(gi // 8 as double) else -1.0 end gy from am),
d as (select joint, sqrt(((px - gx) / 8.0) * ((px - gx) / 8.0) + ((py - gy) / 8.0) * ((py - gy) / 8.0)) dist from xy)
select joint, {rnd_sql("avg(case when dist < 0.2 then 1.0e0 else 0.0e0 end)")} acc, count(*) n_valid from d group by joint""",
                                         "fx_heatmaps").replace(")\n, hp as", "),\nhp as"))
def q_pose_pck_heatmap(spark, d):
    """PCK from heatmaps — F1 argmax of predicted and target maps, then
    J1-J3 with the (H, W) normaliser applied to (x, y) as given (Q11)."""
    from posetide.functions.heatmap import argmax
    hp = fx_heatmap_pairs(spark, d)
    a, b = argmax("pred", F.lit(8)), argmax("gt", F.lit(8))
    xy = hp.select("sample_id", "joint", a["px"].alias("pred_x"), a["py"].alias("pred_y"),
                   b["px"].alias("gt_x"), b["py"].alias("gt_y"), F.lit(True).alias("visible"),
                   F.lit(8.0).alias("norm_x"), F.lit(8.0).alias("norm_y"))
    return M.pck_per_joint(M.normalized_distance(xy), 0.2).select("joint", rnd("acc").alias("acc"), "n_valid")
