"""Evaluation metrics and error reports (J1-J17) as aggregates.

Inputs are long-form tables, one row per (sample, joint): predicted and true
coordinates, a visibility mask and per-sample normalisers. Every metric is a
grouped aggregate (partial aggregation before the shuffle; groups are joints
or samples, never a collected list). Distances are computed in double
(the reference stores them as float32).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posetide.schema import SKELETON


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _norm2(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


# ---------------------------------------------------------------------------
# J1-J7 keypoint accuracy
# ---------------------------------------------------------------------------

def normalized_distance(df: DataFrame, sample="sample_id", pred=("pred_x", "pred_y"),
                        gt=("gt_x", "gt_y"), mask="visible", norm=("norm_x", "norm_y")) -> DataFrame:
    """Adds ``dist`` = ||(pred - gt) / norm||, null when masked.

    A sample with any zero normaliser is masked entirely; negative
    normalisers become 1e6 (as the reference)."""
    nx, ny = _c(norm[0]), _c(norm[1])
    zero_norm = (nx == 0) | (ny == 0)
    fx_ = F.when(nx <= 0, F.lit(1e6)).otherwise(nx)
    fy_ = F.when(ny <= 0, F.lit(1e6)).otherwise(ny)
    ux = (_c(pred[0]) - _c(gt[0])) / fx_
    uy = (_c(pred[1]) - _c(gt[1])) / fy_
    d = F.sqrt(ux * ux + uy * uy)
    valid = _c(mask) & ~zero_norm
    return df.withColumn("dist", F.when(valid, d))


def pck_per_joint(dist_df: DataFrame, thr: float, joint="joint") -> DataFrame:
    """Per joint, share of valid distances below ``thr`` (null when
    the joint has no valid distance; the reference's -1)."""
    hit = F.when(F.col("dist").isNotNull(), F.when(F.col("dist") < thr, 1.0).otherwise(0.0))
    return dist_df.groupBy(joint).agg(F.avg(hit).alias("acc"), F.count("dist").alias("n_valid"))


def pck_summary(dist_df: DataFrame, thr: float, joint="joint") -> DataFrame:
    """Mean of the per-joint accuracies over joints with data, and the
    number of such joints (mean of means, not a pooled mean)."""
    pj = pck_per_joint(dist_df, thr, joint)
    return pj.agg(F.coalesce(F.avg("acc"), F.lit(0.0)).alias("avg_acc"),
                  F.count("acc").alias("cnt"))


def auc(dist_df: DataFrame, num_step: int = 20, joint="joint") -> DataFrame:
    """Area under the PCK curve for thresholds i/num_step, i < num_step.

    For a valid distance d, the thresholds it passes are the i with
    i/num_step > d, counted in closed form, so the whole curve is one
    aggregate (no thresholds x rows cross join):
      AUC = 1/J * sum_j 1/(n * N_j) * sum_d #{i : i/n > d}."""
    n = float(num_step)
    d = F.col("dist")
    passed = F.greatest(F.lit(0.0), F.least(F.lit(n), F.lit(n - 1) - F.floor(d * n)))
    per_joint = (dist_df.where(d.isNotNull()).groupBy(joint)
                 .agg((F.sum(passed) / (F.count(F.lit(1)) * n)).alias("area")))
    return per_joint.agg(F.coalesce(F.avg("area"), F.lit(0.0)).alias("auc"))


def nme(dist_df: DataFrame) -> DataFrame:
    """Mean of valid normalised distances, denominator max(1, n)."""
    return dist_df.agg((F.coalesce(F.sum("dist"), F.lit(0.0))
                        / F.greatest(F.lit(1), F.count("dist"))).alias("nme"))


def epe(df: DataFrame, pred=("pred_x", "pred_y"), gt=("gt_x", "gt_y"), mask="visible") -> DataFrame:
    """End-point error = NME with unit normalisers."""
    d = normalized_distance(df.withColumn("_one", F.lit(1.0)), pred=pred, gt=gt, mask=mask,
                            norm=("_one", "_one"))
    return d.agg((F.coalesce(F.sum("dist"), F.lit(0.0))
                  / F.greatest(F.lit(1), F.count("dist"))).alias("epe"))


def multilabel_accuracy(df: DataFrame, preds, gts, masks, thr: float = 0.5) -> DataFrame:
    """Exact-match accuracy over fully labelled samples (all masks > 0);
    0 when no sample qualifies."""
    valid = None
    for m in masks:
        v = _c(m) > 0
        valid = v if valid is None else valid & v
    match = None
    for p, g in zip(preds, gts):
        ok = (_c(p) - thr) * (_c(g) - thr) > 0
        match = ok if match is None else match & ok
    return df.where(valid).agg(
        F.coalesce(F.avg(F.when(match, 1.0).otherwise(0.0)), F.lit(0.0)).alias("accuracy"))


# ---------------------------------------------------------------------------
# J9-J11 error reports
# ---------------------------------------------------------------------------

def coordinate_errors(df: DataFrame, sample="sample_id", pred=("pred_x", "pred_y"),
                      gt=("gt_x", "gt_y"), weight=None, omega=10.0, epsilon=2.0,
                      omega1=2.0, omega2=20.0, sw_epsilon=0.5) -> DataFrame:
    """L1, MSE, SmoothL1 (beta 1), Wing, SoftWing and mean joint
    distance. Weights multiply both sides before the error (as reference).
    Wing and SoftWing are means over samples of per-sample sums."""
    w = _c(weight) if weight is not None else F.lit(1.0)
    px, py = _c(pred[0]) * w, _c(pred[1]) * w
    gx, gy = _c(gt[0]) * w, _c(gt[1]) * w
    ex, ey = px - gx, py - gy
    ax, ay = F.abs(ex), F.abs(ey)
    wing_c = omega * (1.0 - math.log(1.0 + omega / epsilon))
    sw_b = omega1 - omega2 * math.log(1.0 + omega1 / sw_epsilon)

    def smooth(a):
        return F.when(a < 1.0, 0.5 * a * a).otherwise(a - 0.5)

    def wing(a):
        return F.when(a < omega, omega * F.log(1.0 + a / epsilon)).otherwise(a - wing_c)

    def soft(a):
        return F.when(a < omega1, a).otherwise(omega2 * F.log(1.0 + a / sw_epsilon) + sw_b)
    per_sample = df.groupBy(sample).agg(
        F.sum(ax + ay).alias("l1"), F.sum(ex * ex + ey * ey).alias("se"),
        F.sum(smooth(ax) + smooth(ay)).alias("sl1"), F.sum(wing(ax) + wing(ay)).alias("wing"),
        F.sum(soft(ax) + soft(ay)).alias("soft"), F.sum(F.sqrt(ex * ex + ey * ey)).alias("dist"),
        F.count(F.lit(1)).alias("k"))
    tot = F.sum("k")
    return per_sample.agg(
        (F.sum("l1") / (tot * 2)).alias("l1"), (F.sum("se") / (tot * 2)).alias("mse"),
        (F.sum("sl1") / (tot * 2)).alias("smooth_l1"), F.avg("wing").alias("wing"),
        F.avg("soft").alias("soft_wing"), (F.sum("dist") / tot).alias("mpjpe"))


def skeleton_parents(root: int = 14, num_joints: int = 25) -> list[int]:
    """Parent of every joint in a tree grown breadth-first from ``root`` over
    the skeleton edges (root is its own parent)."""
    adj: dict[int, list[int]] = {j: [] for j in range(num_joints)}
    for a, b in SKELETON:
        adj[a].append(b)
        adj[b].append(a)
    parent = {root: root}
    frontier = [root]
    while frontier:
        nxt = []
        for u in frontier:
            for v in sorted(adj[u]):
                if v not in parent:
                    parent[v] = u
                    nxt.append(v)
        frontier = nxt
    return [parent.get(j, j) for j in range(num_joints)]


def bone_bias(df: DataFrame, parents: list[int], sample="sample_id", joint="joint",
              pred=("pred_x", "pred_y"), gt=("gt_x", "gt_y")) -> DataFrame:
    """Mean over bones of |mean predicted length - mean true length|.
    The parent table is a fixed K-row dimension (broadcast); the pose rows
    meet in a merge join, however small Spark thinks them."""
    spark = df.sparkSession
    par = spark.createDataFrame([(j, p) for j, p in enumerate(parents) if j != p],
                                "joint int, parent int")
    child = df.select(_c(sample).alias("s"), _c(joint).alias("joint"),
                      _c(pred[0]).alias("px"), _c(pred[1]).alias("py"),
                      _c(gt[0]).alias("gx"), _c(gt[1]).alias("gy"))
    inner = sorted({p for j, p in enumerate(parents) if j != p})
    parent = child.where(F.col("joint").isin(inner)).select("s", F.col("joint").alias("parent"), *[F.col(c).alias(f"p_{c}") for c in ("px", "py", "gx", "gy")])
    bones = child.join(F.broadcast(par), "joint").join(parent.hint("merge"), ["s", "parent"])
    lens = bones.select("joint",
                        _norm2(F.col("px") - F.col("p_px"), F.col("py") - F.col("p_py")).alias("lo"),
                        _norm2(F.col("gx") - F.col("p_gx"), F.col("gy") - F.col("p_gy")).alias("lt"))
    per_bone = lens.groupBy("joint").agg(F.abs(F.avg("lo") - F.avg("lt")).alias("bias"))
    return per_bone.agg(F.avg("bias").alias("bone_bias"))


def heatmap_row_errors(df: DataFrame, sample="sample_id", pred="pred", gt="gt", weight="weight",
                       alpha=2.1, omega=14.0, epsilon=1.0, theta=0.5) -> DataFrame:
    """J11 per (sample, joint) row: weighted MSE ``m`` and adaptive-wing
    ``aw`` of a heatmap pair (arrays of equal length)."""
    w = _c(weight)
    sq = F.zip_with(pred, gt, lambda p, g: (p * w - g * w) * (p * w - g * w))
    row_mse = F.aggregate(sq, F.lit(0.0), lambda a, v: a + v) / F.size(pred)

    def awing(p, g):
        d = F.abs(g - p)
        base = theta / epsilon
        a_ = (omega * (1 / (1 + F.pow(F.lit(base), alpha - g))) * (alpha - g)
              * F.pow(F.lit(base), alpha - g - 1) * (1 / epsilon))
        c_ = theta * a_ - omega * F.log(1 + F.pow(F.lit(base), alpha - g))
        return F.when(d < theta, omega * F.log(1 + F.pow(d / epsilon, alpha - g))).otherwise(a_ * d - c_)
    aw = F.aggregate(F.zip_with(pred, gt, awing), F.lit(0.0), lambda a, v: a + v) / F.size(pred)
    return df.select(_c(sample).alias("s"), row_mse.alias("m"), aw.alias("aw"))


def heatmap_mse(rows: DataFrame) -> DataFrame:
    """Mean over joints of per-joint MSE (equal map sizes -> pooled
    mean of the row MSEs) and mean adaptive-wing loss."""
    return rows.agg(F.avg("m").alias("mse"), F.avg("aw").alias("adaptive_wing"))


def hard_joint_topk(rows: DataFrame, topk: int = 8) -> DataFrame:
    """J11 OHKM: per sample the mean of its ``topk`` largest joint losses,
    then the mean over samples (rank window inside each sample's joints)."""
    from pyspark.sql import Window as W
    rk = F.row_number().over(W.partitionBy("s").orderBy(F.col("m").desc()))
    hard = (rows.withColumn("rk", rk).where(F.col("rk") <= topk)
            .groupBy("s").agg((F.sum("m") / topk).alias("h")))
    return hard.agg(F.avg("h").alias("ohkm"))


def tag_push_pull(tags: DataFrame, image="image_id", person="person", tag="tag",
                  visible="visible", kind: str = "exp") -> DataFrame:
    """Associative-embedding pull/push per image.

    pull = mean over persons of the within-person tag variance; push sums a
    kernel over ordered pairs of distinct persons' mean tags. Pairs come
    from a band join on tag buckets: exp(-d^2) is exactly 0.0 in double for
    |d| > 39 and max(0, 1-|d|) is 0 for |d| >= 1, so only nearby persons
    are paired — exact, without forming all pairs of an image."""
    vis = tags.where(_c(visible) > 0)
    per = vis.groupBy(image, person).agg(F.avg(tag).alias("m"), F.var_pop(tag).alias("var"))
    width = 39.0 if kind == "exp" else 1.0
    per = per.withColumn("b", F.floor(F.col("m") / width))
    a = per.select(image, F.col(person).alias("pa"), F.col("m").alias("ma"), "b")
    nb = per.select(image, F.col(person).alias("pb"), F.col("m").alias("mb"),
                    F.explode(F.array(F.col("b") - 1, F.col("b"), F.col("b") + 1)).alias("b"))
    pairs = a.join(nb, [image, "b"]).where(F.col("pa") != F.col("pb"))
    diff = F.col("ma") - F.col("mb")
    k = F.exp(-(diff * diff)) if kind == "exp" else F.greatest(F.lit(0.0), 1 - F.abs(diff))
    push_sum = pairs.groupBy(image).agg(F.sum(k).alias("push_sum"))
    stats = per.groupBy(image).agg(F.count(F.lit(1)).alias("n"), F.sum("var").alias("pull_sum"))
    n = F.col("n")
    return (stats.join(push_sum, image, "left")
            .select(image, n.alias("n_persons"),
                    F.when(n <= 1, F.lit(0.0)).otherwise(
                        F.coalesce(F.col("push_sum"), F.lit(0.0)) / ((n - 1) * n) * 0.5).alias("push"),
                    (F.col("pull_sum") / n).alias("pull")))


def bce(df: DataFrame, preds, gts, weights=None) -> DataFrame:
    """Binary cross-entropy, log clamped at -100, mean over all labels
    (weighted when weights are given)."""
    terms = []
    for i, (p, g) in enumerate(zip(preds, gts)):
        p, g = _c(p), _c(g)
        lp = F.greatest(F.log(p), F.lit(-100.0))
        l1p = F.greatest(F.log(1 - p), F.lit(-100.0))
        t = -(g * F.when(p > 0, lp).otherwise(F.lit(-100.0))
              + (1 - g) * F.when(p < 1, l1p).otherwise(F.lit(-100.0)))
        if weights is not None:
            t = t * _c(weights[i])
        terms.append(t)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return df.agg((F.sum(total) / (F.count(F.lit(1)) * len(terms))).alias("bce"))


def project_points(X, Y, Z, fx_, fy_, cx, cy, k=None, p=None) -> tuple[Column, Column]:
    """3-D point -> image through f, c and optional radial k1..k3 and
    tangential p1, p2; normalised coordinates clamped to [-1, 1]."""
    u = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _c(X) / _c(Z)))
    v = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), _c(Y) / _c(Z)))
    if k is not None and p is not None:
        r2 = u * u + v * v
        radial = 1 + _c(k[0]) * r2 + _c(k[1]) * r2 * r2 + _c(k[2]) * r2 * r2 * r2
        tan = _c(p[0]) * u + _c(p[1]) * v
        u, v = u * (radial + tan) + _c(p[0]) * r2, v * (radial + tan) + _c(p[1]) * r2
    return _c(fx_) * u + _c(cx), _c(fy_) * v + _c(cy)


def smooth_l1(diff: Column, beta: float = 1.0) -> Column:
    """Half the square up to ``beta``, the distance less half of it beyond."""
    a = F.abs(diff)
    return F.when(a < beta, a * a * (0.5 / beta)).otherwise(a - 0.5 * beta)


def root_aligned_smooth_l1(df: DataFrame, sample: str = "sample_id", joint: str = "joint", visible: str = "visible",
                           axes=("x", "y", "z"), root: tuple[int, int] = (2, 3)) -> DataFrame:
    """Smooth-L1 error of 3-D joints after both skeletons are moved to the
    midpoint of two root joints, averaged over all rows and axes; masked rows
    count as 0. Columns pred_<axis> and gt_<axis>. One row. The roots, a row a
    sample, meet the joints in a merge join, however small Spark thinks them."""
    mids = [F.avg(f"{s}_{a}").alias(f"_{s}_{a}") for s in ("pred", "gt") for a in axes]
    at = df.where(F.col(joint).isin(*root)).groupBy(sample).agg(*mids)
    errors = [smooth_l1((F.col(f"pred_{a}") - F.col(f"_pred_{a}")) - (F.col(f"gt_{a}") - F.col(f"_gt_{a}"))) for a in axes]
    total = sum(errors[1:], errors[0]) / len(axes)
    return df.join(at.hint("merge"), sample).agg(F.avg(F.when(F.col(visible), total).otherwise(F.lit(0.0))).alias("error"))
