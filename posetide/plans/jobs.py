"""End-to-end jobs: person flags (P5), body-part cut-outs (P6) and video
poses (L3). One lazy plan each; only Arrow batches cross to Python, and
only for fetching, pixels and model calls. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posetide.functions import boxes as C
from posetide.functions.flags import (face_visible, first_image_url, flag_from_count, nonempty,
                                      person_filter, size_variant_url, small_image)
from posetide.operators import score as P
from posetide.operators import track as T
from posetide.schema import CATEGORY_PARTS, category_part_dim, part_spec_dim
from posetide.session import cut_lineage
from posetide.sources.images import local_then_http


def person_flags(wide: DataFrame, host: str, fetcher=local_then_http, detector=None,
                 image_cols=("image_1", "image_2", "image_3", "image_4")) -> DataFrame:
    """P5: product_id + model_flag1..N in {true, false, NA}.

    unpivot the image columns -> 512 variant URL (B2) -> distinct URLs ->
    one Arrow pass per URL: fetch + decode + detect + person gate (A3, P1,
    B7) -> flag (B12) -> join back -> pivot with the fixed slot list."""
    slots = [f"img{i + 1}" for i in range(len(image_cols))]
    urls = wide.select("product_id", *[size_variant_url(c, host).alias(s) for c, s in zip(image_cols, slots)])
    long = urls.unpivot("product_id", slots, "slot", "url")
    uniq = long.select("url").where(F.col("url").isNotNull()).dropDuplicates()
    scored = P.score_images(uniq, "url", ["url"], fetcher, detector=detector)
    per_url = scored.select("url", flag_from_count("error", "n_persons").alias("flag"))
    flagged = long.join(per_url, "url", "left").withColumn("flag", F.coalesce("flag", F.lit("NA")))
    wide_flags = flagged.groupBy("product_id").pivot("slot", slots).agg(F.first("flag"))
    return wide_flags.select("product_id", *[F.col(s).alias(f"model_flag{i + 1}") for i, s in enumerate(slots)])


def cutouts(products: DataFrame, host: str, fetcher=local_then_http, segmenter=None, detector=None,
            pose_model=None) -> tuple[DataFrame, DataFrame]:
    """Body-part cut-outs. Returns (summary, crops):

    summary: product_id, is_model_or_not (true/false/NA), cropped_paths (CSV,
      '' when none), img_w, img_h, error
    crops:   product_id, img, part, path, x1, y1, x2, y2 (pixels are cut by
      ``cut_crops``, a second Arrow stage over the crops only)

    Steps: A1/B1/B3 scan -> one Arrow pass per image (A3, P3+D6, P1, B7, C3,
    P2+F9+C5) -> native: B9 small-image gate, B10 face gate, B16 category
    parts (broadcast, 16 rows), C8 crop boxes, A13 names, B6 manifest."""
    spark = products.sparkSession
    src = products.where(nonempty("image_512")).select(
        "product_id", "category_id", first_image_url("images", host).alias("img"))
    scored = P.score_images(src, "img", ["product_id", "category_id", "img"], fetcher, detector=detector,
                            pose_model=pose_model or P.GridPoseModel(), segmenter=segmenter or P.DarkMaskSegmenter())
    scored = cut_lineage(scored)  # model output is reused by several branches
    s = (scored.withColumn("person", F.coalesce(F.col("n_persons") > 0, F.lit(False)))
               .withColumn("small", small_image("img_w", "img_h"))
               .withColumn("face", F.coalesce(face_visible("js"), F.lit(False))))
    parts = category_part_dim(spark).join(F.broadcast(part_spec_dim(spark)), "part")
    wanted = (s.where(F.col("person") & ~F.col("small") & F.col("face"))
              .join(F.broadcast(parts), "category_id"))
    # joint extents per part: explode the part's joint range from the arrays
    # Parts of a category in the order of the configuration
    order = F.array(*[F.lit(f"{c}|{p}") for c, ps in CATEGORY_PARTS for p in ([ps] if isinstance(ps, str) else ps)])
    place = F.array_position(order, F.concat(F.col("category_id").cast("string"), F.lit("|"), "part"))
    pj = wanted.select("product_id", "img", "img_w", "img_h", "part", place.alias("place"), "bl", "bt", "br", "bb",
                       F.slice("jx", F.col("kp_from") + 1, F.col("kp_to") - F.col("kp_from")).alias("px"),
                       F.slice("jy", F.col("kp_from") + 1, F.col("kp_to") - F.col("kp_from")).alias("py"))
    box = C.part_crop_box(F.array_min("px"), F.array_min("py"), F.array_max("px"), F.array_max("py"),
                          "img_w", "img_h", "bl", "bt", "br", "bb")
    crops = pj.select("product_id", "img", "part", "place",
                      F.concat(F.col("product_id").cast("string"), F.lit("_"),
                               F.regexp_replace("part", " ", "_"), F.lit(".jpg")).alias("path"),
                      *[v.alias(k.replace("crop_", "")) for k, v in box.items()])
    manifest = crops.groupBy("product_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "path"))).alias("_paths")).select(
        "product_id", F.concat_ws(",", F.col("_paths.path")).alias("cropped_paths"))
    crops = crops.drop("place")
    known = sorted({c for c, _ in CATEGORY_PARTS})
    flag = (F.when(F.col("error").isNotNull(), F.lit("NA"))
            .when(F.col("category_id").isin(*known),
                  F.when(F.col("person"), F.lit("true")).otherwise(F.lit("false")))
            .otherwise(F.lit("NA")))  # Q2: an unknown category fails like a fetch error
    summary = (s.join(manifest, "product_id", "left")
               .select("product_id", flag.alias("is_model_or_not"),
                       F.coalesce("cropped_paths", F.lit("")).alias("cropped_paths"), "img_w", "img_h", "error"))
    return summary, crops


def cut_crops(crops: DataFrame, fetcher=local_then_http, segmenter=None) -> DataFrame:
    """A13 + D4 + D6: crop pixels as PNG rows keyed by their manifest name
    (re-reads only the pictures that are actually cut)."""
    import pandas as pd
    from posetide.operators.images import composite_on_white
    from posetide.sources.images import decode_any, encode_png
    seg = segmenter or P.DarkMaskSegmenter()

    def run(it):
        model = P.cached(seg)
        for pdf in it:
            data = []
            for _, r in pdf.iterrows():
                img = decode_any(fetcher(r["img"]))
                img = composite_on_white(img, model.predict([img])[0])
                c = img[int(r["y1"]):int(r["y2"]), int(r["x1"]):int(r["x2"])]
                data.append(encode_png(c) if c.size else None)
            yield pd.DataFrame({"product_id": pdf["product_id"], "part": pdf["part"], "path": pdf["path"], "png": data})
    return crops.select("product_id", "img", "part", "path", "x1", "y1", "x2", "y2").mapInPandas(
        run, "product_id long, part string, path string, png binary")


def video_poses(frames: DataFrame, url_col: str, fetcher=local_then_http, detector=None, pose_model=None,
                step: int = 1, smooth: bool = True) -> DataFrame:
    """L3: frames (video_id, frame_idx, url) -> P1 on cadence frames (H1,
    Arrow stage 1) -> B7 -> H2 tracking per video -> C3 boxes -> P2 + F9 +
    C5 joints (Arrow stage 2) -> H6 One-Euro per (video, track, joint).
    Output: video_id, frame_idx, track_id, joint, x, y, score, x_smooth,
    y_smooth."""
    fr = T.detect_cadence(frames.select("video_id", "frame_idx", url_col), step, tracking=True)
    dets = cut_lineage(person_filter(P.detect_urls(fr.where("run_detector"), url_col, ["video_id", "frame_idx"],
                                                   fetcher, detector)))  # scored once, used twice
    sizes = dets.groupBy("video_id").agg(F.max("img_w").alias("img_w"), F.max("img_h").alias("img_h"))
    tracks = T.track_boxes(dets, frames.select("video_id", "frame_idx"), max_age=step,
                           min_hits=3 if step == 1 else 1, order_by=["det_idx"])
    sized = (tracks.join(sizes, "video_id")
             .join(frames.select("video_id", "frame_idx", url_col), ["video_id", "frame_idx"]))
    rp = C.round_pad_clip("x1", "y1", "x2", "y2", "img_w", "img_h")
    boxes = sized.select("video_id", "frame_idx", "track_id", url_col, *[v.alias(k) for k, v in rp.items()])
    boxes = cut_lineage(boxes)  # tracked once, used twice
    joints = P.pose_urls(boxes, url_col, ["video_id", "frame_idx", "track_id"], fetcher, pose_model)
    if not smooth:
        return joints
    # a box gives one sample a joint at most: series are counted in the boxes, not in
    # the joints, whose pictures would be fetched and posed for it once more
    longest = boxes.groupBy("video_id", "track_id").count().agg(F.max("count")).first()[0] or 0
    if longest > T.LONG_SERIES:
        joints = cut_lineage(joints)  # cut into segments in several passes
    # x and y smoothed in one sorted pass per (video, track, joint)
    return T.one_euro(joints, ["video_id", "track_id", "joint"], "frame_idx", ["x", "y"], long_series=T.LONG_SERIES, longest=longest)
