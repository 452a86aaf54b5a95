"""Tracking scores that take localisation, association and classification apart, per class and overlap threshold.

A class is judged on the predictions, of any class, that lie on its truths: ids that overlap one of them by `NEAR` in some frame, less,
frame by frame, ids that the assignment over all classes gives to a truth of another class. Predictions of the class that
lie on nothing are its classification errors if truths are exhaustive, and so is each match of another class for that class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cut import settled
from .tracks import EPS, alignment, by_threshold, frame_matches, similarity

ALPHAS = list(range(0, 100, 5))
NEAR = 0.5


def preprocessed(gt: DataFrame, dt: DataFrame, video: str = "video_id", measure: Callable[..., DataFrame] = similarity) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(overlapping: video, cls, frame_idx, track_id; kept: dt's rows as video, cls, frame_idx, track_id, own_class; sim: video, cls, frame_idx, gt_id, dt_id, sim).

    `overlapping` holds, per class and frame, the ids on one of its truths that belong to no other class's truth there; `kept` all
    rows of ids that overlap so in any frame; `sim` the overlaps of a class's truths with them. gt, dt: video, frame_idx, track_id (once in a frame),
    category_id, and what `measure` needs. It is called once: classes are told by ids.
    """
    all_ = settled(measure(gt, dt, [video]))
    ids = all_.where(F.col("sim") >= NEAR).select(video, "dt_id").distinct()
    on = all_.join(ids, [video, "dt_id"], "left_semi")
    assigned = frame_matches(on, alignment(on, gt, dt, [video]), [video]).where(F.col("sim") >= NEAR - EPS)
    label = gt.select(video, "frame_idx", F.col("track_id").alias("gt_id"), F.col("category_id").alias("cls")).distinct()
    # only ids that overlap a truth somewhere can be kept
    labelled = settled(on.join(label, [video, "frame_idx", "gt_id"]))
    by_class = labelled.where(F.col("sim") >= NEAR).select(video, "cls", "frame_idx", F.col("dt_id").alias("track_id")).distinct()
    taken = assigned.join(label, [video, "frame_idx", "gt_id"]).select(video, "frame_idx", F.col("dt_id").alias("track_id"), F.col("cls").alias("of"))
    others = by_class.join(taken, [video, "frame_idx", "track_id"]).where("of <> cls").select(video, "cls", "frame_idx", "track_id")
    overlapping = settled(by_class.join(others, [video, "cls", "frame_idx", "track_id"], "left_anti"))
    stay = overlapping.select(video, "cls", "track_id").distinct()
    kept = dt.join(stay, [video, "track_id"]).select(video, "cls", "frame_idx", "track_id", F.col("category_id").alias("own_class"))
    sim = labelled.join(stay.withColumnRenamed("track_id", "dt_id"), [video, "cls", "dt_id"], "left_semi")
    return overlapping, kept, sim.select(video, "cls", "frame_idx", "gt_id", "dt_id", "sim")


def teta_parts(gt: DataFrame, dt: DataFrame, video: str = "video_id", measure: Callable[..., DataFrame] = similarity, exhaustive: bool = True) -> DataFrame:
    """Rows of video, cls, alpha (percent) and what adds up over rows and videos, null where a row does not tell: n_gt, c (matches), same (of the right class), a, re,
    pr (association, by match), near, used, wrong and stray. At alpha 0 any overlap counts. `measure`: similarity of boxes, or tracks.mask_similarity. Unless truths
    are `exhaustive`, predictions that lie on no truth are no classification errors."""
    overlapping, kept, found = preprocessed(gt, dt, video, measure)
    keys = [video, "cls"]
    own = gt.select(video, F.col("category_id").alias("cls"), "frame_idx", "track_id")
    sim = settled(found)
    matched = settled(
        frame_matches(sim, alignment(sim, own, kept, keys), keys).join(kept.select(*keys, "frame_idx", F.col("track_id").alias("dt_id"), "own_class"), [*keys, "frame_idx", "dt_id"])
    )
    grid = F.explode(F.array(*(F.lit(a) for a in ALPHAS)))
    at = lambda df, pair, **sums: by_threshold(df, pair, ALPHAS, EPS, F.col("sim") > 0, **sums)
    pairs = at(matched, [*keys, "gt_id", "dt_id", "g", "d"], same=(F.col("own_class") == F.col("cls")).cast("long"))
    c, g, d = F.col("c"), F.col("g"), F.col("d")
    by = pairs.groupBy(*keys, "alpha").agg(F.sum("c").alias("c"), F.sum("same").alias("same"), F.sum(c * c / F.greatest(F.lit(1), g + d - c)).alias("a"), F.sum(c * c / g).alias("re"), F.sum(c * c / d).alias("pr"))
    # of the ids on truths in a frame that has any, those that are not matched there
    used = at(matched.join(overlapping.withColumnRenamed("track_id", "dt_id"), [*keys, "frame_idx", "dt_id"], "left_semi"), keys).withColumnRenamed("c", "used")
    wrong = at(matched.where("own_class <> cls").select(video, F.col("own_class").alias("cls"), "sim"), keys).withColumnRenamed("c", "wrong")
    stray = dt.where(F.lit(exhaustive)).select(video, F.col("category_id").alias("cls"), "frame_idx", "track_id").distinct().join(overlapping, [*keys, "frame_idx", "track_id"], "left_anti")
    count = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).withColumn("alpha", grid)
    parts = [count(own, "n_gt"), by, count(overlapping, "near"), used, wrong, count(stray, "stray")]
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p, allowMissingColumns=True)
    return all_


NAMES = ["n_gt", "c", "same", "a", "re", "pr", "near", "used", "wrong", "stray"]


def teta_sums(gt: DataFrame, dt: DataFrame, video: str = "video_id", measure: Callable[..., DataFrame] = similarity, exhaustive: bool = True) -> DataFrame:
    """teta_parts added up, a row for each video, cls and alpha."""
    return teta_parts(gt, dt, video, measure, exhaustive).groupBy(video, "cls", "alpha").agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in NAMES))


def combine_teta(sums: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, alpha (percent), loc_tp, loc_fn, loc_fp, loc_a, assoc_a, assoc_re, assoc_pr, cls_a (over the thresholds from 50 on) and teta from sums of
    videos or classes, for keys that have truths. Without `keys` everything is one."""
    keys = ["cls"] if keys is None else keys
    out = sums.groupBy(*keys, "alpha").agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in NAMES)).where("n_gt > 0")
    tp, fp, ctp = F.col("c"), F.col("near") - F.col("used"), F.col("same")
    one = lambda x: F.greatest(F.lit(1), x)
    out = out.withColumns({"loc_fn": F.col("n_gt") - tp, "loc_fp": fp, "loc_a": tp / one(F.col("n_gt") + fp)})
    out = out.withColumns({f"assoc_{k}": F.col(k) / one(tp) for k in ("a", "re", "pr")})
    # classes missed are c - same, and those claimed wrongly the stray and the wrong ones
    out = out.withColumn("__c", ctp / one(tp + F.col("stray") + F.col("wrong")))
    mean = out.where("alpha >= 50").groupBy(*keys).agg(F.avg("__c").alias("cls_a"))
    out = (out.join(mean, keys) if keys else out.crossJoin(F.broadcast(mean))).withColumn("teta", (F.col("loc_a") + F.col("assoc_a") + F.col("cls_a")) / 3)
    return out.select(*keys, "alpha", F.col("c").alias("loc_tp"), "loc_fn", "loc_fp", "loc_a", "assoc_a", "assoc_re", "assoc_pr", "cls_a", "teta")


def teta(gt: DataFrame, dt: DataFrame, video: str = "video_id", measure: Callable[..., DataFrame] = similarity, exhaustive: bool = True) -> DataFrame:
    """combine_teta of teta_parts: the scores of every class of truths over all videos. Sums of each video are not made on the way."""
    return combine_teta(teta_parts(gt, dt, video, measure, exhaustive))


def class_average(per_class: DataFrame) -> DataFrame:
    """alpha and the mean of every score over the classes; counts add up."""
    sums, means = ["loc_tp", "loc_fn", "loc_fp"], ["loc_a", "assoc_a", "assoc_re", "assoc_pr", "cls_a", "teta"]
    return per_class.groupBy("alpha").agg(*(F.sum(c).alias(c) for c in sums), *(F.avg(c).alias(c) for c in means))
