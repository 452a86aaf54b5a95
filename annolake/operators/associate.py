"""Association of a frame's detections with existing tracks, by aggregates over the pair join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as bx
from .matching import assigned
from .pairs import iou_join
from .prep import top_k


def associate(dets: DataFrame, tracks: DataFrame, keys: list[str], iou_thr: float = 0.1, track_thr: float = 0.5, new_thr: float = 0.7, sure: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(detections, tracks) with what becomes of them.

    dets: keys, det_id, x, y, w, h, score. tracks: keys, track_id, x, y, w, h. A detection is new from a score of `new_thr` if no track
    reaches `iou_thr`; `matched` lists its tracks; `anchor` is the best track of a sure detection with a sure overlap.
    A track is matched if a detection reaches `track_thr`, empty if its box is, else unmatched.
    """
    d = dets.select(*keys, "det_id", "score", *(F.col(c).alias(f"d_{c}") for c in "xywh"))
    t = tracks.select(*keys, "track_id", *(F.col(c).alias(f"t_{c}") for c in "xywh"))
    pairs = d.join(t, keys).withColumn("iou", bx.iou(bx.xywh("d_"), bx.xywh("t_"))).where("iou > 0")
    by_det = pairs.groupBy(*keys, "det_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("iou") >= iou_thr, F.col("track_id")))).alias("matched"), F.max_by("track_id", F.struct("iou", -F.col("track_id"))).alias("best"), F.max("iou").alias("iou")
    )
    out = d.select(*keys, "det_id", "score").join(by_det, [*keys, "det_id"], "left").withColumn("matched", F.coalesce("matched", F.array().cast("array<bigint>")))
    is_new = (F.size("matched") == 0) & (F.col("score") >= new_thr)
    anchor = F.when((F.col("score") >= sure) & ~is_new & (F.col("iou") >= sure), F.col("best"))
    found = out.select(*keys, "det_id", "score", is_new.alias("is_new"), "matched", anchor.alias("anchor"))
    by_track = pairs.groupBy(*keys, "track_id").agg(F.max("iou").alias("iou"))
    state = F.when((F.col("t_w") <= 0) | (F.col("t_h") <= 0), "empty").when(F.col("iou") >= track_thr, "matched").otherwise("unmatched")
    return found, t.join(by_track, [*keys, "track_id"], "left").select(*keys, "track_id", state.alias("state"))


def associate_one_to_one(dets: DataFrame, tracks: DataFrame, keys: list[str], iou_thr: float = 0.5, new_thr: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """As associate, but a detection and a track belong to each other: the assignment of greatest summed iou, from `iou_thr` on."""
    left = tracks.select(*keys, F.col("track_id").alias("ann_id"), *"xywh")
    pairs = iou_join(left, dets, keys).where(F.col("iou") >= iou_thr)
    taken = assigned(pairs.select(*keys, "ann_id", "det_id", "iou"), keys).select(*keys, "det_id", F.col("ann_id").alias("track_id"), "iou")
    found = dets.select(*keys, "det_id", "score").join(taken, [*keys, "det_id"], "left")
    found = found.withColumn("is_new", F.col("track_id").isNull() & (F.col("score") >= new_thr))
    empty = (F.col("w") <= 0) | (F.col("h") <= 0)
    hit = taken.select(*keys, "track_id", F.lit(True).alias("__hit"))
    state = F.when(empty, "empty").when(F.col("__hit"), "matched").otherwise("unmatched")
    return found, tracks.join(hit, [*keys, "track_id"], "left").select(*keys, "track_id", state.alias("state"))


def cap_new(dets: DataFrame, keys: list[str], room: int) -> DataFrame:
    """At most `room` new detections of each key, by score."""
    return top_k(dets.where("is_new"), keys, room, "det_id")
