"""Suppression of overlapping boxes, masks' boxes and tracks; equal scores are ordered by id."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as bx
from . import masks
from .groups import group_of, map_groups


def _greedy(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, det_id of what is suppressed. pairs: keys, hi, lo: lo overlaps hi too much, and hi comes first (by `rank`)."""
    fields = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def sweep(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        hi, lo, group = rows["hi"].to_numpy(), rows["lo"].to_numpy(), group_of(starts)
        # where none that suppresses is suppressed itself, every `lo` goes, at its first row
        ids, code = np.unique(np.concatenate([hi, lo]), return_inverse=True)
        above, below = group * len(ids) + code[: len(hi)], group * len(ids) + code[len(hi) :]
        hard = np.unique(group[np.isin(above, below)])
        easy = np.unique(np.where(np.isin(group, hard), -1, below), return_index=True)
        keep = easy[1][easy[0] >= 0].tolist()
        for g in hard.tolist():
            a, b = int(starts[g]), int(starts[g + 1])
            gone: set = set()
            for k in range(a, b):  # a kept box suppresses all below it; a suppressed one nothing
                if hi[k] not in gone and lo[k] not in gone:
                    gone.add(lo[k])
                    keep.append(k)
        return rows.iloc[keep][[*keys, "lo"]].rename(columns={"lo": "det_id"})

    schema = ", ".join(f"{k} {fields[k]}" for k in keys) + f", det_id {fields['hi']}"
    return map_groups(pairs.withColumn("__first", -F.col("hi_score")), keys, sweep, schema, ["__first", "hi"])


def _overlaps(dets: DataFrame, keys: list[str], measure, too_much) -> DataFrame:
    """Ordered pairs whose overlap is too much: only these reach Python."""
    left = dets.select(*keys, F.col("det_id").alias("hi"), F.col("score").alias("hi_score"), *(F.col(c).alias(f"a_{c}") for c in "xywh"))
    right = dets.select(*keys, F.col("det_id").alias("lo"), F.col("score").alias("lo_score"), *(F.col(c).alias(f"b_{c}") for c in "xywh"))
    first = (F.col("hi_score") > F.col("lo_score")) | ((F.col("hi_score") == F.col("lo_score")) & (F.col("hi") < F.col("lo")))
    return left.join(right, keys).where(first & too_much(measure(bx.xywh("a_"), bx.xywh("b_")))).select(*keys, "hi", "hi_score", "lo")


def mask_overlaps(dets: DataFrame, keys: list[str], measure: str, thr: float, inclusive: bool = False) -> DataFrame:
    """Ordered pairs (keys, hi, hi_score, lo) of masks whose `measure` (iou or iom) is above `thr`, or at it too. dets: keys, det_id, score,
    runs, and boxes x, y, w, h of the masks: only masks whose boxes meet are compared."""
    left = dets.select(*keys, F.col("det_id").alias("hi"), F.col("score").alias("hi_score"), F.col("runs").alias("runs_a"), F.lit(0).alias("crowd"), *(F.col(c).alias(f"a_{c}") for c in "xywh"))
    right = dets.select(*keys, F.col("det_id").alias("lo"), F.col("score").alias("lo_score"), F.col("runs").alias("runs_b"), *(F.col(c).alias(f"b_{c}") for c in "xywh"))
    first = (F.col("hi_score") > F.col("lo_score")) | ((F.col("hi_score") == F.col("lo_score")) & (F.col("hi") < F.col("lo")))
    near = left.join(right, keys).where(first & (bx.intersection(bx.xywh("a_"), bx.xywh("b_")) > 0)).select(*keys, "hi", "hi_score", "lo", "crowd", "runs_a", "runs_b")
    v = F.col(measure)
    return masks.similarity(near).where(v >= thr if inclusive else v > thr).select(*keys, "hi", "hi_score", "lo")


def mask_nms(dets: DataFrame, keys: list[str], prob: float, thr: float) -> DataFrame:
    """generic_nms by mask overlap."""
    dets = dets.where(F.col("score") > prob)
    return dets.join(_greedy(mask_overlaps(dets, keys, "iou", thr), keys), [*keys, "det_id"], "left_anti")


def mask_iom_filter(dets: DataFrame, keys: list[str], thr: float = 0.3) -> DataFrame:
    """iom_filter by mask overlap."""
    gone = _greedy(mask_overlaps(dets, keys, "iom", thr), keys).withColumn("__gone", F.lit(True))
    return dets.join(gone, [*keys, "det_id"], "left").withColumn("kept", F.col("__gone").isNull()).drop("__gone")


def frame_nms(dets: DataFrame, keys: list[str], thr: float) -> DataFrame:
    """The detections that no higher-scored kept one overlaps with an iou of `thr` or more."""
    gone = _greedy(_overlaps(dets, keys, bx.iou, lambda v: v >= thr), keys)
    return dets.join(gone, [*keys, "det_id"], "left_anti")


def generic_nms(dets: DataFrame, keys: list[str], prob: float, thr: float) -> DataFrame:
    """As frame_nms, after a cut of scores above `prob`; an iou of exactly `thr` is kept."""
    dets = dets.where(F.col("score") > prob)
    gone = _greedy(_overlaps(dets, keys, bx.iou, lambda v: v > thr), keys)
    return dets.join(gone, [*keys, "det_id"], "left_anti")


def iom_filter(dets: DataFrame, keys: list[str], thr: float = 0.3) -> DataFrame:
    """All detections with `kept`: false where the share of the smaller box under a kept one is above `thr`."""
    gone = _greedy(_overlaps(dets, keys, bx.iom, lambda v: v > thr), keys).withColumn("__gone", F.lit(True))
    return dets.join(gone, [*keys, "det_id"], "left").withColumn("kept", F.col("__gone").isNull()).drop("__gone")


def track_nms(tracks: DataFrame, keys: list[str], thr: float) -> DataFrame:
    """The frame rows of tracks that no higher-scored kept track overlaps with `thr` or more.

    Overlap of two tracks: intersections over unions, summed over the frames that hold both. tracks: keys,
    track_id, frame_idx, x, y, w, h, score; a track's score is its mean, to twelve decimals: equal means stay equal in whatever order they are summed.
    """
    scores = tracks.groupBy(*keys, "track_id").agg(F.round(F.avg("score"), 12).alias("s"))
    side = lambda p: tracks.select(*keys, "frame_idx", F.col("track_id").alias(f"{p}t"), *(F.col(c).alias(f"{p}_{c}") for c in "xywh"))
    a, b = bx.xywh("a_"), bx.xywh("b_")
    both = side("a").join(side("b"), [*keys, "frame_idx"]).where("at <> bt")
    iou = both.groupBy(*keys, "at", "bt").agg(F.sum(bx.intersection(a, b)).alias("i"), F.sum(bx.union_area(a, b)).alias("u")).where(F.col("i") >= thr * F.col("u"))
    named = lambda p, s: scores.select(*keys, F.col("track_id").alias(p), F.col("s").alias(s))
    ranked = iou.join(named("at", "hi_score"), [*keys, "at"]).join(named("bt", "lo_score"), [*keys, "bt"])
    ranked = ranked.where("hi_score > lo_score or (hi_score = lo_score and at < bt)").select(*keys, F.col("at").alias("hi"), "hi_score", F.col("bt").alias("lo"))
    return tracks.join(_greedy(ranked, keys).withColumnRenamed("det_id", "track_id"), [*keys, "track_id"], "left_anti")
