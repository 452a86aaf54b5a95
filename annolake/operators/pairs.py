"""Pair joins of boxes and tracks: an equi-join on the keys, then box arithmetic on the pair's columns."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import boxes as bx
from . import masks
from .runs import by_batch


def iou_join(gt: DataFrame, dt: DataFrame, keys: list[str], min_iou: float | None = None, crowd: str | None = None, more: list[str] | None = None, every: float | None = None) -> DataFrame:
    """Pairs of `gt` (ann_id, x, y, w, h) and `dt` (det_id, ...) with equal keys, and their iou; `more` names further columns of gt to keep.

    `crowd` names a 0/1 column of gt: where it is 1 the denominator is the detection's area. Pairs of at most
    `min_iou` are dropped. The join is by the keys alone, so AQE can split a crowded key. With `every` pairs count from that iou on, and a
    detection without any stays, with nulls in place of the truth.
    """
    left = gt.select(*keys, *(more or []), "ann_id", *(F.col(c).alias(f"g_{c}") for c in "xywh"), *([F.col(crowd).alias("g_crowd")] if crowd else []))
    right = dt.select(*keys, "det_id", *(F.col(c).alias(f"d_{c}") for c in "xywh"), *(["score"] if "score" in dt.columns else []))
    a, b = bx.xywh("g_"), bx.xywh("d_")
    iou = bx.iou(a, b)
    if crowd:
        iou = F.when(F.col("g_crowd") == 1, bx.ioa(a, b)).otherwise(iou)
    if every is not None:
        left = left.withColumnsRenamed({k: f"__{k}" for k in keys})
        met = reduce(Column.__and__, (F.col(k) == F.col(f"__{k}") for k in keys)) & (iou > 0) & (iou >= every)
        return right.join(left, met, "left").withColumn("iou", F.when(F.col("ann_id").isNotNull(), iou)).drop(*(f"__{k}" for k in keys))
    out = left.join(right, keys).withColumn("iou", iou)
    return out if min_iou is None else out.where(F.col("iou") > min_iou)


def tracklet_iou(gt: DataFrame, dt: DataFrame, keys: list[str], frame: str = "frame_idx") -> DataFrame:
    """Summed intersection over summed union of every pair of tracks with equal keys that share a frame.

    Frames on one side only add their box to the union, so the union is the sum of both tracks' areas less the intersection.
    """
    whole = lambda df, ids, name: df.groupBy(*keys, ids).agg(F.sum(F.col("w") * F.col("h")).alias(name))
    left = gt.select(*keys, frame, F.col("track_id").alias("gt_id"), *(F.col(c).alias(f"g_{c}") for c in "xywh"))
    right = dt.select(*keys, frame, F.col("track_id").alias("dt_id"), *(F.col(c).alias(f"d_{c}") for c in "xywh"))
    inter = left.join(right, [*keys, frame]).groupBy(*keys, "gt_id", "dt_id").agg(F.sum(bx.intersection(bx.xywh("g_"), bx.xywh("d_"))).alias("inter"))
    sized = inter.join(whole(left.selectExpr(*keys, "gt_id", "g_w w", "g_h h"), "gt_id", "g_area"), [*keys, "gt_id"])
    sized = sized.join(whole(right.selectExpr(*keys, "dt_id", "d_w w", "d_h h"), "dt_id", "d_area"), [*keys, "dt_id"])
    union = F.col("g_area") + F.col("d_area") - F.col("inter")
    return sized.select(*keys, "gt_id", "dt_id", "inter", union.alias("union"), F.when(union > 0, F.col("inter") / union).otherwise(F.lit(0.0)).alias("iou"))


def tracklet_mask_iou(gt: DataFrame, dt: DataFrame, keys: list[str], frame: str = "frame_idx") -> DataFrame:
    """As tracklet_iou over masks (runs, height), for every pair of tracks that share a frame: two tracks empty in all frames count as
    one. Only masks whose boxes meet are compared; other pairs just have no intersection."""
    size = lambda df, ids, name: df.groupBy(*keys, F.col("track_id").alias(ids)).agg(F.sum(masks.area(F.col("runs"))).alias(name))
    ids = lambda df, name: df.select(*keys, frame, F.col("track_id").alias(name))
    met = ids(gt, "gt_id").join(ids(dt, "dt_id"), [*keys, frame]).select(*keys, "gt_id", "dt_id").distinct()
    found = masks.mask_pairs(gt.withColumnRenamed("track_id", "ann_id"), dt.withColumnRenamed("track_id", "det_id"), [*keys, frame])
    found = found.groupBy(*keys, F.col("ann_id").alias("gt_id"), F.col("det_id").alias("dt_id")).agg(F.sum("inter").alias("inter"))
    inter = met.join(found, [*keys, "gt_id", "dt_id"], "left").fillna(0, ["inter"])
    sized = inter.join(size(gt, "gt_id", "g_area"), [*keys, "gt_id"]).join(size(dt, "dt_id", "d_area"), [*keys, "dt_id"])
    union = F.col("g_area") + F.col("d_area") - F.col("inter")
    return sized.select(*keys, "gt_id", "dt_id", "inter", union.alias("union"), F.when(union > 0, F.col("inter") / union).otherwise(F.lit(1.0)).alias("iou"))


def corners(boxes: np.ndarray) -> np.ndarray:
    """(n, 4, 2) corners of rotated boxes (n, 5: xc, yc, w, h, angle in degrees), in the direction of positive area."""
    xc, yc, w, h, angle = boxes.T
    turn = np.radians(angle)
    c, s = np.cos(turn)[:, None], np.sin(turn)[:, None]
    dx, dy = np.abs(w)[:, None] * [[-0.5, 0.5, 0.5, -0.5]], np.abs(h)[:, None] * [[-0.5, -0.5, 0.5, 0.5]]
    return np.stack([xc[:, None] + c * dx + s * dy, yc[:, None] - s * dx + c * dy], axis=2)


def common_area(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Area of the part of each quadrilateral of a (n, 4, 2) within the one of b: a cut along the four lines of b, all pairs at once.

    Corners of the part so far stand left in rows of up to eight, `n` of them in each; a cut adds one at most.
    """
    points = np.zeros((len(a), 8, 2))
    points[:, :4] = a
    n = np.full(len(a), 4)
    place = np.arange(8)
    for k in range(4):
        p, q = b[:, k, None], b[:, (k + 1) % 4, None]
        side = (q[..., 0] - p[..., 0]) * (points[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (points[..., 0] - p[..., 0])
        before = np.where(place == 0, np.maximum(n - 1, 0)[:, None], place - 1)
        last, from_ = np.take_along_axis(side, before, axis=1), np.take_along_axis(points, before[..., None], axis=1)
        there = place < n[:, None]
        crosses = there & ((side >= 0) != (last >= 0))
        share = np.divide(last, last - side, out=np.zeros_like(side), where=crosses)[..., None]
        made = np.empty((len(a), 16, 2))
        made[:, 0::2], made[:, 1::2] = from_ + share * (points - from_), points
        keep = np.empty((len(a), 16), bool)
        keep[:, 0::2], keep[:, 1::2] = crosses, there & (side >= 0)
        order = np.argsort(~keep, axis=1, kind="stable")[:, :8]
        points, n = np.take_along_axis(made, order[..., None], axis=1), keep.sum(axis=1)
    after = np.where(place == n[:, None] - 1, 0, np.minimum(place + 1, 7))
    to = np.take_along_axis(points, after[..., None], axis=1)
    cross = points[..., 0] * to[..., 1] - points[..., 1] * to[..., 0]
    return np.maximum(np.where((place < n[:, None]) & (n[:, None] > 2), cross, 0.0).sum(axis=1) / 2, 0.0)


def rotated_iou(pairs: DataFrame) -> DataFrame:
    """pairs with `iou` of two rotated boxes (a_ and b_ columns xc, yc, w, h, angle in degrees); 0 if both are empty.

    Filter the pairs by their upright bounds first: only what is left needs polygon clipping.
    """

    def fn(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        a, b = (np.column_stack([np.asarray(batch.column(f"{p}_{c}")).astype(float) for c in ("xc", "yc", "w", "h", "angle")]) for p in "ab")
        middle = (a[:, :2] + b[:, :2]) / 2  # clipped near the origin
        near = lambda x: corners(np.column_stack([x[:, :2] - middle, x[:, 2:]]))
        inter = common_area(near(a), near(b))
        whole = np.abs(a[:, 2] * a[:, 3]) + np.abs(b[:, 2] * b[:, 3]) - inter
        return {"iou": np.divide(inter, whole, out=np.zeros(len(whole)), where=whole > 0)}

    return by_batch(pairs, fn, [], "iou double")
