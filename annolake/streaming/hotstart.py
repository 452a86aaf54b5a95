"""Pruning of young tracks, in batch: running counts by window, keep-alive by an ordered fold per track."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.groups import map_groups


def keep_alive(events: DataFrame, start: int = 30, least: int = -1, most: int = 30) -> DataFrame:
    """events with `alive`: +1 on a matched frame, -1 on an unmatched one, within [least, most], from `start`."""

    def fold(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        step = rows["kind"].map({"matched": 1, "unmatched": -1}).fillna(0).to_numpy(dtype=np.int64)
        alive = np.empty(len(rows), np.int64)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            v = start
            for k in range(a, b):
                v = min(most, max(least, v + step[k]))
                alive[k] = v
        return rows.assign(alive=alive)

    cols = ["video_id", "track_id", "frame_idx", "kind"]
    fields = {f.name: f.dataType.simpleString() for f in events.schema}
    return map_groups(events.select(*cols), ["video_id", "track_id"], fold, ", ".join(f"{c} {fields[c]}" for c in cols) + ", alive long", ["frame_idx"])


def prune_tracks(events: DataFrame, delay: int = 15, unmatch: int = 8, dup: int = 8, start: int = 30, least: int = -1, most: int = 30) -> tuple[DataFrame, DataFrame]:
    """(removed: video_id, track_id, frame_idx, reason; suppressed: video_id, track_id, frame_idx).

    events: video_id, frame_idx, track_id, det_id, kind (new, matched, unmatched, empty), a row per track and frame. A track is
    removed at its `unmatch`-th unmatched frame, or at the `dup`-th frame in which it shares a detection with the
    same earlier track, if it first appeared less than `delay` frames before. It is suppressed in frames where it has
    been unmatched, its keep-alive is 0 or less, and it is not removed. Empty frames do not count as unmatched.
    """
    first = events.groupBy("video_id", "track_id").agg(F.min("frame_idx").alias("first_frame"))
    rows = events.join(first, ["video_id", "track_id"])
    young = F.col("first_frame") > F.col("frame_idx") - delay
    by_track = Window.partitionBy("video_id", "track_id").orderBy("frame_idx")
    lost = rows.where("kind = 'unmatched'").withColumn("c", F.row_number().over(by_track)).where((F.col("c") == unmatch) & young)
    shared = rows.where("kind in ('matched', 'new') and det_id is not null")
    same_det = Window.partitionBy("video_id", "frame_idx", "det_id")
    shared = shared.withColumn("earlier", F.min(F.struct("first_frame", "track_id")).over(same_det)["track_id"]).where("earlier <> track_id")
    pair = Window.partitionBy("video_id", "earlier", "track_id").orderBy("frame_idx")
    double = shared.withColumn("c", F.row_number().over(pair)).where((F.col("c") == dup) & young)
    found = lost.select("video_id", "track_id", "frame_idx", F.lit("unmatched").alias("reason")).unionByName(double.select("video_id", "track_id", "frame_idx", F.lit("duplicate").alias("reason")))
    removed = found.groupBy("video_id", "track_id").agg(F.min(F.struct("frame_idx", "reason")).alias("r"))
    removed = removed.select("video_id", "track_id", "r.frame_idx", F.when(F.col("r.reason") == "duplicate", "duplicate").otherwise("unmatched").alias("reason"))
    alive = keep_alive(events, start, least, most).withColumn("misses", F.sum((F.col("kind") == "unmatched").cast("int")).over(by_track))
    gone = removed.select("video_id", "track_id", F.col("frame_idx").alias("gone"))
    low = alive.where("misses > 0 and alive <= 0").join(gone, ["video_id", "track_id"], "left").where("gone is null or frame_idx < gone")
    return removed, low.select("video_id", "track_id", "frame_idx")
