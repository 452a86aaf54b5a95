"""Ids and shapes: re-indexing, unique pairs and tracks, frame rows to nested tracks and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cut import settled


def numbered(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Global numbers in `order` without one task for all rows: range partitions, counts per partition, offsets.

    The cut into partitions is written once (a checkpoint), as both the counts and the rows are read from it.
    """
    cut = settled(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()))
    sizes = cut.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    local = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return cut.withColumn("__local", local).join(before, "__p").withColumn(name, F.col("__before") + F.col("__local") - 1 + start).drop("__p", "__local", "__before")


def reindexed(df: DataFrame, key: str, refs: list[tuple[DataFrame, str]] | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The table with its ids moved from 0-based to 1-based if it holds id 0, and the referring tables likewise."""
    shift = F.broadcast(df.agg(F.coalesce(F.max((F.col(key) == 0).cast("int")), F.lit(0)).alias("__s")))
    move = lambda t, c: t.crossJoin(shift).withColumn(c, F.col(c) + F.col("__s")).drop("__s")
    return move(df, key), [move(t, c) for t, c in refs or []]


def pair_ids(gt: DataFrame, dt: DataFrame, a: str = "video_id", b: str = "category_id") -> DataFrame:
    """A number from 1 for each pair of truth or prediction, in the order of the pairs."""
    pairs = gt.select(a, b).unionByName(dt.select(a, b)).distinct()
    # a window per first key, then offsets of a table with one row per first key
    w = Window.partitionBy(a).orderBy(b)
    sizes = pairs.groupBy(a).agg(F.count(F.lit(1)).alias("__n"))
    before = numbered_offsets(sizes, a)
    return pairs.withColumn("__r", F.row_number().over(w)).join(before, a).withColumn("new_id", F.col("__before") + F.col("__r")).drop("__r", "__before")


def numbered_offsets(sizes: DataFrame, key: str) -> DataFrame:
    """key, __before: running sum of __n over smaller keys, by blocks of keys."""
    block = F.floor(F.col(key) / 4096)
    blocks = sizes.groupBy(block.alias("__b")).agg(F.sum("__n").alias("__bn"))
    start = blocks.select("__b", (F.sum("__bn").over(Window.orderBy("__b")) - F.col("__bn")).alias("__start"))
    within = F.sum("__n").over(Window.partitionBy("__b").orderBy(key)) - F.col("__n")
    return sizes.withColumn("__b", block).withColumn("__w", within).join(start, "__b").select(key, (F.col("__start") + F.col("__w")).alias("__before"))


def unique_tracks(tracks: DataFrame) -> DataFrame:
    """tracks (video_id, track_id) with new_track_id: ids used in several videos get new ids above the largest, by (id, video)."""
    pairs = tracks.select("video_id", "track_id").distinct()
    shared = pairs.groupBy("track_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("track_id", "n")
    top = F.broadcast(tracks.agg(F.max("track_id").alias("__top")))
    before = numbered_offsets(shared.select("track_id", F.col("n").alias("__n")), "track_id")
    w = Window.partitionBy("track_id").orderBy("video_id")
    renamed = pairs.join(before, "track_id").withColumn("__r", F.row_number().over(w)).crossJoin(top)
    renamed = renamed.select("video_id", "track_id", (F.col("__top") + F.col("__before") + F.col("__r")).alias("__new"))
    return tracks.join(renamed, ["video_id", "track_id"], "left").withColumn("new_track_id", F.coalesce("__new", "track_id")).drop("__new")


def nested_tracks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Frame rows to one row per track: boxes and areas over all frames 0..length-1, null where the track is absent."""
    got = rows.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("frame_idx", F.array("x", "y", "w", "h")))).alias("__m"), F.max("frame_idx").alias("__last"), F.avg(F.col("w") * F.col("h")).alias("mean_area")
    )
    boxes = F.transform(F.sequence(F.lit(0).cast("long"), F.col("__last").cast("long")), lambda i: F.element_at("__m", i))
    return got.select(*keys, boxes.alias("bboxes"), "mean_area")


def video_nests(videos: DataFrame, rows: DataFrame) -> DataFrame:
    """`videos` (video_id, ...) with images (frame numbers in order), tracks (track_id, category_id, frames in order and mean_area, by track_id) and n_boxes; a
    video without rows keeps empty lists. rows: video_id, frame_idx, track_id, category_id, w, h."""
    own = rows.groupBy("video_id", "track_id").agg(
        F.min("category_id").alias("category_id"), F.array_sort(F.collect_list("frame_idx")).alias("frames"), F.avg(F.col("w") * F.col("h")).alias("mean_area"), F.count(F.lit(1)).alias("__n"),
    )
    track = F.struct("track_id", "category_id", "frames", "mean_area")
    per = own.groupBy("video_id").agg(F.array_sort(F.collect_list(track)).alias("tracks"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("frames")))).alias("images"), F.sum("__n").alias("n_boxes"))
    out = videos.join(per, "video_id", "left")
    empty = lambda c: F.coalesce(c, F.array().cast(per.schema[c].dataType)).alias(c)
    return out.select(*videos.columns, empty("images"), empty("tracks"), F.coalesce("n_boxes", F.lit(0)).alias("n_boxes"))


def exploded_tracks(tracks: DataFrame, keys: list[str]) -> DataFrame:
    """Track rows to frame rows; null and all-zero boxes are absent, and so are those of area 0 where the tracks have areas;
    without areas the area is w * h."""
    areas = F.col("areas") if "areas" in tracks.columns else F.lit(None).cast("array<double>")
    rows = tracks.select(*keys, areas.alias("areas"), F.posexplode("bboxes").alias("frame_idx", "box"))
    area = F.coalesce(F.try_element_at("areas", F.col("frame_idx") + 1), F.col("box")[2] * F.col("box")[3])
    rows = rows.withColumn("area", area).where("box is not null and exists(box, v -> v <> 0) and (areas is null or area <> 0)")
    return rows.select(*keys, "frame_idx", *(F.col("box")[i].alias(c) for i, c in enumerate("xywh")), "area")


def with_images(rows: DataFrame, video: str = "video_id", frame: str = "frame_idx") -> tuple[DataFrame, DataFrame]:
    """(rows with image_id, images): an image for every frame of every video, numbered from 1 in the order of video and frame."""
    images = numbered(rows.select(video, frame).distinct(), [video, frame], "image_id", start=1)
    return rows.join(images, [video, frame]), images


def with_negatives(ids: DataFrame, negatives: DataFrame, order: list[str]) -> DataFrame:
    """`ids` (new_id) followed by pairs that have neither truth nor prediction, in the given order of the file."""
    last = ids.agg(F.coalesce(F.max("new_id"), F.lit(0)).alias("__last"))
    keys = [c for c in ids.columns if c != "new_id"]
    rest = numbered(negatives.join(ids, keys, "left_anti"), order, "__i", start=1).crossJoin(F.broadcast(last))  # one row
    return ids.unionByName(rest.select(*keys, (F.col("__last") + F.col("__i")).alias("new_id")))
