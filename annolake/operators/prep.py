"""Dataset preparation: query and object filters, caps, compaction, availability, sampling by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .remap import numbered


def hashed(key: Column, seed: int = 0) -> Column:
    """A repeatable order for sampling, in integer arithmetic that any engine can follow and no key can overflow."""
    return F.pmod(F.pmod(key, F.lit(1000003)) * 2654435761 + seed, F.lit(1000003))


def drop_texts(queries: DataFrame, texts: list[str]) -> DataFrame:
    return queries.where(~F.col("query_text").isin(texts)) if texts else queries


def text_queries(queries: DataFrame) -> DataFrame:
    """Queries without an input box."""
    return queries.where("input_bbox is null")


def drop_queries(queries: DataFrame, bad: DataFrame) -> DataFrame:
    return queries.join(bad.select("datapoint_id", "query_idx").distinct(), ["datapoint_id", "query_idx"], "left_anti")


def with_flat_targets(queries: DataFrame, objects: DataFrame) -> DataFrame:
    """Queries that point at an object without width or height."""
    flat = objects.where("w <= 0 or h <= 0").select("datapoint_id", F.col("obj_idx").alias("object_id"))
    return queries.select("datapoint_id", "query_idx", F.explode("object_ids").alias("object_id")).join(flat, ["datapoint_id", "object_id"], "left_semi")


def few_targets(queries: DataFrame, most: int) -> DataFrame:
    return queries.where(F.size("object_ids") <= most)


def real_objects(objects: DataFrame, least_area: float = 1e-6, crowds: bool = False) -> DataFrame:
    kept = objects.where(F.col("area") >= least_area)
    return kept if crowds else kept.where("is_crowd = 0")


def exhaustive(queries: DataFrame, kind: str) -> DataFrame:
    """instance: is_exhaustive has to hold; pixel: is_pixel_exhaustive must not be false (null stays)."""
    return queries.where("is_exhaustive" if kind == "instance" else "is_pixel_exhaustive is null or is_pixel_exhaustive")


def valid_geometric(queries: DataFrame) -> DataFrame:
    return queries.where("input_bbox is null or size(object_ids) > 0")


def cap_queries(queries: DataFrame, most: int, positives_first: bool = False, seed: int = 0) -> DataFrame:
    """At most `most` queries of a datapoint, in hashed order; with positives_first those with objects come first."""
    w = Window.partitionBy("datapoint_id").orderBy(*([(F.size("object_ids") == 0)] if positives_first else []), hashed(F.col("query_idx") + F.col("datapoint_id"), seed), "query_idx")
    return queries.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= most).drop("__r")


def cap_video_queries(queries: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """Choose positions on a video's first stage and keep them on every stage."""
    first = queries.where("processing_order = 0").select("datapoint_id", "position")
    w = Window.partitionBy("datapoint_id").orderBy(hashed(F.col("position") + F.col("datapoint_id"), seed), "position")
    kept = first.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= most)
    return queries.join(kept, ["datapoint_id", "position"], "left_semi")


def size_guards(queries: DataFrame, most_queries: int, most_objects: int, datapoints: DataFrame | None = None, most_tracks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects): datapoints with too many queries, a query with too many objects, stages of unequal length, too many
    different objects in all (`most_tracks`), and those of `datapoints` that have no query."""
    stages = queries.groupBy("datapoint_id", "processing_order").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("object_ids")).alias("most"))
    size = stages.groupBy("datapoint_id").agg(F.sum("n").alias("n"), F.max("most").alias("most"), (F.min("n") != F.max("n")).alias("uneven"))
    why = F.when(F.col("n") > most_queries, "too_many_queries").when(F.col("most") > most_objects, "too_many_objects").when(F.col("uneven"), "uneven_stages")
    rejects = size.withColumn("reason", why).where("reason is not null").select("datapoint_id", "reason")
    if most_tracks is not None:
        ids = queries.select("datapoint_id", F.explode("object_ids").alias("o")).groupBy("datapoint_id").agg(F.count_distinct("o").alias("n")).where(F.col("n") > most_tracks)
        many = ids.join(rejects, "datapoint_id", "left_anti").select("datapoint_id", F.lit("too_many_tracks").alias("reason"))
        rejects = rejects.unionByName(many)
    if datapoints is not None:
        bare = datapoints.select("datapoint_id").distinct().join(queries, "datapoint_id", "left_anti")
        rejects = rejects.unionByName(bare.select("datapoint_id", F.lit("no_queries").alias("reason")))
    return queries.join(rejects, "datapoint_id", "left_anti"), rejects


def compact_images(queries: DataFrame, objects: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries, objects, images) with new_image: images that no query and no object names are dropped, the others numbered anew.

    All three hold datapoint_id and image_idx.
    """
    used = queries.select("datapoint_id", "image_idx").unionByName(objects.select("datapoint_id", "image_idx")).distinct()
    kept = images.join(used, ["datapoint_id", "image_idx"], "left_semi").withColumn("new_image", F.row_number().over(Window.partitionBy("datapoint_id").orderBy("image_idx")) - 1)
    ids = kept.select("datapoint_id", "image_idx", "new_image")
    return queries.join(ids, ["datapoint_id", "image_idx"]), objects.join(ids, ["datapoint_id", "image_idx"]), kept


def compact(queries: DataFrame, objects: DataFrame, datapoints: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(queries, objects, rejects) after filters: queries and stages numbered anew, unreferenced objects dropped, ids in
    object_ids mapped. A datapoint without a first stage is rejected, and one of `datapoints` that has no query left."""
    lost = queries.groupBy("datapoint_id").agg(F.min("processing_order").alias("m")).where("m > 0").select("datapoint_id", F.lit("no_first_stage").alias("reason"))
    if datapoints is not None:
        bare = datapoints.select("datapoint_id").distinct().join(queries, "datapoint_id", "left_anti")
        lost = lost.unionByName(bare.select("datapoint_id", F.lit("empty").alias("reason")))
    own = queries.join(lost, "datapoint_id", "left_anti")
    by = Window.partitionBy("datapoint_id")
    own = own.withColumn("new_query", F.row_number().over(by.orderBy("query_idx")) - 1).withColumn("new_stage", F.dense_rank().over(by.orderBy("processing_order")) - 1)
    uses = own.select("datapoint_id", "new_query", F.posexplode("object_ids").alias("pos", "obj_idx"))
    kept = objects.join(uses.select("datapoint_id", "obj_idx").distinct(), ["datapoint_id", "obj_idx"], "left_semi")
    kept = kept.withColumn("new_obj", F.row_number().over(by.orderBy("obj_idx")) - 1)
    ids = uses.join(kept.select("datapoint_id", "obj_idx", "new_obj"), ["datapoint_id", "obj_idx"]).groupBy("datapoint_id", "new_query")
    ids = ids.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "new_obj"))), lambda s: s["new_obj"]).alias("new_ids"))
    out = own.join(ids, ["datapoint_id", "new_query"], "left").withColumn("new_ids", F.coalesce("new_ids", F.array().cast("array<int>")))
    return out, kept, lost


def available_by_name(images: DataFrame, annotations: DataFrame, have: DataFrame, name: str, suffix: str = ".mp4") -> tuple[DataFrame, DataFrame]:
    """Images whose name, without `suffix`, is at hand (have: name), and their annotations."""
    own = F.replace(F.col(name), F.lit(suffix), F.lit(""))
    kept = images.withColumn("__name", own).join(have.select(F.col("name").alias("__name")).distinct(), "__name", "left_semi").drop("__name")
    return kept, annotations.join(kept.select(F.col("id").alias("image_id")), "image_id", "left_semi")


def available(videos: DataFrame, annotations: DataFrame, pairs: DataFrame, have: DataFrame, key: str = "video_id") -> tuple[DataFrame, ...]:
    """Videos with at least one frame at hand, and their annotations and phrase pairs."""
    there = have.select(key).distinct()
    return tuple(df.join(there, key, "left_semi") for df in (videos, annotations, pairs))


def eligible_images(first: DataFrame, others: list[DataFrame]) -> DataFrame:
    """Images that the first ground truth calls exhaustive and no other calls non-exhaustive."""
    out = first.where("is_instance_exhaustive = 1")
    for other in others:
        out = out.join(other.where("is_instance_exhaustive = 0").select("id"), "id", "left_anti")
    return out


def class_threshold(dets: DataFrame, thresholds: DataFrame, default: float = 0.0) -> DataFrame:
    """Scores strictly above their class's threshold; a class that the table lacks has the default."""
    joined = dets.join(thresholds.select("name", "threshold"), "name", "left")
    return joined.where(F.col("score") > F.coalesce("threshold", F.lit(default))).drop("threshold")


def top_k(dets: DataFrame, keys: list[str], k: int, *ties: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), *ties)
    return dets.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r") if k else dets


def merge_shards(preds: DataFrame, keys: list[str], shard: str = "shard") -> DataFrame:
    """Rows of the first shard that holds a key."""
    first = preds.groupBy(*keys).agg(F.min(shard).alias(shard))
    return preds.join(first, [*keys, shard], "left_semi")


def clip_frames(frames: DataFrame, n: int, stride: int, seed: int = 0, reverse: float = 0.0) -> DataFrame:
    """n frames of each video by stride (lowered to fit), from a hashed start; stages are numbered from 0, with a probability
    of `reverse` from the last frame to the first."""
    w = Window.partitionBy("video_id")
    ranked = frames.withColumn("__r", F.row_number().over(w.orderBy("frame_idx")) - 1).withColumn("__n", F.count(F.lit(1)).over(w))
    step = F.greatest(F.lit(1), F.least(F.lit(stride), F.floor((F.col("__n") - 1) / max(1, n - 1))))
    start = F.pmod(hashed(F.col("video_id"), seed), F.greatest(F.lit(1), F.col("__n") - step * (n - 1)))
    ranked = ranked.withColumn("__s", step).withColumn("__a", start)
    off = F.col("__r") - F.col("__a")
    kept = ranked.where((off >= 0) & (off % F.col("__s") == 0) & (off / F.col("__s") < n))
    stage = (off / F.col("__s")).cast("int")
    if reverse:
        last = F.least(F.lit(n - 1), F.floor((F.col("__n") - 1 - F.col("__a")) / F.col("__s"))).cast("int")
        stage = F.when(hashed(F.col("video_id"), seed + 1) < int(reverse * 1_000_003), last - stage).otherwise(stage)
    return kept.withColumn("stage", stage).drop("__r", "__n", "__s", "__a")


def clip_rows(rows: DataFrame, clips: DataFrame) -> DataFrame:
    """Annotation rows on the frames of their video's clip, with the frame's stage."""
    return rows.join(clips.select("video_id", "frame_idx", "stage"), ["video_id", "frame_idx"])


def frame_plan(videos: DataFrame, every: int, running: bool = False) -> DataFrame:
    """Every n-th frame of each video (0: all) with a name; videos (video_name, length). With `running`, also a number over all
    frames of all videos, by name and frame."""
    step = max(1, every)
    rows = videos.where("length > 0").select("video_name", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(step))).alias("frame_idx"))
    named = rows.withColumn("name", F.format_string("%s_frame_%06d", "video_name", "frame_idx"))
    return numbered(named, ["video_name", "frame_idx"], "number") if running else named


def shard_of(df: DataFrame, order: str, shards: int) -> DataFrame:
    """Shards by a hash of the key: of nearly equal size, and no task orders all rows. For exact turns see round_robin."""
    return df.withColumn("shard", F.pmod(hashed(F.col(order)), F.lit(shards)))


def round_robin(df: DataFrame, order: list[str], shards: int) -> DataFrame:
    """Row i, by `order`, goes to shard i mod `shards`; numbers come from range partitions, not from one task."""
    return numbered(df, order, "__i").withColumn("shard", F.pmod("__i", F.lit(shards)).cast("int")).drop("__i")
