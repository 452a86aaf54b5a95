"""Label checks over frames in order: gaps, sudden drops, interpolation, summaries. Windows run per video."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def in_order(frames: DataFrame, by: str = "video_id") -> DataFrame:
    """frames (video_id, frame_idx, status) with the neighbours' status; adjacency is by rank, not by number."""
    w = Window.partitionBy(by).orderBy("frame_idx")
    return frames.withColumn("prev_status", F.lag("status").over(w)).withColumn("next_status", F.lead("status").over(w))


def frame_gaps(frames: DataFrame) -> DataFrame:
    """Empty or missing frames between two frames that are ok."""
    return in_order(frames).where("status <> 'ok' and prev_status = 'ok' and next_status = 'ok'").select("video_id", "frame_idx", "status")


def present(frames: DataFrame, counts: DataFrame, classes: DataFrame) -> DataFrame:
    """A row for each frame and class (of `classes`) that has a box: n, the class's next such frame (g, g_n) in the video, and the two frames that
    follow (next_1, next_2 with their status). What is absent needs no row: it lies between a row and the class's next."""
    w, own = Window.partitionBy("video_id").orderBy("frame_idx"), Window.partitionBy("video_id", "category_id").orderBy("frame_idx")
    line = frames.select("video_id", "frame_idx", "status", *(F.lead(c, k).over(w).alias(f"{c}_{k}") for c in ("frame_idx", "status") for k in (1, 2)))
    rows = counts.where("n > 0").join(classes.select("category_id").distinct(), "category_id", "left_semi").select("video_id", "frame_idx", "category_id", "n")
    return rows.join(line, ["video_id", "frame_idx"]).withColumns({"g": F.lead("frame_idx").over(own), "g_n": F.lead("n").over(own)})


def class_gaps(frames: DataFrame, counts: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes that are present, absent and present again on three consecutive ok frames."""
    found = present(frames, counts, classes).where("g = frame_idx_2 and status = 'ok' and status_1 = 'ok' and status_2 = 'ok'")
    return found.select("video_id", F.col("frame_idx_1").alias("frame_idx"), "category_id", F.col("n").alias("prev_n"), F.col("g_n").alias("next_n"))


def frame_warnings(frames: DataFrame, counts: DataFrame, classes: DataFrame, thr: float = 0.5) -> DataFrame:
    """video_id, frame_idx, kind, category_id, prev_n, n: all_missing, class_missing and sudden_decrease.

    Compared with the frame before; a video's first frame has no warnings, and a frame without objects is all missing only
    if the one before had some. A decrease needs a count above 0 and a ratio strictly below `thr`.
    """
    stays = F.col("g").eqNullSafe(F.col("frame_idx_1"))
    kind = F.when(~stays, "class_missing").when(F.col("g_n") / F.col("n") < thr, "sudden_decrease")
    now = F.when(stays, F.col("g_n")).otherwise(0).cast(counts.schema["n"].dataType)
    steps = present(frames, counts, classes).where("frame_idx_1 is not null").select("video_id", F.col("frame_idx_1").alias("frame_idx"), kind.alias("kind"), "category_id", F.col("n").alias("prev_n"), now.alias("n"))
    by_class = steps.where("kind is not null")
    total = frames.join(counts.groupBy("video_id", "frame_idx").agg(F.sum("n").alias("n")), ["video_id", "frame_idx"], "left").fillna(0, ["n"])
    total = total.withColumn("before", F.lag("n").over(Window.partitionBy("video_id").orderBy("frame_idx")))
    empty = total.where("n = 0 and before > 0").selectExpr("video_id", "frame_idx", "'all_missing' kind", "cast(null as int) category_id", "cast(null as int) prev_n", "cast(0 as int) n")
    return by_class.unionByName(empty)


def interpolation_candidates(frames: DataFrame, counts: DataFrame) -> DataFrame:
    """Empty frames between non-empty ones; confidence = common classes over the larger neighbour's classes."""
    sets = counts.where("n > 0").groupBy("video_id", "frame_idx").agg(F.collect_set("category_id").alias("classes"))
    seen = frames.select("video_id", "frame_idx").join(sets, ["video_id", "frame_idx"], "left").withColumn("classes", F.coalesce("classes", F.array().cast("array<int>")))
    w = Window.partitionBy("video_id").orderBy("frame_idx")
    near = seen.withColumn("p", F.lag("classes").over(w)).withColumn("q", F.lead("classes").over(w))
    near = near.where((F.size("classes") == 0) & (F.size("p") > 0) & (F.size("q") > 0))
    return near.select("video_id", "frame_idx", (F.size(F.array_intersect("p", "q")) / F.greatest(F.size("p"), F.size("q"))).alias("confidence"))


def summary(frames: DataFrame, counts: DataFrame) -> DataFrame:
    """Per video: frames, ok, empty, missing, sorted classes."""
    per = counts.where("n > 0").groupBy("video_id").agg(F.array_sort(F.collect_set("category_id")).alias("classes"), F.sum("n").alias("boxes"))
    head = frames.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("frames"), *(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "empty", "missing"))
    )
    return head.join(per, "video_id", "left")


def class_rates(frames: DataFrame, counts: DataFrame, classes: DataFrame, thr: float = 0.5) -> DataFrame:
    """Per class: detections, missing warnings, and warnings as a share of all frames."""
    n = frames.agg(F.count(F.lit(1)).alias("frames"))
    missing = frame_warnings(frames, counts, classes, thr).where("kind = 'class_missing'").groupBy("category_id").agg(F.count(F.lit(1)).alias("missing"))
    sums = counts.groupBy("category_id").agg(F.sum("n").alias("detections"))
    out = classes.select("category_id").join(sums, "category_id", "left").join(missing, "category_id", "left").crossJoin(F.broadcast(n))
    return out.fillna(0, ["detections", "missing"]).withColumn("missing_rate", F.col("missing") / F.col("frames"))


def class_map_audit(prompts: DataFrame, class_map: DataFrame) -> DataFrame:
    """Prompts that the map lacks, and ids that it gives to more than one name."""
    lacking = prompts.select("name").distinct().join(class_map, "name", "left_anti").selectExpr("'unmapped' issue", "name item")
    twice = class_map.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").selectExpr("'duplicate_id' issue", "cast(class_id as string) item")
    return lacking.unionByName(twice)
