"""Image listings, merged metric files and nested reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IMAGE_ENDS = ("jpg", "jpeg", "png", "bmp")


def images_in(spark: SparkSession, folder: str, ends: tuple[str, ...] = IMAGE_ENDS) -> DataFrame:
    """path of every image file of a folder, whatever the case of its extension; contents are not read."""
    files = spark.read.format("binaryFile").load(folder).select("path")
    return files.where(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*ends)).distinct()


def images_of_list(spark: SparkSession, list_file: str, existing: DataFrame) -> DataFrame:
    """path: the lines of a list file that name one of the `existing` paths; blank lines do not count."""
    lines = spark.read.text(list_file).select(F.trim("value").alias("path")).where("path <> ''").distinct()
    return lines.join(existing.select("path").distinct(), "path", "left_semi")


def write_metrics(dataset: DataFrame, rows: DataFrame, folder: str) -> None:
    """One record of all dataset metrics (metric, value) under dataset_results, and a line for each row under np_results."""
    record = dataset.groupBy().agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value")))).alias("dataset_results"))
    record.write.mode("overwrite").json(f"{folder}/dataset_results")
    rows.write.mode("overwrite").json(f"{folder}/np_results")


def gap_report(frames: DataFrame, gaps: DataFrame, class_gaps: DataFrame) -> DataFrame:
    """video_id, report: the checks of a video as one JSON text: summary, missing and empty frames, gaps, and every frame's status."""
    key = "video_id"
    listed = lambda status: F.array_sort(F.collect_list(F.when(F.col("status") == status, F.col("frame_idx"))))
    own = frames.groupBy(key).agg(
        F.struct(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in ("ok", "empty", "missing"))).alias("summary"),
        listed("missing").alias("missing_frames"), listed("empty").alias("empty_frames"),
        F.array_sort(F.collect_list(F.struct("frame_idx", "status"))).alias("frames"),
    )
    of = lambda df, name, *cols: df.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    both = own.join(of(gaps, "gaps", "frame_idx", "status"), key, "left").join(of(class_gaps, "class_gaps", "frame_idx", "category_id", "prev_n", "next_n"), key, "left")
    return both.select(key, F.to_json(F.struct("summary", "missing_frames", "empty_frames", "gaps", "class_gaps", "frames")).alias("report"))


def read_report(reports: DataFrame) -> DataFrame:
    """video_id, total, ok, empty, missing, gaps of written reports."""
    at = lambda p, kind: F.get_json_object("report", p).cast(kind)
    return reports.select("video_id", *(at(f"$.summary.{c}", "long").alias(c) for c in ("total", "ok", "empty", "missing")), F.coalesce(F.json_array_length(F.get_json_object("report", "$.gaps")), F.lit(0)).alias("gaps"))
