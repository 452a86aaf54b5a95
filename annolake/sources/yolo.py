"""YOLO label text: one file per frame, a line `class xc yc w h` per box, shares of the image."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes as bx
from . import files

_FIELDS = ("class_id", "xc", "yc", "w", "h")
_ROW = "struct<line_no: int, class_id: int, xc: double, yc: double, w: double, h: double, bad: boolean>"


def yolo_lines(dets: DataFrame, frame: str, width: int, height: int, classes: DataFrame | None = None, frames: DataFrame | None = None) -> DataFrame:
    """frame, text: the label file of every frame. dets: frame, class_id (or name, with a map), det_id, x, y, w, h.

    Names that the map lacks are dropped. With `frames`, a frame without boxes has an empty text. A frame is one row, so its
    lines are gathered within one group.
    """
    if classes is not None:
        dets = dets.drop("class_id").join(classes.select("name", "class_id"), "name")
    xc, yc, w, h = bx.to_yolo(bx.xywh(), F.lit(width), F.lit(height))
    # a tie in the seventh decimal goes up
    line = F.format_string("%d %.6f %.6f %.6f %.6f", F.col("class_id"), *(F.floor(v * 1e6 + 0.5) / 1e6 for v in (xc, yc, w, h)))
    lines = dets.select(frame, F.struct("det_id", line.alias("line")).alias("s"))
    texts = lines.groupBy(frame).agg(F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: s["line"]), "\n").alias("text"))
    return texts if frames is None else frames.select(frame).distinct().join(texts, frame, "left").fillna("", ["text"])


def parse_lines(texts: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(frames, boxes) from texts of files (frame, text). frames: frame, status (ok, empty, missing).

    Lenient: blank and short lines are skipped, further tokens ignored, and a bad number makes the file `missing`.
    Strict: any line of other than five numbers is an error when it is read.
    """
    line = lambda text, i: F.struct(i.alias("line_no"), F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != "").alias("t"))
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\r?\n"), line), lambda s: F.size(s["t"]) > 0)

    def row(s: Column) -> Column:
        numbers = [F.try_element_at(s["t"], F.lit(i + 1)).try_cast("double") for i in range(5)]
        bad = reduce(Column.__or__, (n.isNull() for n in numbers))
        out = F.struct(s["line_no"].alias("line_no"), numbers[0].cast("int").alias("class_id"), *(n.alias(c) for c, n in zip(_FIELDS[1:], numbers[1:], strict=True)), bad.alias("bad"))
        return F.when((F.size(s["t"]) != 5) | bad, F.raise_error(F.concat(F.lit("bad label line in "), "frame")).cast(_ROW)).otherwise(out) if strict else out

    # a file's lines stay in its row, so nothing is shuffled
    read = texts.select("frame", F.transform(lines if strict else F.filter(lines, lambda s: F.size(s["t"]) >= 5), row).alias("rows"))
    bad = F.exists("rows", lambda r: r["bad"])
    frames = read.select("frame", F.when(bad, "missing").when(F.size("rows") > 0, "ok").otherwise("empty").alias("status"))
    return frames, read.select("frame", F.inline(F.when(~bad, F.col("rows")))).drop("bad")


def label_texts(spark: SparkSession, path: str) -> DataFrame:
    """frame, text of a folder of label files."""
    files.register(spark)
    return spark.read.format("label_files").option("path", path).load()


def read_yolo(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(frames, boxes) of a folder of label files (.txt); the file's stem is the frame, and an empty file is a frame without boxes."""
    return parse_lines(label_texts(spark, path), strict)


def write_yolo(texts: DataFrame, path: str) -> None:
    """One label file per row of yolo_lines (a frame's name, text), an empty one for an empty text; files of an earlier run go."""
    files.register(texts.sparkSession)
    frame = next(c for c in texts.columns if c != "text")
    rows = texts.select(F.col(frame).cast("string").alias("frame"), F.coalesce("text", F.lit("")).alias("text"))
    rows.write.format("label_files").option("path", path).mode("overwrite").save()


#: About how many label files stand at once in through_files.
STANDING = 500_000


def through_files(texts: DataFrame, path: str, frames: int) -> DataFrame:
    """frame, text of every row of yolo_lines, each written to its label file and read again; `frames` says about how many there are.

    A file takes a block of the disk however short it is. So frames go in rounds by hash: a round's files are written and read as ever, and removed when
    what was read is in a table below `path`. Each frame has its file; those of one round stand at once.
    """
    spark, frame = texts.sparkSession, next(c for c in texts.columns if c != "text")
    rounds, share, key = max(1, -(-frames // STANDING)), int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(frame)
    dealt = texts.select(F.col(frame).cast("string").alias("frame"), "text", F.pmod(key, F.lit(rounds)).cast("int").alias("round"), F.pmod(F.shiftright(key, 32), F.lit(share)).alias("share"))
    dealt.repartition(rounds * share, "round", "share").drop("share").write.partitionBy("round").parquet(f"{path}/texts")
    rows = spark.read.schema("frame string, text string, round int").parquet(f"{path}/texts")
    for k in range(rounds):
        own = f"{path}/files/{k}"
        write_yolo(rows.where(F.col("round") == k).drop("round"), own)
        label_texts(spark, own).write.parquet(f"{path}/read/{k}")
        files.remove(spark.read.parquet(f"{path}/read/{k}").select("frame"), own)
    return spark.read.schema("frame string, text string").parquet(*(f"{path}/read/{k}" for k in range(rounds)))


#: About how many label files one task of by_files writes.
TASK_FILES = 20_000


def by_files(texts: DataFrame, path: str, frames: int) -> DataFrame:
    """frame, text of every row of yolo_lines, each written to its label file below `path` and read again; `frames` says about how many there are.

    As through_files, in one job: a task writes files.PART_FILES files at a time into a folder of its own, by the sink, lists and reads it, by the source, and
    removes it. Making files in one folder is done one after another by most file systems, and removing them costs little before they have reached the disk.
    """
    frame = next(c for c in texts.columns if c != "text")
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-frames // TASK_FILES))
    names = ["frame", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, files.PART_FILES):
                some = b.slice(at, files.PART_FILES)
                read = files.passed(zip(*(some.column(c).to_pylist() for c in names), strict=True), path)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in zip(*read, strict=True)], names)

    return texts.select(F.col(frame).cast("string").alias("frame"), "text").repartition(tasks, "frame").mapInArrow(run, "frame string, text string")


def class_map(spark: SparkSession, text: str) -> DataFrame:
    """name, class_id from "name:id,name:id"."""
    pairs = spark.range(1).select(F.explode(F.expr(f"str_to_map({_quoted(text)}, ',', ':')")).alias("name", "id"))
    return pairs.select(F.trim("name").alias("name"), F.trim("id").cast("int").alias("class_id"))


def class_names(spark: SparkSession, text: str) -> DataFrame:
    """class_id, name from "name:id,name:id"; of names with one id the first in order."""
    return class_map(spark, text).groupBy("class_id").agg(F.min("name").alias("name"))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
