"""A metric over sequences and classes, in two phases: sums of each (sequence, class), which are then combined over sequences and over classes.

A user's own metric is a Metric with three functions; `evaluate` runs it beside the library's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cut import settled
from .teta import class_average, combine_teta, teta_sums
from .tracks import average_hota, combine_hota, counts, hota, mask_similarity, similarity


@dataclass(frozen=True)
class Metric:
    """`sequences`(gt, dt): a row for each (video, cls, ...) with what adds up, or what `combine` can weigh. `combine`(rows, keys): the same
    over all rows of each key. `average`(rows of classes): the mean over classes."""

    name: str
    sequences: Callable[[DataFrame, DataFrame], DataFrame]
    combine: Callable[[DataFrame, list[str]], DataFrame]
    average: Callable[[DataFrame], DataFrame]


def hota_metric(measure: Callable[..., DataFrame] = similarity) -> Metric:
    def sequences(gt: DataFrame, dt: DataFrame) -> DataFrame:
        return hota(*(df.withColumnRenamed("category_id", "cls") for df in (gt, dt)), ["video_id", "cls"], measure=measure)

    return Metric("hota", sequences, combine_hota, average_hota)


def teta_metric(measure: Callable[..., DataFrame] = similarity, exhaustive: bool = True) -> Metric:
    return Metric("teta", lambda gt, dt: teta_sums(gt, dt, measure=measure, exhaustive=exhaustive), combine_teta, class_average)


def count_metric() -> Metric:
    names = ["frames", "gt_dets", "gt_ids", "dets", "ids"]
    total = lambda rows, keys: rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in names))
    mean = lambda rows: rows.agg(*(F.avg(c).alias(c) for c in names))
    return Metric("count", lambda gt, dt: counts(*(df.withColumnRenamed("category_id", "cls") for df in (gt, dt)), ["video_id", "cls"]), total, mean)


def mask_metrics(exhaustive: bool = True) -> list[Metric]:
    return [hota_metric(mask_similarity), teta_metric(mask_similarity, exhaustive), count_metric()]


def evaluate(gt: DataFrame, dt: DataFrame, metrics: list[Metric], only: DataFrame | None = None) -> dict[str, dict[str, DataFrame]]:
    """By metric: `sequences`, `sequence` (each over its classes), `class` (each over sequences), `classes` (their mean) and `all` (everything as one).

    gt, dt: video_id, frame_idx, track_id, category_id, and boxes or masks. `only` (video_id) takes a subset of the sequences, such as those of a tag; the
    sums of a metric are made once and written, as every level reads them.
    """
    if only is not None:
        gt, dt = (df.join(only.select("video_id").distinct(), "video_id", "left_semi") for df in (gt, dt))
    out = {}
    for m in metrics:
        rows = settled(m.sequences(gt, dt))
        by_class = m.combine(rows, ["cls"])
        out[m.name] = {"sequences": rows, "sequence": m.combine(rows, ["video_id"]), "class": by_class, "classes": m.average(by_class), "all": m.combine(rows, [])}
    return out
