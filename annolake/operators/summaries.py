"""Summaries of runs and scores: what is reported of a run, of classes, of tracks and of thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import matching, metrics, pairs


def class_means(report: DataFrame) -> DataFrame:
    """mean_precision, mean_recall and mean_f1: the unweighted means over the classes of a class report; 0 without any class."""
    return report.agg(*(F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in ("precision", "recall", "f1")))


def tracklets(rows: DataFrame, keys: list[str], label: str | None = None) -> DataFrame:
    """Per track: score (the mean over its frames), n, mean_area, and with `label` the label that most of its frames have (the smallest of equals)."""
    size = F.col("w") * F.col("h")
    out = rows.groupBy(*keys).agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("n"), F.avg(size).alias("mean_area"))
    if label is None:
        return out
    votes = rows.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("votes"))
    most = votes.groupBy(*keys).agg(F.min_by(label, F.struct(-F.col("votes"), F.col(label))).alias(label))
    return out.join(most, keys)


def run_summary(items: DataFrame, source: str, value: str, order: str, success: Column) -> DataFrame:
    """Per source: items, successes, lo, hi, mean and median of a value (such as seconds), the first by `order`, and the mean of the rest (null if there is none)."""
    v, first = F.col(value), F.min_by(value, order)
    n, total = F.count(v), F.sum(v)
    rest = F.when(n > 1, (total - first) / (n - 1))
    return items.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(success).alias("successes"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.avg(v).alias("mean"), F.median(v).alias("median"), first.alias("first"), rest.alias("rest_mean"),
    )


def presence(dets: DataFrame, by: str, after: Column, percents: tuple[int, ...] = (10, 20, 30, 50)) -> DataFrame:
    """Largest and mean score before and after presence is multiplied in, and how many stay above each percentage."""
    s = dets.withColumn("after", after)
    aggs = [f(c).alias(n) for f, c, n in ((F.max, "score", "max_before"), (F.avg, "score", "mean_before"), (F.max, "after", "max_after"), (F.avg, "after", "mean_after"))]
    return s.groupBy(by).agg(*aggs, *(F.count_if(F.col("after") > t / 100).alias(f"n_{t}") for t in percents))


def best_threshold(dets: DataFrame, by: str, right: Column, cells: int = 100) -> DataFrame:
    """by, k, f1: of the grid k / (cells - 1) the lowest threshold whose detections above it have the best F1 against all that are right.

    Scores fall into cells once, then counts add up from the right: rows meet as sums of cells, never as a grid.
    """
    scored = dets.select(by, right.cast("int").alias("y"), (F.ceil(F.col("score") * (cells - 1)) - 1).alias("k"))
    some = scored.where("k >= 0").groupBy(by, "k").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q"))
    w = Window.partitionBy(by).orderBy(F.desc("k"))
    run = some.withColumn("tp", F.sum("p").over(w)).withColumn("fp", F.sum("q").over(w))
    # thresholds between two filled cells give the same sums as the upper one: the first grid point above the lower cell
    below = F.coalesce(F.lead("k").over(w) + 1, F.lit(0))
    total = scored.groupBy(by).agg(F.sum("y").alias("n"))
    f1 = run.withColumn("first", below).join(total, by).withColumn("f1", 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("n")))
    best = f1.groupBy(by).agg(F.max_by(F.struct("first", "f1"), F.struct(F.round("f1", 12), -F.col("first"))).alias("b"))
    return best.select(by, F.col("b.first").cast("long").alias("k"), F.col("b.f1").alias("f1"))


def bucket_means(values: DataFrame, bucket: str) -> DataFrame:
    """bucket, v, n: the mean of v in each bucket, the mean of these means, and the mean over all rows."""
    b = values.groupBy(bucket).agg(F.avg("v").alias("v"), F.count(F.lit(1)).alias("n"))
    one = lambda df, name: df.agg(F.avg("v").alias("v"), F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("bucket"), "v", "n")
    return b.select(F.col(bucket).cast("string").alias("bucket"), "v", "n").unionByName(one(b, "mean_of_means")).unionByName(one(values, "true_mean"))


def annotator_counts(images: DataFrame, truths: DataFrame, dt: DataFrame, annotators: list[int]) -> DataFrame:
    """image_id, annotator, n_gt, n_dt, tps (metrics.image_counts) for every image and annotator, of the best assignment of detections to each one's truths.

    images: id. truths: image_id, annotator, ann_id, x, y, w, h. All annotators' truths meet the detections in one join, and what is counted comes
    together by image and annotator, then by image.
    """
    matched = matching.assigned(pairs.iou_join(truths, dt, ["image_id"], min_iou=0.0, more=["annotator"]), ["image_id", "annotator"])
    none = F.lit(None)
    row = lambda df, kind, image="image_id", annotator=none, iou=none: df.select(F.col(image).alias("image_id"), annotator.cast("int").alias("annotator"), iou.cast("double").alias("iou"), F.lit(kind).alias("kind"))
    own = F.col("annotator")
    rows = row(images, 0, "id").unionByName(row(truths, 1, annotator=own)).unionByName(row(dt, 2)).unionByName(row(matched, 3, annotator=own, iou=F.col("iou")))
    n = lambda kind: F.count_if(F.col("kind") == kind)
    per = rows.groupBy("image_id", "annotator").agg(n(0).alias("known"), n(1).alias("n_gt"), n(2).alias("n_dt"), metrics.matches_at())
    found = F.collect_list(F.when(own.isNotNull(), F.struct("annotator", "n_gt", "tps"))).alias("found")
    whole = per.groupBy("image_id").agg(F.sum("known").alias("known"), F.sum("n_dt").alias("n_dt"), found).where("known > 0")
    zeros = F.array_repeat(F.lit(0).cast("long"), len(metrics.IOU_PERCENT))
    missing = F.filter(F.array(*map(F.lit, annotators)), lambda a: ~F.exists("found", lambda f: f["annotator"] == a))
    bare = F.transform(missing, lambda a: F.struct(a.alias("annotator"), F.lit(0).cast("long").alias("n_gt"), zeros.alias("tps")))
    return whole.select("image_id", "n_dt", F.inline(F.concat("found", bare))).select("image_id", "annotator", "n_gt", "n_dt", "tps")


def best_annotator(scorings: DataFrame) -> DataFrame:
    """image_id, annotator, mean_f1, tn: of the scorings of an image (annotator, n_gt, n_dt, tps) the one of best mean local F1; a true negative wins,
    ties go to the first annotator."""
    f1 = F.aggregate("tps", F.lit(0.0), lambda s, tp: s + metrics.f1_of(tp, F.col("n_dt") - tp, F.col("n_gt") - tp, 1e-4)) / F.size("tps")
    per = scorings.select("image_id", "annotator", ((F.col("n_gt") == 0) & (F.col("n_dt") == 0)).alias("tn"), F.round(f1, 6).alias("mean_f1"))
    best = per.groupBy("image_id").agg(F.max_by(F.struct("annotator", "mean_f1", "tn"), F.struct("tn", "mean_f1", -F.col("annotator"))).alias("b"))
    return best.select("image_id", "b.annotator", "b.mean_f1", "b.tn")


def best_of(rows: DataFrame, key: str, item: str) -> DataFrame:
    """key, item, score: the item of greatest score, the smaller of equals."""
    return rows.groupBy(key).agg(F.max_by(item, F.struct("score", -F.col(item))).alias(item), F.max("score").alias("score"))
