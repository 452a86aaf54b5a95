"""Metrics: sums per threshold first, then scalar formulas on a handful of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import settled
from .masks import SHARE, area, mask_pairs
from .matching import AREAS, assigned, score_assigned, score_match, score_taken
from .pairs import tracklet_iou, tracklet_mask_iou

IOU_PERCENT = list(range(50, 100, 5))


def class_report(matches: DataFrame, dt: DataFrame, keys: list[str], eps: float = 1e-6) -> DataFrame:
    """Per class: tp, fp, fn, precision, recall, f1. matches: one row for each truth, det_id null where unmatched;
    detections of images without truth do not count."""
    by = matches.groupBy("class_id").agg(F.count("det_id").alias("tp"), (F.count(F.lit(1)) - F.count("det_id")).alias("fn"))
    paired = dt.join(matches.select("image_id").distinct(), "image_id", "left_semi").groupBy("class_id").agg(F.count(F.lit(1)).alias("dets"))
    out = by.join(paired, "class_id", "full").fillna(0)
    out = out.select("class_id", "tp", (F.col("dets") - F.col("tp")).alias("fp"), "fn")
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    p, r = tp / (tp + fp + eps), tp / (tp + fn + eps)
    return out.select("class_id", "tp", "fp", "fn", p.alias("precision"), r.alias("recall"), (2 * p * r / (p + r + eps)).alias("f1"))


def matches_at() -> Column:
    """tps: how many of a group's overlaps (iou) reach each of the ten thresholds."""
    return F.array(*(F.count_if(F.round(F.col("iou"), 12) >= p / 100) for p in IOU_PERCENT)).alias("tps")


def image_counts(images: DataFrame, gt: DataFrame, dt: DataFrame, matched: DataFrame, **sums: Column) -> DataFrame:
    """Per image its number of truths, detections and matches at each of the ten thresholds (array tps), and `sums` over its matches."""
    hits = matched.groupBy("image_id").agg(matches_at(), *(F.sum(v).alias(k) for k, v in sums.items()))
    count = lambda df, name: df.groupBy("image_id").agg(F.count(F.lit(1)).alias(name))
    out = images.select(F.col("id").alias("image_id")).join(count(gt, "n_gt"), "image_id", "left").join(count(dt, "n_dt"), "image_id", "left").join(hits, "image_id", "left")
    return out.fillna(0, ["n_gt", "n_dt"]).withColumn("tps", F.coalesce("tps", F.array_repeat(F.lit(0).cast("long"), len(IOU_PERCENT))))


def f1_of(tp: Column, fp: Column, fn: Column, eps: float) -> Column:
    p, r = tp / (tp + fp + eps), tp / (tp + fn + eps)
    return 2 * p * r / (p + r + eps)


def phrase_metrics(per_image: DataFrame) -> DataFrame:
    """Per IoU threshold (in percent): counts, F1, positive micro and macro F1, image-level scores and cgF1."""
    rows = per_image.select("n_gt", "n_dt", F.posexplode("tps").alias("k", "tp"))
    pos, det = F.col("n_gt") > 0, F.col("n_dt") > 0
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    local = f1_of(F.col("tp"), F.col("n_dt") - F.col("tp"), F.col("n_gt") - F.col("tp"), 1e-4)
    s = rows.groupBy("k").agg(
        F.sum("tp").alias("tp"),
        F.sum(F.col("n_dt") - F.col("tp")).alias("fp"),
        F.sum(F.col("n_gt") - F.col("tp")).alias("fn"),
        F.sum(F.when(pos, F.col("n_dt") - F.col("tp")).otherwise(0)).alias("pos_fp"),
        F.avg(F.when(pos & det, local)).alias("positive_macro_f1"),
        one(pos & det).alias("il_tp"),
        one(~pos & det).alias("il_fp"),
        one(pos & ~det).alias("il_fn"),
        one(~pos & ~det).alias("il_tn"),
    )
    tp, fp, fn, tn = (F.col(f"il_{c}").cast("double") for c in ("tp", "fp", "fn", "tn"))
    mcc = (tp * tn - fp * fn) / (F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) + 1e-6)
    out = s.withColumn("f1", f1_of(F.col("tp"), F.col("fp"), F.col("fn"), 1e-4)).withColumn("positive_micro_f1", f1_of(F.col("tp"), F.col("pos_fp"), F.col("fn"), 1e-4))
    out = out.withColumn("il_f1", f1_of(tp, fp, fn, 1e-6)).withColumn("il_fpr", fp / (fp + tn + 1e-6)).withColumn("il_mcc", mcc)
    return out.withColumn("cgf1", F.col("positive_micro_f1") * F.col("il_mcc")).withColumn("iou_percent", 50 + 5 * F.col("k")).drop("k")


def phrase_rows(per_image: DataFrame) -> DataFrame:
    """image_id, tp, fp, fn, f1 at an overlap of 50, and mean_f1 over all thresholds: 1 where nothing is to be found and nothing is."""
    f1 = lambda tp: F.when(F.col("n_gt") + F.col("n_dt") == 0, F.lit(1.0)).otherwise(2 * tp / (F.col("n_gt") + F.col("n_dt")))
    tp = F.col("tps")[0]
    mean = F.aggregate(F.transform("tps", f1), F.lit(0.0), lambda a, v: a + v) / F.size("tps")
    return per_image.select("image_id", tp.alias("tp"), (F.col("n_dt") - tp).alias("fp"), (F.col("n_gt") - tp).alias("fn"), f1(tp).alias("f1"), mean.alias("mean_f1"))


def phrase_summary(per_threshold: DataFrame, metrics: list[str], image_level: list[str]) -> DataFrame:
    """metric, value: each metric's mean over the thresholds, and at 50 and 75; image-level ones as they are."""
    at = lambda m, p: F.max(F.when(F.col("iou_percent") == p, F.col(m)))
    cols = {m: F.avg(m) for m in metrics} | {f"{m}@{p / 100:g}": at(m, p) for m in metrics for p in (50, 75)} | {m: F.max(m) for m in image_level}
    one = per_threshold.agg(*(v.alias(k) for k, v in cols.items()))
    return one.select(F.inline(F.array(*(F.struct(F.lit(k).alias("metric"), F.col(f"`{k}`").cast("double").alias("value")) for k in cols))))


def demo_metrics(per_image: DataFrame, jf: DataFrame | None = None) -> DataFrame:
    """phrase_metrics with precision and recall at both levels, macro F1 with and without images that have no detection, the
    shares of perfect images, and cgF1 in three forms; with jf (image_id, j, f of images with a match) J, F and J&F."""
    rows = per_image.select("n_gt", "n_dt", F.posexplode("tps").alias("k", "tp"))
    pos, det = F.col("n_gt") > 0, F.col("n_dt") > 0
    perfect = (F.col("tp") == F.col("n_gt")) & (F.col("tp") == F.col("n_dt"))
    local = f1_of(F.col("tp"), F.col("n_dt") - F.col("tp"), F.col("n_gt") - F.col("tp"), 1e-4)
    more = rows.groupBy("k").agg(
        (F.count_if(pos & perfect) / (F.count_if(pos) + 1e-9)).alias("il_perfect_pos"), (F.count_if(~pos & perfect) / (F.count_if(~pos) + 1e-9)).alias("il_perfect_neg"),
        (F.sum(F.when(pos & det, local).otherwise(0.0)) / F.count_if(pos & det)).alias("positive_w0dt_macro_f1"),
    )
    out = phrase_metrics(per_image).join(more.withColumn("iou_percent", 50 + 5 * F.col("k")).drop("k"), "iou_percent")
    tp, fp, fn, pos_fp = (F.col(c) for c in ("tp", "fp", "fn", "pos_fp"))
    il_tp, il_fp, il_fn = (F.col(f"il_{c}") for c in ("tp", "fp", "fn"))
    out = out.withColumns(
        {
            "precision": tp / (tp + fp + 1e-4), "recall": tp / (tp + fn + 1e-4), "positive_micro_precision": tp / (tp + pos_fp + 1e-4),
            "il_precision": il_tp / (il_tp + il_fp + 1e-6), "il_recall": il_tp / (il_tp + il_fn + 1e-6),
            "cgf1_macro": F.col("positive_macro_f1") * F.col("il_mcc"), "cgf1_w0dt": F.col("positive_w0dt_macro_f1") * F.col("il_mcc"),
        }
    )
    if jf is None:
        return out
    n = F.count(F.lit(1)) + 1e-9
    mean = jf.agg((F.sum("j") / n).alias("j"), (F.sum("f") / n).alias("f"), (F.sum((F.col("j") + F.col("f")) / 2) / n).alias("j_and_f"))
    return out.crossJoin(F.broadcast(mean))  # one row


def mask_matches(gt: DataFrame, dt: DataFrame, share: float | None = None) -> DataFrame:
    """image_id, ann_id, det_id, iou: the assignment of an image's masks that maximises the summed overlap; with `share` also boundary_f."""
    return assigned(mask_pairs(gt, dt, ["image_id"], share=share), ["image_id"], None if share is None else ["boundary_f"])


def mask_phrase_metrics(images: DataFrame, gt: DataFrame, dt: DataFrame, rows: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """phrase_metrics of masks: gt (image_id, ann_id, runs, height), dt (image_id, det_id, runs, height). `rows`: both again without their masks,
    to be counted (image_id), where drawing them once more would cost."""
    return phrase_metrics(image_counts(images, *(rows or (gt, dt)), mask_matches(gt, dt)))


def mask_demo_metrics(images: DataFrame, gt: DataFrame, dt: DataFrame, rows: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """demo_metrics of masks (with width). Per image with truths and detections J is the mean overlap and F the mean boundary F over as many pairs as
    the smaller side has; pairs without overlap count 0 in both. `rows` as in mask_phrase_metrics. The rows of images are written once."""
    matched = mask_matches(gt, dt, SHARE)
    per = settled(image_counts(images, *(rows or (gt, dt)), matched, j=F.col("iou"), f=F.col("boundary_f")))
    least = F.least("n_gt", "n_dt")
    share = lambda c: (F.coalesce(c, F.lit(0.0)) / least).alias(c)
    return demo_metrics(per, per.where(least > 0).select("image_id", share("j"), share("f")))


#: Detections of one range of average_precision.
RANGE = 100_000


def average_precision(flags: DataFrame, truths: DataFrame, by: list[str], points: int = 101) -> DataFrame:
    """by, k, ap, recall: precision, made monotonic from the right, averaged over a grid of recalls; for every k that has truths.

    flags: by, image_id, det_id, score, flags (an array: 1 hit, 0 miss, -1 ignored). truths: by, n_gt (an array as long). Detections are cut into ranges
    of (by, score), which are written once. Each range's counts give the counts before it; each range then tells, for
    every recall of the grid, the best precision among its own hits that reach it; the best of all ranges is the answer.
    So no class is one task's, and thresholds stay an array. A range holds about RANGE detections, however many there are in all: it is one
    group of a task's Python. `flags` are read several times and should be settled.
    """
    order = [*by, F.desc("score"), "image_id", "det_id"]
    ranges = max(int(flags.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-flags.count() // RANGE))
    rows = flags.select(*by, "image_id", "det_id", "score", "flags").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows = settled(rows.withColumn("__p", F.spark_partition_id()))
    kinds = ", ".join(f"`{b}` {rows.schema[b].dataType.simpleString()}" for b in by)

    def segments(pdf: pd.DataFrame) -> Iterator[tuple[tuple, np.ndarray]]:
        for key, part in pdf.groupby(by, sort=False):
            yield key, np.array(part["flags"].tolist(), np.int8).reshape(len(part), -1)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}
        p = None
        for pdf in batches:
            for key, f in segments(pdf):
                now = np.array([(f == 1).sum(axis=0), (f >= 0).sum(axis=0)])
                sums[key] = now + sums[key] if key in sums else now
                p = int(pdf["__p"].iloc[0])
        yield pd.DataFrame([(*key, p, k, int(v[0, k]), int(v[1, k])) for key, v in sums.items() for k in range(v.shape[1])], columns=[*by, "__p", "k", "tp", "n"])

    counts = rows.mapInPandas(counted, f"{kinds}, __p int, k int, tp long, n long")
    w = Window.partitionBy(*by, "k").orderBy("__p")
    before = settled(counts.withColumn("tp0", F.sum("tp").over(w) - F.col("tp")).withColumn("n0", F.sum("n").over(w) - F.col("n")))
    sized = before.join(truths.select(*by, F.posexplode("n_gt").alias("k", "n_gt")), [*by, "k"])
    steps = points - 1

    def reached(key: tuple, pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        start = {tuple(r[:-4]) + (r[-4],): r[-3:] for r in known[[*by, "k", "tp0", "n0", "n_gt"]].itertuples(index=False, name=None)}
        out = []
        for own, f in segments(pdf.sort_values([*by, "score", "image_id", "det_id"], ascending=[True] * len(by) + [False, True, True])):
            tp, n = np.cumsum(f == 1, axis=0), np.cumsum(f >= 0, axis=0)
            for k in range(f.shape[1]):
                tp0, n0, n_gt = start.get((*own, k), (0, 0, 0))
                at = np.flatnonzero(f[:, k] == 1)
                if not n_gt or not len(at):
                    continue
                hits = tp[at, k] + tp0
                best = np.zeros(points)
                np.maximum.at(best, np.minimum(np.floor(hits / n_gt * steps + 1e-9).astype(int), steps), hits / (n[at, k] + n0))
                out.append((*own, k, np.maximum.accumulate(best[::-1])[::-1].tolist()))
        return pd.DataFrame(out, columns=[*by, "k", "best"])

    best = rows.groupBy("__p").cogroup(sized.select(*by, "__p", "k", "tp0", "n0", "n_gt").groupBy("__p")).applyInPandas(reached, f"{kinds}, k int, best array<double>")
    grid = best.select(*by, "k", F.posexplode("best").alias("g", "p")).groupBy(*by, "k", "g").agg(F.max("p").alias("p"))
    ap = grid.groupBy(*by, "k").agg((F.sum("p") / points).alias("ap"))
    found = counts.groupBy(*by, "k").agg(F.sum("tp").alias("tp"))
    all_ = truths.select(*by, F.posexplode("n_gt").alias("k", "n_gt")).where("n_gt > 0").join(ap, [*by, "k"], "left").join(found, [*by, "k"], "left")
    return all_.select(*by, "k", F.coalesce("ap", F.lit(0.0)).alias("ap"), (F.coalesce("tp", F.lit(0)) / F.col("n_gt")).alias("recall"))


def truth_counts(gt: DataFrame, by: list[str], areas: list[tuple[float, float]], thresholds: int, size: Column | None = None) -> DataFrame:
    """by, n_gt: the truths that count, per area range and threshold (the same for all thresholds of a range). `size` is a box's area unless given."""
    size = F.col("w") * F.col("h") if size is None else size
    n = [F.count_if((F.col("iscrowd") == 0) & (size >= lo) & (size <= hi)) for lo, hi in areas]
    return gt.groupBy(*by).agg(F.flatten(F.array(*(F.array_repeat(c, thresholds) for c in n))).alias("n_gt"))


def precision_summary(gt: DataFrame, dt: DataFrame, keys: list[str], label: str = "class_id", max_dets: tuple[int, ...] = (1, 10, 100), areas: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """metric, value: AP over ten thresholds, at 50 and 75, and by area; AR by number of detections, and by area.

    A class without truths (in the area range) does not count; -1 if none has any. `label` None takes all classes as one.
    """
    areas = areas or AREAS
    flags = score_match(gt, dt, keys, [p / 100 for p in IOU_PERCENT], max_dets[-1], list(areas.values()))
    return summarised(flags, truth_counts(gt, [label], list(areas.values()), len(IOU_PERCENT)), [label], max_dets, list(areas))


def mask_precision_summary(gt: DataFrame, dt: DataFrame, keys: list[str], label: str = "class_id", max_dets: tuple[int, ...] = (1, 10, 100), areas: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """precision_summary over masks: gt (keys, ann_id, iscrowd, runs, height), dt (keys, det_id, score, runs, height). Areas are those of the masks."""
    areas = areas or AREAS
    thresholds = [p / 100 for p in IOU_PERCENT]
    rows = mask_pairs(gt, dt, keys, "iscrowd", every=["score"])
    rows = rows.withColumns({c: F.col(c).cast("double") for c in ("g_area", "d_area")})
    flags = score_taken(rows, keys, thresholds, max_dets[-1], list(areas.values()))
    return summarised(flags, truth_counts(gt, [label], list(areas.values()), len(IOU_PERCENT), area(F.col("runs"))), [label], max_dets, list(areas))


def bucket_precision(gt: DataFrame, dt: DataFrame, keys: list[str], buckets: DataFrame, **options: object) -> DataFrame:
    """bucket, metric, value: precision_summary of the images of each bucket (buckets: image_id, bucket), and bucket null: the mean over buckets.

    A bucket's classes are those of its images; a metric without truths is -1 in its bucket and counts so in the mean, as the metric is defined.
    """
    own = [k for k in keys if k != "image_id"]
    with_bucket = lambda df: df.join(buckets.select("image_id", "bucket"), "image_id")
    areas = options.pop("areas", None) or AREAS
    most = options.pop("max_dets", (1, 10, 100))
    flags = score_match(with_bucket(gt), with_bucket(dt), ["bucket", "image_id", *own], [p / 100 for p in IOU_PERCENT], most[-1], list(areas.values()))
    truths = truth_counts(with_bucket(gt), ["bucket", "class_id"], list(areas.values()), len(IOU_PERCENT))
    per = settled(summarised(flags, truths, ["bucket", "class_id"], most, list(areas), ["bucket"]))
    return per.unionByName(per.groupBy("metric").agg(F.avg("value").alias("value")).withColumn("bucket", F.lit(None).cast(per.schema["bucket"].dataType)))


#: Areas of video objects, by the mean box of a track.
VIDEO_AREAS = {"all": (0.0, 1e10), "small": (0.0, 128.0**2), "medium": (128.0**2, 256.0**2), "large": (256.0**2, 1e10)}


def video_precision(gt: DataFrame, dt: DataFrame, use_classes: bool = True, max_dets: tuple[int, ...] = (1, 10, 100)) -> DataFrame:
    """precision_summary over tracks: a video is an image, a track a box, overlap the tracklet overlap, area the track's mean.

    gt, dt: video_id, category_id, track_id, frame_idx, x, y, w, h, and dt's score (a track's is its mean). With use_classes the classes are
    matched and averaged apart; else a (video, phrase) pair is an image of its own and all phrases are one class. With runs and
    height in place of boxes, overlaps and areas are those of the masks.
    """
    keys = ["video_id", "category_id"]
    masks = "runs" in gt.columns
    size = area(F.col("runs")) if masks else F.col("w") * F.col("h")
    own = lambda df, name: df.groupBy(*keys, F.col("track_id").alias(name)).agg(F.avg(size).alias("area"), *([F.avg("score").alias("score")] if "score" in df.columns else []))
    truths, dets = own(gt, "ann_id"), own(dt, "det_id")
    shape = [c for c in (("runs", "height", "mx", "my", "mw", "mh") if masks else "xywh") if c in gt.columns]
    box = [*keys, "track_id", "frame_idx", *shape]
    iou = (tracklet_mask_iou if masks else tracklet_iou)(gt.select(*box), dt.select(*box), keys).select(*keys, F.col("gt_id").alias("ann_id"), F.col("dt_id").alias("det_id"), "iou").where(F.col("iou") >= IOU_PERCENT[0] / 100)
    pairs = iou.join(truths.select(*keys, "ann_id", F.col("area").alias("g_area")), [*keys, "ann_id"]).withColumn("g_crowd", F.lit(0))
    t = len(IOU_PERCENT)
    flags = score_assigned(dets.withColumnRenamed("area", "d_area"), pairs, keys, [p / 100 for p in IOU_PERCENT], max_dets[-1], list(VIDEO_AREAS.values()))
    label = F.col("category_id") if use_classes else F.lit(0)
    flags = flags.select(label.alias("class_id"), F.xxhash64(*keys).alias("image_id"), "det_id", "score", "rank", "flags")
    n = [F.array_repeat(F.count_if((F.col("area") >= lo) & (F.col("area") <= hi)), t) for lo, hi in VIDEO_AREAS.values()]
    return summarised(flags, truths.groupBy(label.alias("class_id")).agg(F.flatten(F.array(*n)).alias("n_gt")), ["class_id"], max_dets, list(VIDEO_AREAS))


def summarised(flags: DataFrame, truths: DataFrame, by: list[str], max_dets: tuple[int, ...], areas: list[str], apart: list[str] | None = None) -> DataFrame:
    """metric, value from a match's flags (by area, then threshold) and the truths of each class; for each value of `apart` (of `by`) on its own."""
    apart = apart or []
    flags, t = settled(flags), len(IOU_PERCENT)
    ap = settled(average_precision(flags, truths, by).withColumn("area", F.floor(F.col("k") / t).cast("int")).withColumn("t", F.col("k") % t))
    mean = lambda c, when: F.coalesce(F.avg(F.when(when, F.col(c))), F.lit(-1.0))
    all_ = F.col("area") == 0
    cols = {"AP": mean("ap", all_), "AP_50": mean("ap", all_ & (F.col("t") == 0)), "AP_75": mean("ap", all_ & (F.col("t") == 5))}
    cols |= {f"AP_{a}": mean("ap", F.col("area") == k) for k, a in enumerate(areas) if k}
    cols |= {f"AR@{max_dets[-1]}": mean("recall", all_)} | {f"AR_{a}": mean("recall", F.col("area") == k) for k, a in enumerate(areas) if k}
    one = ap.groupBy(*apart).agg(*(v.alias(k) for k, v in cols.items()))
    for m in max_dets[:-1]:
        hits = flags.where(F.col("rank") <= m).groupBy(*by).agg(F.array(*(F.count_if(F.col("flags")[k] == 1) for k in range(t))).alias("tp"))
        both = truths.join(hits, by, "left").where(F.col("n_gt")[0] > 0)
        share = F.aggregate(F.coalesce("tp", F.array_repeat(F.lit(0).cast("long"), t)), F.lit(0.0), lambda a, v: a + v) / t / F.col("n_gt")[0]
        found = both.groupBy(*apart).agg(F.coalesce(F.avg(share), F.lit(-1.0)).alias(f"AR@{m}"))
        one = one.join(found, apart, "left").fillna(-1.0, [f"AR@{m}"]) if apart else one.crossJoin(F.broadcast(found))  # one row
    names = [c for c in one.columns if c not in apart]
    return one.select(*apart, F.inline(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in names))))
