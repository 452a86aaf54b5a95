"""Track metrics: similarity over frames, HOTA, counts and audits. Ids travel, boxes do not, after the pair join."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import settled
from .groups import best_pairs, map_groups
from .masks import mask_pairs
from .nms import track_nms
from .pairs import iou_join

ALPHAS = list(range(5, 100, 5))
EPS = 2.220446049250313e-16


def similarity(gt: DataFrame, dt: DataFrame, seq: list[str], frame: str = "frame_idx") -> DataFrame:
    """seq, frame, gt_id, dt_id, sim of all pairs that overlap in a frame."""
    left = gt.select(*seq, frame, F.col("track_id").alias("ann_id"), *"xywh")
    right = dt.select(*seq, frame, F.col("track_id").alias("det_id"), *"xywh")
    pairs = iou_join(left, right, [*seq, frame], min_iou=0.0)
    return pairs.select(*seq, frame, F.col("ann_id").alias("gt_id"), F.col("det_id").alias("dt_id"), F.col("iou").alias("sim"))


def mask_similarity(gt: DataFrame, dt: DataFrame, seq: list[str], frame: str = "frame_idx") -> DataFrame:
    """similarity over masks (runs, height and their boxes mx, my, mw, mh)."""
    pairs = mask_pairs(gt.withColumnRenamed("track_id", "ann_id"), dt.withColumnRenamed("track_id", "det_id"), [*seq, frame])
    return pairs.select(*seq, frame, F.col("ann_id").alias("gt_id"), F.col("det_id").alias("dt_id"), F.col("iou").alias("sim"))


def alignment(sim: DataFrame, gt: DataFrame, dt: DataFrame, seq: list[str], frame: str = "frame_idx") -> DataFrame:
    """seq, gt_id, dt_id, align, g, d: the summed share of each pair in its frames' rows and columns, over the union of frames; g and d are the
    frames of either track."""
    row, col = Window.partitionBy(*seq, frame, "gt_id"), Window.partitionBy(*seq, frame, "dt_id")
    share = sim.withColumn("__s", F.col("sim") / (F.sum("sim").over(row) + F.sum("sim").over(col) - F.col("sim")))
    sums = share.groupBy(*seq, "gt_id", "dt_id").agg(F.sum("__s").alias("m"))
    n = lambda df, a, b: df.groupBy(*seq, F.col("track_id").alias(a)).agg(F.count(F.lit(1)).alias(b))
    out = sums.join(n(gt, "gt_id", "g"), [*seq, "gt_id"]).join(n(dt, "dt_id", "d"), [*seq, "dt_id"])
    return out.select(*seq, "gt_id", "dt_id", (F.col("m") / (F.col("g") + F.col("d") - F.col("m"))).alias("align"), "g", "d")


def frame_matches(sim: DataFrame, align: DataFrame, seq: list[str], frame: str = "frame_idx") -> DataFrame:
    """seq, frame, gt_id, dt_id, sim, g, d of the assignment that maximises align * sim in each frame."""
    rows = sim.join(align, [*seq, "gt_id", "dt_id"])
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    cols = [*seq, frame, "gt_id", "dt_id", "sim", "g", "d"]

    def match(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        score = (rows["align"] * rows["sim"]).to_numpy()
        return rows.iloc[best_pairs(rows["gt_id"].to_numpy(), rows["dt_id"].to_numpy(), score, starts)][cols]

    return map_groups(rows, [*seq, frame], match, ", ".join(f"{c} {fields[c]}" for c in cols), ["gt_id", "dt_id"])


def by_threshold(matched: DataFrame, pair: list[str], alphas: list[int], eps: float, least: Column | None = None, **sums: Column) -> DataFrame:
    """pair, alpha (percent), c and `sums`, each over the matches of a pair whose sim reaches alpha.

    A match is counted once, in the cell of the highest alpha that it reaches; cells are then summed from the top, so what grows
    with the number of thresholds is a row for each pair, not for each match.
    """
    reached = F.size(F.filter(F.array(*(F.lit(a / 100 - eps) for a in alphas)), lambda a: F.col("sim") >= a)) - 1
    cells = matched if least is None else matched.where(least)
    cells = cells.withColumn("__cell", reached).where("__cell >= 0").groupBy(*pair, "__cell").agg(F.count(F.lit(1)).alias("c"), *(F.sum(v).alias(k) for k, v in sums.items()))
    names = ["c", *sums]
    per = cells.groupBy(*pair).agg(*(F.array(*(F.sum(F.when(F.col("__cell") >= k, F.col(n))) for k in range(len(alphas)))).alias(n) for n in names))
    rows = per.select(*pair, F.posexplode(F.arrays_zip(*names)).alias("__k", "__s")).where("__s.c > 0")
    at = F.element_at(F.array(*map(F.lit, alphas)), F.col("__k") + 1)
    return rows.select(*pair, at.alias("alpha"), *(F.col(f"__s.{n}").alias(n) for n in names))


def hota(gt: DataFrame, dt: DataFrame, seq: list[str], frame: str = "frame_idx", measure: Callable[..., DataFrame] = similarity) -> DataFrame:
    """Per sequence and alpha (percent): tp, fn, fp, det_a, ass_a, loc_a, hota, and det_re, det_pr, ass_re, ass_pr, owta.

    `measure` gives the similarity of pairs: of boxes, or mask_similarity.
    """
    sim = settled(measure(gt, dt, seq, frame))  # read twice
    matched = frame_matches(sim, alignment(sim, gt, dt, seq, frame), seq, frame)
    pairs = by_threshold(matched, [*seq, "gt_id", "dt_id", "g", "d"], ALPHAS, EPS, s=F.col("sim"))
    ass = F.col("c") / F.greatest(F.lit(1), F.col("g") + F.col("d") - F.col("c"))
    c = F.col("c")
    by = pairs.groupBy(*seq, "alpha").agg(F.sum("c").alias("tp"), F.sum("s").alias("s"), F.sum(c * ass).alias("a"), F.sum(c * c / F.col("g")).alias("re"), F.sum(c * c / F.col("d")).alias("pr"))
    size = gt.groupBy(*seq).agg(F.count(F.lit(1)).alias("n_gt")).join(dt.groupBy(*seq).agg(F.count(F.lit(1)).alias("n_dt")), seq, "full").fillna(0, ["n_gt", "n_dt"])
    grid = size.withColumn("alpha", F.explode(F.array(*(F.lit(a) for a in ALPHAS))))
    out = grid.join(by, [*seq, "alpha"], "left").fillna(0, ["tp", "s", "a", "re", "pr"])
    tp, fn, fp = F.col("tp"), F.col("n_gt") - F.col("tp"), F.col("n_dt") - F.col("tp")
    det, ass_a = tp / F.greatest(F.lit(1), tp + fn + fp), F.col("a") / F.greatest(F.lit(1), tp)
    one_sided = (F.col("n_gt") == 0) | (F.col("n_dt") == 0)
    loc = F.when(one_sided | (tp == 0), F.lit(1.0)).otherwise(F.greatest(F.lit(1e-10), F.col("s")) / F.greatest(F.lit(1e-10), tp))
    re, pr = F.col("re") / F.greatest(F.lit(1), tp), F.col("pr") / F.greatest(F.lit(1), tp)
    return _final(out.select(*seq, "alpha", tp.alias("tp"), fn.alias("fn"), fp.alias("fp"), ass_a.alias("ass_a"), loc.alias("loc_a"), re.alias("ass_re"), pr.alias("ass_pr")), seq)


def _final(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Detection scores and the two means from counts and association."""
    tp, fn, fp = (F.col(c) for c in ("tp", "fn", "fp"))
    det, re, pr = (tp / F.greatest(F.lit(1), n) for n in (tp + fn + fp, tp + fn, tp + fp))
    cols = [*keys, "alpha", "tp", "fn", "fp", det.alias("det_a"), "ass_a", "loc_a", F.sqrt(det * F.col("ass_a")).alias("hota")]
    return rows.select(*cols, re.alias("det_re"), pr.alias("det_pr"), "ass_re", "ass_pr", F.sqrt(re * F.col("ass_a")).alias("owta"))


def combine_hota(per_seq: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """All sequences (of each of `keys`: a class, a tag) as one, per alpha: counts add up, association and location are
    weighted by their matches. Over classes this is the detection average."""
    keys = keys or []
    weighted = lambda c: (F.sum(F.col(c) * F.col("tp")) / F.greatest(F.lit(1), F.sum("tp"))).alias(c)
    by = per_seq.groupBy(*keys, "alpha").agg(*(weighted(c) for c in ("ass_a", "loc_a", "ass_re", "ass_pr")), *(F.sum(c).alias(c) for c in ("tp", "fn", "fp")))
    return _final(by, keys)


def average_hota(per_class: DataFrame, keys: list[str] | None = None, ignore_empty: bool = False) -> DataFrame:
    """Class average, per alpha: counts add up, every other score is the mean over the classes (those with any box, if
    `ignore_empty`). `keys` may name super-categories."""
    rows = per_class.where("tp + fn + fp > 0") if ignore_empty else per_class
    means = ["det_a", "ass_a", "loc_a", "hota", "det_re", "det_pr", "ass_re", "ass_pr", "owta"]
    return rows.groupBy(*(keys or []), "alpha").agg(*(F.sum(c).alias(c) for c in ("tp", "fn", "fp")), *(F.avg(c).alias(c) for c in means))


def class_agnostic_hota(gt: DataFrame, dt: DataFrame, video: str = "video_id", thr: float = 0.5) -> DataFrame:
    """HOTA per video with all classes as one: tracks are suppressed across classes first, and truth ids made unique."""
    kept = track_nms(dt, [video], thr)
    ids = gt.select(video, "category_id", "track_id").distinct()
    own = gt.withColumn("track_id", F.xxhash64("category_id", "track_id")) if ids.select(video, "track_id").distinct().count() < ids.count() else gt
    return hota(own, kept, [video])


def counts(gt: DataFrame, dt: DataFrame, seq: list[str]) -> DataFrame:
    """Per sequence: boxes, ids and frames on both sides."""
    left = gt.groupBy(*seq).agg(F.count(F.lit(1)).alias("gt_dets"), F.count_distinct("track_id").alias("gt_ids"))
    right = dt.groupBy(*seq).agg(F.count(F.lit(1)).alias("dets"), F.count_distinct("track_id").alias("ids"))
    frames = gt.select(*seq, "frame_idx").unionByName(dt.select(*seq, "frame_idx")).groupBy(*seq).agg(F.count_distinct("frame_idx").alias("frames"))
    return frames.join(left, seq, "left").join(right, seq, "left").fillna(0)


def repeated_ids(rows: DataFrame, seq: list[str]) -> DataFrame:
    """Track ids that occur more than once in a frame."""
    return rows.groupBy(*seq, "frame_idx", "track_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
