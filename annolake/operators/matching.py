"""Assignments within an image or frame: greedy, optimal, and by score."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .groups import best_pairs, group_of, map_groups, repeated_in
from .pairs import iou_join


def greedy_match(gt: DataFrame, dt: DataFrame, keys: list[str], thr: float = 0.5) -> DataFrame:
    """keys, ann_id, det_id, iou: each truth, in the order of ann_id, takes the unused detection of highest iou.

    The first detection wins a tie; a pair counts from `thr` on. Truths without a match keep a null det_id.
    """
    if thr <= 0:
        raise ValueError("thr must be above 0")
    # a pair below the threshold can never be taken, and taking it would not count: only the rest is shipped
    pairs = iou_join(gt, dt, keys).where(F.col("iou") >= thr).select(*keys, "ann_id", "det_id", "iou")
    fields = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def match(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        ann, det, group = rows["ann_id"].to_numpy(), rows["det_id"].to_numpy(), group_of(starts)
        # the first row of a truth is its best; where no two truths of a group have the same best, all get it
        take = np.ones(len(rows), bool)
        take[1:] = (group[1:] != group[:-1]) | (ann[1:] != ann[:-1])
        hard = repeated_in(group[take], det[take])
        take[np.isin(group, hard)] = False
        for k in hard.tolist():
            a, b = int(starts[k]), int(starts[k + 1])
            used: set = set()
            at = a
            while at < b:
                stop = at
                while stop < b and ann[stop] == ann[at]:
                    stop += 1
                for k in range(at, stop):  # best iou first
                    if det[k] not in used:
                        used.add(det[k])
                        take[k] = True
                        break
                at = stop
        return rows[take]

    best_first = pairs.withColumn("__order", -F.col("iou"))
    schema = ", ".join(f"{k} {fields[k]}" for k in [*keys, "ann_id", "det_id", "iou"])
    taken = map_groups(best_first, keys, lambda r, s: match(r, s).drop(columns="__order"), schema, ["ann_id", "__order", "det_id"])
    return gt.select(*keys, "ann_id").join(taken, [*keys, "ann_id"], "left")


def optimal_match(gt: DataFrame, dt: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ann_id, det_id, iou: the assignment that maximises the summed iou of each group.

    Only ids and overlaps travel. Pairs without overlap never change the sum, so they are left out.
    """
    return assigned(iou_join(gt, dt, keys, min_iou=0.0), keys)


def assigned(pairs: DataFrame, keys: list[str], more: list[str] | None = None) -> DataFrame:
    """The assignment of given pairs (keys, ann_id, det_id, iou) that maximises the summed iou of each group; `more` names further columns to keep."""
    cols = [*keys, "ann_id", "det_id", "iou", *(more or [])]
    pairs = pairs.select(*cols)
    fields = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def match(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        return rows.iloc[best_pairs(rows["ann_id"].to_numpy(), rows["det_id"].to_numpy(), rows["iou"].to_numpy(), starts)]

    schema = ", ".join(f"{k} {fields[k]}" for k in cols)
    return map_groups(pairs, keys, match, schema, ["ann_id", "det_id"])


#: Lower and upper bounds of an object's area.
AREAS = {"all": (0.0, 1e10), "small": (0.0, 32.0**2), "medium": (32.0**2, 96.0**2), "large": (96.0**2, 1e10)}


def score_match(gt: DataFrame, dt: DataFrame, keys: list[str], thresholds: list[float], max_dets: int = 100, areas: list[tuple[float, float]] | None = None) -> DataFrame:
    """keys, det_id, score, rank, flags: detections by falling score each take the best truth that is free.

    flags holds, per area range and within it per threshold, 1 matched, 0 not, -1 ignored. A crowd truth (iscrowd 1) can be taken many times
    and turns its detection to ignored; so does a truth outside the area range, which is taken once and after all others; an
    unmatched detection outside the range is ignored. Of equal overlaps the later truth wins. `rank` is the detection's place in its group.
    """
    # one join, by the keys: its rows are not shuffled again to be matched
    rows = iou_join(gt, dt.select(*keys, "det_id", "score", *"xywh"), keys, crowd="iscrowd", every=min(thresholds))
    rows = rows.select(*keys, "det_id", "score", (F.col("d_w") * F.col("d_h")).alias("d_area"), "ann_id", "g_crowd", "iou", (F.col("g_w") * F.col("g_h")).alias("g_area"))
    return score_taken(rows, keys, thresholds, max_dets, areas)


def score_assigned(dets: DataFrame, pairs: DataFrame, keys: list[str], thresholds: list[float], max_dets: int = 100, areas: list[tuple[float, float]] | None = None) -> DataFrame:
    """score_match on given pairs (keys, ann_id, det_id, g_crowd, g_area, iou) of detections (keys, det_id, score, d_area)."""
    return score_taken(dets.join(pairs, [*keys, "det_id"], "left"), keys, thresholds, max_dets, areas)


def score_taken(rows: DataFrame, keys: list[str], thresholds: list[float], max_dets: int = 100, areas: list[tuple[float, float]] | None = None) -> DataFrame:
    """score_match on detections (keys, det_id, score, d_area) with the truths that they may take (ann_id, g_crowd, g_area, iou): a row for each
    pair, and one with nulls for a detection without any. Pairs below the thresholds do no harm."""
    areas = areas or [AREAS["all"]]
    rows = rows.withColumn("__order", -F.col("score"))
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    tops = [min(t, 1 - 1e-10) for t in thresholds]

    def match(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        det, ann, iou, crowd = (rows[c].tolist() for c in ("det_id", "ann_id", "iou", "g_crowd"))
        g_area, d_area = rows["g_area"].tolist(), rows["d_area"].tolist()
        group = group_of(starts)
        # where no detection has two candidates and no truth two suitors, every pair stands alone
        hard = repeated_in(group, rows["det_id"].to_numpy())
        has = rows["ann_id"].notna().to_numpy()
        hard = np.union1d(hard, repeated_in(group[has], rows["ann_id"].to_numpy()[has]))
        place = np.arange(len(rows)) - starts[group] + 1
        easy = np.flatnonzero(~np.isin(group, hard) & (place <= max_dets))
        v = rows["iou"].to_numpy(dtype=float, na_value=-1.0)[easy, None] >= np.array(tops)
        parts = []
        for lo, hi in areas:
            g, d = rows["g_area"].to_numpy(dtype=float, na_value=lo)[easy], rows["d_area"].to_numpy()[easy]
            ignored = ((rows["g_crowd"].to_numpy(dtype=float, na_value=0)[easy] != 0) | (g < lo) | (g > hi))[:, None]
            outside = ((d < lo) | (d > hi))[:, None]
            parts.append(np.where(v & ~ignored, 1, np.where(v | outside, -1, 0)))
        first, flags, ranks = easy.tolist(), np.hstack(parts).tolist(), place[easy].tolist()
        for number in hard.tolist():
            a, b = int(starts[number]), int(starts[number + 1])
            used: list[set] = [set() for _ in range(len(areas) * len(tops))]
            at, n = a, 0
            while at < b and n < max_dets:
                stop = at + 1
                while stop < b and det[stop] == det[at]:
                    stop += 1
                some = []
                for lo, hi in areas:
                    outside = not lo <= d_area[at] <= hi
                    plain, ignored = [], []
                    if iou[at] == iou[at]:  # it overlaps a truth
                        for j in range(at, stop):
                            (ignored if crowd[j] or not lo <= g_area[j] <= hi else plain).append(j)
                    for top in tops:
                        taken, got, best = used[len(some)], -1, top
                        for j in plain:
                            if iou[j] >= best and ann[j] not in taken:
                                got, best = j, iou[j]
                        flag = int(got >= 0)
                        if got < 0:
                            for j in ignored:
                                if iou[j] >= best and (crowd[j] or ann[j] not in taken):
                                    got, best = j, iou[j]
                            flag = -1 if got >= 0 or outside else 0
                        if got >= 0:
                            taken.add(ann[got])
                        some.append(flag)
                first.append(at)
                flags.append(some)
                n += 1
                ranks.append(n)
                at = stop
        out = rows.iloc[first][[*keys, "det_id", "score"]].copy()
        out["rank"], out["flags"] = ranks, flags
        return out

    schema = ", ".join(f"{k} {fields[k]}" for k in [*keys, "det_id", "score"]) + ", rank int, flags array<tinyint>"
    return map_groups(rows, keys, match, schema, ["__order", "det_id", "ann_id"])


def only_positive(dt: DataFrame, gt: DataFrame, keys: list[str]) -> DataFrame:
    """Detections of the classes that their image has truths of."""
    return dt.join(gt.select(*keys).distinct(), keys, "left_semi")


def without_unlabelled(dt: DataFrame, gt: DataFrame, keys: list[str], labelled: DataFrame, thr: float = 0.5) -> DataFrame:
    """Detections less those that may be right though no truth matches them.

    keys begin with the sequence and the class. labelled: both, and `state`: negative (verified absent) or partial (not exhaustively
    labelled). After an optimal match from `thr` on, an unmatched detection goes if its class is partial, or if its
    frame has no truth of the class and the class is not verified absent.
    """
    seq = keys[:2]
    pairs = iou_join(gt, dt, keys).where(F.col("iou") >= thr - 2.220446049250313e-16).select(*keys, "ann_id", "det_id", "iou")
    hit = assigned(pairs, keys).select(*keys, "det_id", F.lit(True).alias("__hit"))
    there = gt.select(*keys, F.lit(True).alias("__there")).distinct()
    state = labelled.select(*seq, F.col("state").alias("__state"))
    all_ = dt.join(hit, [*keys, "det_id"], "left").join(there, keys, "left").join(state, seq, "left")
    gone = F.col("__hit").isNull() & ((F.col("__state") == "partial") | (F.col("__there").isNull() & ~F.col("__state").eqNullSafe("negative")))
    return all_.where(~F.coalesce(gone, F.lit(False))).drop("__hit", "__there", "__state")
