"""Group algorithms and metrics that SQL cannot express, against plain Python over a whole small table."""

from collections import defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from annolake.operators import associate, evaluation, matching, metrics, prep, tracks
from annolake.plans import fixtures as fx
from annolake.plans.evaluations import ell_masks

THRESHOLDS = [p / 100 for p in metrics.IOU_PERCENT]


def size(r):
    return len(r["cells"]) if "cells" in r else r["w"] * r["h"]


def iou(a, b, crowd=False):
    if "cells" in a:
        i = len(a["cells"] & b["cells"])
        return i / whole if (whole := len(b["cells"]) if crowd else len(a["cells"] | b["cells"])) else 0.0
    w = min(a["x"] + a["w"], b["x"] + b["w"]) - max(a["x"], b["x"])
    h = min(a["y"] + a["h"], b["y"] + b["h"]) - max(a["y"], b["y"])
    i = max(w, 0) * max(h, 0)
    return i / (b["w"] * b["h"] if crowd else a["w"] * a["h"] + b["w"] * b["h"] - i)


def with_cells(r, scale):
    """A row with the pixels of its mask: its box without the upper right quarter, on the canvas of the queries."""
    at = lambda v, top: max(0, min(int(v // scale), top))
    x1, x2, y1, y2 = at(r["x"], 160), at(r["x"] + r["w"], 160), at(r["y"], 120), at(r["y"] + r["h"], 120)
    return r | {"cells": {(x, y) for x in range(x1, x2) for y in range(y1 if x < (x1 + x2) // 2 else (y1 + y2) // 2, y2)}}


@pytest.fixture(scope="module")
def boxes(spark, sf):
    gt, dt = fx.gt_boxes(spark, sf).cache(), fx.pred_boxes(spark, sf).cache()
    by = defaultdict(lambda: ([], []))
    for k, df in enumerate((gt, dt)):
        for r in df.collect():
            by[r.image_id, r.class_id][k].append(r.asDict())
    return gt, dt, by


@pytest.fixture(scope="module")
def shapes(boxes):
    """gt and dt as masks, and their rows with pixels."""
    gt, dt, by = boxes
    return ell_masks(gt, 4), ell_masks(dt, 4), {k: tuple([with_cells(r, 4) for r in rows] for rows in both) for k, both in by.items()}


def track_rows(spark, sf, shape, where="true"):
    """Tables of tracks with boxes or masks, how to measure them, and their rows."""
    tables = [t.where(where) for t in (fx.tracks_gt(spark, sf), fx.tracks_pred(spark, sf))]
    rows = [[r.asDict() for r in t.collect()] for t in tables]
    if shape == "box":
        return *tables, tracks.similarity, *rows
    return *(ell_masks(t, 2) for t in tables), tracks.mask_similarity, *([with_cells(r, 2) for r in some] for some in rows)


def plain_flags(truths, dets, areas, most=100):
    """Per detection its flags, in the order of score."""
    truths, dets = sorted(truths, key=lambda g: g["ann_id"]), sorted(dets, key=lambda d: (-d["score"], d["det_id"]))[:most]
    out = {d["det_id"]: [] for d in dets}
    for lo, hi in areas:
        ignored = [g["iscrowd"] or not lo <= size(g) <= hi for g in truths]
        for thr in THRESHOLDS:
            used = set()
            for d in dets:
                best, got = min(thr, 1 - 1e-10), None
                for j in sorted(range(len(truths)), key=lambda j: ignored[j]):
                    g = truths[j]
                    if j in used and not g["iscrowd"]:
                        continue
                    if got is not None and not ignored[got] and ignored[j]:
                        break
                    v = iou(g, d, g["iscrowd"])
                    if v >= best and v > 0:
                        best, got = v, j
                if got is not None:
                    used.add(got)
                outside = not lo <= size(d) <= hi
                out[d["det_id"]].append(-1 if (got is not None and ignored[got]) or (got is None and outside) else int(got is not None))
    return out


def plain_summary(by, areas):
    """Metric to value, over classes."""
    classes = {c for _, c in by}
    ap, ar = defaultdict(list), defaultdict(list)
    for c in classes:
        flags = {key: plain_flags(*by[key], areas.values()) for key in by if key[1] == c}
        rows = sorted((-d["score"], key[0], d["det_id"], flags[key][d["det_id"]]) for key in flags for d in by[key][1])
        for a, (name, (lo, hi)) in enumerate(areas.items()):
            n_gt = sum(not g["iscrowd"] and lo <= size(g) <= hi for key in flags for g in by[key][0])
            if not n_gt:
                continue
            for t in range(10):
                tp = n = 0
                curve = []
                for *_, f in rows:
                    v = f[10 * a + t]
                    tp, n = tp + (v == 1), n + (v >= 0)
                    curve.append((tp / n_gt, tp / n if n else 0.0))
                for k in range(len(curve) - 2, -1, -1):
                    curve[k] = (curve[k][0], max(curve[k][1], curve[k + 1][1]))
                score = sum(next((p for r, p in curve if r >= g / 100 - 1e-12), 0.0) for g in range(101)) / 101
                ap[name, t].append(score)
                ar[name, t].append(tp / n_gt)
    mean = lambda d, name, ts: (lambda v: sum(v) / len(v) if v else -1.0)([x for t in ts for x in d[name, t]])
    out = {"AP": mean(ap, "all", range(10)), "AP_50": mean(ap, "all", [0]), "AP_75": mean(ap, "all", [5]), "AR@100": mean(ar, "all", range(10))}
    for name in list(areas)[1:]:
        out |= {f"AP_{name}": mean(ap, name, range(10)), f"AR_{name}": mean(ar, name, range(10))}
    return out


def test_precision_by_area(boxes):
    gt, dt, by = boxes
    got = {r.metric: r.value for r in metrics.precision_summary(gt, dt, ["image_id", "class_id"]).collect()}
    for metric, value in plain_summary(by, matching.AREAS).items():
        assert got[metric] == pytest.approx(value, abs=1e-9), metric
    assert got["AR@1"] <= got["AR@10"] <= got["AR@100"] + 1e-12


def test_precision_on_positives(boxes):
    gt, dt, by = boxes
    kept = {key: (g, d if g else []) for key, (g, d) in by.items()}
    got = {r.metric: r.value for r in metrics.precision_summary(gt, matching.only_positive(dt, gt, ["image_id", "class_id"]), ["image_id", "class_id"]).collect()}
    assert got["AP"] == pytest.approx(plain_summary(kept, matching.AREAS)["AP"], abs=1e-9)


def test_optimal_matches_reach_the_best_sum(boxes):
    gt, dt, by = boxes
    got = defaultdict(float)
    for r in matching.optimal_match(gt, dt, ["image_id", "class_id"]).collect():
        got[r.image_id, r.class_id] += r.iou
    for key, (truths, dets) in by.items():
        if truths and dets and max(len(truths), len(dets)) <= 6:
            small, large = sorted((truths, dets), key=len)
            best = max(sum(iou(a, b) for a, b in zip(small, p, strict=True)) for p in permutations(large, len(small)))
            assert got[key] == pytest.approx(best, abs=1e-9)


@pytest.mark.parametrize("shape", ["box", "mask"])
def test_hota(spark, sf, shape):
    gt, dt, measure, *rows = track_rows(spark, sf, shape)
    got = {(r.video_id, r.alpha): r for r in tracks.hota(gt, dt, ["video_id"], measure=measure).collect()}
    for video in {r["video_id"] for r in rows[0]}:
        frames = defaultdict(lambda: ([], []))
        n = [defaultdict(int), defaultdict(int)]
        for k in (0, 1):
            for r in rows[k]:
                if r["video_id"] == video:
                    frames[r["frame_idx"]][k].append(r)
                    n[k][r["track_id"]] += 1
        share, sims = defaultdict(float), {}
        for f, (a, b) in frames.items():
            s = {(x["track_id"], y["track_id"]): iou(x, y) for x in a for y in b}
            sims[f] = s
            for (g, d), v in s.items():
                whole = sum(v2 for (g2, _), v2 in s.items() if g2 == g) + sum(v2 for (_, d2), v2 in s.items() if d2 == d) - v
                share[g, d] += v / whole if whole > 0 else 0.0
        align = {(g, d): m / (n[0][g] + n[1][d] - m) for (g, d), m in share.items()}
        matched = []
        for s in sims.values():
            gs, ds = sorted({g for g, _ in s}), sorted({d for _, d in s})
            small, large, turn = (gs, ds, False) if len(gs) <= len(ds) else (ds, gs, True)
            if small:
                pairs = max(([(b, a) if turn else (a, b) for a, b in zip(small, p, strict=True)] for p in permutations(large, len(small))), key=lambda ps: round(sum(align[q] * s[q] for q in ps), 12))
                matched += [(q, s[q]) for q in pairs]
        for alpha in (5, 50, 95):
            hits = [q for q, v in matched if v >= alpha / 100 - 2.3e-16]
            c = {q: hits.count(q) for q in set(hits)}
            tp = len(hits)
            ass = sum(k * k / (n[0][g] + n[1][d] - k) for (g, d), k in c.items()) / max(1, tp)
            r = got[video, alpha]
            assert (r.tp, r.fn, r.fp) == (tp, sum(n[0].values()) - tp, sum(n[1].values()) - tp)
            assert r.ass_a == pytest.approx(ass, abs=1e-9) and r.hota == pytest.approx((r.det_a * ass) ** 0.5, abs=1e-9)
            assert r.ass_re == pytest.approx(sum(k * k / n[0][g] for (g, _), k in c.items()) / max(1, tp), abs=1e-9)


def test_video_precision_of_perfect_tracks(spark, sf):
    gt = fx.tracks_gt(spark, sf)
    got = {r.metric: r.value for r in metrics.video_precision(gt, gt.withColumn("score", F.lit(0.5))).collect()}
    assert got["AP"] == pytest.approx(1.0) and got["AR@100"] == pytest.approx(1.0) and got["AP_large"] == -1.0
    apart = {r.metric: r.value for r in metrics.video_precision(gt, gt.withColumn("score", F.lit(0.5)), use_classes=False).collect()}
    assert apart["AP"] == pytest.approx(1.0)


def test_demo_metrics_micro_case(spark):
    per = spark.createDataFrame([(1, 2, 2, [2, 1]), (2, 0, 1, [0, 0]), (3, 1, 0, [0, 0]), (4, 0, 0, [0, 0]), (5, 0, 0, [0, 0])], "image_id long, n_gt long, n_dt long, tps array<long>")
    jf = spark.createDataFrame([(1, 0.8, 0.6)], "image_id long, j double, f double")
    r = metrics.demo_metrics(per, jf).where("iou_percent = 50").first()
    assert (r.il_perfect_pos, r.il_perfect_neg) == (pytest.approx(0.5), pytest.approx(2 / 3))
    assert (r.j, r.f, r.j_and_f) == (pytest.approx(0.8), pytest.approx(0.6), pytest.approx(0.7))
    assert r.precision == pytest.approx(2 / 3, abs=1e-4) and r.recall == pytest.approx(2 / 3, abs=1e-4) and r.positive_w0dt_macro_f1 == pytest.approx(1.0, abs=1e-3)
    total = {x.metric: x.value for x in metrics.phrase_summary(metrics.demo_metrics(per), ["f1"], ["il_mcc"]).collect()}
    both = [x.f1 for x in metrics.demo_metrics(per).collect()]
    assert total["f1"] == pytest.approx(sum(both) / len(both)) and total["f1@0.5"] == pytest.approx(r.f1) and total["il_mcc"] == pytest.approx(r.il_mcc)


def test_one_to_one_association(spark):
    box = "video_id long, frame_idx long, {} long, x double, y double, w double, h double"
    dets = spark.createDataFrame([(1, 0, 1, 0.0, 0.0, 10.0, 10.0, 0.9), (1, 0, 2, 0.0, 0.0, 10.0, 9.0, 0.9), (1, 0, 3, 90.0, 0.0, 9.0, 9.0, 0.3)], box.format("det_id") + ", score double")
    own = spark.createDataFrame([(1, 0, 7, 0.0, 0.0, 10.0, 10.0), (1, 0, 8, 0.0, 0.0, 10.0, 8.0), (1, 0, 9, 0.0, 0.0, 0.0, 0.0)], box.format("track_id"))
    found, states = associate.associate_one_to_one(dets, own, ["video_id", "frame_idx"])
    assert {(r.det_id, r.track_id, r.is_new) for r in found.collect()} == {(1, 7, False), (2, 8, False), (3, None, False)}
    assert {(r.track_id, r.state) for r in states.collect()} == {(7, "matched"), (8, "matched"), (9, "empty")}


def test_hashed_order_takes_any_key(spark):
    rows = spark.createDataFrame([(4_000_000_000,), (2**62,), (-5,)], "k long")
    got = [r.h for r in rows.select(prep.hashed(F.col("k"), 7).alias("h")).collect()]
    assert got == [((k % 1000003) * 2654435761 + 7) % 1000003 for k in (4_000_000_000, 2**62, -5)]


def test_first_empty_frame_and_a_run_of_them(spark):
    from annolake.operators import label_qa

    frames = spark.createDataFrame([(1, f, "empty" if n == 0 else "ok") for f, n in enumerate([0, 2, 0, 0, 1])], "video_id long, frame_idx long, status string")
    counts = spark.createDataFrame([(1, 1, 1, 2), (1, 4, 1, 1)], "video_id long, frame_idx long, category_id int, n int")
    got = [(r.frame_idx, r.kind) for r in label_qa.frame_warnings(frames, counts, spark.createDataFrame([(1,)], "category_id int")).collect()]
    assert sorted(got) == [(2, "all_missing"), (2, "class_missing")]


def test_boundary_against_its_definition():
    import numpy as np

    from annolake.operators import masks

    rng = np.random.default_rng(1)
    for _ in range(30):
        h, w = rng.integers(1, 8, 2)
        m = rng.random((h, w)) < 0.5
        for i in range(h):
            for j in range(w):
                near = [m[a, b] for a, b in ((i, j + 1), (i + 1, j), (i + 1, j + 1)) if a < h and b < w]
                assert masks.boundary(m)[i, j] == any(m[i, j] != x for x in near)
        r = int(rng.integers(0, 4))
        for i in range(h):
            for j in range(w):
                assert masks.dilate(m, r)[i, j] == m[max(0, i - r) : i + r + 1, max(0, j - r) : j + r + 1].any()


def test_few_is_checked(spark):
    from annolake.operators.cut import few

    with pytest.raises(ValueError, match="more than 3"):
        few(spark.range(5), "id", 3)
    assert evaluation.merged_categories(spark.range(3).withColumnRenamed("id", "category_id"), {7: [0, 2]}).collect()[0][0] == 7


def assignment(score):
    """Pairs of the best assignment of a {(row, column): score}, whatever is on pairs that are not there."""
    gs, ds = sorted({g for g, _ in score}), sorted({d for _, d in score})
    small, large, turn = (gs, ds, False) if len(gs) <= len(ds) else (ds, gs, True)
    pairs = lambda p: [(b, a) if turn else (a, b) for a, b in zip(small, p, strict=True)]
    best = max((pairs(p) for p in permutations(large, len(small))), key=lambda ps: round(sum(score.get(q, 0) for q in ps), 12), default=[])
    return [q for q in best if score.get(q, 0) > 0]


def aligned(sims, n_gt, n_dt):
    share = defaultdict(float)
    for s in sims.values():
        for (g, d), v in s.items():
            share[g, d] += v / (sum(x for (g2, _), x in s.items() if g2 == g) + sum(x for (_, d2), x in s.items() if d2 == d) - v)
    return {(g, d): m / (n_gt[g] + n_dt[d] - m) for (g, d), m in share.items()}


@pytest.mark.parametrize(("shape", "exhaustive"), [("box", True), ("box", False), ("mask", True)])
def test_teta(spark, sf, shape, exhaustive):
    from annolake.operators import teta

    # some predictions under another class, and some that lie on nothing
    gt, dt, measure, g_rows, d_rows = track_rows(spark, sf, shape, "video_id % 3 <> 0")
    other = F.when(F.col("track_id") % 5 == 0, (F.col("category_id") % 5) + 1).otherwise(F.col("category_id"))
    dt = dt.withColumn("category_id", other.cast("int"))
    if shape == "box":
        dt = dt.withColumn("x", F.when(F.col("track_id") % 7 == 0, F.col("x") + 500).otherwise(F.col("x")))
    else:
        empty = F.array(F.lit(120 * 160))
        dt = dt.withColumn("runs", F.when(F.col("track_id") % 7 == 0, empty).otherwise(F.col("runs")))
    for r in d_rows:
        r["category_id"] = r["category_id"] % 5 + 1 if r["track_id"] % 5 == 0 else r["category_id"]
        if r["track_id"] % 7 == 0:
            r |= {"x": r["x"] + 500} if shape == "box" else {"cells": set()}
    got = {(r.cls, r.alpha): r for r in teta.teta(gt, dt, measure=measure, exhaustive=exhaustive).collect()}
    classes, alphas = {r["category_id"] for r in g_rows}, (5, *range(50, 100, 5))
    s = {(c, a): defaultdict(float) for c in range(1, 6) for a in alphas}
    for video in {r["video_id"] for r in g_rows} | {r["video_id"] for r in d_rows}:
        frames = defaultdict(lambda: ([], []))
        for k, rows in enumerate((g_rows, d_rows)):
            for r in rows:
                if r["video_id"] == video:
                    frames[r["frame_idx"]][k].append(r)
        sim = {f: {(x["track_id"], y["track_id"]): v for x in a for y in b if (v := iou(x, y)) > 0} for f, (a, b) in frames.items()}
        cls_of = {x["track_id"]: x["category_id"] for a, _ in frames.values() for x in a}

        def count(rows_of, ids=None):
            n = defaultdict(int)
            for pair in frames.values():
                for r in pair[rows_of]:
                    if ids is None or r["track_id"] in ids:
                        n[r["track_id"]] += 1
            return n

        near = {d for x in sim.values() for (_, d), v in x.items() if v >= 0.5}
        on = {f: {q: v for q, v in x.items() if q[1] in near} for f, x in sim.items()}
        al = aligned(on, count(0), count(1, near))
        taken = {f: {d: cls_of[g] for g, d in assignment({q: al[q] * v for q, v in x.items()}) if x[g, d] >= 0.5 - 1e-15} for f, x in on.items()}
        for c in range(1, 6):
            over = {f: {d for (g, d), v in x.items() if v >= 0.5 and cls_of[g] == c} - {d for d, of in taken[f].items() if of != c} for f, x in sim.items()}
            ids = set().union(*over.values()) if over else set()
            own = {f: {(g, d): v for (g, d), v in x.items() if cls_of[g] == c and d in ids} for f, x in sim.items()}
            n_g, n_d = count(0, {t for t, k in cls_of.items() if k == c}), count(1, ids)
            al = aligned(own, n_g, n_d)
            pairs = {f: assignment({q: al[q] * v for q, v in x.items()}) for f, x in own.items()}
            for a in alphas:
                hits = [(f, q) for f, ps in pairs.items() for q in ps if own[f][q] >= a / 100 - 1e-15]
                kinds = [next(r["category_id"] for r in frames[f][1] if r["track_id"] == d) for f, (_, d) in hits]
                v, times = s[c, a], defaultdict(int)
                for f, q in hits:
                    times[q] += 1
                v["tp"] += len(hits)
                v["fn"] += sum(n_g.values()) - len(hits)
                v["fp"] += sum(len(o - {d for f2, (_, d) in hits if f2 == f}) for f, o in over.items())
                v["assoc"] += sum(k * k / (n_g[g] + n_d[d] - k) for (g, d), k in times.items())
                v["cls_tp"] += sum(k == c for k in kinds)
                v["cls_fn"] += sum(k != c for k in kinds)
                v["cls_fp"] += exhaustive * sum(len({r["track_id"] for r in b if r["category_id"] == c} - over[f]) for f, (_, b) in frames.items())
                for k in kinds:
                    if k != c:
                        s[k, a]["cls_fp"] += 1
    assert any(v["cls_fn"] for v in s.values()) and any(v["fp"] for v in s.values())
    for c in classes:
        for a in alphas:
            v, r = s[c, a], got[c, a]
            assert (r.loc_tp, r.loc_fn, r.loc_fp) == (v["tp"], v["fn"], v["fp"]), (c, a)
            assert r.assoc_a == pytest.approx(v["assoc"] / max(1, v["tp"]), abs=1e-9)
            assert r.teta == pytest.approx((r.loc_a + r.assoc_a + r.cls_a) / 3, abs=1e-12)
        high = [s[c, a] for a in alphas if a >= 50]
        share = [v["cls_tp"] / max(1, v["cls_tp"] + v["cls_fn"] + v["cls_fp"]) for v in high]
        assert got[c, 50].cls_a == pytest.approx(sum(share) / 10, abs=1e-9)


def hits_at(truths, dets):
    """Matches at each of the ten thresholds of the assignment with the greatest summed overlap."""
    import numpy as np

    from annolake.operators.groups import hungarian

    if not truths or not dets:
        return [0] * 10
    m = np.array([[iou(g, d) for d in dets] for g in truths])
    found = [m[i, j] for i, j in zip(*hungarian(-m), strict=True) if m[i, j] > 0]
    return [sum(round(v, 12) >= t for v in found) for t in THRESHOLDS]


def plain_f1(tp, fp, fn, eps=1e-4):
    p, r = tp / (tp + fp + eps), tp / (tp + fn + eps)
    return 2 * p * r / (p + r + eps)


def by_image(rows):
    out = defaultdict(list)
    for r in rows:
        out[r["image_id"]].append(r)
    return out


def test_phrase_metrics_and_oracle_over_a_whole_table(spark, sf):
    from annolake.plans.queries import QUERIES

    gt = [r.asDict() for r in fx.gt_boxes(spark, sf).where("iscrowd = 0").collect()]
    dt = by_image(r.asDict() for r in fx.pred_boxes(spark, sf).where("score >= 0.5").collect())
    images = {r.id: r.is_instance_exhaustive for r in fx.images(spark, sf).collect()}
    own = by_image(gt)
    rows = [(len(own[i]), len(dt[i]), hits_at(own[i], dt[i])) for i, e in images.items() if e == 1]
    got = {r.iou_percent: r for r in QUERIES["phrase_cgf1"](spark, sf).collect()}
    tp_, fp_, fn_, tn_ = (sum(1 for g, d, _ in rows if (g > 0, d > 0) == k) for k in ((True, True), (False, True), (True, False), (False, False)))
    mcc = (tp_ * tn_ - fp_ * fn_) / (((tp_ + fp_) * (tp_ + fn_) * (tn_ + fp_) * (tn_ + fn_)) ** 0.5 + 1e-6)
    for k, p in enumerate(metrics.IOU_PERCENT):
        tp, fp, fn = sum(h[k] for _, _, h in rows), sum(d - h[k] for _, d, h in rows), sum(g - h[k] for g, _, h in rows)
        pos_fp = sum(d - h[k] for g, d, h in rows if g)
        local = [plain_f1(h[k], d - h[k], g - h[k]) for g, d, h in rows if g and d]
        r = got[p]
        assert (r.tp, r.fp, r.fn, r.pos_fp, r.il_tp, r.il_fp, r.il_fn, r.il_tn) == (tp, fp, fn, pos_fp, tp_, fp_, fn_, tn_)
        assert r.positive_macro_f1 == pytest.approx(sum(local) / len(local), abs=2e-6) and r.il_mcc == pytest.approx(mcc, abs=2e-6)
        assert r.cgf1 == pytest.approx(plain_f1(tp, pos_fp, fn) * mcc, abs=3e-6)
    sets = [own, by_image(r | {"x": r["x"] + 2} for r in gt if r["sk"] % 7), by_image(r | {"y": r["y"] + 5} for r in gt if r["pk"] % 6)]
    chosen = {r.image_id: r for r in QUERIES["oracle_annotator"](spark, sf).collect()}
    for i in images:
        scores = []
        for k, truths in enumerate(sets):
            g, d, h = len(truths[i]), len(dt[i]), hits_at(truths[i], dt[i])
            scores.append((g == 0 and d == 0, round(sum(plain_f1(tp, d - tp, g - tp) for tp in h) / 10, 6), -k))
        best = max(scores)
        assert (chosen[i].annotator, chosen[i].tn) == (-best[2], best[0]) or abs(chosen[i].mean_f1 - best[1]) < 2e-6
        assert chosen[i].mean_f1 == pytest.approx(best[1], abs=2e-6)


def test_mask_precision(shapes):
    gt, dt, by = shapes
    got = {r.metric: r.value for r in metrics.mask_precision_summary(gt, dt, ["image_id", "class_id"]).collect()}
    for metric, value in plain_summary(by, matching.AREAS).items():
        assert got[metric] == pytest.approx(value, abs=1e-9), metric


def test_precision_of_each_rarity_and_their_mean(spark, sf, boxes):
    gt, dt, by = boxes
    buckets = fx.images(spark, sf).select(F.col("id").alias("image_id"), F.col("rarity").alias("bucket"))
    got = {(r.bucket, r.metric): r.value for r in metrics.bucket_precision(gt, dt, ["image_id", "class_id"], buckets).collect()}
    of = {r.image_id: r.bucket for r in buckets.collect()}
    want = {b: plain_summary({k: v for k, v in by.items() if of[k[0]] == b}, matching.AREAS) for b in set(of.values())}
    for metric in want[0]:
        for b, values in want.items():
            assert got[b, metric] == pytest.approx(values[metric], abs=1e-9), (b, metric)
        assert got[None, metric] == pytest.approx(sum(v[metric] for v in want.values()) / len(want), abs=1e-9)
    assert {b for b, m in got if m == "AR@1"} == {None, *want}


def edge(cells, w, h):
    """Boundary pixels: the square of a pixel, its right, its lower and its diagonal neighbour has both values."""
    out = set()
    for x in range(w):
        for y in range(h):
            near = [(a, b) for a, b in ((x, y), (x + 1, y), (x, y + 1), (x + 1, y + 1))]
            if x == w - 1 and y == h - 1:
                continue
            if y == h - 1:
                near = [(x, y), (x + 1, y)]
            elif x == w - 1:
                near = [(x, y), (x, y + 1)]
            if 0 < sum(q in cells for q in near) < len(near):
                out.add((x, y))
    return out


def plain_boundary_f(a, b, r, w, h):
    a, b = edge(a, w, h), edge(b, w, h)
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    close = lambda own, other: sum(any((x + dx, y + dy) in other for dx in range(-r, r + 1) for dy in range(-r, r + 1)) for x, y in own) / len(own)
    p, q = close(b, a), close(a, b)
    return 2 * p * q / (p + q) if p + q else 0.0


def test_mask_phrase_and_demo_metrics(spark, sf):
    import numpy as np

    from annolake.operators.groups import hungarian
    from annolake.plans.queries import QUERIES

    truths = by_image(with_cells(r.asDict(), 4) for r in fx.gt_boxes(spark, sf).where("iscrowd = 0").collect())
    dets = by_image(with_cells(r.asDict(), 4) for r in fx.pred_boxes(spark, sf).where("score >= 0.5").collect())
    images = {r.id: r.is_instance_exhaustive for r in fx.images(spark, sf).collect()}
    got = {r.iou_percent: r for r in QUERIES["mask_phrase_cgf1"](spark, sf).collect()}
    rows = {i: (len(truths[i]), len(dets[i]), hits_at(truths[i], dets[i])) for i in images}
    for k, p in enumerate(metrics.IOU_PERCENT):
        some = [v for i, v in rows.items() if images[i] == 1]
        tp, fp, fn = sum(h[k] for _, _, h in some), sum(d - h[k] for _, d, h in some), sum(g - h[k] for g, _, h in some)
        assert (got[p].tp, got[p].fp, got[p].fn) == (tp, fp, fn)
        local = [plain_f1(h[k], d - h[k], g - h[k]) for g, d, h in some if g and d]
        assert got[p].positive_macro_f1 == pytest.approx(sum(local) / len(local), abs=2e-6)
    j, f = [], []
    for i in images:
        g, d = truths[i], dets[i]
        if g and d:
            m = np.array([[iou(a, b) for b in d] for a in g])
            pairs = [(a, b) for a, b in zip(*hungarian(-m), strict=True) if m[a, b] > 0]
            j.append(sum(m[q] for q in pairs) / min(len(g), len(d)))
            f.append(sum(plain_boundary_f(g[a]["cells"], d[b]["cells"], 2, 160, 120) for a, b in pairs) / min(len(g), len(d)) if i % 40 == 0 else None)
    demo = {r.iou_percent: r for r in QUERIES["demo_metrics"](spark, sf).collect()}
    assert demo[50].j == pytest.approx(sum(j) / len(j), abs=2e-6) and demo[50].f != demo[50].j
    assert demo[50].tp == sum(h[0] for _, _, h in rows.values())
    # boundaries of every fortieth image, by definition
    ids = [i for i in images if i % 40 == 0]
    table = lambda df, at: ell_masks(df.where(F.col("image_id").isin(ids)), at)
    some = fx.images(spark, sf).where(F.col("id").isin(ids))
    part = metrics.mask_demo_metrics(some, table(fx.gt_boxes(spark, sf).where("iscrowd = 0"), 4), table(fx.pred_boxes(spark, sf).where("score >= 0.5"), 4)).first()
    known = [v for v in f if v is not None]
    assert len(known) > 5 and part.f == pytest.approx(sum(known) / len(known), abs=1e-6)


def test_mask_video_precision_of_perfect_tracks(spark, sf):
    gt = ell_masks(fx.tracks_gt(spark, sf), 2)
    got = {r.metric: r.value for r in metrics.video_precision(gt, gt.withColumn("score", F.lit(0.5))).collect()}
    assert got["AP"] == pytest.approx(1.0) and got["AR@100"] == pytest.approx(1.0) and got["AP_large"] == -1.0


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_a_whole_batch(seed):
    """Areas, boxes and overlaps of random masks at once, also of empty, full and null ones."""
    import numpy as np
    import pyarrow as pa

    from annolake.operators import masks, runs

    rng = np.random.default_rng(seed)
    maps = [[rng.random((7, 5)) < share for share in rng.choice([0.0, 0.1, 0.5, 1.0], 40)] for _ in "ab"]
    spans = [runs.Spans.of(pa.array([None if k == 9 else masks.from_bitmap(m).tolist() for k, m in enumerate(some)], pa.list_(pa.int32()))) for some in maps]
    for some in maps:
        some[9] = np.zeros((7, 5), bool)
    assert spans[0].area().tolist() == [int(m.sum()) for m in maps[0]]
    assert runs.overlaps(*spans).tolist() == [int((a & b).sum()) for a, b in zip(*maps, strict=True)]
    want = []
    for m in maps[0]:
        ys, xs = np.nonzero(m)
        want.append([xs.min(), ys.min(), xs.max() - xs.min() + 1, ys.max() - ys.min() + 1] if len(xs) else [0, 0, 0, 0])
    assert runs.boxes(spans[0], np.full(40, 7)).tolist() == [[int(v) for v in r] for r in want]


def test_queries_of_more_classes_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "BLOCK", 3)
    truths = spark.createDataFrame([(i, c, i * 100 + c) for i in range(4) for c in range(11) if (i + c) % 3 == 0], "image_id long, class_id int, ann_id long")
    images = spark.range(5).select(F.col("id").alias("image_id"))
    got = sorted((r.image_id, r.class_id, r.chunk, r.prompt, r.n, tuple(r.ids)) for r in evaluation.image_category_queries(images, truths, 4, {2: "two"}).collect())
    has = lambda i, c: i < 4 and (i + c) % 3 == 0
    assert got == [(i, c, c // 4, "two" if c == 2 else str(c), int(has(i, c)), (i * 100 + c,) if has(i, c) else ()) for i in range(5) for c in range(11)]
    assert evaluation.image_category_queries(images, truths.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_gaps_and_warnings_against_the_whole_grid(spark, seed):
    import random

    from annolake.operators import label_qa

    rng = random.Random(seed)
    frames = [(v, 3 * f + rng.randrange(3), rng.choice(["ok", "ok", "ok", "empty", "missing"])) for v in range(3) for f in range(25)]
    n = {(v, f, c): rng.choice([0, 0, 1, 2, 5]) for v, f, s in frames if s == "ok" for c in range(4)}
    counts = spark.createDataFrame([(*k, x) for k, x in n.items() if x or rng.random() < 0.5], "video_id long, frame_idx long, category_id int, n int")
    tables = spark.createDataFrame(frames, "video_id long, frame_idx long, status string"), counts, spark.createDataFrame([(c,) for c in range(3)], "category_id int")
    gaps, warned = [], []
    for v in range(3):
        own = [(f, s) for w, f, s in frames if w == v]
        for c in range(3):
            at = [n.get((v, f, c), 0) for f, _ in own]
            for k in range(1, len(own)):
                if 0 < k < len(own) - 1 and not at[k] and at[k - 1] and at[k + 1] and all(own[k + j][1] == "ok" for j in (-1, 0, 1)):
                    gaps.append((v, own[k][0], c, at[k - 1], at[k + 1]))
                if at[k - 1] and at[k] / at[k - 1] < 0.5:
                    warned.append((v, own[k][0], "sudden_decrease" if at[k] else "class_missing", c, at[k - 1], at[k]))
        total = [sum(n.get((v, f, c), 0) for c in range(4)) for f, _ in own]
        warned += [(v, own[k][0], "all_missing", None, None, 0) for k in range(1, len(own)) if not total[k] and total[k - 1]]
    assert gaps and sorted(map(tuple, label_qa.class_gaps(*tables).collect())) == sorted(gaps)
    assert sorted(map(tuple, label_qa.frame_warnings(*tables).collect()), key=str) == sorted(warned, key=str)
