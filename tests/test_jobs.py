"""Micro-cases, brute force on small groups, and invariants."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annolake.operators import label_qa, masks, matching, metrics, nms, pairs, prep, remap
from annolake.operators.groups import hungarian
from annolake.plans import fixtures as fx
from annolake.sources import coco, yolo
from annolake.streaming import frames as st_frames
from annolake.streaming.hotstart import prune_tracks

BOX = "image_id long, class_id int, {} long, x double, y double, w double, h double"


def frame_rows(spark, per_frame):
    """frames, counts and classes of one video from {frame: {class: n}}."""
    frames = spark.createDataFrame([(1, f, "ok" if any(c.values()) else "empty") for f, c in per_frame.items()], "video_id long, frame_idx long, status string")
    counts = spark.createDataFrame([(1, f, k, n) for f, c in per_frame.items() for k, n in c.items() if n], "video_id long, frame_idx long, category_id int, n int")
    classes = spark.createDataFrame([(k,) for k in sorted({k for c in per_frame.values() for k in c})], "category_id int")
    return frames, counts, classes


SIX = {0: {1: 2, 2: 1}, 1: {1: 2, 2: 1}, 2: {1: 0, 2: 1}, 3: {1: 2, 2: 1}, 4: {1: 0, 2: 0}, 5: {1: 1, 2: 1, 3: 1}}


def test_six_frames(spark):
    frames, counts, classes = frame_rows(spark, SIX)
    got = {(r.frame_idx, r.kind, r.category_id, r.prev_n) for r in label_qa.frame_warnings(frames, counts, classes).collect()}
    assert got == {(2, "class_missing", 1, 2), (4, "all_missing", None, None), (4, "class_missing", 1, 2), (4, "class_missing", 2, 1)}
    near = label_qa.interpolation_candidates(frames, counts).collect()
    assert [(r.frame_idx, round(r.confidence, 6)) for r in near] == [(4, 0.666667)]
    gaps = label_qa.class_gaps(frames, counts, classes).collect()
    assert [(r.frame_idx, r.category_id, r.prev_n, r.next_n) for r in gaps] == [(2, 1, 2, 2)]
    assert [(r.frame_idx, r.status) for r in label_qa.frame_gaps(frames).collect()] == [(4, "empty")]


def test_stream_and_batch_agree(spark, tmp_path):
    frames, counts, classes = frame_rows(spark, SIX)
    source = counts.unionByName(frames.where("status = 'empty'").selectExpr("video_id", "frame_idx", "1 category_id", "0 n"))
    for i, part in enumerate((0, 2, 4)):
        source.where(F.col("frame_idx").between(part, part + 1)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        del i
    stream = spark.readStream.schema(source.schema).parquet(str(tmp_path / "in"))
    got = st_frames.drained(st_frames.stream_warnings(stream), "warnings_test", str(tmp_path / "check"))
    key = lambda rows: sorted(str(tuple(r)) for r in rows)
    assert key(got.collect()) == key(label_qa.frame_warnings(frames, counts, classes).select(*got.columns).collect())


@pytest.mark.parametrize("mode", ["append", "complete"])
def test_streams_are_drained_into_files(spark, tmp_path, mode):
    rows = [(v, f, c, 1 + (f + c) % 3) for v in (1, 2) for f in range(4) for c in (1, 2)]
    source = spark.createDataFrame(rows, "video_id long, frame_idx long, category_id int, n int")
    for f in range(4):
        source.where(F.col("frame_idx") == f).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    (tmp_path / "none").mkdir()
    job = st_frames.stream_warnings if mode == "append" else st_frames.stream_progress
    stream = lambda p: job(spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / p)))
    got = st_frames.drained(stream("in"), f"files_{mode}", str(tmp_path / "out"), mode)
    assert got.inputFiles() and all(str(tmp_path / "out") in f for f in got.inputFiles())
    if mode == "complete":
        assert sorted(map(tuple, got.collect())) == [(v, c, sum(r[3] for r in rows if r[0] == v and r[2] == c), 4) for v in (1, 2) for c in (1, 2)]
    else:
        assert sorted((r.video_id, r.frame_idx, r.kind, r.category_id, r.prev_n, r.n) for r in got.collect()) == sorted(
            (v, f, "sudden_decrease", c, 3, 1) for v in (1, 2) for f in range(1, 4) for c in (1, 2) if (f + c) % 3 == 0
        )
    assert st_frames.drained(stream("none"), f"none_{mode}", str(tmp_path / "out2"), mode).count() == 0


def test_phrase_metrics_micro_case(spark):
    per = spark.createDataFrame([(2, 2, [2, 1]), (0, 1, [0, 0]), (1, 0, [0, 0]), (0, 0, [0, 0]), (0, 0, [0, 0])], "n_gt long, n_dt long, tps array<long>")
    r = metrics.phrase_metrics(per).where("iou_percent = 50").first()
    assert (r.tp, r.fp, r.fn, r.pos_fp, r.il_tp, r.il_fp, r.il_fn, r.il_tn) == (2, 1, 1, 0, 1, 1, 1, 2)
    assert r.f1 == pytest.approx(0.6665944489, abs=1e-4) and r.positive_micro_f1 == pytest.approx(0.7999200040, abs=1e-4)
    assert r.il_mcc == pytest.approx(0.1666666389, abs=1e-6) and r.cgf1 == pytest.approx(r.positive_micro_f1 * r.il_mcc)


def test_suppression_at_the_boundary(spark):
    rows = [(1, 1, 0.9, 0.0, 0.0, 10.0, 10.0), (1, 2, 0.8, 0.0, 0.0, 5.0, 10.0)]
    dets = spark.createDataFrame(rows, "image_id long, det_id long, score double, x double, y double, w double, h double")
    assert nms.frame_nms(dets, ["image_id"], 0.5).count() == 1 and nms.generic_nms(dets, ["image_id"], 0.0, 0.5).count() == 2
    kept = nms.frame_nms(dets, ["image_id"], 0.5)
    assert nms.frame_nms(kept, ["image_id"], 0.5).count() == kept.count()


def test_two_track_overlaps(spark):
    schema = "video_id long, track_id long, frame_idx long, x double, y double, w double, h double, score double"
    box = lambda t, f, s: (1, t, f, 0.0, 0.0, 10.0, 10.0, s)
    p, q = [box(1, 1, 0.9), box(1, 2, 0.9)], [box(2, 2, 0.5), box(2, 3, 0.5)]
    both = spark.createDataFrame(p + q, schema)
    assert {r.track_id for r in nms.track_nms(both, ["video_id"], 0.99).collect()} == {1}  # over shared frames: 1
    iou = pairs.tracklet_iou(spark.createDataFrame(p, schema), spark.createDataFrame(q, schema), ["video_id"]).first()
    assert iou.iou == pytest.approx(1 / 3)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 5), st.integers(1, 5), st.integers(0, 10**6))
def test_hungarian_against_all_assignments(n, m, seed):
    cost = np.random.default_rng(seed).integers(0, 9, (n, m)).astype(float)
    rows, cols = hungarian(cost)
    small, large, c = (n, m, cost) if n <= m else (m, n, cost.T)
    best = min(sum(c[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
    assert cost[rows, cols].sum() == best and len(set(rows)) == len(set(cols)) == min(n, m)


def test_match_invariants(spark, sf):
    gt, dt = fx.gt_boxes(spark, sf), fx.pred_boxes(spark, sf)
    greedy = matching.greedy_match(gt, dt, ["image_id", "class_id"])
    assert greedy.count() == gt.count()
    used = greedy.where("det_id is not null")
    assert used.select("image_id", "class_id", "det_id").distinct().count() == used.count()
    best = matching.optimal_match(gt, dt, ["image_id", "class_id"])
    total = lambda df: df.agg(F.sum("iou")).first()[0]
    assert total(best) >= total(used) - 1e-9


def test_reindexing(spark):
    images = spark.createDataFrame([(0,), (1,)], "id long")
    annotations = spark.createDataFrame([(5, 0), (6, 1)], "id long, image_id long")
    moved, (refs,) = remap.reindexed(images, "id", [(annotations, "image_id")])
    assert sorted(r.id for r in moved.collect()) == [1, 2] and sorted((r.id, r.image_id) for r in refs.collect()) == [(5, 1), (6, 2)]
    tracks = spark.createDataFrame([(1, 5), (2, 5), (2, 9)], "video_id long, track_id long")
    assert sorted(tuple(r) for r in remap.unique_tracks(tracks).collect()) == [(1, 5, 10), (2, 5, 11), (2, 9, 9)]


def test_compaction(spark):
    queries = spark.createDataFrame(
        [(1, 3, 0, [7, 4]), (1, 5, 2, [4]), (2, 0, 1, [1])], "datapoint_id long, query_idx long, processing_order int, object_ids array<long>"
    )
    objects = spark.createDataFrame([(1, 4), (1, 5), (1, 7), (2, 1)], "datapoint_id long, obj_idx long")
    q, o, lost = prep.compact(queries, objects)
    assert sorted((r.new_query, r.new_stage, r.new_ids) for r in q.collect()) == [(0, 0, [1, 0]), (1, 1, [0])]
    assert sorted(r.obj_idx for r in o.collect()) == [4, 7] and [tuple(r) for r in lost.collect()] == [(2, "no_first_stage")]


def test_label_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("0 0.5 0.5 0.1 0.2\n\n1 0.1 0.1\n2 0.2 0.2 0.3 0.3 0.9\n")
    (tmp_path / "b.txt").write_text("")
    (tmp_path / "c.txt").write_text("0 0.5 x 0.1 0.2\n")
    frames, boxes = yolo.read_yolo(spark, str(tmp_path))
    assert {r.frame: r.status for r in frames.collect()} == {"a": "ok", "b": "empty", "c": "missing"}
    assert sorted((r.frame, r.line_no, r.class_id) for r in boxes.collect()) == [("a", 0, 0), ("a", 3, 2)]
    with pytest.raises(Exception, match="bad label line"):
        yolo.read_yolo(spark, str(tmp_path), strict=True)[1].collect()
    assert {(r.name, r.class_id) for r in yolo.class_map(spark, "person:0, car:2").collect()} == {("person", 0), ("car", 2)}


def test_coco_documents(spark, tmp_path):
    path = tmp_path / "gt.json"
    path.write_text('{"images":[{"id":1,"file_name":"a.jpg","width":10,"height":10}],"annotations":[{"id":1,"image_id":1,"category_id":2,"bbox":[1,2,3,4]}],"categories":[{"id":2,"name":"c"}]}')
    images, annotations, categories = coco.read_coco(spark, str(path))
    assert (images.count(), annotations.first().bbox, categories.first().name) == (1, [1.0, 2.0, 3.0, 4.0], "c")
    preds = spark.createDataFrame([(1, 2, [1.0, 1.0, 2.0, 3.0], 0.5), (9, 2, [0.0] * 4, 0.1)], "image_id long, category_id int, bbox array<double>, score double")
    good, bad = coco.normalise_predictions(preds, images)
    assert good.first().area == 6.0 and good.first().segmentation == [1.0, 1.0, 1.0, 4.0, 3.0, 4.0, 3.0, 1.0] and bad.count() == 1
    log = tmp_path / "m"
    log.mkdir()
    (log / "val.json").write_text('{"ap": 0.1}\n{"ap": 0.3, "x/y": 2}\n')
    assert coco.last_metric_rows(spark, str(log), ["ap", "x/y"]).first()[1:] == (0.3, 2.0)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 10**6))
def test_mask_codecs(h, w, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.random((h, w)) < 0.5, rng.random((h, w)) < 0.5
    ra, rb = masks.from_bitmap(a), masks.from_bitmap(b)
    assert (masks.to_bitmap(ra, h, w) == a).all() and masks.from_text(masks.to_text(ra)).tolist() == ra.tolist()
    sa, sb = masks.spans(ra), masks.spans(rb)
    assert masks.overlap(sa, sb) == (a & b).sum()
    assert (masks.to_bitmap(masks.from_spans(masks.union_spans([sa, sb]), h * w), h, w) == (a | b)).all()


def test_mask_shapes():
    ring = np.zeros((9, 9), bool)
    ring[1:8, 1:8] = True
    ring[3:5, 3:5] = False
    assert masks.components(ring).max() >= 1 and len(np.unique(masks.components(~ring))) == 3
    assert masks.fill_polygon([1, 1, 5, 1, 5, 4, 1, 4], 6, 7).sum() == 12


def test_track_pruning(spark):
    rows = [(1, 0, 1, 0, "new")] + [(1, f, 1, None, "unmatched") for f in range(1, 10)] + [(1, f, 2, 5, "new" if f == 0 else "matched") for f in range(12)] + [(1, f, 3, 5, "new" if f == 1 else "matched") for f in range(1, 12)]
    events = spark.createDataFrame(rows, "video_id long, frame_idx long, track_id long, det_id long, kind string")
    removed, suppressed = prune_tracks(events, start=3)
    assert sorted(tuple(r) for r in removed.collect()) == [(1, 1, 8, "unmatched"), (1, 3, 8, "duplicate")]
    assert sorted(r.frame_idx for r in suppressed.collect()) == [3, 4, 5, 6, 7]


def test_average_precision_of_a_perfect_run(spark):
    gt = spark.createDataFrame([(i, 0, 1, 0.0, 0.0, 10.0, 10.0, 0) for i in range(4)], BOX.format("ann_id") + ", iscrowd int")
    dt = spark.createDataFrame([(i, 0, 1, 0.0, 0.0, 10.0, 10.0, 0.9 - i / 10) for i in range(4)], BOX.format("det_id") + ", score double")
    flags = matching.score_match(gt, dt, ["image_id", "class_id"], [0.5, 0.75])
    ap = metrics.average_precision(flags, spark.createDataFrame([(0, [4, 4])], "class_id int, n_gt array<long>"), ["class_id"]).collect()
    assert [round(r.ap, 9) for r in ap] == [1.0, 1.0] and [r.recall for r in ap] == [1.0, 1.0]


def test_occlusion_order(spark):
    from annolake.streaming.occlusion import occlusion_suppress

    def box(track, frame, w=10.0):
        return (1, frame, track, 0.0, 0.0, w, 10.0)

    rows = [box(1, 0, 0.0), box(2, 0), box(1, 1), box(2, 1, 0.0), box(1, 2), box(2, 2), box(3, 2), box(1, 3), box(2, 3)]
    objects = spark.createDataFrame(rows, "video_id long, frame_idx long, track_id long, x double, y double, w double, h double")
    # frame 2: 1 was hidden at 0, 2 at 1, 3 never; 2 goes, and stays the more recent one
    assert sorted(tuple(r) for r in occlusion_suppress(objects).collect()) == [(1, 2, 2), (1, 3, 2)]


def test_rotated_overlap(spark):
    schema = ", ".join(f"{p}_{c} double" for p in "ab" for c in ("xc", "yc", "w", "h", "angle"))
    square, turned = (0.0, 0.0, 2.0, 2.0), (0.0, 0.0, 2.0, 2.0, 45.0)
    rows = [(*square, 0.0, *square, 0.0), (*square, 0.0, *turned), (*square, 0.0, 9.0, 9.0, 1.0, 1.0, 30.0), (0.0, 0.0, 4.0, 2.0, 90.0, 0.0, 0.0, 2.0, 4.0, 0.0)]
    got = [r.iou for r in pairs.rotated_iou(spark.createDataFrame(rows, schema)).collect()]
    octagon = 8 * (np.sqrt(2) - 1)
    assert got == pytest.approx([1.0, octagon / (8 - octagon), 0.0, 1.0])


def test_segmentations_in_all_forms(spark, tmp_path):
    ring = np.zeros((6, 8), bool)
    ring[1:5, 2:6] = True
    runs = masks.from_bitmap(ring).tolist()
    path = tmp_path / "gt.json"
    forms = [f'{{"size":[6,8],"counts":{runs}}}', f'{{"size":[6,8],"counts":"{masks.to_text(np.array(runs))}"}}'.replace("\\", "\\\\"), "[[2,1,6,1,6,5,2,5]]", "[2,1,6,1,6,5,2,5]"]
    rows = ",".join(f'{{"id":{k},"image_id":1,"category_id":1,"segmentation":{s}}}' for k, s in enumerate(forms))
    path.write_text(f'{{"images":[{{"id":1,"file_name":"a.jpg","width":8,"height":6}}],"annotations":[{rows}],"categories":[]}}')
    images, annotations, _ = coco.read_coco(spark, str(path))
    preds = annotations.select("image_id", "category_id", "segmentation", (F.lit(1.0) - F.col("id") / 10).alias("score"))
    got = sorted(coco.mask_predictions(preds, images).collect(), key=lambda r: r.id)
    assert [r.id for r in got] == [1, 2, 3, 4] and [r.bbox for r in got] == [[2.0, 1.0, 4.0, 4.0]] * 4 and [r.area for r in got] == [16.0] * 4


def test_tracking_text(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("1,5,1,2,3,4,0.5,car,\n1,-1,1,2,3,4,0.5,car,\n2,6,1,2,3,4," + ",".join(map(str, range(100))) + "\n2,7,1,2,3,4,0.5,ignore,\n")
    rows, crowd = coco.read_track_text(spark, str(path), crowd=(7, "ignore"), values={7: {"car": "vehicle"}})
    got = {r.track_id: r.rest for r in rows.collect()}
    assert got[5] == ["0.5", "vehicle"] and len(got[6]) == 100 and [r.track_id for r in crowd.collect()] == [7]


def test_keypoint_boxes_and_empty_frames(spark):
    images = spark.createDataFrame([(1,)], "id long")
    preds = spark.createDataFrame([(1, 2, None, [4.0, 5.0, 2.0, 1.0, 9.0, 1.0], 0.5)], "image_id long, category_id int, bbox array<double>, keypoints array<double>, score double")
    assert coco.normalise_predictions(preds, images)[0].first().bbox == [1.0, 5.0, 3.0, 4.0]
    dets = spark.createDataFrame([("a", 0, 1, 0.0, 0.0, 64.0, 48.0)], "frame string, class_id int, det_id long, x double, y double, w double, h double")
    frames = spark.createDataFrame([("a",), ("b",)], "frame string")
    assert {r.frame: r.text for r in yolo.yolo_lines(dets, "frame", 640, 480, frames=frames).collect()} == {"a": "0 0.050000 0.050000 0.100000 0.100000", "b": ""}
    assert {(r.class_id, r.name) for r in yolo.class_names(spark, "person:0,car:2").collect()} == {(0, "person"), (2, "car")}


def test_listings_and_metric_files(spark, tmp_path):
    from annolake.sources import listing

    for name in ("a.JPG", "b.png", "c.txt"):
        (tmp_path / name).write_bytes(b"x")
    found = listing.images_in(spark, str(tmp_path))
    assert sorted(r.path.rsplit("/", 1)[1] for r in found.collect()) == ["a.JPG", "b.png"]
    (tmp_path / "list.txt").write_text("\n".join([*(r.path for r in found.collect()), "", "gone.jpg"]))
    assert listing.images_of_list(spark, str(tmp_path / "list.txt"), found).count() == 2
    listing.write_metrics(spark.createDataFrame([("a", 0.5)], "metric string, value double"), spark.createDataFrame([(1, 2)], "video_id long, n long"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/dataset_results")).first().dataset_results.a == 0.5


def as_stream(spark, rows, folder, parts=3):
    """The rows as files, a few frames in each, one file a micro-batch."""
    last = rows.agg(F.max("frame_idx")).first()[0]
    for lo in range(0, last + 1, last // parts + 1):
        rows.where(F.col("frame_idx").between(lo, lo + last // parts)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def test_track_streams_agree_with_their_batch_twins(spark, sf, tmp_path):
    from annolake.plans.queries import track_events
    from annolake.streaming import tracks as st_tracks
    from annolake.streaming.occlusion import occlusion_suppress

    objects = fx.tracks_gt(spark, sf).withColumn("w", F.when(F.col("eid") % 5 == 0, F.lit(0.0)).otherwise(F.col("w"))).select("video_id", "frame_idx", "track_id", *"xywh")
    want = sorted(map(tuple, occlusion_suppress(objects, 0.3).collect()))
    got = st_frames.drained(st_tracks.stream_occlusion(as_stream(spark, objects, str(tmp_path / "o")), 0.3), "occlusion_test", str(tmp_path / "oc"))
    assert want and sorted(map(tuple, got.collect())) == want
    events = track_events(spark, sf)
    want = sorted(map(tuple, prune_tracks(events, delay=40, unmatch=3, dup=2)[0].collect()))
    got = st_frames.drained(st_tracks.stream_removals(as_stream(spark, events, str(tmp_path / "e")), delay=40, unmatch=3, dup=2), "removals_test", str(tmp_path / "ec"))
    assert want and sorted(map(tuple, got.collect())) == want


def test_mask_suppression_and_tracklets(spark):
    def runs(x, y, w, h):
        m = np.zeros((20, 20), bool)
        m[y : y + h, x : x + w] = True
        return masks.from_bitmap(m).tolist()

    shapes = [(1, 0.9, 0, 0, 10, 10), (2, 0.8, 0, 0, 10, 9), (3, 0.7, 12, 12, 4, 4), (4, 0.6, 0, 0, 3, 3)]
    rows = [(1, i, s, float(x), float(y), float(w), float(h), runs(x, y, w, h)) for i, s, x, y, w, h in shapes]
    dets = spark.createDataFrame(rows, "image_id long, det_id long, score double, x double, y double, w double, h double, runs array<int>")
    assert sorted(r.det_id for r in nms.mask_nms(dets, ["image_id"], 0.0, 0.5).collect()) == [1, 3, 4]
    assert sorted(r.det_id for r in nms.mask_iom_filter(dets, ["image_id"], 0.5).where("kept").collect()) == [1, 3]
    track = lambda t, f, box: (1, t, f, runs(*box))
    schema = "video_id long, track_id long, frame_idx long, runs array<int>"
    a = spark.createDataFrame([track(1, 0, (0, 0, 4, 4)), track(1, 1, (0, 0, 4, 4))], schema)
    b = spark.createDataFrame([track(5, 1, (0, 0, 4, 2)), track(5, 2, (0, 0, 4, 4))], schema)
    r = pairs.tracklet_mask_iou(a, b, ["video_id"]).first()
    assert (r.inter, r.union, r.iou) == (8, 48, pytest.approx(8 / 48))


def test_box_forms(spark):
    from annolake.functions import boxes as bx

    row = spark.createDataFrame([(1.0, 2.0, 4.0, 6.0)], "a double, b double, c double, d double")
    box = tuple(F.col(c) for c in "abcd")
    forms = {"xywh": (1.0, 2.0, 3.0, 4.0), "cxcywh": (2.5, 4.0, 3.0, 4.0), "rotated": (2.5, 4.0, 3.0, 4.0, 0.0)}
    for name, want in forms.items():
        there = bx.converted(box, "xyxy", name)
        back = bx.converted(there, name, "xyxy")
        assert tuple(row.select(*there).first()) == want and tuple(row.select(*back).first()) == (1.0, 2.0, 4.0, 6.0)


def test_compaction_of_images_and_negative_pairs(spark):
    q = spark.createDataFrame([(1, 0, 2)], "datapoint_id long, query_idx long, image_idx int")
    o = spark.createDataFrame([(1, 0, 5)], "datapoint_id long, obj_idx long, image_idx int")
    images = spark.createDataFrame([(1, k) for k in range(7)], "datapoint_id long, image_idx int")
    q2, o2, kept = prep.compact_images(q, o, images)
    assert (q2.first().new_image, o2.first().new_image, kept.count()) == (0, 1, 2)
    ids = spark.createDataFrame([(1, 1, 1), (1, 2, 2)], "video_id long, category_id int, new_id long")
    more = spark.createDataFrame([(9, 1, 0), (1, 1, 1), (3, 2, 2)], "video_id long, category_id int, line long")
    assert sorted(map(tuple, remap.with_negatives(ids, more, ["line"]).collect())) == [(1, 1, 1), (1, 2, 2), (3, 2, 4), (9, 1, 3)]


def test_tracks_of_equal_mean_scores_go_by_id(spark):
    from annolake.operators import nms

    scores = {1: [0.3, 0.2, 0.1], 2: [0.1, 0.2, 0.3]}  # summed in this order they differ in the last bit
    rows = [(1, t, k, 0.0, 0.0, 10.0, 10.0, s) for t, own in scores.items() for k, s in enumerate(own)]
    df = spark.createDataFrame(rows, "video_id long, track_id long, frame_idx long, x double, y double, w double, h double, score double").coalesce(1)
    assert {r.track_id for r in nms.track_nms(df, ["video_id"], 0.3).collect()} == {1}
