"""What one task or the driver holds does not grow with the tables."""

import pytest

from annolake.operators import cut, matching, metrics
from annolake.plans import fixtures as fx

FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def small_pieces(spark, monkeypatch):
    monkeypatch.setattr(cut, "PIECE", 500)
    yield
    spark.conf.unset(FIRST)


def test_shuffles_have_a_partition_for_each_piece(spark, sf, small_pieces, capsys):
    n = -(-fx.table(spark, sf, "lineitem").count() // 500)
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = sorted(map(tuple, fx.pred_boxes(spark, sf).collect()))
    fx.pred_boxes(spark, sf).explain()
    said = capsys.readouterr().out
    assert f", {n}), ENSURE_REQUIREMENTS" in said and f", {n}), REPARTITION_BY_NUM" in said
    spark.conf.unset(FIRST)
    assert sorted(map(tuple, fx.pred_boxes(spark, sf).collect())) == want


def test_ranges_of_average_precision_are_bounded(spark, sf, monkeypatch):
    gt, dt = fx.gt_boxes(spark, sf), fx.pred_boxes(spark, sf)
    flags = cut.settled(matching.score_match(gt, dt, ["image_id", "class_id"], [0.5, 0.75]))
    truths = metrics.truth_counts(gt, ["class_id"], [matching.AREAS["all"]], 2)
    want = sorted(map(tuple, metrics.average_precision(flags, truths, ["class_id"]).collect()))
    sizes = []

    def settled(df):
        out = cut.settled(df)
        if "flags" in df.columns:
            sizes.extend(r[1] for r in out.groupBy("__p").count().collect())
        return out

    monkeypatch.setattr(metrics, "settled", settled)
    monkeypatch.setattr(metrics, "RANGE", 100, raising=False)
    assert sorted(map(tuple, metrics.average_precision(flags, truths, ["class_id"]).collect())) == want
    assert sum(sizes) == flags.count() and max(sizes) <= 300  # ranges are cut by a sample


def test_small_documents_share_tasks(spark, tmp_path):
    from annolake.sources import files

    n = 2 * files.LEAST_TASKS
    for k in range(n):
        (tmp_path / f"{k}.json").write_text(f'{{"images": [{{"id": {k}}}]}}')
    rows = files.json_lists(spark, str(tmp_path), ["images"])
    assert rows.count() == n and rows.select("file").distinct().count() == n
    assert rows.rdd.getNumPartitions() <= files.LEAST_TASKS


def test_boundaries_of_small_images_need_no_runs(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from annolake.operators import masks, runs, shapes

    rng = np.random.default_rng(5)
    sizes = [(int(rng.integers(1, 200)), int(rng.integers(1, 40))) for _ in range(60)]
    maps = [[rng.random(s) < rng.choice([0.0, 0.05, 0.5, 0.97, 1.0]) for s in sizes] for _ in range(2)]
    h, w = (np.array(v) for v in zip(*sizes, strict=True))
    a, b = (runs.Spans.of(pa.array([masks.from_bitmap(m).tolist() for m in part], pa.list_(pa.int32()))) for part in maps)
    for share in (0.008, 0.1, 0.6):
        with monkeypatch.context() as m:
            m.setattr(shapes, "WORDS", -1)  # all by their runs
            want = shapes.boundary_f(a, b, h, w, share)
        with monkeypatch.context() as m:
            m.setattr(shapes, "dilated", None)
            m.setattr(shapes, "WORDS", 300)  # several steps
            got = shapes.boundary_f(*(s.some(np.arange(0, 60)) for s in (a, b)), h, w, share) if (h < 64 * 4).all() and share < 0.05 else None
            m.setattr(shapes, "WORDS", 1 << 18)
            assert np.allclose(shapes.boundary_f(a, b, h, w, share), want)
        assert got is None or np.allclose(got, want)


def test_background_of_an_image_is_a_few_blocks():
    import numpy as np
    import pyarrow as pa

    from annolake.operators import runs, shapes

    spans = runs.Spans.of(pa.array([[20_000 * 20_000], [20_000 * 100 + 50, 7, 20_000 * 19_899 + 19_943]]))
    size, height = np.full(2, 20_000**2), np.full(2, 20_000)
    mask, x1, x2, y1, y2 = shapes.blocks(shapes.complement(spans, size), height)
    assert list(zip(mask.tolist(), x1.tolist(), x2.tolist(), y1.tolist(), y2.tolist(), strict=True)) == [
        (0, 0, 19_999, 0, 20_000), (1, 0, 99, 0, 20_000), (1, 100, 100, 0, 50), (1, 100, 100, 57, 20_000), (1, 101, 19_999, 0, 20_000),
    ]


def test_unions_are_made_for_whole_batches(spark, monkeypatch):
    from annolake.operators import masks

    monkeypatch.setattr(masks, "union_spans", None)  # the union of one group
    rows = [(1, 2, 3, [1, 2, 3]), (1, 2, 3, [0, 1, 5]), (2, 2, 3, [6]), (3, 1, 4, [4]), (3, 1, 4, None)]
    df = spark.createDataFrame(rows, "k int, height int, width int, runs array<int>")
    assert sorted(map(tuple, masks.union(df, ["k"]).collect())) == [(1, 2, 3, [0, 3, 3]), (2, 2, 3, [6]), (3, 1, 4, [4])]
    with pytest.raises(Exception, match="masks of one group differ in size"):
        masks.union(df.withColumn("k", df["k"] * 0), ["k"]).collect()
    corner = "array(named_struct('x1', -1, 'y1', 0, 'x2', 1, 'y2', 2), named_struct('x1', 1, 'y1', 1, 'x2', 9, 'y2', 2), named_struct('x1', 2, 'y1', 1, 'x2', 2, 'y2', 2))"
    made = masks.filled(spark.sql(f"select 2 height, 3 width, {corner} boxes union all select 2, 3, array()")).collect()
    assert sorted(map(tuple, made)) == [(2, 3, [0, 2, 1, 1, 1, 1], 0, 0, 3, 2), (2, 3, [6], 0, 0, 0, 0)]


def test_boundaries_come_with_the_pairs(spark, sf):
    from annolake.operators import masks
    from annolake.plans.evaluations import ell_masks

    gt, dt = ell_masks(fx.gt_boxes(spark, sf), 4), ell_masks(fx.pred_boxes(spark, sf), 4)
    got = metrics.mask_matches(gt, dt, masks.SHARE)
    a, b = gt.selectExpr("image_id", "ann_id", "runs runs_a", "height", "width"), dt.selectExpr("image_id", "det_id", "runs runs_b")
    want = masks.boundary_f(metrics.mask_matches(gt, dt).join(a, ["image_id", "ann_id"]).join(b, ["image_id", "det_id"])).drop("height", "width")
    some = lambda df: sorted(map(tuple, df.select("image_id", "ann_id", "det_id", "iou", "boundary_f").collect()))
    assert some(got) == some(want) != []


def test_annotators_share_one_assignment(spark, sf, monkeypatch):
    from annolake.operators import summaries
    from annolake.plans.queries import QUERIES

    calls, assigned = [], matching.assigned
    monkeypatch.setattr(matching, "assigned", lambda *a, **k: calls.append(1) or assigned(*a, **k))
    assert QUERIES["oracle_annotator"](spark, sf).count() == fx.images(spark, sf).count() and len(calls) == 1
    box = "cast(0 as double) x, cast(0 as double) y, cast(2 as double) w, cast(2 as double) h"
    images = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    truths = spark.sql(f"select id image_id, annotator, 1 ann_id, {box} from values (1L, 1), (3L, 0), (9L, 0) t(id, annotator)")
    dets = spark.sql(f"select id image_id, 1 det_id, {box} from values (1L), (2L), (9L) t(id)")
    got = {(r.image_id, r.annotator): (r.n_gt, r.n_dt, sum(r.tps)) for r in summaries.annotator_counts(images, truths, dets, [0, 1]).collect()}
    assert got == {(1, 0): (0, 1, 0), (1, 1): (1, 1, 10), (2, 0): (0, 1, 0), (2, 1): (0, 1, 0), (3, 0): (1, 0, 0), (3, 1): (0, 0, 0)}


def test_small_assignments_are_those_of_the_solver(monkeypatch):
    import numpy as np

    from annolake.operators import groups

    rng = np.random.default_rng(3)
    key = np.unique(np.column_stack([np.repeat(np.arange(600), 14), rng.integers(0, 6, 8400), rng.integers(0, 5, 8400)])[rng.random(8400) < 0.5], axis=0)
    group, a, b = key.T
    starts = np.searchsorted(group, np.append(np.unique(group), 600))
    for value in (rng.random(len(group)), rng.integers(0, 3, len(group)) / 2):
        got = groups.best_pairs(a, b, value, starts)
        with monkeypatch.context() as m:
            m.setattr(groups, "SIDE", 1)
            want = groups.best_pairs(a, b, value, starts)
        assert got.tolist() == want.tolist()
    ran = []
    solve = groups.hungarian
    monkeypatch.setattr(groups, "hungarian", lambda cost: ran.append(cost.shape) or solve(cost))
    groups.best_pairs(a, b, rng.random(len(a)), starts)
    assert ran and min(map(max, ran)) > groups.SIDE


@pytest.mark.parametrize("name", ["mask_hota", "mask_teta"])
def test_masks_of_tracks_are_drawn_once(spark, sf, monkeypatch, name):
    from annolake.plans import evaluations
    from annolake.plans.queries import QUERIES

    drawn = spark.sparkContext.accumulator(0)
    filled = evaluations.masks.filled

    def counted(df):
        def each(batches):
            for b in batches:
                drawn.add(b.num_rows)
                yield b

        out = filled(df)
        return out.mapInArrow(each, out.schema)

    monkeypatch.setattr(evaluations.masks, "filled", counted)
    QUERIES[name](spark, sf).collect()
    assert drawn.value == fx.tracks_gt(spark, sf).count() + fx.tracks_pred(spark, sf).count()


def test_overlaps_of_tracks_are_measured_once(spark, sf):
    from annolake.operators import teta, tracks

    calls = []
    measure = lambda *a, **k: calls.append(1) or tracks.similarity(*a, **k)
    gt, dt = fx.tracks_gt(spark, sf), fx.tracks_pred(spark, sf)
    got = teta.teta(gt, dt, measure=measure)
    assert len(calls) == 1
    key = lambda df: [tuple(round(v, 9) for v in r) for r in df.orderBy("cls", "alpha").collect()]
    assert key(got) == key(teta.combine_teta(teta.teta_sums(gt, dt))) != []


def test_joined_partitions_are_bounded(spark, sf):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    try:
        for given, want in (("64MB", str(cut.JOINED)), ("8m", "8m"), ("67108864b", str(cut.JOINED)), ("1g", str(cut.JOINED)), ("1000", "1000")):
            spark.conf.set(size, given)
            fx.frames(spark, sf)
            assert spark.conf.get(size) == want
    finally:
        spark.conf.unset(size)


def test_files_of_shuffles_go_when_a_table_is_settled(spark):
    import time

    store, conf = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), cut._SHUFFLES_GO
    shuffles = lambda: sum(1 for f in store.getAllFiles().mkString(" ").split() if "shuffle_" in f)
    given, before = spark.conf.get(conf), shuffles()
    rows = cut.settled(spark.range(1000).repartition(7, "id"))
    until = time.time() + 20
    while shuffles() > before and time.time() < until:
        time.sleep(0.2)
    assert shuffles() <= before and rows.count() == 1000 and spark.conf.get(conf) == given


def test_detections_meet_their_truths_in_one_join(spark, sf):
    from annolake.operators.pairs import iou_join

    keys, thresholds = ["image_id", "class_id"], [0.5, 0.75]
    gt, dt, areas = fx.gt_boxes(spark, sf), fx.pred_boxes(spark, sf), list(matching.AREAS.values())
    got = matching.score_match(gt, dt, keys, thresholds, areas=areas)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and "Join Inner" not in plan
    pairs = iou_join(gt, dt, keys, min_iou=0.0, crowd="iscrowd").where("iou >= 0.5").selectExpr(*keys, "ann_id", "det_id", "g_crowd", "iou", "g_w * g_h g_area")
    want = matching.score_assigned(dt.selectExpr(*keys, "det_id", "score", "w * h d_area"), pairs, keys, thresholds, areas=areas)
    some = lambda df: sorted(map(str, df.collect()))
    assert some(got) == some(want) != []
