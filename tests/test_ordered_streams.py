"""Ordered streams over several micro-batches, against their batch twins and plain Python."""

import pytest
from pyspark.sql import functions as F

from annolake.operators import label_qa
from annolake.plans import evaluations as ev
from annolake.plans import fixtures as fx
from annolake.plans.queries import track_events
from annolake.streaming import frames, rules
from annolake.streaming.hotstart import prune_tracks
from annolake.streaming.occlusion import ALWAYS, occlusion_suppress

RULES = {"delay": 40, "unmatch": 3, "dup": 2, "start": 2, "most": 3}


def drained(rule, rows, folder, name):
    stream = rule(fx.arrivals(rows, f"{folder}/in"))
    done = frames.drained(stream, name, f"{folder}/out")
    return sorted((tuple(r) for r in done.collect()), key=str)


def left_over(spark, folder, name):
    """Rows of a state that are still there, by video."""
    state = spark.read.format("statestore").option("path", f"{folder}/out/state").option("stateVarName", name).load()
    return sorted({r[0] for r in state.select("key.video_id").collect()})


def pruned(rows):
    removed, low = prune_tracks(rows, **RULES)
    return [(r.video_id, r.frame_idx, r.track_id, r.reason) for r in removed.collect()] + [(r.video_id, r.frame_idx, r.track_id, "suppressed") for r in low.collect()]


def test_warnings_and_states_that_end(spark, sf, tmp_path):
    rows = frames.event_rows(fx.table(spark, sf, "events"))
    counts = rows.groupBy("video_id", "frame_idx", "category_id").agg(F.sum("n").cast("int").alias("n"))
    all_frames = counts.select("video_id", "frame_idx").distinct().withColumn("status", F.lit("ok"))
    want = label_qa.frame_warnings(all_frames, counts, counts.select("category_id").distinct())
    got = drained(lambda s: rules.ordered_warnings(s, delay="3 days"), rows, str(tmp_path), "w1")
    assert got == sorted((tuple(r) for r in want.select("video_id", "frame_idx", "kind", "category_id", "prev_n", "n").collect()), key=str) and len(got) > 100
    # the last batch has moved the watermark beyond every idle video: only the row of the end waits
    assert left_over(spark, tmp_path, "last") in ([], [-1]) and left_over(spark, tmp_path, "before") in ([], [-1]) and left_over(spark, tmp_path, "waiting") == [-1]


def test_rows_that_come_too_late_are_dropped(spark, tmp_path):
    schema = "video_id long, frame_idx long, category_id int, n int, ts timestamp"
    at = lambda f, c, n: (1, f, c, n, f)
    batches = [[at(0, 1, 2), at(1, 1, 4)], [at(9, 1, 1), at(1, 2, 1)], [at(9, 2, 1)], [at(0, 1, 9), at(1, 1, 9)], [(-1, 400, 1, 0, 400)]]
    for rows in batches:
        df = spark.createDataFrame(rows, schema.replace("ts timestamp", "day long")).withColumn("ts", F.timestamp_millis((F.col("day") + 19723) * 86_400_000)).drop("day")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = rules.ordered_warnings(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), delay="2 days")
    got = sorted((tuple(r) for r in frames.drained(stream, "late", str(tmp_path / "out")).collect()), key=str)
    assert got == [(1, 9, "sudden_decrease", 1, 4, 1)]  # class 2 of frame 1 came with frame 9 and counts; what came after frame 1 was handled does not


def test_removals(spark, sf, tmp_path):
    rows = track_events(spark, sf)
    got = drained(lambda s: rules.ordered_removals(s, **RULES, late="3 days"), rows, str(tmp_path), "r1")
    assert got == sorted(pruned(rows), key=str) and {g[3] for g in got} == {"unmatched", "duplicate", "suppressed"}
    assert left_over(spark, tmp_path, "tracks") == [] and left_over(spark, tmp_path, "pairs") == []


def plain_occlusion(rows, overlap, reverse=False, removed=()):
    """By sets of pixels, frame by frame."""
    by = {}
    for r in rows:
        ones, at = set(), 0
        for k, n in enumerate(r.runs):
            if k % 2:
                ones.update(range(at, at + n))
            at += n
        by.setdefault(r.video_id, {}).setdefault(r.frame_idx, {})[r.track_id] = ones
    out = []
    for video, per in by.items():
        last = {}
        for f in sorted(per, reverse=reverse):
            objects, gone = per[f], set()
            for t in objects:
                if (video, f, t) in removed:
                    last[t] = ALWAYS
            for i in objects:
                for j in objects:
                    whole = len(objects[i] | objects[j])
                    if i < j and whole and len(objects[i] & objects[j]) >= overlap * whole and objects[i] & objects[j]:
                        p, q = last.get(i, -1), last.get(j, -1)
                        if q > -1 and (p < q if reverse else p > q):
                            gone.add(i)
                        elif p > -1 and (q < p if reverse else q > p):
                            gone.add(j)
            for t, ones in objects.items():
                if not ones or t in gone:
                    last[t] = f
            out += [(video, f, t) for t in gone]
    return sorted(out)


@pytest.fixture(scope="module")
def objects(spark, sf):
    return ev.object_rows(spark, sf).cache()


@pytest.mark.parametrize("reverse", [False, True])
def test_occlusion_of_masks_in_batch(objects, reverse):
    want = plain_occlusion(objects.collect(), 0.2, reverse)
    assert want and sorted(map(tuple, occlusion_suppress(objects, 0.2, reverse).collect())) == want


def test_occlusion_of_masks_as_a_stream(spark, objects, tmp_path):
    rows = objects.select("video_id", "frame_idx", "track_id", "height", "runs")
    got = drained(lambda s: rules.ordered_occlusion(s, 0.2, delay="3 days"), rows, str(tmp_path), "o1")
    assert got == sorted(plain_occlusion(rows.collect(), 0.2), key=str) and left_over(spark, tmp_path, "hidden") == []


def test_removals_feed_occlusion(spark, objects, tmp_path):
    rows = objects.collect()
    told = pruned(objects.drop("runs", "height"))
    removed = [(v, f, t) for v, f, t, what in told if what != "suppressed"]
    want = [(*g, "overlapping") for g in plain_occlusion(rows, 0.2, removed=set(removed))]
    assert want != [(*g, "overlapping") for g in plain_occlusion(rows, 0.2)]
    batch = occlusion_suppress(objects, 0.2, removed=spark.createDataFrame(removed, "video_id long, frame_idx long, track_id long"))
    assert sorted(map(tuple, batch.collect())) == sorted(w[:3] for w in want)
    got = drained(lambda s: rules.ordered_track_rules(s, 0.2, **RULES, late="3 days"), objects, str(tmp_path), "f1")
    assert got == sorted(want + told, key=str)


def test_a_batch_reads_and_writes_a_state_once():
    from annolake.streaming.rules import FrameWarnings

    calls = []

    class State:
        value = None

        def __init__(self, name):
            self.name = name

        def get(self):
            calls.append(self.name)
            return self.value

        def update(self, value):
            calls.append(self.name)
            self.value = value

        def clear(self):
            calls.append(self.name)
            self.value = None

    class Handle:
        def getValueState(self, name, schema):
            return State(name)

        def registerTimer(self, at):
            calls.append("timer")

        deleteTimer = registerTimer

    class Now:
        def getCurrentWatermarkInMs(self):
            return 50

    import pandas as pd

    rule = FrameWarnings(0.5, 10**6)
    rule.init(Handle())
    rows = pd.DataFrame([(at, at, 1, 100 - at) for at in range(100)], columns=["at_ms", "frame_idx", "category_id", "n"])
    out = list(rule.handleInputRows((7,), iter([rows]), Now()))
    assert out == [] and len(calls) <= 10  # 51 frames were due
    assert rule.last.value == (50,) and len(rule.held()) == 49
