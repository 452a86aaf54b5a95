"""Metrics in two phases, the library's and a user's own, through one runner."""

import pytest
from pyspark.sql import functions as F

from annolake.operators import pairs, protocol, teta, tracks
from annolake.plans import fixtures as fx


@pytest.fixture(scope="module")
def both(spark, sf):
    other = F.when(F.col("track_id") % 5 == 0, F.col("category_id") % 5 + 1).otherwise(F.col("category_id")).cast("int")
    return fx.tracks_gt(spark, sf).drop("eid", "cents").cache(), fx.tracks_pred(spark, sf).withColumn("category_id", other).cache()


def rows(df):
    return {tuple(sorted((k, v) for k, v in r.asDict().items() if not isinstance(v, float))): {k: v for k, v in r.asDict().items() if isinstance(v, float)} for r in df.collect()}


def same(a, b):
    a, b = rows(a), rows(b)
    assert a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_levels_of_the_library_metrics(both):
    gt, dt = both
    got = protocol.evaluate(gt, dt, [protocol.hota_metric(), protocol.teta_metric(), protocol.count_metric()])
    named = [df.withColumnRenamed("category_id", "cls") for df in both]
    per = tracks.hota(*named, ["video_id", "cls"])
    same(got["hota"]["class"], tracks.combine_hota(per, ["cls"]))
    same(got["hota"]["classes"], tracks.average_hota(tracks.combine_hota(per, ["cls"])))
    same(got["hota"]["all"], tracks.combine_hota(per))
    same(got["teta"]["class"], teta.teta(gt, dt))
    same(got["teta"]["classes"], teta.class_average(teta.teta(gt, dt)))
    assert got["count"]["all"].first().gt_dets == gt.count() and got["count"]["all"].first().dets == dt.count()


def test_sums_of_single_videos_give_the_whole(both):
    """TETA of all videos is the combination of the sums of each video on its own."""
    gt, dt = both
    videos = [r.video_id for r in gt.select("video_id").distinct().orderBy("video_id").limit(3).collect()]
    some = [df.where(F.col("video_id").isin(videos)) for df in both]
    apart = None
    for v in videos:
        one = teta.teta_sums(*(df.where(F.col("video_id") == v) for df in both))
        apart = one if apart is None else apart.unionByName(one)
    same(teta.combine_teta(apart), teta.teta(*some))


def test_a_users_own_metric_and_a_subset(spark, both):
    gt, dt = both

    def found(gt, dt):
        near = pairs.iou_join(gt.withColumnRenamed("track_id", "ann_id"), dt.withColumnRenamed("track_id", "det_id"), ["video_id", "frame_idx"], 0.5)
        hit = near.select("video_id", "frame_idx", "ann_id").distinct().withColumn("hit", F.lit(1))
        on = gt.withColumnRenamed("track_id", "ann_id").join(hit, ["video_id", "frame_idx", "ann_id"], "left")
        return on.groupBy("video_id", F.col("category_id").alias("cls")).agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"))

    total = lambda rows, keys: rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).withColumn("share", F.col("hits") / F.col("n"))
    own = protocol.Metric("found", found, total, lambda rows: rows.agg(F.avg("share").alias("share")))
    only = gt.select("video_id").distinct().where("video_id % 2 = 0")
    got = protocol.evaluate(gt, dt, [own, protocol.count_metric()], only)
    r = got["found"]["all"].first()
    assert r.n == gt.where("video_id % 2 = 0").count() == got["count"]["all"].first().gt_dets and 0 < r.share < 1
    per = [x.share for x in got["found"]["class"].collect()]
    assert got["found"]["classes"].first().share == pytest.approx(sum(per) / len(per))
