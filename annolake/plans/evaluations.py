"""Registered queries of evaluation tables, look-ups, listings and summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes as bx
from ..functions import text as tx
from ..operators import associate, evaluation, label_qa, masks, matching, metrics, pairs, prep, remap, teta, tracks
from ..sources import coco, listing
from ..streaming import frames as st_frames
from ..streaming import rules
from ..streaming.occlusion import occlusion_suppress
from . import fixtures as fx
from .fixtures import DT, FR, GT, IMG, TD, TG, iou_sql
from .queries import DAYS, EVENTS, GRID, QO, STREAM, _folder, day_frames, query, query_tables, rounded, track_events

NAMES = {1: "view", 2: "signup", 3: "purchase", 4: "error", 5: "click"}
NAME_SQL = "case category_id when 1 then 'view' when 2 then 'signup' when 3 then 'purchase' when 4 then 'error' else 'click' end"


def phrase(category: str = "category_id"):
    return F.element_at(F.create_map(*(F.lit(x) for item in NAMES.items() for x in item)), F.col(category))


@query(
    f"with {IMG}, {GT}, g as (select id image_id, class_id from img cross join (select distinct class_id from gt)), t as (select distinct image_id, class_id from gt)"
    " select class_id, case when t.image_id is null then 'negative' else 'positive' end side, count(*) n from g left join t using (image_id, class_id) group by 1, 2"
)
def positive_and_negative_pairs(spark: SparkSession, d: str) -> DataFrame:
    gt = fx.gt_boxes(spark, d)
    grid = evaluation.image_category_queries(fx.images(spark, d).select(F.col("id").alias("image_id")), gt).select("image_id", "class_id")
    pos, neg = evaluation.split_by_truth(grid, gt, ["image_id", "class_id"])
    one = lambda df, side: df.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))
    return one(pos, "positive").unionByName(one(neg, "negative"))


VIDEOS = f"{FR}, v as (select video_id, 1+max(frame_idx) n from fr group by 1), ph as (select distinct video_id, category_id, case when video_id%7=0 and category_id=5 then 'other' else {NAME_SQL} end noun_phrase from fr)"


def video_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """videos with a file name per day, (video, phrase) pairs of which some are misnamed, categories."""
    fr = fx.frames(spark, d)
    names = F.transform(F.sequence(F.lit(0).cast("long"), F.col("last")), lambda i: F.concat(F.lit("v"), F.col("video_id").cast("string"), F.lit("/"), i.cast("string"), F.lit(".jpg")))
    videos = fr.groupBy("video_id").agg(F.max("frame_idx").alias("last")).select("video_id", names.alias("file_names"))
    pairs_ = fr.select("video_id", "category_id").distinct()
    pairs_ = pairs_.withColumn("noun_phrase", F.when((F.col("video_id") % 7 == 0) & (F.col("category_id") == 5), "other").otherwise(phrase()))
    return videos, pairs_, spark.createDataFrame(list(NAMES.items()), "category_id int, name string")


@query(
    f"with {VIDEOS} select ph.video_id, category_id, noun_phrase query_text, f frame_idx, 'v' || ph.video_id || '/' || f || '.jpg' file_name"
    " from ph join (select video_id, unnest(range(0, n))::int f from v) v on v.video_id = ph.video_id where noun_phrase <> 'other'"
)
def video_phrase_frames(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.video_queries(*video_tables(spark, d))[0]


@query(f"with {VIDEOS} select video_id, category_id, noun_phrase, {NAME_SQL} as name from ph where noun_phrase = 'other'")
def misnamed_phrases(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.video_queries(*video_tables(spark, d))[1]


FRAME_IDS = f"{TD}, im as (select video_id, frame_idx, video_id*1000+frame_idx image_id from (select distinct video_id, frame_idx from fr) where (video_id+frame_idx)%9<>0)"


@query(f"with {FRAME_IDS} select t.video_id, t.frame_idx, t.track_id, image_id from td t left join im using (video_id, frame_idx)")
def frame_image_ids(spark: SparkSession, d: str) -> DataFrame:
    """Predictions with their frame's image id; frames without one are kept apart, and shown with null."""
    images = fx.frames(spark, d).select("video_id", "frame_idx").distinct().where("(video_id + frame_idx) % 9 <> 0").withColumn("image_id", F.col("video_id") * 1000 + F.col("frame_idx"))
    found, lost = evaluation.frame_images(fx.tracks_pred(spark, d).select("video_id", "frame_idx", "track_id"), images)
    return found.unionByName(lost.withColumn("image_id", F.lit(None).cast("long")))


@query(
    f"with {IMG}, m as (select o_orderkey::varchar stem, 200+o_custkey%700 width, 300+o_orderkey%500 height from orders where o_orderkey%5<>0)"
    " select file_name, case when m.width is null then 'no_metadata' when m.width>700 or m.height>700 then 'too_large' else 'ok' end reason from img left join m on m.stem=img.id::varchar"
)
def images_with_metadata(spark: SparkSession, d: str) -> DataFrame:
    meta = fx.table(spark, d, "orders").where("o_orderkey % 5 <> 0").selectExpr("cast(o_orderkey as string) stem", "200 + o_custkey % 700 width", "300 + o_orderkey % 500 height")
    good, bad = evaluation.with_metadata(fx.images(spark, d).select("file_name"), meta, 700)
    return good.select("file_name", F.lit("ok").alias("reason")).unionByName(bad)


@query(f"with {TG} select track_id id, {NAME_SQL} noun_phrase, x, y, w, h from tg where frame_idx = 3 and video_id = (select min(video_id) from tg where frame_idx = 3)")
def annotations_of_a_frame(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.tracks_gt(spark, d)
    video = rows.where("frame_idx = 3").agg(F.min("video_id")).first()[0]
    nested = remap.nested_tracks(rows, ["video_id", "category_id", "track_id"]).withColumn("noun_phrase", phrase()).withColumnRenamed("track_id", "id")
    out = evaluation.frame_annotations(nested, video, 3)
    return out.select("id", "noun_phrase", *(F.col("box")[i].alias(c) for i, c in enumerate("xywh")))


@query("select distinct l_orderkey id from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F') and l_orderkey not in (select o_orderkey from orders where o_orderpriority = '1-URGENT')")
def ids_left_to_do(spark: SparkSession, d: str) -> DataFrame:
    orders = fx.table(spark, d, "orders").withColumnRenamed("o_orderkey", "id")
    return evaluation.left_to_do(fx.table(spark, d, "lineitem").selectExpr("l_orderkey id"), orders.where("o_orderstatus = 'F'"), orders.where("o_orderpriority = '1-URGENT'"), "id")


@query(f"with {FR} select distinct video_id, frame_idx, 'v' || video_id file_name, 640 width, 480 height from fr")
def distinct_frame_requests(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.frames(spark, d).select("video_id", "frame_idx", F.concat(F.lit("v"), F.col("video_id").cast("string")).alias("file_name"), F.lit(640).alias("width"), F.lit(480).alias("height"))
    return evaluation.frame_requests(rows)


@query(
    f"with {IMG}, {GT}, {DT} select id image_id, p prompt, count(dt.det_id) n, max(score) best from img cross join (select unnest(['0','1','2','none']) p) left join dt on dt.image_id = id and dt.class_id::varchar = p group by 1, 2"
)
def gathered_prompts(spark: SparkSession, d: str) -> DataFrame:
    prompts = fx.images(spark, d).select(F.col("id").alias("image_id"), F.explode(F.array(*(F.lit(p) for p in ("0", "1", "2", "none")))).alias("prompt"))
    out = evaluation.gathered(prompts, fx.pred_boxes(spark, d).withColumn("prompt", F.col("class_id").cast("string")))
    return out.select("image_id", "prompt", F.size("boxes").cast("long").alias("n"), F.try_element_at("boxes", F.lit(1))["score"].alias("best"))


@query("with s as (select l_orderkey image_id, l_linenumber % 3 shard, l_partkey v from lineitem) select image_id, min(shard) shard, min(v) v from s where (image_id, shard) in (select image_id, min(shard) from s group by 1) group by 1")
def one_row_an_image(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.first_of_each_image(fx.table(spark, d, "lineitem").selectExpr("l_orderkey image_id", "l_linenumber % 3 shard", "l_partkey v"))


@query(f"with {TG} select case when category_id in (1, 2) then 'known' when category_id = 5 then 'distractor' else 'unknown' end subset, video_id, count(*) n from tg group by 1, 2")
def category_subsets(spark: SparkSession, d: str) -> DataFrame:
    out, rows = None, fx.tracks_gt(spark, d)
    for name in ("known", "unknown", "distractor"):
        one = evaluation.category_subset(rows, [1, 2], [5], name).groupBy("video_id").agg(F.count(F.lit(1)).alias("n")).withColumn("subset", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"with {GT}, {DT} select class_id, count_if(score > 0.5005) above, count_if(score >= 0.5005) from_there from dt group by 1".replace("0.5005", "0.5005::double"))
def detections_above_threshold(spark: SparkSession, d: str) -> DataFrame:
    dt = fx.pred_boxes(spark, d)
    one = lambda df, name: df.groupBy("class_id").agg(F.count(F.lit(1)).alias(name))
    return dt.select("class_id").distinct().join(one(evaluation.above(dt, 0.5005), "above"), "class_id", "left").join(one(evaluation.above(dt, 0.5005, inclusive=True), "from_there"), "class_id", "left").fillna(0)


@query("with m as (select o_orderpriority || '_' || o_orderstatus metric, o_totalprice v from orders) select s suffix, round(avg(v), 4) mean, count(*) n from m join (select unnest(['_F', '_O', 'LOW_O']) s) on ends_with(metric, s) group by 1")
def suffix_averages(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.table(spark, d, "orders").selectExpr("concat(o_orderpriority, '_', o_orderstatus) metric", "o_totalprice value")
    return rounded(evaluation.suffix_means(rows, ["_F", "_O", "LOW_O"]), "mean", places=4)


HASH = "(((datapoint_id*31+query_idx)%1000003)*2654435761+{s})%1000003"


@query(f"with {QO}, c as (select distinct datapoint_id, query_idx, query_text from q) select datapoint_id, query_idx, case when {HASH.format(s=4)} < 400001 then 'object' else query_text end query_text from c")
def overwritten_texts(spark: SparkSession, d: str) -> DataFrame:
    q = query_tables(spark, d)[0].select("datapoint_id", "query_idx", "query_text").distinct()
    return evaluation.overwritten(q, "object", 0.4, seed=4)


@query(
    f"with {QO}, c as (select distinct datapoint_id, query_idx, processing_order from q), o as (select distinct datapoint_id, obj_idx, w from (select datapoint_id, obj_idx, min(w) w from ob group by 1, 2)),"
    " l as (select c.*, coalesce(list(obj_idx order by obj_idx) filter (obj_idx is not null), []) ids from c left join o on o.datapoint_id=c.datapoint_id and o.obj_idx%2=c.query_idx%2 group by 1,2,3),"
    f" p as (select *, {HASH.format(s=8)} h from l), s as (select *, case when len(ids)>0 and processing_order=0 and h<700002 then ids[h%len(ids)+1] end pick from p)"
    " select s.datapoint_id, query_idx, case when o.obj_idx is not null then 'visual' else 'text' end query_text, o.w box_width from s left join o on o.datapoint_id=s.datapoint_id and o.obj_idx=s.pick"
)
def visual_prompts(spark: SparkSession, d: str) -> DataFrame:
    q, ob = query_tables(spark, d)
    q = q.dropDuplicates(["datapoint_id", "query_idx"]).withColumn("query_text", F.lit("text")).withColumn("input_bbox", F.lit(None).cast("array<double>"))
    boxes = ob.groupBy("datapoint_id", "obj_idx").agg(F.min("w").alias("w")).select("datapoint_id", "obj_idx", F.array(F.col("w").cast("double")).alias("bbox"))
    out = evaluation.visual_queries(q, boxes, 0.7, seed=8)
    return out.select("datapoint_id", "query_idx", "query_text", F.col("input_bbox")[0].alias("box_width"))


@query(f"with {IMG}, n as (select id, row_number() over (order by id) - 1 i from img) select (i % 7)::int shard, count(*) n, min(id) first_id, max(id) last_id from n group by 1")
def round_robin_shards(spark: SparkSession, d: str) -> DataFrame:
    out = prep.round_robin(fx.images(spark, d).select("id"), ["id"], 7)
    return out.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query(
    f"with {DAYS}, o as (select *, lag(status) over w p, lead(status) over w q from fs window w as (partition by video_id order by frame_idx))"
    " select video_id, count(*) total, count_if(status='ok') ok, count_if(status='empty') empty, count_if(status='missing') missing, count_if(status<>'ok' and p='ok' and q='ok')::int gaps from o group by 1"
)
def gap_reports(spark: SparkSession, d: str) -> DataFrame:
    frames, counts, classes = day_frames(spark, d)
    return listing.read_report(listing.gap_report(frames, label_qa.frame_gaps(frames), label_qa.class_gaps(frames, counts, classes)))


@query(
    "with p as (select o_orderkey id, 'Lab' || o_custkey%9 || '_ok_2024-01-0' || o_orderkey%9 || '_Fri_Jul__7_' || o_custkey || '_recordings_MP4_' || o_orderkey || '.mp4' n, o_custkey%900 w, o_orderkey%900 h from orders)"
    " select id, 'store/Lab' || split_part(n, '_', 1)[4:] || '/ok/' || split_part(n, '_', 3) || '/Fri_Jul__7_' || split_part(n, '_', 8) || '/recordings/MP4/' || id || '.mp4' as path,"
    " n[:-5] as stem, replace('a/' || n, '/', '_') as flat, 'host/' || id || '/' || case when id%3=0 or (600>w and 600>h) then 'full' else '!600,600' end as url from p"
)
def shaped_names(spark: SparkSession, d: str) -> DataFrame:
    name = "concat('Lab', o_custkey % 9, '_ok_2024-01-0', o_orderkey % 9, '_Fri_Jul__7_', o_custkey, '_recordings_MP4_', o_orderkey, '.mp4') n"
    p = fx.table(spark, d, "orders").selectExpr("o_orderkey id", name, "o_custkey % 900 w", "o_orderkey % 900 h")
    most = F.when(F.col("id") % 3 != 0, F.lit(600))
    return p.select(
        "id", tx.recording_path(F.col("n"), "store").alias("path"), tx.stem(F.concat(F.lit("x/"), F.col("n"))).alias("stem"), tx.flat_path(F.concat(F.lit("a/"), F.col("n"))).alias("flat"),
        tx.sized_url("host/%s/%s", F.col("id").cast("string"), F.col("w"), F.col("h"), most).alias("url"),
    )


@query(f"with {IMG}, k as (select id from img where id%4<>0) select g.class_id, count(*) n from (with {GT} select * from gt) g where image_id in (select id from k) group by 1")
def annotations_of_available_names(spark: SparkSession, d: str) -> DataFrame:
    img = fx.images(spark, d).withColumn("video", F.concat(F.col("id").cast("string"), F.lit(".mp4")))
    have = img.where("id % 4 <> 0").select(F.col("id").cast("string").alias("name"))
    _, kept = prep.available_by_name(img, fx.gt_boxes(spark, d), have, "video")
    return kept.groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"with {TG}, a as (select video_id, count(*) boxes, count(distinct track_id) tracks from tg where video_id%3<>0 group by 1), b as (select video_id, max(frame_idx) last_frame from tg where video_id%5<>0 group by 1)"
    " select video_id, boxes size_boxes, tracks size_tracks, last_frame time_last_frame from a full join b using (video_id)"
)
def merged_evaluations(spark: SparkSession, d: str) -> DataFrame:
    """Two evaluations by name, their rows joined in full."""
    known = evaluation.Evaluators(["video_id"])
    total = lambda df: df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("boxes").alias("metric"), "value")
    by = lambda df: df.groupBy("video_id")
    known.add("size", lambda t: (total(t), by(t.where("video_id % 3 <> 0")).agg(F.count(F.lit(1)).alias("boxes"), F.count_distinct("track_id").alias("tracks"))))
    known.add("time", lambda t: (total(t), by(t.where("video_id % 5 <> 0")).agg(F.max("frame_idx").alias("last_frame"))))
    return known.run(["size", "time"], fx.tracks_gt(spark, d))[1]


@query(
    f"with {DAYS}, {GRID}, {TD[len(FR) + 2 :]}, st as (select distinct video_id, category_id, case when video_id%4=0 then 'negative' when video_id%4=1 then 'partial' else 'full' end state from td),"
    f" p as (select d.video_id, d.category_id, d.frame_idx, d.track_id, count(g.track_id) truths, max({iou_sql('g', 'd')}) iou from td d left join tg g using (video_id, category_id, frame_idx) group by 1,2,3,4)"
    " select p.video_id, p.category_id, p.frame_idx, p.track_id from p join st using (video_id, category_id) where coalesce(iou, 0) >= 0.5 or not (state = 'partial' or (truths = 0 and state <> 'negative'))"
)
def tracks_without_unlabelled(spark: SparkSession, d: str) -> DataFrame:
    """One truth at most for each (video, class, frame) here, so the best overlap decides."""
    gt = fx.tracks_gt(spark, d).withColumnRenamed("track_id", "ann_id")
    dt = fx.tracks_pred(spark, d).withColumnRenamed("track_id", "det_id")
    state = F.when(F.col("video_id") % 4 == 0, "negative").when(F.col("video_id") % 4 == 1, "partial").otherwise("full")
    labelled = dt.select("video_id", "category_id").distinct().withColumn("state", state)
    out = matching.without_unlabelled(dt, gt, ["video_id", "category_id", "frame_idx"], labelled)
    return out.select("video_id", "category_id", "frame_idx", F.col("det_id").alias("track_id"))


@query()
def one_to_one_association(spark: SparkSession, d: str) -> DataFrame:
    dets = fx.tracks_pred(spark, d).withColumnRenamed("track_id", "det_id")
    return rounded(associate.associate_one_to_one(dets, fx.tracks_gt(spark, d), ["video_id", "frame_idx"])[0], "iou")


@query()
def precision_by_area(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.precision_summary(fx.gt_boxes(spark, d), fx.pred_boxes(spark, d), ["image_id", "class_id"]), "value")


@query()
def precision_on_positives(spark: SparkSession, d: str) -> DataFrame:
    gt = fx.gt_boxes(spark, d)
    return rounded(metrics.precision_summary(gt, matching.only_positive(fx.pred_boxes(spark, d), gt, ["image_id", "class_id"]), ["image_id", "class_id"]), "value")


@query()
def video_class_precision(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.video_precision(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d)), "value")


@query()
def video_phrase_precision(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.video_precision(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d), use_classes=False), "value")


@query()
def class_agnostic_hota(spark: SparkSession, d: str) -> DataFrame:
    out = tracks.combine_hota(tracks.class_agnostic_hota(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d)))
    return rounded(out.drop("tp", "fn", "fp"), *(c for c in out.columns if c not in ("alpha", "tp", "fn", "fp")))


@query()
def class_averaged_hota(spark: SparkSession, d: str) -> DataFrame:
    per = tracks.hota(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d), ["video_id", "category_id"])
    out = tracks.average_hota(tracks.combine_hota(per, ["category_id"]))
    return rounded(out, *(c for c in out.columns if c not in ("alpha", "tp", "fn", "fp")))


@query()
def demo_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Over masks: J is their overlap, F that of their boundaries."""
    rows = fx.gt_boxes(spark, d).where("iscrowd = 0"), fx.pred_boxes(spark, d).where("score >= 0.5")
    out = metrics.mask_demo_metrics(fx.images(spark, d), *(ell_masks(r, 4) for r in rows), rows)
    return rounded(out, *(f.name for f in out.schema if f.dataType.simpleString() == "double"))


@query(
    f"with {TG}, g as (select video_id, frame_idx, category_id, count(*) over (partition by video_id, frame_idx) n, row_number() over (partition by video_id, frame_idx order by category_id) r from tg)"
    " select video_id, frame_idx, string_agg(category_id::varchar, ',' order by r) classes from g group by 1, 2"
)
def classes_of_frames(spark: SparkSession, d: str) -> DataFrame:
    """Frame rows to nests: the classes of each frame, in order."""
    rows = fx.tracks_gt(spark, d).groupBy("video_id", "frame_idx").agg(F.array_sort(F.collect_list("category_id")).alias("c"))
    return rows.select("video_id", "frame_idx", F.array_join(F.col("c").cast("array<string>"), ",").alias("classes"))


@query(
    f"with {TD}, p as (select distinct video_id, category_id from (select video_id, category_id from tg union all select video_id, category_id from td)), a as (select video_id, category_id, count(distinct track_id) n_gt from tg group by 1, 2),"
    " b as (select video_id, category_id, count(distinct track_id) n_dt from td group by 1, 2), s as (select video_id, category_id, track_id, sum(w*h) area from tg group by 1, 2, 3), t as (select video_id, category_id, track_id, sum(w*h) area from td group by 1, 2, 3),"
    f" i as (select g.video_id, g.category_id, g.track_id gt_id, d.track_id dt_id, sum({fx.inter_sql('g', 'd')}) i from tg g join td d using (video_id, category_id, frame_idx) group by 1, 2, 3, 4),"
    " m as (select i.video_id, i.category_id, max(i.i/(s.area+t.area-i.i)) iou from i join s on s.track_id=i.gt_id and s.video_id=i.video_id join t on t.track_id=i.dt_id and t.video_id=i.video_id group by 1, 2)"
    " select video_id, category_id, (coalesce(iou, 0) >= 0.5)::bigint tp, coalesce(n_dt, 0)-(coalesce(iou, 0) >= 0.5)::bigint fp, coalesce(n_gt, 0)-(coalesce(iou, 0) >= 0.5)::bigint fn,"
    " round(2.0::double*(coalesce(iou, 0) >= 0.5)::bigint/(coalesce(n_gt, 0)+coalesce(n_dt, 0)), 6) f1 from p left join a using (video_id, category_id) left join b using (video_id, category_id) left join m using (video_id, category_id)"
)
def video_phrase_rows(spark: SparkSession, d: str) -> DataFrame:
    """Per (video, phrase) matches of tracks; a phrase has one true track here, so the best overlap decides."""
    gt, dt = fx.tracks_gt(spark, d), fx.tracks_pred(spark, d)
    keys = ["video_id", "category_id"]
    ids = remap.pair_ids(gt, dt).withColumnRenamed("new_id", "image_id")
    p = pairs.tracklet_iou(gt.drop("eid", "cents"), dt, keys).where("iou > 0").join(ids, keys)
    matched = matching.assigned(p.select("image_id", F.col("gt_id").alias("ann_id"), F.col("dt_id").alias("det_id"), "iou"), ["image_id"])
    one = lambda df: df.select(*keys, "track_id").distinct().join(ids, keys)
    per = metrics.phrase_rows(metrics.image_counts(ids.select(F.col("image_id").alias("id")), one(gt), one(dt), matched))
    return rounded(per.join(ids, "image_id").select(*keys, "tp", "fp", "fn", "f1"), "f1")


@query()
def track_teta(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth predicted track is of the next class."""
    other = F.when(F.col("track_id") % 5 == 0, F.col("category_id") % 5 + 1).otherwise(F.col("category_id")).cast("int")
    out = teta.teta(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d).withColumn("category_id", other))
    return rounded(out, "loc_a", "assoc_a", "assoc_re", "assoc_pr", "cls_a", "teta")


@query(
    f"with {GT}, r as (select *, ((pk*37)%720-360)::double a, x+w/2 xc, y+h/2 yc from gt), n as (select *, (((a+180)%360+360)%360)-180 t from r)"
    " select image_id, ann_id, xc >= 0 and yc >= 0 and xc < 300 and yc < 200 inside, t angle, case when abs(t) <= 1 then (greatest(0, least(x, 300.0::double))+greatest(0, least(x+w, 300.0::double)))/2 else xc end xc,"
    " case when abs(t) <= 1 then least(w, greatest(0, least(x+w, 300.0::double))-greatest(0, least(x, 300.0::double))) else w end w from n"
)
def rotated_boxes_in_images(spark: SparkSession, d: str) -> DataFrame:
    r = fx.gt_boxes(spark, d).withColumn("a", ((F.col("pk") * 37) % 720 - 360).cast("double")).withColumns({"xc": F.expr("x + w / 2"), "yc": F.expr("y + h / 2")})
    size = F.lit(300.0), F.lit(200.0)
    xc, _, w, _, angle = bx.rotated_clip(*(F.col(c) for c in ("xc", "yc", "w", "h", "a")), *size)
    return r.select("image_id", "ann_id", bx.rotated_inside(F.col("xc"), F.col("yc"), *size).alias("inside"), angle.alias("angle"), xc.alias("xc"), w.alias("w"))


@query(f"with {TG}, v as (select video_id, 1+max(frame_idx) n from tg group by 1) select video_id, category_id, track_id, n length, count(*) boxes from tg join v using (video_id) group by 1, 2, 3, 4")
def padded_tracklets(spark: SparkSession, d: str) -> DataFrame:
    """Tracks on all frames of their video: boxes are null, and scores -1e8, where they are absent."""
    t = fx.tracks_gt(spark, d).withColumn("score", F.lit(0.5))
    out = coco.tracklet_records(t, t.groupBy("video_id").agg((F.max("frame_idx") + 1).alias("length")))
    boxes = F.size(F.filter("per_frame_scores", lambda s: s > -1e8)).cast("long")
    return out.select("video_id", "category_id", "track_id", F.size("bboxes").cast("long").alias("length"), boxes.alias("boxes"))


@query(f"with {TG}, i as (select video_id, frame_idx, row_number() over (order by video_id, frame_idx) image_id from (select distinct video_id, frame_idx from tg)) select video_id, frame_idx, track_id, image_id from tg join i using (video_id, frame_idx)")
def video_images(spark: SparkSession, d: str) -> DataFrame:
    return remap.with_images(fx.tracks_gt(spark, d).select("video_id", "frame_idx", "track_id"))[0]


@query(
    f"with {FR}, v as (select video_id, 1+max(frame_idx) n from fr group by 1), p as (select 'v'||video_id video_name, f frame_idx from (select video_id, unnest(range(0, n, 4)) f from v))"
    " select video_name, frame_idx, row_number() over (order by video_name, frame_idx) - 1 as number from p"
)
def numbered_frame_plan(spark: SparkSession, d: str) -> DataFrame:
    v = fx.frames(spark, d).groupBy("video_id").agg((F.max("frame_idx") + 1).alias("length"))
    return prep.frame_plan(v.select(F.concat(F.lit("v"), F.col("video_id").cast("string")).alias("video_name"), "length"), 4, running=True).drop("name")


# -- masks: every box without its upper right quarter, on a canvas of one pixel for 4 x 4 (tracks: 2 x 2) units -----------------------

CANVAS = 120, 160
PARTS = """greatest(least(floor(x/{s}), 160), 0)::bigint x1, greatest(least(floor((x+w)/{s}), 160), 0)::bigint x2, greatest(least(floor(y/{s}), 120), 0)::bigint y1,
 greatest(least(floor((y+h)/{s}), 120), 0)::bigint y2"""


def ell_sql(name: str, table: str, scale: int) -> str:
    """Both rectangles of each mask of a table, as a common table expression."""
    return (
        f"{name}0 as (select *, {PARTS.format(s=scale)} from {table}), {name} as (select *, (x1+x2)//2 xm, (y1+y2)//2 ym,"
        f" case when x2>x1 and y2>y1 then ((x1+x2)//2-x1)*(y2-y1)+(x2-(x1+x2)//2)*(y2-(y1+y2)//2) else 0 end area from {name}0)"
    )


def ell_inter(a: str, b: str) -> str:
    """Common pixels: each of the two rectangles of a with each of b."""
    part = {"l": ("{t}.x1", "{t}.xm", "{t}.y1"), "r": ("{t}.xm", "{t}.x2", "{t}.ym")}
    terms = []
    for p in "lr":
        for q in "lr":
            (ax, ay, at), (bx_, by, bt) = ([e.format(t=t) for e in part[k]] for t, k in ((a, p), (b, q)))
            terms.append(f"greatest(least({ay},{by})-greatest({ax},{bx_}),0)*greatest(least({a}.y2,{b}.y2)-greatest({at},{bt}),0)")
    return "(" + "+".join(terms) + ")"


def ell_masks(boxes: DataFrame, scale: int) -> DataFrame:
    """`boxes` with runs, height, width and the mask's box in place of x, y, w, h."""
    h, w = CANVAS
    at = {"x1": (F.col("x"), w), "x2": (F.col("x") + F.col("w"), w), "y1": (F.col("y"), h), "y2": (F.col("y") + F.col("h"), h)}
    px = boxes.withColumns({k: F.greatest(F.least(F.floor(v / scale), F.lit(top)), F.lit(0)).cast("int") for k, (v, top) in at.items()})
    px = px.withColumns({"xm": F.expr("(x1 + x2) div 2").cast("int"), "ym": F.expr("(y1 + y2) div 2").cast("int")})
    two = F.array(masks.corners(*map(F.col, ("x1", "y1", "xm", "y2"))), masks.corners(*map(F.col, ("xm", "ym", "x2", "y2"))))
    return masks.filled(px.select(*(c for c in boxes.columns if c not in "xywh"), two.alias("boxes"), F.lit(h).alias("height"), F.lit(w).alias("width")))


@query(
    f"with {GT}, {DT}, {ell_sql('a', 'gt', 4)}, {ell_sql('b', 'dt', 4)}, p as (select a.image_id, a.class_id, a.ann_id, b.det_id, {ell_inter('a', 'b')} i, a.area ga, b.area da, a.iscrowd from a join b using (image_id, class_id))"
    ' select image_id, class_id, ann_id, det_id, i::bigint "inter", round(i/(case when iscrowd=1 then da else ga+da-i end), 6) iou from p where i > 0'
)
def mask_pair_iou(spark: SparkSession, d: str) -> DataFrame:
    """Masks of truths and detections that overlap, and by how much; crowds over the detection."""
    found = masks.mask_pairs(ell_masks(fx.gt_boxes(spark, d), 4), ell_masks(fx.pred_boxes(spark, d), 4), ["image_id", "class_id"], "iscrowd")
    return rounded(found.select("image_id", "class_id", "ann_id", "det_id", "inter", "iou"), "iou")


@query()
def mask_phrase_cgf1(spark: SparkSession, d: str) -> DataFrame:
    """phrase_cgf1 with the overlap of masks."""
    img = prep.eligible_images(fx.images(spark, d), [])
    ids = img.select(F.col("id").alias("image_id"))
    rows = tuple(b.join(ids, "image_id", "left_semi") for b in (fx.gt_boxes(spark, d).where("iscrowd = 0"), fx.pred_boxes(spark, d).where("score >= 0.5")))
    out = metrics.mask_phrase_metrics(img, *(ell_masks(r, 4) for r in rows), rows)
    return rounded(out, "f1", "positive_micro_f1", "positive_macro_f1", "il_f1", "il_fpr", "il_mcc", "cgf1")


@query()
def mask_average_precision(spark: SparkSession, d: str) -> DataFrame:
    gt, dt = ell_masks(fx.gt_boxes(spark, d), 4), ell_masks(fx.pred_boxes(spark, d), 4)
    return rounded(metrics.mask_precision_summary(gt, dt, ["image_id", "class_id"]), "value")


@query()
def precision_by_rarity(spark: SparkSession, d: str) -> DataFrame:
    """AP and AR of the images of each rarity, and their mean over rarities (bucket null)."""
    buckets = fx.images(spark, d).select(F.col("id").alias("image_id"), F.col("rarity").alias("bucket"))
    return rounded(metrics.bucket_precision(fx.gt_boxes(spark, d), fx.pred_boxes(spark, d), ["image_id", "class_id"], buckets), "value")


def track_masks(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return ell_masks(fx.tracks_gt(spark, d), 2), ell_masks(fx.tracks_pred(spark, d), 2)


@query(
    f"with {TD}, {ell_sql('a', 'tg', 2)}, {ell_sql('b', 'td', 2)}, i as (select video_id, a.track_id gt_id, b.track_id dt_id, sum({ell_inter('a', 'b')}) i from a join b using (video_id, frame_idx) group by 1, 2, 3),"
    " s as (select track_id, sum(area) n from a group by 1), t as (select track_id, sum(area) n from b group by 1)"
    " select video_id, gt_id, dt_id, round(coalesce(i/nullif(s.n+t.n-i, 0), 1), 6) iou from i join s on s.track_id=gt_id join t on t.track_id=dt_id"
)
def tracklet_mask_overlap(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pairs.tracklet_mask_iou(*track_masks(spark, d), ["video_id"]).select("video_id", "gt_id", "dt_id", "iou"), "iou")


def drawn_similarity(gt: DataFrame, dt: DataFrame, seq: list[str], frame: str = "frame_idx") -> DataFrame:
    """mask_similarity of boxes, whose masks are drawn here only: what else reads a row needs its ids alone."""
    return tracks.mask_similarity(ell_masks(gt, 2), ell_masks(dt, 2), seq, frame)


@query()
def mask_hota(spark: SparkSession, d: str) -> DataFrame:
    out = tracks.combine_hota(tracks.hota(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d), ["video_id"], measure=drawn_similarity))
    return rounded(out, *(c for c in out.columns if c not in ("alpha", "tp", "fn", "fp")))


@query()
def mask_teta(spark: SparkSession, d: str) -> DataFrame:
    """Every fifth predicted track is of the next class; truths are not exhaustive."""
    gt, dt = fx.tracks_gt(spark, d), fx.tracks_pred(spark, d)
    other = F.when(F.col("track_id") % 5 == 0, F.col("category_id") % 5 + 1).otherwise(F.col("category_id")).cast("int")
    out = teta.teta(gt, dt.withColumn("category_id", other), measure=drawn_similarity, exhaustive=False)
    return rounded(out, "loc_a", "assoc_a", "assoc_re", "assoc_pr", "cls_a", "teta")


@query()
def mask_video_precision(spark: SparkSession, d: str) -> DataFrame:
    return rounded(metrics.video_precision(*track_masks(spark, d)), "value")


# -- ordered streams: frames come split and out of order over four batches -----------------------------------------------------------


def _ordered(spark: SparkSession, rows: DataFrame, rule: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    folder = _folder(spark, name)
    return st_frames.drained(rule(fx.arrivals(rows, f"{folder}/in")), f"{name}_{folder[-12:]}", folder)


@query(
    f"with {STREAM} select video_id, frame_idx, case when n=0 then 'class_missing' else 'sudden_decrease' end kind, category_id, pn prev_n, n from o where pn>0 and (n=0 or n/pn<0.5)"
    " union all select video_id, frame_idx, 'all_missing', null::int, null::int, 0 from e where total=0 and pt>0"
)
def ordered_frame_warnings(spark: SparkSession, d: str) -> DataFrame:
    """The rows of streamed_frame_warnings, whatever order they come in."""
    rows = st_frames.event_rows(fx.table(spark, d, "events"))
    return _ordered(spark, rows, lambda s: rules.ordered_warnings(s, delay="3 days"), "ordered_warnings")


def object_rows(spark: SparkSession, d: str) -> DataFrame:
    """Events of tracks with their masks; every fifth mask is empty."""
    shapes = ell_masks(fx.tracks_gt(spark, d).where("eid % 5 <> 0"), 2).select("video_id", "frame_idx", "track_id", "runs")
    h, w = CANVAS
    rows = track_events(spark, d).join(shapes, ["video_id", "frame_idx", "track_id"], "left")
    return rows.withColumn("height", F.lit(h)).withColumn("runs", F.coalesce("runs", F.array(F.lit(h * w))))


@query(
    f"""with recursive {EVENTS}, gone as (select video_id, track_id, min(frame_idx) gone, arg_min(reason, frame_idx*10+(reason='unmatched')::int) reason from r group by 1, 2), ke as (select *, row_number() over (partition by video_id, track_id order by frame_idx) k,
  count_if(kind='unmatched') over (partition by video_id, track_id order by frame_idx) misses from f),
al as (select video_id, track_id, 0::bigint k, 2::bigint alive, 0::bigint frame_idx, 0::bigint misses from ke where k=1
  union all select ke.video_id, ke.track_id, ke.k, least(3, greatest(-1, alive + (kind='matched')::bigint - (kind='unmatched')::bigint)), ke.frame_idx, ke.misses
  from al join ke on ke.video_id=al.video_id and ke.track_id=al.track_id and ke.k=al.k+1)
select video_id, frame_idx, track_id, 'suppressed' what from al left join gone using (video_id, track_id) where k>0 and misses>0 and alive<=0 and (gone is null or frame_idx<gone)
union all select video_id, gone, track_id, reason from gone"""
)
def ordered_track_removals(spark: SparkSession, d: str) -> DataFrame:
    """Removed and suppressed tracks of the hot-start rules, by the stream."""
    return _ordered(spark, track_events(spark, d), lambda s: rules.ordered_removals(s, delay=40, unmatch=3, dup=2, start=2, most=3, late="3 days"), "ordered_removals")


@query()
def ordered_occlusion(spark: SparkSession, d: str) -> DataFrame:
    """Masks that are suppressed by occlusion order, by the stream."""
    rows = object_rows(spark, d).select("video_id", "frame_idx", "track_id", "height", "runs")
    return _ordered(spark, rows, lambda s: rules.ordered_occlusion(s, 0.2, delay="3 days"), "ordered_occlusion")


@query()
def ordered_track_rules(spark: SparkSession, d: str) -> DataFrame:
    """Hot-start rules, and occlusion order that they tell of removals: two states in a row."""
    run = lambda s: rules.ordered_track_rules(s, 0.2, delay=40, unmatch=3, dup=2, start=2, most=3, late="3 days")
    return _ordered(spark, object_rows(spark, d), run, "track_rules")


@query()
def mask_occlusion_suppressed(spark: SparkSession, d: str) -> DataFrame:
    """The batch twin of ordered_occlusion, backwards."""
    return occlusion_suppress(object_rows(spark, d), 0.2, reverse=True)


@query()
def turned_pair_iou(spark: SparkSession, d: str) -> DataFrame:
    """Overlap of boxes turned by any angles, of one image and class."""
    b = fx.gt_boxes(spark, d).selectExpr("image_id", "class_id", "ann_id", "x + w / 2 xc", "y + h / 2 yc", "w", "h", "cast((pk * 37) % 720 - 360 as double) / 2 angle")
    side = lambda p, i: b.select("image_id", "class_id", F.col("ann_id").alias(i), *(F.col(c).alias(f"{p}_{c}") for c in ("xc", "yc", "w", "h", "angle")))
    both = side("a", "ann_id").join(side("b", "other"), ["image_id", "class_id"]).where("ann_id < other")
    near = both.where(bx.intersection(*(bx.rotated_bounds(*(F.col(f"{p}_{c}") for c in ("xc", "yc", "w", "h", "angle"))) for p in "ab")) > 0)
    return rounded(pairs.rotated_iou(near).where("iou > 1e-9").select("image_id", "ann_id", "other", "iou"), "iou")


@query()
def polygon_masks(spark: SparkSession, d: str) -> DataFrame:
    """Area and box of hexagons drawn by the rule of the COCO format, partly outside their images of 300 x 400 pixels."""
    x, y, w, h = (F.col(c) for c in "xywh")
    corner = [(0.25, 0.0), (0.75, 0.0), (1.0, 0.4), (0.7, 1.0), (0.3, 0.9), (0.0, 0.5)]
    six = F.array(*(v for a, b in corner for v in (x + w * a + 0.25, y + h * b)))
    rows = fx.gt_boxes(spark, d).select("image_id", "ann_id", F.lit(None).cast("array<int>").alias("counts"), F.lit(None).cast("string").alias("text"), F.array(six).alias("polygons"), F.lit(300).alias("height"), F.lit(400).alias("width"))
    return masks.sizes(rows).drop("height", "width")
