"""Registered queries of preparation filters, of files that are written and read again, and of small joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes as bx
from ..operators import evaluation, matching, metrics, prep, remap, summaries
from ..sources import coco, listing, yolo
from . import fixtures as fx
from .fixtures import DT, GT, IMG, TD, TG
from .queries import GREEDY, PAIRS, _folder, query, rounded

#: Queries of an image: one for each class with its truths, and one without truths for every second order.
QS = f"""{GT}, q as (select image_id datapoint_id, class_id query_idx, 'c'||class_id query_text, image_id%3=0 boxed, list(ann_id order by ann_id) ids, image_id%10<>3 ex, case image_id%5 when 0 then null when 1 then false else true end px from gt group by 1, 2
  union all select o_orderkey, 9, 'c9', o_orderkey%3=0, [], o_orderkey%10<>3, case o_orderkey%5 when 0 then null when 1 then false else true end from orders where o_orderkey%2=0)"""


def image_queries(spark: SparkSession, d: str) -> DataFrame:
    some = fx.gt_boxes(spark, d).groupBy(F.col("image_id").alias("datapoint_id"), F.col("class_id").alias("query_idx")).agg(F.array_sort(F.collect_list("ann_id")).alias("object_ids"))
    bare = fx.table(spark, d, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("datapoint_id"), F.lit(9).alias("query_idx"), F.array().cast("array<int>").alias("object_ids"))
    key = F.col("datapoint_id")
    box = F.when(key % 3 == 0, F.array(*map(F.lit, (0.0, 0.0, 1.0, 1.0))))
    pixel = F.when(key % 5 == 1, False).when(key % 5 != 0, True)
    return some.unionByName(bare).withColumns({"query_text": F.concat(F.lit("c"), F.col("query_idx")), "input_bbox": box, "is_exhaustive": key % 10 != 3, "is_pixel_exhaustive": pixel})


@query(
    f"with {QS}, r as (select 'texts' \"rule\", * from q where query_text not in ('c1') union all select 'no_box', * from q where not boxed union all select 'few', * from q where len(ids) <= 1 union all select 'instance', * from q where ex"
    " union all select 'pixel', * from q where px is null or px union all select 'geometric', * from q where not boxed or len(ids) > 0 union all select 'box_dropped', * from q where not boxed or len(ids) > 2)"
    ' select "rule", query_idx, count(*) n, sum(datapoint_id)::bigint s, sum(len(ids))::bigint ids from r group by 1, 2'
)
def query_filters(spark: SparkSession, d: str) -> DataFrame:
    """What each filter of queries keeps: by rule and query how many, and sums that tell which."""
    q = image_queries(spark, d)
    kept = {
        "texts": prep.drop_texts(q, ["c1"]), "no_box": prep.text_queries(q), "few": prep.few_targets(q, 1), "instance": prep.exhaustive(q, "instance"), "pixel": prep.exhaustive(q, "pixel"), "geometric": prep.valid_geometric(q),
        "box_dropped": prep.text_queries(evaluation.without_boxes(q.where("size(object_ids) > 2")).unionByName(q.where("size(object_ids) <= 2"))),
    }
    out = None
    for rule, df in kept.items():
        per = df.groupBy("query_idx").agg(F.count(F.lit(1)).alias("n"), F.sum("datapoint_id").alias("s"), F.sum(F.size("object_ids")).alias("ids")).withColumn("rule", F.lit(rule))
        out = per if out is None else out.unionByName(per)
    return out


@query(f"with {GT}, o as (select image_id, ann_id, iscrowd, w*h/307200 area, w, h from gt) select image_id, ann_id, area >= 0.005 and iscrowd=0 one, area >= 0.005 with_crowds, w > 45 and h > 45 wide from o where area >= 0.005")
def real_objects(spark: SparkSession, d: str) -> DataFrame:
    """Objects of some area, with and without crowds, and boxes wider and higher than a threshold."""
    o = fx.gt_boxes(spark, d).withColumns({"area": F.col("w") * F.col("h") / 307200, "is_crowd": F.col("iscrowd")})
    one = prep.real_objects(o, 0.005).select("image_id", "ann_id", F.lit(True).alias("one"))
    wide = bx.non_empty(bx.xywh(), 45.0)
    all_ = prep.real_objects(o, 0.005, crowds=True).select("image_id", "ann_id", wide.alias("wide"))
    return all_.join(one, ["image_id", "ann_id"], "left").select("image_id", "ann_id", F.coalesce("one", F.lit(False)).alias("one"), F.lit(True).alias("with_crowds"), "wide")


YOLO = "n as (select image_id, ann_id, class_id, floor((x+w/2)/640*1e6+0.5)/1e6 xc, floor((y+h/2)/480*1e6+0.5)/1e6 yc, floor(w/640*1e6+0.5)/1e6 w, floor(h/480*1e6+0.5)/1e6 h from gt)"


@query(f"with {GT}, {YOLO} select image_id, class_id, (row_number() over (partition by image_id order by ann_id)-1)::int line_no, round(xc, 6) xc, round(yc, 6) yc, round(w, 6) w, round(h, 6) h from n")
def label_file_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes as label files, one for each image, written and read again."""
    return _read_labels(spark, d)[1].select(F.col("frame").cast("long").alias("image_id"), "class_id", "line_no", *(F.round(c, 6).alias(c) for c in ("xc", "yc", "w", "h")))


@query(f"with {GT}, {IMG} select id image_id, case when exists (select 1 from gt where image_id=id) then 'ok' else 'empty' end status from img")
def label_file_states(spark: SparkSession, d: str) -> DataFrame:
    """Whether each label file holds boxes: images without any have an empty file."""
    return _read_labels(spark, d)[0].select(F.col("frame").cast("long").alias("image_id"), "status")


def _read_labels(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    frame = F.col("image_id").cast("string").alias("frame")
    dets = fx.gt_boxes(spark, d).select(frame, "class_id", F.col("ann_id").alias("det_id"), *"xywh")
    frames = fx.images(spark, d).select(F.col("id").cast("string").alias("frame"))
    return yolo.parse_lines(yolo.by_files(yolo.yolo_lines(dets, "frame", 640, 480, frames=frames), _folder(spark, "labels"), frames.count()), strict=True)


@query("select o_orderkey, case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '5-LOW' then 2 end class_id, case o_orderpriority when '1-URGENT' then '1-URGENT' when '2-HIGH' then '2-HIGH' when '5-LOW' then '2-HIGH' end name from orders where o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')")
def mapped_prompts(spark: SparkSession, d: str) -> DataFrame:
    """Priorities as prompts, through a class map and back; of two names with one id the first is its name."""
    text = "1-URGENT:1, 2-HIGH:2, 5-LOW:2"
    rows = fx.table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("name"))
    ids = rows.join(yolo.class_map(spark, text), "name").drop("name")
    return ids.join(yolo.class_names(spark, text), "class_id").select("o_orderkey", "class_id", "name")


@query(f"with {GT}, {DT}, {IMG} select image_id, class_id category_id, det_id, w*h area, x px1, y py1, x px2, y+h py2, x+w px3, y+h py3, x+w px4, y py4, 0 iscrowd from dt where exists (select 1 from img where id=image_id and id%3<>0)")
def normalised_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Detections of known images with area, a polygon from the box and iscrowd 0."""
    known = fx.images(spark, d).where("id % 3 <> 0")
    preds = fx.pred_boxes(spark, d).select("image_id", F.col("class_id").alias("category_id"), "det_id", F.array(*"xywh").alias("bbox"), "score")
    good, _ = coco.normalise_predictions(preds, known)
    corner = [F.col("segmentation")[k].alias(f"p{'xy'[k % 2]}{k // 2 + 1}") for k in range(8)]
    return good.select("image_id", "category_id", "det_id", "area", *corner, "iscrowd")


@query(f"with {GT}, {DT} select image_id, class_id category_id, round(x, 5) x, round(y, 5) y, round(w, 5) w, round(h, 5) h, round(score, 5) score from dt")
def prediction_records(spark: SparkSession, d: str) -> DataFrame:
    """Detections by their corners as records of a result file."""
    corner = fx.pred_boxes(spark, d).select("image_id", F.col("class_id").alias("category_id"), "score", F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))
    return coco.prediction_records(corner).select("image_id", "category_id", *(F.col("bbox")[k].alias(c) for k, c in enumerate("xywh")), "score")


@query(f"with {TG}, v as (select video_id, 1+max(frame_idx) n from tg group by 1) select video_id, track_id, round(sum(w*h)/any_value(n), 6) area, any_value(n)::bigint boxes from tg join v using (video_id) group by 1, 2")
def filled_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Tracks on all frames of their video, boxes that are null as zeros, and the mean area over all frames."""
    t = fx.tracks_gt(spark, d).withColumn("score", F.lit(1.0))
    records = coco.tracklet_records(t, t.groupBy("video_id").agg((F.max("frame_idx") + 1).alias("length")))
    areas = F.transform("bboxes", lambda b: b[2] * b[3])
    out = coco.filled_tracks(records.select("video_id", "track_id", "bboxes", areas.alias("areas")))
    return rounded(out.select("video_id", "track_id", "area", F.size(F.filter("bboxes", lambda b: b.isNotNull())).cast("long").alias("boxes")), "area")


@query(f"with {TG}, v as (select video_id, 400+video_id%7 h from tg group by 1) select video_id, track_id, case when track_id%3=0 then h else 100 end::int height, 640 width from (select distinct video_id, track_id from tg) join v using (video_id)")
def tracks_with_parent_size(spark: SparkSession, d: str) -> DataFrame:
    """Every third track lacks a height, and all lack a width: they are the video's."""
    t = fx.tracks_gt(spark, d).select("video_id", "track_id").distinct().withColumns({"height": F.when(F.col("track_id") % 3 != 0, 100), "width": F.lit(None).cast("int")})
    videos = fx.tracks_gt(spark, d).select(F.col("video_id").alias("id")).distinct().withColumns({"height": (400 + F.col("id") % 7).cast("int"), "width": F.lit(640)})
    return coco.with_parent_size(t, videos)


@query(f"with {TG}, r as (select *, case when eid%9=0 then -1 else track_id end tid, eid%11=0 crowd from tg) select frame_idx::int frame_idx, tid::int track_id, x, y, w, h, 'c'||category_id kind, crowd from r where tid >= 0")
def tracking_text(spark: SparkSession, d: str) -> DataFrame:
    """Tracks as delimited text, written and read again: negative ids go, rows of crowds come apart, and names are mapped."""
    t = fx.tracks_gt(spark, d)
    tid = F.when(F.col("eid") % 9 == 0, -1).otherwise(F.col("track_id"))
    crowd = F.when(F.col("eid") % 11 == 0, "crowd").otherwise("one")
    line = F.concat_ws(",", "frame_idx", tid.cast("string"), *"xywh", crowd, F.concat(F.lit("k"), F.col("category_id")), F.lit(""))
    folder = _folder(spark, "tracking")
    t.select(line.alias("value")).write.text(folder)
    names = {7: {f"k{k}": f"c{k}" for k in range(1, 6)}}
    plain, crowds = coco.read_track_text(spark, folder, crowd=(6, "crowd"), values=names)
    own = lambda df, yes: df.select("frame_idx", "track_id", *"xywh", F.col("rest")[1].alias("kind"), F.lit(yes).alias("crowd"))
    return own(plain, False).unionByName(own(crowds, True))


@query(
    f"""with recursive {GT}, {DT}, {PAIRS}, {GREEDY},
t as (select class_id, count(det_id) tp, count(*) - count(det_id) fn from m where rk > 0 group by 1),
n as (select class_id, count(*) dets from dt where image_id in (select image_id from gt) group by 1),
c as (select class_id, coalesce(tp, 0) tp, coalesce(dets, 0) - coalesce(tp, 0) fp, coalesce(fn, 0) fn from t full join n using (class_id)),
p as (select tp/(tp+fp+1e-6::double) p, tp/(tp+fn+1e-6::double) r from c)
select round(avg(p), 6) mean_precision, round(avg(r), 6) mean_recall, round(avg(2*p*r/(p+r+1e-6::double)), 6) mean_f1 from p"""
)
def class_report_means(spark: SparkSession, d: str) -> DataFrame:
    gt, dt = fx.gt_boxes(spark, d), fx.pred_boxes(spark, d)
    report = metrics.class_report(matching.greedy_match(gt, dt, ["image_id", "class_id"]), dt, [])
    return rounded(summaries.class_means(report), "mean_precision", "mean_recall", "mean_f1")


@query(
    f"with {TD}, v as (select video_id, track_id, frame_idx%3 label, count(*) n from td group by all), s as (select video_id, track_id, round(avg(score), 6) score, count(*) n from td group by 1, 2),"
    " b as (select video_id, track_id, label from v qualify row_number() over (partition by video_id, track_id order by n desc, label) = 1) select video_id, track_id, score, n, label from s join b using (video_id, track_id)"
)
def tracklet_labels(spark: SparkSession, d: str) -> DataFrame:
    """Tracks whose frames are labelled apart: the mean score and the label of most frames."""
    rows = fx.tracks_pred(spark, d).withColumn("label", F.col("frame_idx") % 3)
    return rounded(summaries.tracklets(rows, ["video_id", "track_id"], "label").drop("mean_area"), "score")


@query(
    f"with {TG}, v as (select c_custkey video_id from customer), s as (select video_id, category_id, track_id, round(avg(w*h), 6) area, string_agg(frame_idx::varchar, ',' order by frame_idx) frames, count(*) n from tg group by 1, 2, 3),"
    " f as (select video_id, string_agg(frame_idx::varchar, ',' order by frame_idx) images from (select distinct video_id, frame_idx from tg) group by 1),"
    " t as (select video_id, string_agg(track_id||':'||frames, ';' order by track_id) tracks, sum(n)::bigint n_boxes, round(sum(area), 4) area from s group by 1)"
    " select video_id, coalesce(images, '') images, coalesce(tracks, '') tracks, coalesce(n_boxes, 0) n_boxes, coalesce(area, 0) area from v left join f using (video_id) left join t using (video_id)"
)
def nested_videos(spark: SparkSession, d: str) -> DataFrame:
    """A video for each customer, with its frames and tracks in order, as text; many have none."""
    out = remap.video_nests(fx.table(spark, d, "customer").select(F.col("c_custkey").alias("video_id")), fx.tracks_gt(spark, d))
    joined = lambda c: F.array_join(c.cast("array<string>"), ",")
    tracks = F.array_join(F.transform("tracks", lambda t: F.concat(t["track_id"].cast("string"), F.lit(":"), joined(t["frames"]))), ";")
    area = F.aggregate("tracks", F.lit(0.0), lambda s, t: s + F.round(t["mean_area"], 6))
    return out.select("video_id", joined(F.col("images")).alias("images"), tracks.alias("tracks"), "n_boxes", F.round(area, 4).alias("area"))


@query(f"with {TG}, m as (select *, round(avg(w*h) over (partition by video_id, track_id), 6) mean_area from tg) select video_id, category_id, track_id, frame_idx, x, y, w, h, mean_area from m")
def nested_and_exploded_tracks(spark: SparkSession, d: str) -> DataFrame:
    """Frame rows to nests and back: the same rows, with the mean area of their track."""
    keys = ["video_id", "category_id", "track_id"]
    nests = remap.nested_tracks(fx.tracks_gt(spark, d), keys)
    back = remap.exploded_tracks(nests, keys).join(nests.select(*keys, "mean_area"), keys)
    return rounded(back.select(*keys, F.col("frame_idx").cast("long").alias("frame_idx"), *"xywh", "mean_area"), "mean_area")


#: Images of one document.
DOCUMENT = 2_000


def _documents(spark: SparkSession, d: str) -> str:
    """A folder of JSON documents, each of about DOCUMENT images with their annotations and the categories."""
    gt, img = fx.gt_boxes(spark, d), fx.images(spark, d)
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(max(1, -(-img.count() // DOCUMENT)))).alias("doc")
    images = img.select(shard("id"), F.struct("id", "file_name", "width", "height").alias("r")).groupBy("doc").agg(F.collect_list("r").alias("images"))
    row = F.struct((F.col("image_id") * 100 + F.col("ann_id")).alias("id"), "image_id", F.col("class_id").alias("category_id"), F.array(*"xywh").alias("bbox"), (F.col("w") * F.col("h")).alias("area"), "iscrowd")
    annotations = gt.select(shard("image_id"), row.alias("r")).groupBy("doc").agg(F.collect_list("r").alias("annotations"))
    kinds = F.array(*(F.struct(F.lit(k).alias("id"), F.lit(f"c{k}").alias("name")) for k in range(3))).alias("categories")
    folder = _folder(spark, "documents")
    whole = images.join(annotations, "doc", "left").select("doc", F.to_json(F.struct("images", F.coalesce("annotations", F.array().cast(annotations.schema["annotations"].dataType)).alias("annotations"), kinds)).alias("value"))
    whole.write.partitionBy("doc").text(folder)  # a row, and so a file, for each document
    return folder


@query(f"with {GT}, {IMG} select image_id*100+ann_id id, image_id, 'c'||class_id name, x, y, w, h, w*h area, iscrowd, file_name from gt join img on img.id=image_id")
def annotation_documents(spark: SparkSession, d: str) -> DataFrame:
    """Truths written as annotation documents and read again by byte ranges: each annotation with its image and category."""
    images, annotations, categories = coco.read_coco(spark, _documents(spark, d))
    named = annotations.join(categories.select(F.col("id").alias("category_id"), "name").distinct(), "category_id")
    both = named.join(images.select(F.col("id").alias("image_id"), "file_name"), "image_id")
    return both.select("id", "image_id", "name", *(F.col("bbox")[k].alias(c) for k, c in enumerate("xywh")), "area", "iscrowd", "file_name")


@query(f"with {IMG} select file_name path from img where id%3<>1")
def listed_images(spark: SparkSession, d: str) -> DataFrame:
    """A list file that names every image, some without a file and some twice, and holds blank lines: the names that exist."""
    img = fx.images(spark, d)
    folder = _folder(spark, "list")
    lines = img.select(F.explode(F.array("file_name", F.concat(F.lit(" "), "file_name"), F.lit(""))).alias("value"))
    lines.write.text(folder)
    return listing.images_of_list(spark, folder, img.where("id % 3 <> 1").select(F.col("file_name").alias("path")))


@query("select c_nationkey::double nation, max(c_custkey)::double step, round(arg_max(c_acctbal, c_custkey), 2) balance from customer group by 1")
def last_log_lines(spark: SparkSession, d: str) -> DataFrame:
    """A log of JSON lines for each nation, in the order of customers: its last line."""
    folder = _folder(spark, "logs")
    rows = fx.table(spark, d, "customer").repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    line = F.to_json(F.struct(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("step"), F.col("c_acctbal").alias("balance")))
    rows.select("c_nationkey", line.alias("value")).write.partitionBy("c_nationkey").text(folder)
    return rounded(coco.last_metric_rows(spark, folder, ["nation", "step", "balance"]).drop("file"), "balance", places=2)
