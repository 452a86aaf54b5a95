"""Registered queries: each applies a job to whole tables, with the same result in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import boxes as bx
from ..functions import text as tx
from ..operators import evaluation, label_qa, matching, metrics, nms, pairs, prep, remap, summaries, tracks
from ..operators.cut import settled, shared_folder
from . import fixtures as fx
from .fixtures import DT, FR, GT, IMG, TD, TG, inter_sql, iou_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# -- pairs, matching, per-class report --------------------------------------------------------------------------------

PAIRS = f"pairs as (select g.image_id, g.class_id, g.ann_id, d.det_id, d.score, g.iscrowd, {iou_sql('g', 'd')} iou from gt g join dt d using (image_id, class_id))"
GREEDY = """
gr as (select image_id, class_id, ann_id, row_number() over (partition by image_id, class_id order by ann_id) rk from gt),
m as (
  select distinct image_id, class_id, 0::bigint rk, []::bigint[] used, null::bigint det_id, null::double iou from gt
  union all
  select m.image_id, m.class_id, m.rk + 1, case when max(p.iou) is null then any_value(m.used)
      else list_append(any_value(m.used), -max(struct_pack(i := p.iou, d := -p.det_id)).d) end,
    -max(struct_pack(i := p.iou, d := -p.det_id)).d, max(p.iou)
  from m join gr on gr.image_id = m.image_id and gr.class_id = m.class_id and gr.rk = m.rk + 1
  left join pairs p on p.image_id = m.image_id and p.class_id = m.class_id and p.ann_id = gr.ann_id and p.iou >= 0.5 and not list_contains(m.used, p.det_id)
  group by m.image_id, m.class_id, m.rk)"""


@query(f"with {GT}, {DT}, {PAIRS} select image_id, class_id, ann_id, det_id, round(iou, 6) iou from pairs where iou > 0")
def iou_pair_join(spark: SparkSession, d: str) -> DataFrame:
    out = pairs.iou_join(fx.gt_boxes(spark, d), fx.pred_boxes(spark, d), ["image_id", "class_id"], min_iou=0.0)
    return rounded(out.select("image_id", "class_id", "ann_id", "det_id", "iou"), "iou")


@query(
    f"""with recursive {GT}, {DT}, {PAIRS}, {GREEDY},
t as (select class_id, count(det_id) tp, count(*) - count(det_id) fn from m where rk > 0 group by 1),
n as (select class_id, count(*) dets from dt where image_id in (select image_id from gt) group by 1),
c as (select class_id, coalesce(tp, 0) tp, coalesce(dets, 0) - coalesce(tp, 0) fp, coalesce(fn, 0) fn from t full join n using (class_id)),
p as (select *, tp/(tp+fp+1e-6::double) p, tp/(tp+fn+1e-6::double) r from c)
select class_id, tp::bigint tp, fp::bigint fp, fn::bigint fn, round(p, 6) "precision", round(r, 6) recall, round(2*p*r/(p+r+1e-6::double), 6) f1 from p"""
)
def greedy_class_report(spark: SparkSession, d: str) -> DataFrame:
    gt, dt = fx.gt_boxes(spark, d), fx.pred_boxes(spark, d)
    return rounded(metrics.class_report(matching.greedy_match(gt, dt, ["image_id", "class_id"]), dt, []), "precision", "recall", "f1")


@query()
def optimal_matches(spark: SparkSession, d: str) -> DataFrame:
    return rounded(matching.optimal_match(fx.gt_boxes(spark, d), fx.pred_boxes(spark, d), ["image_id", "class_id"]), "iou")


@query()
def phrase_cgf1(spark: SparkSession, d: str) -> DataFrame:
    gt = fx.gt_boxes(spark, d).where("iscrowd = 0")
    dt = fx.pred_boxes(spark, d).where("score >= 0.5")
    img = prep.eligible_images(fx.images(spark, d), [])
    per = metrics.image_counts(img, gt.join(img.select(F.col("id").alias("image_id")), "image_id", "left_semi"), dt.join(img.select(F.col("id").alias("image_id")), "image_id", "left_semi"), matching.optimal_match(gt, dt, ["image_id"]))
    return rounded(metrics.phrase_metrics(per), "f1", "positive_micro_f1", "positive_macro_f1", "il_f1", "il_fpr", "il_mcc", "cgf1")


@query()
def coco_average_precision(spark: SparkSession, d: str) -> DataFrame:
    gt, dt = fx.gt_boxes(spark, d), fx.pred_boxes(spark, d)
    flags = settled(matching.score_match(gt, dt, ["image_id", "class_id"], [p / 100 for p in metrics.IOU_PERCENT]))  # ranges are sampled first
    truths = metrics.truth_counts(gt, ["class_id"], [matching.AREAS["all"]], len(metrics.IOU_PERCENT))
    ap = metrics.average_precision(flags, truths, ["class_id"])
    return rounded(ap.select("class_id", (50 + 5 * F.col("k")).alias("iou_percent"), "ap", "recall"), "ap", "recall")


@query(
    f"with {GT}, {DT}, b as (select g.image_id, g.ann_id, d.det_id, {inter_sql('g', 'd')} i, g.w*g.h ga, d.w*d.h da,"
    " (greatest(g.x+g.w,d.x+d.w)-least(g.x,d.x))*(greatest(g.y+g.h,d.y+d.h)-least(g.y,d.y)) hull from gt g join dt d using (image_id, class_id))"
    " select image_id, ann_id, det_id, round(i/da, 6) ioa, round(i/least(ga,da), 6) iom, round(i/(ga+da-i)-(hull-(ga+da-i))/hull, 6) giou from b"
)
def overlap_measures(spark: SparkSession, d: str) -> DataFrame:
    p = pairs.iou_join(fx.gt_boxes(spark, d), fx.pred_boxes(spark, d), ["image_id", "class_id"])
    a, b = bx.xywh("g_"), bx.xywh("d_")
    out = p.select("image_id", "ann_id", "det_id", bx.ioa(a, b).alias("ioa"), bx.iom(a, b).alias("iom"), bx.giou(a, b).alias("giou"))
    return rounded(out, "ioa", "iom", "giou")


# -- geometry and labels ------------------------------------------------------------------------------------------------


@query(
    f"with {GT} select image_id, ann_id, (x+w/2)/640 xc, (y+h/2)/480 yc, w/640 w, h/480 h, w*h area,"
    " greatest(least(x+w, 400.0::double), 0) x2c, (x >= 0 and y >= 0 and x+w < 400 and y+h < 300) inside,"
    " least(greatest(x/200, 0), 1) xn from gt"
)
def box_formats(spark: SparkSession, d: str) -> DataFrame:
    b = bx.xywh()
    xc, yc, w, h = bx.to_yolo(b, F.lit(640), F.lit(480))
    size = F.lit(400.0), F.lit(300.0)
    out = fx.gt_boxes(spark, d).select(
        "image_id", "ann_id", xc.alias("xc"), yc.alias("yc"), w.alias("w"), h.alias("h"), bx.area(b).alias("area"),
        bx.clip(b, *size).x2.alias("x2c"), bx.inside(b, *size).alias("inside"), bx.unit(F.col("x"), F.lit(200)).alias("xn"),
    )
    return out


@query(
    f"with {GT}, r as (select *, ((pk*37)%720-360)::double a from gt) select image_id, ann_id,"
    " round(abs(cos(radians(a)))*w+abs(sin(radians(a)))*h, 5) bw, round(abs(cos(radians(a)))*h+abs(sin(radians(a)))*w, 5) bh,"
    " (((a+180)%360+360)%360)-180 angle from r"
)
def rotated_boxes(spark: SparkSession, d: str) -> DataFrame:
    r = fx.gt_boxes(spark, d).withColumn("a", ((F.col("pk") * 37) % 720 - 360).cast("double"))
    b = bx.rotated_bounds(F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col("a"))
    return rounded(r.select("image_id", "ann_id", (b.x2 - b.x1).alias("bw"), (b.y2 - b.y1).alias("bh"), bx.normal_angle(F.col("a")).alias("angle")), "bw", "bh", places=5)


@query(f"with {GT} select image_id, ann_id, w*h/2 area from gt")
def polygon_areas(spark: SparkSession, d: str) -> DataFrame:
    triangle = F.expr("array(x, y, x + w, y, x, y + h)")
    return fx.gt_boxes(spark, d).select("image_id", "ann_id", bx.polygon_area(triangle).alias("area"))


@query(
    f"with {GT}, {DT} select image_id, string_agg(class_id || ' ' || printf('%.6f', floor(((x+w/2)/640)*1e6::double+0.5::double)/1e6::double) || ' ' || printf('%.6f', floor(((y+h/2)/480)*1e6::double+0.5::double)/1e6::double) || ' ' || printf('%.6f', floor((w/640)*1e6::double+0.5::double)/1e6::double) || ' ' || printf('%.6f', floor((h/480)*1e6::double+0.5::double)/1e6::double),"
    " chr(10) order by det_id) as text from dt group by 1"
)
def yolo_label_text(spark: SparkSession, d: str) -> DataFrame:
    from ..sources.yolo import yolo_lines

    return yolo_lines(fx.pred_boxes(spark, d), "image_id", 640, 480)


@query(
    f"with {GT}, {DT}, s as (select *, ln(score/(1-score)) logit, (image_id%7-3)::double presence from dt),"
    " p as (select image_id, class_id, det_id, 1/(1+exp(-logit))*(1/(1+exp(-presence))) score from s),"
    " t as (select * from p where score > case class_id when 0 then 0.2 when 1 then 0.3 else 0.1 end),"
    " k as (select *, row_number() over (partition by image_id order by round(score, 9) desc, class_id, det_id) r from t) select image_id, class_id, det_id, floor(score*1e6::double+0.5::double)/1e6::double score from k where r <= 3"
)
def postprocess_scores(spark: SparkSession, d: str) -> DataFrame:
    s = fx.pred_boxes(spark, d).withColumn("name", F.col("class_id").cast("string"))
    s = s.withColumn("raw", bx.presence_score(F.expr("ln(score / (1 - score))"), (F.col("image_id") % 7 - 3).cast("double"))).withColumn("score", F.round("raw", 9))
    thresholds = spark.createDataFrame([("0", 0.2), ("1", 0.3)], "name string, threshold double")
    kept = prep.top_k(prep.class_threshold(s, thresholds, 0.1), ["image_id"], 3, "class_id", "det_id")
    return kept.select("image_id", "class_id", "det_id", (F.floor(F.col("raw") * 1e6 + 0.5) / 1e6).alias("score"))


# -- label checks ---------------------------------------------------------------------------------------------------------

DAYS = f"""{FR}, v as (select distinct video_id from fr), fd as (select video_id, unnest(range(0, 1 + (select max(frame_idx) from fr))) frame_idx from v),
tot as (select video_id, frame_idx, sum(n) n from fr group by 1, 2),
fs as (select fd.video_id, fd.frame_idx, case when n is null then 'missing' when n = 1 then 'empty' else 'ok' end status from fd left join tot using (video_id, frame_idx)),
cl as (select distinct category_id from fr)"""
GRID = """g as (select fs.*, cl.category_id, coalesce(fr.n, 0) n from fs cross join cl left join fr using (video_id, frame_idx, category_id))"""


def day_frames(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(frames with status, counts, classes): all days of every video; a day of one event stands for an empty file."""
    fr = fx.frames(spark, d)
    last = fr.agg(F.max("frame_idx").alias("last"))
    days = fr.select("video_id").distinct().crossJoin(F.broadcast(last)).select(  # one row
        "video_id", F.explode(F.expr("sequence(0L, last)")).alias("frame_idx"))
    total = fr.groupBy("video_id", "frame_idx").agg(F.sum("n").alias("n"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") == 1, "empty").otherwise("ok")
    frames = days.join(total, ["video_id", "frame_idx"], "left").select("video_id", "frame_idx", status.alias("status"))
    return frames, fr.select("video_id", "frame_idx", "category_id", "n"), fr.select("category_id").distinct()


@query(
    f"with {DAYS}, o as (select *, lag(status) over w p, lead(status) over w q from fs window w as (partition by video_id order by frame_idx))"
    " select video_id, frame_idx, status from o where status <> 'ok' and p = 'ok' and q = 'ok'"
)
def frame_gaps(spark: SparkSession, d: str) -> DataFrame:
    return label_qa.frame_gaps(day_frames(spark, d)[0])


@query(
    f"with {DAYS}, {GRID}, o as (select *, lag(n) over w pn, lead(n) over w qn, lag(status) over w ps, lead(status) over w qs from g window w as (partition by video_id, category_id order by frame_idx))"
    " select video_id, frame_idx, category_id, pn prev_n, qn next_n from o where status='ok' and ps='ok' and qs='ok' and n=0 and pn>0 and qn>0"
)
def class_gaps(spark: SparkSession, d: str) -> DataFrame:
    return label_qa.class_gaps(*day_frames(spark, d))


@query(
    f"with {DAYS}, {GRID}, o as (select *, lag(n) over (partition by video_id, category_id order by frame_idx) pn from g)"
    " select video_id, frame_idx, case when n=0 then 'class_missing' else 'sudden_decrease' end kind, category_id, pn prev_n, n from o where pn>0 and (n=0 or n/pn<0.5)"
    " union all select video_id, frame_idx, 'all_missing', null::int, null::int, 0 from (select *, lag(status) over (partition by video_id order by frame_idx) p from fs) where status='missing' and p<>'missing'"
)
def frame_warnings(spark: SparkSession, d: str) -> DataFrame:
    return label_qa.frame_warnings(*day_frames(spark, d))


@query(
    f"with {DAYS}, s as (select fs.video_id, fs.frame_idx, coalesce(list(fr.category_id) filter (fr.category_id is not null), []) c from fs left join fr using (video_id, frame_idx) group by 1, 2),"
    " o as (select *, lag(c) over w p, lead(c) over w q from s window w as (partition by video_id order by frame_idx))"
    " select video_id, frame_idx, round(len(list_intersect(p, q))/greatest(len(p), len(q)), 6) confidence from o where len(c)=0 and len(p)>0 and len(q)>0"
)
def interpolation_candidates(spark: SparkSession, d: str) -> DataFrame:
    frames, counts, _ = day_frames(spark, d)
    return rounded(label_qa.interpolation_candidates(frames, counts), "confidence")


@query(
    f"with {DAYS}, h as (select video_id, count(*) frames, count_if(status='ok') ok, count_if(status='empty') empty, count_if(status='missing') missing from fs group by 1),"
    " p as (select video_id, array_to_string(list_sort(list(distinct category_id)), ',') classes, sum(n) boxes from fr group by 1) select * from h left join p using (video_id)"
)
def label_summary(spark: SparkSession, d: str) -> DataFrame:
    frames, counts, _ = day_frames(spark, d)
    return label_qa.summary(frames, counts).withColumn("classes", F.array_join(F.col("classes").cast("array<string>"), ","))


@query(
    f"with {DAYS}, {GRID}, o as (select *, lag(n) over (partition by video_id, category_id order by frame_idx) pn from g),"
    " m as (select category_id, count(*) missing from o where pn>0 and n=0 group by 1), s as (select category_id, sum(n) detections from fr group by 1)"
    " select category_id, detections::bigint detections, coalesce(missing, 0) missing, round(coalesce(missing, 0)/(select count(*) from fs), 6) missing_rate from s left join m using (category_id)"
)
def class_missing_rates(spark: SparkSession, d: str) -> DataFrame:
    return rounded(label_qa.class_rates(*day_frames(spark, d)).select("category_id", "detections", "missing", "missing_rate"), "missing_rate")


@query(
    "with m as (select p_type, (p_partkey % 40)::int id from part), a as (select distinct o_orderpriority n from orders)"
    " select 'unmapped' issue, n item from a where n not in (select p_type from m)"
    " union all select 'duplicate_id', id::varchar from m group by id having count(*) > 1"
)
def class_map_audit(spark: SparkSession, d: str) -> DataFrame:
    class_map = fx.table(spark, d, "part").selectExpr("p_type name", "cast(p_partkey % 40 as int) class_id")
    return label_qa.class_map_audit(fx.table(spark, d, "orders").selectExpr("o_orderpriority name"), class_map)


# -- suppression ------------------------------------------------------------------------------------------------------------

@query(
    f"""with recursive {GT}, {DT}, s as (select *, row_number() over (partition by image_id order by score desc, class_id, det_id) rk from (select * from dt where score > 0.1)),
ov as (select a.image_id, a.rk, b.rk lo from s a join s b on a.image_id=b.image_id and a.rk<b.rk and {iou_sql('a', 'b')} > 0.2),
n as (select image_id, 0::bigint rk, []::bigint[] kept from s group by 1
  union all select n.image_id, n.rk+1, case when count(p.rk) filter (list_contains(n.kept, p.rk)) > 0 then any_value(n.kept) else list_append(any_value(n.kept), n.rk+1) end
  from n join s on s.image_id=n.image_id and s.rk=n.rk+1 left join ov p on p.image_id=n.image_id and p.lo=s.rk group by n.image_id, n.rk)
select s.image_id, s.class_id, s.det_id % 1000 det_id from s join (select image_id, unnest(arg_max(kept, rk)) rk from n group by 1) using (image_id, rk)"""
)
def generic_box_nms(spark: SparkSession, d: str) -> DataFrame:
    dets = fx.pred_boxes(spark, d).withColumn("det_id", F.col("class_id") * 1000 + F.col("det_id"))
    return nms.generic_nms(dets, ["image_id"], 0.1, 0.2).select("image_id", "class_id", (F.col("det_id") % 1000).alias("det_id"))


@query(
    f"""with recursive {TD}, s as (select *, row_number() over (partition by video_id, frame_idx order by score desc, track_id) rk from td),
ov as (select a.video_id, a.frame_idx, a.rk, b.rk lo from s a join s b on a.video_id=b.video_id and a.frame_idx=b.frame_idx and a.rk<b.rk and {iou_sql('a', 'b')} >= 0.3),
n as (select video_id, frame_idx, 0::bigint rk, []::bigint[] kept from s group by 1, 2
  union all select n.video_id, n.frame_idx, n.rk+1, case when count(p.rk) filter (list_contains(n.kept, p.rk)) > 0 then any_value(n.kept) else list_append(any_value(n.kept), n.rk+1) end
  from n join s on s.video_id=n.video_id and s.frame_idx=n.frame_idx and s.rk=n.rk+1 left join ov p on p.video_id=n.video_id and p.frame_idx=n.frame_idx and p.lo=s.rk group by n.video_id, n.frame_idx, n.rk)
select s.video_id, s.frame_idx, s.track_id from s join (select video_id, frame_idx, unnest(arg_max(kept, rk)) rk from n group by 1, 2) using (video_id, frame_idx, rk)"""
)
def frame_level_nms(spark: SparkSession, d: str) -> DataFrame:
    dets = fx.tracks_pred(spark, d).withColumnRenamed("track_id", "det_id")
    return nms.frame_nms(dets, ["video_id", "frame_idx"], 0.3).select("video_id", "frame_idx", F.col("det_id").alias("track_id"))


SWEEP = """n as (select {key}, 0::bigint rk, []::bigint[] kept from s group by 1
  union all select n.{key}, n.rk+1, case when count(p.rk) filter (list_contains(n.kept, p.rk)) > 0 then any_value(n.kept) else list_append(any_value(n.kept), n.rk+1) end
  from n join s on s.{key}=n.{key} and s.rk=n.rk+1 left join ov p on p.{key}=n.{key} and p.lo=s.rk group by n.{key}, n.rk)"""


@query(
    f"""with recursive {TD}, sc as (select video_id, track_id, round(avg(score), 12) m from td group by 1, 2), s as (select *, row_number() over (partition by video_id order by m desc, track_id) rk from sc),
pr as (select a.video_id, a.track_id ta, b.track_id tb, sum({inter_sql('a', 'b')}) i, sum(a.w*a.h+b.w*b.h-{inter_sql('a', 'b')}) u from td a join td b on a.video_id=b.video_id and a.frame_idx=b.frame_idx and a.track_id<>b.track_id group by 1, 2, 3),
ov as (select pr.video_id, x.rk, y.rk lo from pr join s x on x.video_id=pr.video_id and x.track_id=ta join s y on y.video_id=pr.video_id and y.track_id=tb where i >= 0.3::double*u and x.rk < y.rk),
{SWEEP.format(key='video_id')}
select td.video_id, td.track_id, td.frame_idx from td join s using (video_id, track_id) join (select video_id, unnest(arg_max(kept, rk)) rk from n group by 1) using (video_id, rk)"""
)
def track_level_nms(spark: SparkSession, d: str) -> DataFrame:
    return nms.track_nms(fx.tracks_pred(spark, d), ["video_id"], 0.3).select("video_id", "track_id", "frame_idx")


@query(
    f"""with recursive {GT}, {DT}, s as (select image_id, class_id*1000+det_id det_id, x, y, w, h, row_number() over (partition by image_id order by score desc, class_id*1000+det_id) rk from dt),
ov as (select a.image_id, a.rk, b.rk lo from s a join s b on a.image_id=b.image_id and a.rk<b.rk and {inter_sql('a', 'b')}/least(a.w*a.h, b.w*b.h) > 0.3::double),
{SWEEP.format(key='image_id')}
select image_id, det_id, list_contains(kept, rk) kept from s join (select image_id, arg_max(kept, rk) kept from n group by 1) using (image_id)"""
)
def iom_overlap_filter(spark: SparkSession, d: str) -> DataFrame:
    dets = fx.pred_boxes(spark, d).withColumn("det_id", F.col("class_id") * 1000 + F.col("det_id"))
    return nms.iom_filter(dets, ["image_id"]).select("image_id", "det_id", "kept")


# -- tracks -------------------------------------------------------------------------------------------------------------------


@query(
    f"with {TD}, i as (select g.video_id, g.category_id, g.track_id gt_id, t.track_id dt_id, sum({inter_sql('g', 't')}) i from tg g join td t using (video_id, category_id, frame_idx) group by 1,2,3,4),"
    " a as (select video_id, category_id, track_id gt_id, sum(w*h) ga from tg group by 1,2,3), b as (select video_id, category_id, track_id dt_id, sum(w*h) da from td group by 1,2,3)"
    " select video_id, category_id, gt_id, dt_id, round(i, 6) \"inter\", round(ga+da-i, 6) \"union\", round(i/(ga+da-i), 6) iou from i join a using (video_id, category_id, gt_id) join b using (video_id, category_id, dt_id)"
)
def tracklet_iou(spark: SparkSession, d: str) -> DataFrame:
    out = pairs.tracklet_iou(fx.tracks_gt(spark, d).drop("eid", "cents"), fx.tracks_pred(spark, d), ["video_id", "category_id"])
    return rounded(out, "inter", "union", "iou")


@query(
    f"with {TD}, s as (select g.video_id, g.frame_idx, g.track_id gt_id, t.track_id dt_id, {iou_sql('g', 't')} sim from tg g join td t using (video_id, frame_idx)),"
    " p as (select * from s where sim>0), n as (select *, sim/(sum(sim) over (partition by video_id, frame_idx, gt_id)+sum(sim) over (partition by video_id, frame_idx, dt_id)-sim) v from p),"
    " m as (select video_id, gt_id, dt_id, sum(v) m from n group by 1,2,3), a as (select video_id, track_id gt_id, count(*) g from tg group by 1,2), b as (select video_id, track_id dt_id, count(*) t from td group by 1,2)"
    " select video_id, gt_id, dt_id, round(m/(g+t-m), 6) align from m join a using (video_id, gt_id) join b using (video_id, dt_id)"
)
def global_alignment(spark: SparkSession, d: str) -> DataFrame:
    gt, dt = fx.tracks_gt(spark, d), fx.tracks_pred(spark, d)
    return rounded(tracks.alignment(tracks.similarity(gt, dt, ["video_id"]), gt, dt, ["video_id"]).drop("g", "d"), "align")


HOTA = ["det_a", "ass_a", "loc_a", "hota", "det_re", "det_pr", "ass_re", "ass_pr", "owta"]


@query()
def hota_by_video(spark: SparkSession, d: str) -> DataFrame:
    out = tracks.hota(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d).where("score > 0.1"), ["video_id"])
    return rounded(out, *HOTA)


@query()
def hota_combined(spark: SparkSession, d: str) -> DataFrame:
    return rounded(tracks.combine_hota(tracks.hota(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d), ["video_id"])), *HOTA)


@query(
    f"with {TD}, l as (select video_id, count(*) gt_dets, count(distinct track_id) gt_ids from tg group by 1), r as (select video_id, count(*) dets, count(distinct track_id) ids from td group by 1),"
    " f as (select video_id, count(distinct frame_idx) frames from (select video_id, frame_idx from tg union all select video_id, frame_idx from td) group by 1)"
    " select video_id, frames, coalesce(gt_dets,0) gt_dets, coalesce(gt_ids,0) gt_ids, coalesce(dets,0) dets, coalesce(ids,0) ids from f left join l using (video_id) left join r using (video_id)"
)
def track_counts(spark: SparkSession, d: str) -> DataFrame:
    return tracks.counts(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d), ["video_id"])


@query(f"with {TD} select video_id, frame_idx, track_id//20 track_id, count(*) n from td group by 1,2,3 having count(*) > 1")
def repeated_track_ids(spark: SparkSession, d: str) -> DataFrame:
    """All tracks of a video under one id: every frame with more than one box repeats it."""
    return tracks.repeated_ids(fx.tracks_pred(spark, d).withColumn("track_id", F.expr("track_id div 20")), ["video_id"])


@query(f"with {TD} select video_id, track_id, round(avg(score), 6) score, count(*) n, round(avg(w*h), 6) mean_area from td group by 1,2")
def tracklet_scores(spark: SparkSession, d: str) -> DataFrame:
    return rounded(summaries.tracklets(fx.tracks_pred(spark, d), ["video_id", "track_id"]), "score", "mean_area")


# -- re-indexing and shapes -----------------------------------------------------------------------------------------------------


@query(f"with {TD}, p as (select distinct video_id, category_id from (select video_id, category_id from tg union all select video_id, category_id from td)) select video_id, category_id, row_number() over (order by video_id, category_id) new_id from p")
def video_phrase_ids(spark: SparkSession, d: str) -> DataFrame:
    return remap.pair_ids(fx.tracks_gt(spark, d), fx.tracks_pred(spark, d))


@query(
    f"with {TG}, t as (select distinct video_id, track_id % 97 track_id from tg), n as (select track_id from t group by 1 having count(*) > 1),"
    " r as (select *, (select max(track_id) from t) + row_number() over (order by track_id, video_id) new_id from t where track_id in (select track_id from n))"
    " select video_id, track_id, coalesce(new_id, track_id) new_track_id from t left join r using (video_id, track_id)"
)
def unique_track_ids(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tracks_gt(spark, d).select("video_id", (F.col("track_id") % 97).alias("track_id")).distinct()
    return remap.unique_tracks(t).select("video_id", "track_id", "new_track_id")


@query(f"with {TG} select video_id, track_id, frame_idx, x, y, w, h, w*h area from tg")
def track_round_trip(spark: SparkSession, d: str) -> DataFrame:
    nested = remap.nested_tracks(fx.tracks_gt(spark, d), ["video_id", "track_id"])
    return remap.exploded_tracks(nested, ["video_id", "track_id"]).withColumn("frame_idx", F.col("frame_idx").cast("long"))


@query("select l_orderkey + s image_id, c_custkey + t custkey from (select l_orderkey, o_custkey c_custkey from lineitem join orders on l_orderkey = o_orderkey), (select (min(o_orderkey) = 0)::int s, (min(o_custkey) = 0)::int t from orders)")
def one_based_ids(spark: SparkSession, d: str) -> DataFrame:
    orders = fx.table(spark, d, "orders")
    rows = fx.table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr("l_orderkey image_id", "o_custkey custkey")
    _, (rows,) = remap.reindexed(orders, "o_orderkey", [(rows, "image_id")])
    _, (rows,) = remap.reindexed(orders, "o_custkey", [(rows, "custkey")])
    return rows


@query(f"with {IMG} select id, row_number() over (order by id) - 1 as number from img")
def global_numbers(spark: SparkSession, d: str) -> DataFrame:
    return remap.numbered(fx.images(spark, d).select("id"), ["id"], "number")


# -- preparation ----------------------------------------------------------------------------------------------------------------

QO = """q as (select conv_id datapoint_id, turn query_idx, turn // 2 processing_order, text query_text, role from conversations),
ob as (select l_orderkey datapoint_id, l_linenumber::bigint obj_idx, l_quantity*l_discount area, l_quantity w, l_discount h, (l_linenumber%5=0)::int is_crowd from lineitem)"""


def query_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Conversations as datapoints: turns are queries, the lines of the order with the same number are objects."""
    objects = fx.table(spark, d, "lineitem").selectExpr(
        "l_orderkey datapoint_id", "cast(l_linenumber as bigint) obj_idx", "l_quantity * l_discount area", "l_quantity w", "l_discount h", "cast(l_linenumber % 5 = 0 as int) is_crowd"
    )
    queries = fx.table(spark, d, "conversations").selectExpr("conv_id datapoint_id", "turn query_idx", "turn div 2 processing_order", "text query_text", "role")
    ids = objects.groupBy("datapoint_id").agg(F.array_sort(F.collect_set("obj_idx")).alias("object_ids"))
    queries = queries.join(ids, "datapoint_id", "left").withColumn("object_ids", F.expr("filter(coalesce(object_ids, array()), i -> i % 2 = query_idx % 2)"))
    return queries, objects


@query(
    f"with {QO}, bad as (select distinct q.datapoint_id, q.query_idx from q join ob on ob.datapoint_id=q.datapoint_id and ob.obj_idx%2=q.query_idx%2 where w<=0 or h<=0)"
    " select datapoint_id, query_idx, count(*) n from q where not exists (select 1 from bad where bad.datapoint_id=q.datapoint_id and bad.query_idx=q.query_idx) group by 1,2"
)
def no_flat_target_queries(spark: SparkSession, d: str) -> DataFrame:
    q, ob = query_tables(spark, d)
    return prep.drop_queries(q, prep.with_flat_targets(q, ob)).groupBy("datapoint_id", "query_idx").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {QO} select datapoint_id, obj_idx, count(*) n from ob where area >= 1e-6 and is_crowd = 0 group by 1, 2")
def real_objects(spark: SparkSession, d: str) -> DataFrame:
    return prep.real_objects(query_tables(spark, d)[1]).groupBy("datapoint_id", "obj_idx").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {IMG}, b as (select id from img where is_pixel_exhaustive = 0) select id from img where is_instance_exhaustive = 1 and id not in (select id from b)")
def eligible_images(spark: SparkSession, d: str) -> DataFrame:
    img = fx.images(spark, d)
    other = img.withColumn("is_instance_exhaustive", F.col("is_pixel_exhaustive"))
    return prep.eligible_images(img, [other]).select("id")


@query(f"with {TD} select 'gt' side, video_id, count(*) n from tg where video_id % 7 <> 0 group by 1,2 union all select 'dt', video_id, count(*) from td where video_id % 7 <> 0 group by 1,2")
def available_videos(spark: SparkSession, d: str) -> DataFrame:
    gt, dt = fx.tracks_gt(spark, d), fx.tracks_pred(spark, d)
    have = gt.select("video_id").where("video_id % 7 <> 0")
    _, a, b = prep.available(gt.select("video_id").distinct(), gt, dt, have)
    one = lambda df, side: df.groupBy("video_id").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))
    return one(a, "gt").unionByName(one(b, "dt")).select("side", "video_id", "n")


SHARDED = "sh as (select *, eid%3 shard from fr union all select *, (eid%3+1)%3 from fr where eid%4=0)"


@query(
    f"with {FR}, {SHARDED}, f as (select video_id, category_id, min(shard) shard from sh group by 1,2), k as (select sh.* from sh join f using (video_id, category_id, shard)),"
    " r as (select *, row_number() over (partition by video_id order by n desc, cents desc, eid) r from k) select video_id, category_id, frame_idx, shard, eid from r where r <= 5"
)
def merged_shards(spark: SparkSession, d: str) -> DataFrame:
    fr = fx.frames(spark, d)
    sharded = fr.withColumn("shard", F.col("eid") % 3).unionByName(fr.where("eid % 4 = 0").withColumn("shard", (F.col("eid") % 3 + 1) % 3))
    kept = prep.merge_shards(sharded, ["video_id", "category_id"]).withColumn("score", F.col("n"))
    w = Window.partitionBy("video_id").orderBy(F.desc("n"), F.desc("cents"), "eid")
    return kept.withColumn("r", F.row_number().over(w)).where("r <= 5").select("video_id", "category_id", "frame_idx", "shard", "eid")


@query(
    f"with {FR}, f as (select distinct video_id, frame_idx from fr), r as (select *, row_number() over (partition by video_id order by frame_idx) - 1 r, count(*) over (partition by video_id) n from f),"
    " s as (select *, greatest(1, least(4, (n-1)//5)) st from r), a as (select *, ((video_id*2654435761+3)%1000003) % greatest(1, n-st*5) a from s)"
    " select video_id, frame_idx, ((r-a)//st)::int stage from a where r>=a and (r-a)%st=0 and (r-a)//st<6"
)
def sampled_clips(spark: SparkSession, d: str) -> DataFrame:
    f = fx.frames(spark, d).select("video_id", "frame_idx").distinct()
    return prep.clip_frames(f, 6, 4, seed=3)


@query(
    f"with {FR}, v as (select video_id, 1+max(frame_idx) n from fr group by 1) select 'v'||video_id video_name, f frame_idx, printf('v%d_frame_%06d', video_id, f) \"name\" from (select video_id, unnest(range(0, n, 4)) f from v)"
)
def frame_sampling_plan(spark: SparkSession, d: str) -> DataFrame:
    v = fx.frames(spark, d).groupBy("video_id").agg((F.max("frame_idx") + 1).alias("length"))
    return prep.frame_plan(v.select(F.concat(F.lit("v"), F.col("video_id").cast("string")).alias("video_name"), "length"), 4)


@query(
    f"with {IMG}, {GT}, c as (select distinct class_id from gt) select id image_id, c.class_id, (c.class_id // 2)::bigint chunk, count(g.ann_id) n, coalesce(array_to_string(list(g.ann_id order by g.ann_id) filter (g.ann_id is not null), ','), '') ids"
    " from img cross join c left join gt g on g.image_id=img.id and g.class_id=c.class_id group by 1,2,3"
)
def image_category_queries(spark: SparkSession, d: str) -> DataFrame:
    out = evaluation.image_category_queries(fx.images(spark, d).select(F.col("id").alias("image_id")), fx.gt_boxes(spark, d), chunk=2)
    return out.select("image_id", "class_id", "chunk", "n", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(
    f"with {IMG}, {GT}, {DT}, e as (select distinct image_id from dt), g as (select distinct image_id from gt) select 'not_evaluated' issue, id from img where id not in (select image_id from e)"
    " union all select 'no_truth', image_id from e where image_id not in (select image_id from g)"
)
def reconciled_ids(spark: SparkSession, d: str) -> DataFrame:
    evaluated, truth = (df.select(F.col("image_id").alias("id")).distinct() for df in (fx.pred_boxes(spark, d), fx.gt_boxes(spark, d)))
    lacking = fx.images(spark, d).select("id").join(evaluated, "id", "left_anti").select(F.lit("not_evaluated").alias("issue"), "id")
    return lacking.unionByName(evaluated.join(truth, "id", "left_anti").select(F.lit("no_truth").alias("issue"), "id"))


# -- scores ------------------------------------------------------------------------------------------------------------------------


@query(
    f"with {GT}, {DT}, s as (select class_id, score, 1/(1+exp(-(image_id%7-3)::double)) pr from dt)"
    " select class_id, round(max(score), 6) max_before, round(avg(score), 6) mean_before, round(max(score*pr), 6) max_after, round(avg(score*pr), 6) mean_after,"
    " count_if(score*pr > 0.1) n_10, count_if(score*pr > 0.2) n_20, count_if(score*pr > 0.3) n_30, count_if(score*pr > 0.5) n_50 from s group by 1"
)
def presence_analysis(spark: SparkSession, d: str) -> DataFrame:
    after = F.col("score") * bx.sigmoid((F.col("image_id") % 7 - 3).cast("double"))
    return rounded(summaries.presence(fx.pred_boxes(spark, d), "class_id", after), "max_before", "mean_before", "max_after", "mean_after")


@query(
    f"with {GT}, {DT}, l as (select class_id, score, (det_id <= 100 and image_id % 3 <> 0) y from dt), t as (select unnest(range(0, 100)) k),"
    " c as (select class_id, k, count_if(y) tp, count_if(not y) fp from l join t on score > k/99.0::double group by 1,2), n as (select class_id, count_if(y) p from l group by 1),"
    " f as (select class_id, k, 2.0::double*tp/(tp+fp+p) f1 from c join n using (class_id))"
    " select class_id, min(k)::bigint k, round(any_value(f1), 6) f1 from f where (class_id, round(f1, 12)) in (select class_id, round(max(f1), 12) from f group by 1) group by 1"
)
def best_f1_threshold(spark: SparkSession, d: str) -> DataFrame:
    """Grid of 100 thresholds: scores fall into cells once, then a cumulative sum from the right."""
    return rounded(summaries.best_threshold(fx.pred_boxes(spark, d), "class_id", (F.col("det_id") <= 100) & (F.col("image_id") % 3 != 0)), "f1")


@query(
    f"with {GT}, {DT}, {IMG}, i as (select id, rarity from img), s as (select i.rarity, d.class_id, avg(d.score) v from dt d join i on i.id=d.image_id group by 1,2),"
    " b as (select rarity, avg(v) mean, count(*) n from s group by 1) select rarity::varchar bucket, round(mean, 6) v, n from b union all select 'mean_of_means', round(avg(mean), 6), count(*) from b"
    " union all select 'true_mean', round(avg(v), 6), count(*) from s"
)
def bucket_roll_up(spark: SparkSession, d: str) -> DataFrame:
    img = fx.images(spark, d).select(F.col("id").alias("image_id"), "rarity")
    s = fx.pred_boxes(spark, d).join(img, "image_id").groupBy("rarity", "class_id").agg(F.avg("score").alias("v"))
    return rounded(summaries.bucket_means(s, "rarity"), "v")


@query("select o_orderpriority source, count(*) items, count_if(o_totalprice > 100000) successes, round(min(o_totalprice), 4) lo, round(max(o_totalprice), 4) hi, round(avg(o_totalprice), 4) mean, round(median(o_totalprice), 4) median, arg_min(o_totalprice, o_orderkey) \"first\", round((sum(o_totalprice)-arg_min(o_totalprice, o_orderkey))/(count(*)-1), 4) rest_mean from orders group by 1")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    out = summaries.run_summary(fx.table(spark, d, "orders"), "o_orderpriority", "o_totalprice", "o_orderkey", F.col("o_totalprice") > 100000)
    return rounded(out, "lo", "hi", "mean", "median", "rest_mean", places=4)


@query(f"with {GT}, {DT} select image_id, count_if(score > 0.5) n from dt group by 1")
def objects_per_image(spark: SparkSession, d: str) -> DataFrame:
    return fx.pred_boxes(spark, d).groupBy("image_id").agg(F.count_if(F.col("score") > 0.5).alias("n"))


# -- streams and track state ----------------------------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


SEEN = FR.replace("fr as (", "sf as (").replace("cast(count(*) as int) n", "cast(count_if(event_id%4<>0) as int) n")
STREAM = f"""{SEEN}, t as (select video_id, frame_idx, sum(n) total from sf group by 1, 2), g as (select t.*, c.category_id, coalesce(sf.n, 0) n from t cross join (select distinct category_id from sf) c
 left join sf using (video_id, frame_idx, category_id)), o as (select *, lag(n) over (partition by video_id, category_id order by frame_idx) pn from g),
 e as (select *, lag(total) over (partition by video_id order by frame_idx) pt from t)"""


@query(
    f"with {STREAM} select video_id, frame_idx, case when n=0 then 'class_missing' else 'sudden_decrease' end kind, category_id, pn prev_n, n from o where pn>0 and (n=0 or n/pn<0.5)"
    " union all select video_id, frame_idx, 'all_missing', null::int, null::int, 0 from e where total=0 and pt>0"
)
def streamed_frame_warnings(spark: SparkSession, d: str) -> DataFrame:
    """Days with events as frames, checked against the day before by a stateful stream; days may be empty."""
    from ..streaming import frames as st

    stream = st.stream_warnings(st.event_stream(spark, f"{d}/event[s].parquet", 1_000_000))
    name = "warnings_" + _folder(spark, "x")[-12:]
    return st.drained(stream, name, _folder(spark, "warnings"))


@query("select user_id video_id, case event_type when 'view' then 1 when 'signup' then 2 when 'purchase' then 3 when 'error' then 4 else 5 end category_id, count_if(event_id%4<>0)::bigint boxes, count(*)::bigint as \"rows\" from events group by 1, 2")
def streamed_progress(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming import frames as st

    stream = st.stream_progress(st.event_stream(spark, f"{d}/event[s].parquet", 1_000_000))
    name = "progress_" + _folder(spark, "x")[-12:]
    return st.drained(stream, name, _folder(spark, "progress"), "complete")


EVENTS = f"""{FR}, e as (select video_id, frame_idx, video_id*10+category_id track_id, eid%3 det_id,
 case when row_number() over (partition by video_id, category_id order by frame_idx)=1 then 'new' when eid%3=0 then 'unmatched' when eid%7=1 then 'empty' else 'matched' end kind from fr),
f as (select *, min(frame_idx) over (partition by video_id, track_id) ff from e),
u as (select *, row_number() over (partition by video_id, track_id order by frame_idx) c from f where kind='unmatched'),
s as (select *, arg_min(track_id, ff*1000000+track_id) over (partition by video_id, frame_idx, det_id) ea from f where kind in ('matched','new')),
p as (select *, row_number() over (partition by video_id, ea, track_id order by frame_idx) c from s where ea<>track_id),
r as (select video_id, track_id, frame_idx, 'unmatched' reason from u where c=3 and ff>frame_idx-40 union all select video_id, track_id, frame_idx, 'duplicate' from p where c=2 and ff>frame_idx-40)"""


def track_events(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("video_id", "category_id").orderBy("frame_idx")
    kind = F.when(F.row_number().over(w) == 1, "new").when(F.col("eid") % 3 == 0, "unmatched").when(F.col("eid") % 7 == 1, "empty").otherwise("matched")
    return fx.frames(spark, d).select("video_id", "frame_idx", (F.col("video_id") * 10 + F.col("category_id")).alias("track_id"), (F.col("eid") % 3).alias("det_id"), kind.alias("kind"))


@query(f"with {EVENTS} select video_id, track_id, min(frame_idx) frame_idx, arg_min(reason, frame_idx*10+(reason='unmatched')::int) reason from r group by 1,2")
def hotstart_removed_tracks(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming.hotstart import prune_tracks

    return prune_tracks(track_events(spark, d), delay=40, unmatch=3, dup=2)[0]


@query(
    f"""with recursive {EVENTS}, gone as (select video_id, track_id, min(frame_idx) gone from r group by 1, 2), ke as (select *, row_number() over (partition by video_id, track_id order by frame_idx) k,
  count_if(kind='unmatched') over (partition by video_id, track_id order by frame_idx) misses from f),
al as (select video_id, track_id, 0::bigint k, 2::bigint alive, 0::bigint frame_idx, 0::bigint misses from ke where k=1
  union all select ke.video_id, ke.track_id, ke.k, least(3, greatest(-1, alive + (kind='matched')::bigint - (kind='unmatched')::bigint)), ke.frame_idx, ke.misses
  from al join ke on ke.video_id=al.video_id and ke.track_id=al.track_id and ke.k=al.k+1)
select video_id, track_id, frame_idx from al left join gone using (video_id, track_id) where k>0 and misses>0 and alive<=0 and (gone is null or frame_idx<gone)"""
)
def hotstart_suppressed_tracks(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming.hotstart import prune_tracks

    return prune_tracks(track_events(spark, d), delay=40, unmatch=3, dup=2, start=2, most=3)[1]


# -- masks: every box as a filled rectangle on a small canvas -----------------------------------------------------------------------

PIX = "px as (select image_id, ann_id, class_id, iscrowd, least(floor(x/8), 80)::bigint x1, least(floor(y/8), 60)::bigint y1, least(floor((x+w)/8), 80)::bigint x2, least(floor((y+h)/8), 60)::bigint y2 from gt)"
H, W = 60, 80


def rectangle_masks(spark: SparkSession, d: str, boxes: DataFrame) -> DataFrame:
    from ..operators import masks

    px = boxes
    for name, expr, top in (("x1", "floor(x / 8)", W), ("y1", "floor(y / 8)", H), ("x2", "floor((x + w) / 8)", W), ("y2", "floor((y + h) / 8)", H)):
        px = px.withColumn(name, F.least(F.greatest(F.expr(expr), F.lit(0)), F.lit(top)).cast("int"))
    runs = masks.rectangle_runs(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), H, W)
    return px.withColumns({"runs": runs, "height": F.lit(H), "width": F.lit(W)})


@query(
    f"with {GT}, {PIX} select image_id, ann_id, ((x2-x1)*(y2-y1))::bigint area, round((x2-x1)*(y2-y1)/4800, 6) share, x1::int mx, y1::int my, (x2-x1)::int mw, (y2-y1)::int mh from px"
)
def mask_measures(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import masks

    m = masks.bounds(rectangle_masks(spark, d, fx.gt_boxes(spark, d)).select("image_id", "ann_id", "runs", "height", "width"))
    size = masks.area(F.col("runs"))
    return rounded(m.select("image_id", "ann_id", size.alias("area"), (size / (H * W)).alias("share"), "mx", "my", "mw", "mh"), "share")


@query(
    f"with {GT}, {PIX}, p as (select a.image_id, a.ann_id, b.ann_id other, a.iscrowd, greatest(least(a.x2,b.x2)-greatest(a.x1,b.x1),0)*greatest(least(a.y2,b.y2)-greatest(a.y1,b.y1),0) i,"
    " (a.x2-a.x1)*(a.y2-a.y1) na, (b.x2-b.x1)*(b.y2-b.y1) nb from px a join px b on a.image_id=b.image_id and a.ann_id<b.ann_id)"
    " select image_id, ann_id, other, i::bigint \"inter\", round(i/(case when iscrowd=1 then nb else na+nb-i end), 6) iou, round(i/nb, 6) ioa, round(i/least(na,nb), 6) iom from p where i > 0"
)
def mask_similarity(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import masks

    m = rectangle_masks(spark, d, fx.gt_boxes(spark, d)).select("image_id", "ann_id", "iscrowd", "runs", "x1", "y1", "x2", "y2")
    other = m.select("image_id", F.col("ann_id").alias("other"), F.col("runs").alias("runs_b"), *(F.col(c).alias(f"o{c}") for c in ("x1", "y1", "x2", "y2")))
    near = "ann_id < other and x1 < ox2 and ox1 < x2 and y1 < oy2 and oy1 < y2"  # boxes first: masks of other pairs cannot meet
    both = m.join(other, "image_id").where(near).select("image_id", "ann_id", "other", F.col("iscrowd").alias("crowd"), F.col("runs").alias("runs_a"), "runs_b")
    return rounded(masks.similarity(both).drop("crowd", "g_area", "d_area"), "iou", "ioa", "iom")


@query(
    f"with {GT}, {PIX}, cells as (select distinct image_id, class_id, c, r from (select image_id, class_id, unnest(range(x1, x2)) c, y1, y2 from px), lateral (select unnest(range(y1, y2)) r))"
    " select image_id, class_id, count(*) area from cells group by 1, 2"
)
def mask_union_area(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import masks

    m = masks.union(rectangle_masks(spark, d, fx.gt_boxes(spark, d)), ["image_id", "class_id"])
    return m.select("image_id", "class_id", masks.area(F.col("runs")).alias("area"))


# -- association, samples, text and small joins -----------------------------------------------------------------------------------


def frame_dets(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Truth boxes as existing tracks, predicted boxes as detections, keyed by video and frame."""
    return fx.tracks_pred(spark, d).withColumnRenamed("track_id", "det_id"), fx.tracks_gt(spark, d)


ASSOC = f"""{TD}, p as (select d.video_id, d.frame_idx, d.track_id det_id, t.track_id, {iou_sql('d', 't')} iou from td d join tg t using (video_id, frame_idx)),
m as (select video_id, frame_idx, det_id, count_if(iou>=0.1) k, coalesce(array_to_string(list(track_id order by track_id) filter (iou>=0.1), ','), '') matched, max(struct_pack(i:=iou, t:=-track_id)) b from p where iou>0 group by 1,2,3),
o as (select d.video_id, d.frame_idx, d.track_id det_id, d.score, coalesce(k,0)=0 and score>=0.7 is_new, coalesce(matched,'') matched, b from td d left join m on m.video_id=d.video_id and m.frame_idx=d.frame_idx and m.det_id=d.track_id)"""


@query(f"with {ASSOC} select video_id, frame_idx, det_id, is_new, matched, case when score>=0.8 and not is_new and b.i>=0.8 then -b.t end anchor from o")
def detection_track_association(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.associate import associate

    out, _ = associate(*frame_dets(spark, d), ["video_id", "frame_idx"])
    return out.select("video_id", "frame_idx", "det_id", "is_new", F.array_join(F.col("matched").cast("array<string>"), ",").alias("matched"), "anchor")


@query(f"with {TD}, p as (select t.video_id, t.frame_idx, t.track_id, max({iou_sql('d', 't')}) iou from tg t left join td d using (video_id, frame_idx) group by 1,2,3) select video_id, frame_idx, track_id, case when iou>=0.5 then 'matched' else 'unmatched' end state from p")
def track_states(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.associate import associate

    return associate(*frame_dets(spark, d), ["video_id", "frame_idx"])[1]


@query(
    f"with {ASSOC}, n as (select *, row_number() over (partition by video_id order by score desc, det_id, frame_idx) r from o where is_new) select video_id, frame_idx, det_id from n where r<=2".replace(
        "iou>=0.1", "iou>=0.8"
    ).replace("score>=0.7", "score>=0.3")
)
def capped_new_detections(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.associate import associate

    found = associate(*frame_dets(spark, d), ["video_id", "frame_idx"], iou_thr=0.8, new_thr=0.3)[0]
    return prep.top_k(found.where("is_new"), ["video_id"], 2, "det_id", "frame_idx").select("video_id", "frame_idx", "det_id")


@query(f"with {IMG}, r as (select id, (id*2654435761+5)%1000003 h from img) select id from r order by h, id limit 500")
def seeded_subset(spark: SparkSession, d: str) -> DataFrame:
    return fx.images(spark, d).select("id").orderBy(prep.hashed(F.col("id"), 5), "id").limit(500)


@query(f"with {IMG} select ((id*2654435761)%1000003)%7 shard, count(*) n from img group by 1")
def hashed_shards(spark: SparkSession, d: str) -> DataFrame:
    return prep.shard_of(fx.images(spark, d), "id", 7).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))


@query(f"with {TD} select video_id, arg_max(track_id, score*1000000-track_id/1e9) track_id, round(max(score), 6) score from (select video_id, track_id, round(avg(score), 6) score from td group by 1,2) group by 1")
def best_track_of_video(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tracks_pred(spark, d).groupBy("video_id", "track_id").agg(F.round(F.avg("score"), 6).alias("score"))
    return rounded(summaries.best_of(t, "video_id", "track_id"), "score")


@query(f"with {QO} select datapoint_id, query_idx, case when query_text = 'geometric' then query_text else 'a photo of ' || query_text || (case when lower(trim(role)) in ('user') then '.' else '' end) end query_text from q")
def prefixed_texts(spark: SparkSession, d: str) -> DataFrame:
    q, _ = query_tables(spark, d)
    ended = tx.with_ends(F.col("query_text"), after=".", only=tx.listed(F.col("role"), ["User"]))
    return q.select("datapoint_id", "query_idx", tx.with_ends(ended, before="a photo of ").alias("query_text"))


@query(
    f"with {QO}, c as (select q.datapoint_id, q.query_idx, count(distinct ob.obj_idx) n from q left join ob on ob.datapoint_id=q.datapoint_id and ob.obj_idx%2=q.query_idx%2 group by 1,2),"
    " r as (select *, row_number() over (partition by datapoint_id order by n=0, ((query_idx+datapoint_id)*2654435761+9)%1000003, query_idx) r from c) select datapoint_id, query_idx, n from r where r<=2"
)
def capped_queries(spark: SparkSession, d: str) -> DataFrame:
    q = query_tables(spark, d)[0].dropDuplicates(["datapoint_id", "query_idx"])
    return prep.cap_queries(q, 2, positives_first=True, seed=9).select("datapoint_id", "query_idx", F.size("object_ids").cast("long").alias("n"))


@query(
    f"with {QO}, bad as (select distinct q.datapoint_id, q.query_idx from q join ob on ob.datapoint_id=q.datapoint_id and ob.obj_idx%2=q.query_idx%2 where w<=0 or h<=0),"
    " c as (select distinct q.datapoint_id, q.query_idx, q.processing_order from q where not exists (select 1 from bad where bad.datapoint_id=q.datapoint_id and bad.query_idx=q.query_idx)), k as (select * from c where datapoint_id in (select datapoint_id from c group by 1 having min(processing_order)=0)),"
    " n as (select *, row_number() over (partition by datapoint_id order by query_idx)-1 new_query, dense_rank() over (partition by datapoint_id order by processing_order)-1 new_stage from k),"
    " u as (select distinct n.datapoint_id, n.query_idx, ob.obj_idx from n join ob on ob.datapoint_id=n.datapoint_id and ob.obj_idx%2=n.query_idx%2),"
    " o as (select datapoint_id, obj_idx, dense_rank() over (partition by datapoint_id order by obj_idx)-1 new_obj from (select distinct datapoint_id, obj_idx from u)),"
    " i as (select u.datapoint_id, u.query_idx, string_agg(new_obj::varchar, ',' order by obj_idx) ids from u join o using (datapoint_id, obj_idx) group by 1,2)"
    " select n.datapoint_id, new_query, new_stage, coalesce(ids,'') ids from n left join i using (datapoint_id, query_idx)"
)
def compacted_queries(spark: SparkSession, d: str) -> DataFrame:
    """Queries numbered anew after those with a flat target are gone."""
    q, ob = query_tables(spark, d)
    q = prep.drop_queries(q.dropDuplicates(["datapoint_id", "query_idx"]), prep.with_flat_targets(q, ob))
    out, _, _ = prep.compact(q, ob.select("datapoint_id", "obj_idx").distinct())
    return out.select("datapoint_id", "new_query", "new_stage", F.array_join(F.col("new_ids").cast("array<string>"), ",").alias("ids"))


@query("with q as (select conv_id datapoint_id, turn//2 o, count(*) n from conversations group by 1,2), s as (select datapoint_id, sum(n) n, min(n) <> max(n) u from q group by 1) select datapoint_id, case when n>6 then 'too_many_queries' else 'uneven_stages' end reason from s where n>6 or u")
def rejected_datapoints(spark: SparkSession, d: str) -> DataFrame:
    return prep.size_guards(query_tables(spark, d)[0], 6, 1_000_000)[1]


@query(f"with {FR} select video_id, frame_idx, row_number() over (partition by video_id order by frame_idx)-1 step from (select distinct video_id, frame_idx from fr)")
def timestep_index(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("video_id").orderBy("frame_idx")
    return fx.frames(spark, d).select("video_id", "frame_idx").distinct().withColumn("step", F.row_number().over(w) - 1)


@query(f"with {TG}, v as (select video_id, 1+max(frame_idx) n from tg group by 1) select video_id, track_id, round(sum(w*h)/any_value(n), 6) over_all_frames, round(avg(w*h), 6) over_visible from tg join v using (video_id) group by 1,2")
def track_mean_areas(spark: SparkSession, d: str) -> DataFrame:
    t = fx.tracks_gt(spark, d)
    n = t.groupBy("video_id").agg((F.max("frame_idx") + 1).alias("n"))
    area = F.col("w") * F.col("h")
    out = t.groupBy("video_id", "track_id").agg(F.sum(area).alias("s"), F.avg(area).alias("over_visible")).join(n, "video_id")
    return rounded(out.select("video_id", "track_id", (F.col("s") / F.col("n")).alias("over_all_frames"), "over_visible"), "over_all_frames", "over_visible")


@query(f"with {GT}, {DT} select image_id, det_id, class_id, round(x-5,6) l, round(y-5,6) t, round(x+w-5,6) r, round(y+h-5,6) b, round(greatest(0, 1-sqrt((x-100)*(x-100)+(y-100)*(y-100))/250), 6) sim from dt")
def point_measures(spark: SparkSession, d: str) -> DataFrame:
    b = bx.xywh()
    l, t, r, bt = bx.point_distances(F.lit(5.0), F.lit(5.0), b)
    sim = bx.point_similarity(b.x1, b.y1, F.lit(100.0), F.lit(100.0), 250.0)
    return rounded(fx.pred_boxes(spark, d).select("image_id", "det_id", "class_id", (-l).alias("l"), (-t).alias("t"), r.alias("r"), bt.alias("b"), sim.alias("sim")), "l", "t", "r", "b", "sim")


@query(f"with {GT}, {DT}, n as (select *, (x+w/2)/640 cx, (y+h/2)/480 cy from dt) select image_id, class_id, det_id from n where cx>0.025 and cy>0.025 and cx<1-0.025::double and cy<1-0.025::double")
def away_from_edges(spark: SparkSession, d: str) -> DataFrame:
    b = bx.scaled(bx.xywh(), F.lit(1 / 640), F.lit(1 / 480))
    return fx.pred_boxes(spark, d).where(~bx.near_edge(b)).select("image_id", "class_id", "det_id")


@query(f"with {TG}, m as (select 4 a, 2 b union all select 5, 3) select video_id, coalesce(b, category_id) category_id, count(*) n from tg left join m on a=category_id group by 1,2")
def merged_categories(spark: SparkSession, d: str) -> DataFrame:
    t = evaluation.merged_categories(fx.tracks_gt(spark, d), {2: [4], 3: [5]})
    return t.groupBy("video_id", "category_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"with {TD}, i as (select g.video_id, g.track_id gt_id, t.track_id dt_id, sum({inter_sql('g', 't')}) i from tg g join td t using (video_id, category_id, frame_idx) group by 1,2,3)"
    " select video_id, count(distinct gt_id) matched_gt from i where i>0 group by 1"
)
def videos_with_overlap(spark: SparkSession, d: str) -> DataFrame:
    p = pairs.tracklet_iou(fx.tracks_gt(spark, d).drop("eid", "cents"), fx.tracks_pred(spark, d), ["video_id", "category_id"])
    return p.where(F.col("inter") > 0).groupBy("video_id").agg(F.count_distinct("gt_id").alias("matched_gt"))


@query(
    f"""with {TD}, p as (select distinct video_id, category_id from (select video_id, category_id from tg union all select video_id, category_id from td)), a as (select video_id, category_id, count(distinct track_id) n_gt from tg group by 1, 2),
b as (select video_id, category_id, count(distinct track_id) n_dt from td group by 1, 2), s as (select video_id, category_id, track_id, sum(w*h) area from tg group by 1, 2, 3), t as (select video_id, category_id, track_id, sum(w*h) area from td group by 1, 2, 3),
i as (select g.video_id, g.category_id, g.track_id gt_id, d.track_id dt_id, sum({inter_sql('g', 'd')}) i from tg g join td d using (video_id, category_id, frame_idx) group by 1, 2, 3, 4),
m as (select i.video_id, i.category_id, max(i.i/(s.area+t.area-i.i)) iou from i join s on s.track_id=i.gt_id and s.video_id=i.video_id join t on t.track_id=i.dt_id and t.video_id=i.video_id group by 1, 2),
per as (select coalesce(n_gt, 0) g, coalesce(n_dt, 0) d, coalesce(iou, 0) v from p left join a using (video_id, category_id) left join b using (video_id, category_id) left join m using (video_id, category_id)),
k as (select g, d, pct, (round(v, 12) >= pct/100.0::double)::bigint tp from per, (select unnest(range(50, 100, 5)) pct)),
l as (select *, tp/(tp+(d-tp)+1e-4::double) lp, tp/(tp+(g-tp)+1e-4::double) lr from k),
c as (select pct, sum(tp)::bigint tp, sum(d-tp)::bigint fp, sum(g-tp)::bigint fn, sum(case when g>0 then d-tp else 0 end)::bigint pos_fp, avg(case when g>0 and d>0 then 2*lp*lr/(lp+lr+1e-4::double) end) macro,
  count_if(g>0 and d>0)::double itp, count_if(g=0 and d>0)::double ifp, count_if(g>0 and d=0)::double ifn, count_if(g=0 and d=0)::double itn from l group by 1),
f as (select *, tp/(tp+fp+1e-4::double) pr, tp/(tp+fn+1e-4::double) re, tp/(tp+pos_fp+1e-4::double) pp, itp/(itp+ifp+1e-6::double) ip, itp/(itp+ifn+1e-6::double) ir,
  (itp*itn-ifp*ifn)/(sqrt((itp+ifp)*(itp+ifn)*(itn+ifp)*(itn+ifn))+1e-6::double) mcc from c)
select pct::int iou_percent, tp, fp, fn, pos_fp, round(macro, 6) positive_macro_f1, itp::bigint il_tp, ifp::bigint il_fp, ifn::bigint il_fn, itn::bigint il_tn, round(2*pr*re/(pr+re+1e-4::double), 6) f1, round(2*pp*re/(pp+re+1e-4::double), 6) positive_micro_f1,
  round(2*ip*ir/(ip+ir+1e-6::double), 6) il_f1, round(ifp/(ifp+itn+1e-6::double), 6) il_fpr, round(mcc, 6) il_mcc, round(2*pp*re/(pp+re+1e-4::double)*mcc, 6) cgf1 from f"""
)
def video_phrase_cgf1(spark: SparkSession, d: str) -> DataFrame:
    """Phrase metrics over videos: an 'image' is a (video, phrase) pair, a box a track, overlap the tracklet IoU."""
    gt, dt = fx.tracks_gt(spark, d), fx.tracks_pred(spark, d)
    ids = remap.pair_ids(gt, dt).withColumnRenamed("new_id", "image_id")
    keys = ["video_id", "category_id"]
    p = pairs.tracklet_iou(gt.drop("eid", "cents"), dt, keys).where("iou > 0").join(ids, keys)
    matched = matching.assigned(p.select("image_id", F.col("gt_id").alias("ann_id"), F.col("dt_id").alias("det_id"), "iou"), ["image_id"])
    one = lambda df: df.select(*keys, "track_id").distinct().join(ids, keys)
    per = metrics.image_counts(ids.select(F.col("image_id").alias("id")), one(gt), one(dt), matched)
    return rounded(metrics.phrase_metrics(per), "f1", "positive_micro_f1", "positive_macro_f1", "il_f1", "il_fpr", "il_mcc", "cgf1")


@query()
def oracle_annotator(spark: SparkSession, d: str) -> DataFrame:
    """Per image the annotator whose scoring has the best mean local F1; a true negative wins, ties go to the first."""
    dt = fx.pred_boxes(spark, d).where("score >= 0.5")
    box = "named_struct('annotator', {k}, 'x', x{dx}, 'y', y{dy}, 'w', w, 'h', h)"
    one, two, three = (box.format(k=k, dx=dx, dy=dy) for k, dx, dy in ((0, "", ""), (1, " + 2", ""), (2, "", " + 5")))
    sets = fx.gt_boxes(spark, d).where("iscrowd = 0").selectExpr("image_id", "ann_id", f"inline(filter(array({one}, if(sk % 7 <> 0, {two}, null), if(pk % 6 <> 0, {three}, null)), s -> s is not null))")
    return summaries.best_annotator(summaries.annotator_counts(fx.images(spark, d), sets, dt, [0, 1, 2]))


@query()
def mask_boundary_f(spark: SparkSession, d: str) -> DataFrame:
    from ..operators import masks

    gt, dt = fx.gt_boxes(spark, d), fx.pred_boxes(spark, d)
    pairs_ = matching.optimal_match(gt, dt, ["image_id", "class_id"])
    a = rectangle_masks(spark, d, gt).select("image_id", "ann_id", F.col("runs").alias("runs_a"), "height", "width")
    b = rectangle_masks(spark, d, dt).select("image_id", "class_id", "det_id", F.col("runs").alias("runs_b"))
    both = pairs_.join(a, ["image_id", "ann_id"]).join(b, ["image_id", "class_id", "det_id"]).select("image_id", "ann_id", "det_id", "height", "width", "runs_a", "runs_b")
    return rounded(masks.boundary_f(both).drop("height", "width"), "boundary_f")


@query(f"with {GT}, p as (select *, floor((x+w)/2)::bigint-floor(x/2)::bigint pw, floor((y+h)/2)::bigint-floor(y/2)::bigint ph from gt) select image_id, ann_id, pw*ph - (case when ann_id%2=0 then 25 else 0 end) + (case when ann_id%3=0 then 25 else 0 end) area from p")
def cleaned_masks(spark: SparkSession, d: str) -> DataFrame:
    """Rectangles with a hole (3 x 3, which is filled, or 5 x 5, which stays) and a second part (2 x 2, which goes, or 5 x 5, which stays)."""
    from ..operators import masks

    px = fx.gt_boxes(spark, d).selectExpr(
        "image_id", "ann_id", "floor(x / 2) l", "floor(y / 2) t", "floor((x + w) / 2) r", "floor((y + h) / 2) b", "if(ann_id % 2 = 0, 5, 3) hole", "if(ann_id % 3 = 0, 5, 2) part"
    )
    around = [("l", "t", "l + 3", "b"), ("l + 3 + hole", "t", "r", "b"), ("l + 3", "t", "l + 3 + hole", "t + 3"), ("l + 3", "t + 3 + hole", "l + 3 + hole", "b"), ("300", "200", "300 + part", "200 + part")]
    boxes = F.array(*(masks.corners(*map(F.expr, v)) for v in around))
    whole = masks.filled(px.select("image_id", "ann_id", boxes.alias("boxes"), F.lit(240).alias("height"), F.lit(320).alias("width")))
    return masks.clean(whole, 20).select("image_id", "ann_id", masks.area(F.col("runs")).alias("area"))


@query()
def occlusion_suppressed(spark: SparkSession, d: str) -> DataFrame:
    """Tracks of which every fifth box is hidden."""
    from ..streaming.occlusion import occlusion_suppress

    rows = fx.tracks_gt(spark, d).withColumn("w", F.when(F.col("eid") % 5 == 0, F.lit(0.0)).otherwise(F.col("w")))
    return occlusion_suppress(rows.select("video_id", "frame_idx", "track_id", *"xywh"), 0.3)


@query(f"with {GT}, p as (select a.image_id, a.ann_id, b.ann_id other, {iou_sql('a', 'b')} iou from gt a join gt b on a.image_id=b.image_id and a.class_id=b.class_id and a.ann_id<b.ann_id) select image_id, ann_id, other, round(iou, 6) iou from p where iou > 0")
def rotated_pair_iou(spark: SparkSession, d: str) -> DataFrame:
    """Both boxes turned by a right angle, with width and height exchanged: the overlap is that of the upright boxes."""
    b = fx.gt_boxes(spark, d).selectExpr("image_id", "class_id", "ann_id", "x + w / 2 xc", "y + h / 2 yc", "h w", "w h", "cast(90 as double) angle")
    side = lambda p, i: b.select("image_id", "class_id", F.col("ann_id").alias(i), *(F.col(c).alias(f"{p}_{c}") for c in ("xc", "yc", "w", "h", "angle")))
    both = side("a", "ann_id").join(side("b", "other"), ["image_id", "class_id"]).where("ann_id < other")
    lo = [bx.rotated_bounds(*(F.col(f"{p}_{c}") for c in ("xc", "yc", "w", "h", "angle"))) for p in "ab"]
    near = both.where(bx.intersection(*lo) > 0)
    return rounded(pairs.rotated_iou(near).where("iou > 1e-9").select("image_id", "ann_id", "other", "iou"), "iou")
