"""Annotation tables derived from the given tables by integer arithmetic, for Spark and as oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cut import pieces, roomy, settled


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def gt_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Truth boxes: image = order, class = line number mod 3."""
    return roomy(table(spark, d, "lineitem")).selectExpr(
        "l_orderkey image_id",
        "cast(l_linenumber % 3 as int) class_id",
        "row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) ann_id",
        "cast(l_partkey % 400 as double) x",
        "cast((l_partkey * 7 + l_suppkey * 13) % 300 as double) y",
        "cast(20 + l_quantity as double) w",
        "cast(20 + (l_suppkey % 40) as double) h",
        "case when l_linenumber = 7 and l_suppkey % 10 = 0 then 1 else 0 end iscrowd",
        "l_returnflag rf",
        "l_suppkey sk",
        "l_partkey pk",
        "cast(round(l_extendedprice * 100) as bigint) cents",
    )


def pred_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Detections: jittered copies with gaps, shifted extras, and boxes on images without truth."""
    box = lambda det, x, per: f"named_struct('det_id', {det}, 'x', {x[0]}, 'y', {x[1]}, 'score', cast(((cents % {per}) + cast(0.5 as double)) / cast(1000 as double) as double))"
    copy, extra = box("ann_id", ("x + (pk % 9) - 4", "y + (sk % 9) - 4"), 1000), box("ann_id + 100", ("x + w * 2", "y"), 600)
    # both kinds come from one pass over the truth boxes
    some = gt_boxes(spark, d).selectExpr(
        "image_id", "class_id", "w", "h", f"inline(filter(array(if(not (rf = 'R' and sk % 4 = 0), {copy}, null), if(rf = 'A' and sk % 5 = 0, {extra}, null)), s -> s is not null))"
    )
    some = some.select("image_id", "class_id", "det_id", "x", "y", "w", "h", "score")
    keys = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    # keys are so short that adaptive execution would put tens of millions of them into one task
    bare = table(spark, d, "orders").where("o_orderkey % 2 = 0").join(keys.repartition(pieces(keys), "o_orderkey"), "o_orderkey", "left_anti")
    bare = bare.selectExpr(
        "o_orderkey image_id", "0 class_id", "1 det_id", "cast(10 as double) x", "cast(10 as double) y", "cast(30 as double) w", "cast(30 as double) h",
        "cast(((o_orderkey % 1000) + cast(0.5 as double)) / cast(1000 as double) as double) score",
    )
    return some.unionByName(bare)


def images(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").selectExpr(
        "o_orderkey id",
        "concat('img/', cast(o_orderkey as string), '.jpg') file_name",
        "o_orderpriority text_input",
        "640 width",
        "480 height",
        "case when o_orderkey % 10 = 3 then 0 else 1 end is_instance_exhaustive",
        "case when o_orderkey % 20 = 3 then 0 else 1 end is_pixel_exhaustive",
        "cast(o_orderkey % 4 as int) rarity",
    )


def frames(spark: SparkSession, d: str) -> DataFrame:
    """Counts: video = user, frame = day, class = event type. A day without events is a missing frame."""
    return (
        roomy(table(spark, d, "events"))
        .selectExpr(
            "user_id video_id",
            "case event_type when 'view' then 1 when 'signup' then 2 when 'purchase' then 3 when 'error' then 4 else 5 end category_id",
            "cast(datediff(cast(ts as date), date'2024-01-01') as bigint) frame_idx",
            "event_id",
            "value",
        )
        .groupBy("video_id", "category_id", "frame_idx")
        .agg(F.expr("min(event_id) eid"), F.expr("cast(count(*) as int) n"), F.expr("min(cast(round(value * 100) as bigint)) cents"))
    )


def tracks_gt(spark: SparkSession, d: str) -> DataFrame:
    return frames(spark, d).selectExpr(
        "video_id", "category_id", "video_id * 10 + category_id track_id", "frame_idx",
        "cast(video_id % 50 + frame_idx * 3 + category_id * 12 as double) x", "cast((video_id * 7) % 60 + category_id * 8 as double) y",
        "cast(40 as double) w", "cast(30 as double) h", "eid", "cents",
    )


def tracks_pred(spark: SparkSession, d: str) -> DataFrame:
    """Track boxes with switched ids, gaps and jitter."""
    return tracks_gt(spark, d).where("eid % 5 <> 0").selectExpr(
        "video_id", "category_id", "(video_id * 10 + category_id) * 2 + (case when eid % 11 = 0 then 1 else 0 end) track_id", "frame_idx",
        "x + (eid % 13) - 6 x", "y + (eid % 7) - 3 y", "w", "h", "cast(((cents % 1000) + cast(0.5 as double)) / cast(1000 as double) as double) score",
    )


def arrivals(rows: DataFrame, folder: str, pieces: int = 4, late: int = 3, ends: int = 2) -> DataFrame:
    """A stream of `rows` (video_id, frame_idx, ...) with `ts`, the day of the frame, in `pieces` batches of files under `folder`.

    A row arrives up to `late` - 1 days after its frame, by the hash of its content, so frames come split and out of order. `ends` more batches
    hold one row of video -1 each, years later: the watermark passes every frame, and then every idle video.
    """
    spark = rows.sparkSession
    timed = rows.withColumn("ts", F.timestamp_millis((F.col("frame_idx") + 19723) * 86_400_000))  # days since 2024-01-01
    came = settled(timed.withColumn("came", F.col("frame_idx") + F.pmod(F.xxhash64(*rows.columns), F.lit(late))))  # made once for all batches
    lo, hi = came.agg(F.min("came"), F.max("came")).first()
    for k in range(pieces if lo is not None else 0):
        own = came.where(F.floor((F.col("came") - lo) * pieces / (hi - lo + 1)) == k)
        own.drop("came").repartition(1).write.mode("append").parquet(folder)
    for k in range(ends):
        last = {"video_id": F.lit(-1), "frame_idx": F.lit(10**6 + k), "ts": F.timestamp_millis(F.lit((19723 + 10**4 * (k + 1)) * 86_400_000))}
        one = spark.range(1).select(*(last.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in timed.schema))
        one.write.mode("append").parquet(folder)
    return spark.readStream.schema(timed.schema).option("maxFilesPerTrigger", 1).parquet(folder)


#: The same tables as common table expressions of DuckDB.
GT = """gt as (select l_orderkey image_id, cast(l_linenumber%3 as int) class_id,
  row_number() over (partition by l_orderkey order by l_linenumber,l_partkey,l_suppkey,l_extendedprice) ann_id,
  cast(l_partkey%400 as double) x, cast((l_partkey*7+l_suppkey*13)%300 as double) y,
  cast(20+l_quantity as double) w, cast(20+(l_suppkey%40) as double) h,
  case when l_linenumber=7 and l_suppkey%10=0 then 1 else 0 end iscrowd,
  l_returnflag rf, l_suppkey sk, l_partkey pk, cast(round(l_extendedprice*100) as bigint) cents from lineitem)"""
DT = """dt as (select image_id, class_id, ann_id det_id, x+(pk%9)-4 x, y+(sk%9)-4 y, w, h,
    cast(((cents%1000)+0.5::double)/1000.0::double as double) score from gt where not (rf='R' and sk%4=0)
  union all select image_id, class_id, ann_id+100, x+w*2, y, w, h,
    cast(((cents%600)+0.5::double)/1000.0::double as double) from gt where rf='A' and sk%5=0
  union all select o_orderkey, 0, 1, 10.0::double, 10.0::double, 30.0::double, 30.0::double,
    cast(((o_orderkey%1000)+0.5::double)/1000.0::double as double) from orders
    where o_orderkey%2=0 and not exists (select 1 from lineitem where l_orderkey=o_orderkey))"""
IMG = """img as (select o_orderkey id, concat('img/', cast(o_orderkey as varchar), '.jpg') file_name, o_orderpriority text_input,
  640 width, 480 height, case when o_orderkey%10=3 then 0 else 1 end is_instance_exhaustive,
  case when o_orderkey%20=3 then 0 else 1 end is_pixel_exhaustive, cast(o_orderkey%4 as int) rarity from orders)"""
FR = """fr as (select user_id video_id, case event_type when 'view' then 1 when 'signup' then 2 when 'purchase' then 3 when 'error' then 4 else 5 end category_id,
  date_diff('day', date '2024-01-01', cast(ts as date)) frame_idx, min(event_id) eid, cast(count(*) as int) n,
  min(cast(round(value*100) as bigint)) cents from events group by 1,2,3)"""
TG = (
    FR
    + """, tg as (select video_id, category_id, video_id*10+category_id track_id, frame_idx,
  cast(video_id%50+frame_idx*3+category_id*12 as double) x, cast((video_id*7)%60+category_id*8 as double) y,
  cast(40 as double) w, cast(30 as double) h, eid, cents from fr)"""
)
TD = (
    TG
    + """, td as (select video_id, category_id, (video_id*10+category_id)*2+(case when eid%11=0 then 1 else 0 end) track_id,
  frame_idx, x+(eid%13)-6 x, y+(eid%7)-3 y, w, h, cast(((cents%1000)+0.5::double)/1000.0::double as double) score
  from tg where eid%5<>0)"""
)
IOU = "{i}/nullif({a}.w*{a}.h+{b}.w*{b}.h-{i},0)"
INTER = "greatest(least({a}.x+{a}.w,{b}.x+{b}.w)-greatest({a}.x,{b}.x),0)*greatest(least({a}.y+{a}.h,{b}.y+{b}.h)-greatest({a}.y,{b}.y),0)"


def inter_sql(a: str, b: str) -> str:
    return "(" + INTER.format(a=a, b=b) + ")"


def iou_sql(a: str, b: str) -> str:
    i = inter_sql(a, b)
    return f"coalesce({i}/nullif({a}.w*{a}.h+{b}.w*{b}.h-{i},0),0)"
