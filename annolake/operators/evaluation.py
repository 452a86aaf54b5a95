"""Tables around an evaluation: query tables, look-ups, splits, reconciliation and merged results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .prep import hashed
from .remap import numbered


#: Classes that travel together to every image.
BLOCK = 4_096


def image_category_queries(images: DataFrame, truths: DataFrame, chunk: int = 1, names: dict[int, str] | None = None, label: str = "class_id") -> DataFrame:
    """image_id, class_id, chunk, prompt, n, ids: a query for every image and class, with the ids of its truths or none.

    images: image_id. The classes are those of `truths`, however many; `names` renames prompts. Classes are numbered in order and `chunk` of
    them form one chunk. Numbered classes go out in blocks, which meet shares of the images; the result itself has a row for every pair.
    """
    classes = numbered(truths.select(label).where(F.col(label).isNotNull()).distinct(), [label], "__k")
    n = classes.count()
    blocks = max(1, -(-n // BLOCK))
    shares = max(1, int(images.sparkSession.conf.get("spark.sql.shuffle.partitions")) // blocks)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    prompt = F.coalesce(*([F.element_at(F.create_map(*(F.lit(x) for k, v in names.items() for x in (str(k), v))), F.col(label).cast("string"))] if names else []), F.col(label).cast("string"))
    one = F.struct(label, F.expr(f"__k div {chunk}").alias("chunk"), prompt.alias("prompt"))
    block = classes.groupBy(F.expr(f"cast(__k div {BLOCK} as int)").alias("__b")).agg(F.collect_list(one).alias("__c")).withColumn("__s", every(shares))
    asked = images.select("image_id", F.pmod(F.xxhash64("image_id"), F.lit(shares)).cast("int").alias("__s"), every(blocks).alias("__b"))
    grid = asked.join(block, ["__b", "__s"]).select("image_id", F.inline("__c"))
    ids = truths.groupBy("image_id", label).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("ann_id")).alias("ids"))
    out = grid.join(ids, ["image_id", label], "left")
    return out.fillna(0, ["n"]).withColumn("ids", F.coalesce("ids", F.array().cast("array<bigint>")))


def video_queries(videos: DataFrame, phrases: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queries, bad): a query for every frame of every (video, phrase) pair, and pairs whose phrase is not their category's name.

    videos: video_id, file_names. phrases: video_id, category_id, noun_phrase. categories: category_id, name.
    """
    named = phrases.join(categories.select("category_id", "name"), "category_id", "left")
    good = F.col("name").eqNullSafe(F.col("noun_phrase"))
    rows = named.where(good).join(videos.select("video_id", "file_names"), "video_id")
    queries = rows.select("video_id", "category_id", F.col("noun_phrase").alias("query_text"), F.posexplode("file_names").alias("frame_idx", "file_name"))
    return queries, named.where(~good).select("video_id", "category_id", "noun_phrase", "name")


def split_by_truth(pairs: DataFrame, truths: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(positive, negative) pairs: with and without a truth."""
    have = truths.select(*keys).distinct()
    return pairs.join(have, keys, "left_semi"), pairs.join(have, keys, "left_anti")


def frame_images(predictions: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(with image_id, unmatched) of predictions by (video_id, frame_idx)."""
    keys = ["video_id", "frame_idx"]
    by = images.select(*keys, "image_id")
    return predictions.join(by, keys), predictions.join(by, keys, "left_anti")


def merged_categories(rows: DataFrame, merges: dict[int, list[int]], label: str = "category_id") -> DataFrame:
    """`rows` with every merged category replaced by its parent."""
    parent = {c: p for p, merged in merges.items() for c in merged}
    if not parent:
        return rows
    kind = rows.schema[label].dataType
    table = F.create_map(*(F.lit(x).cast(kind) for item in parent.items() for x in item))
    return rows.withColumn(label, F.coalesce(F.element_at(table, F.col(label)), F.col(label)))


def with_metadata(images: DataFrame, metadata: DataFrame, most_side: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(images with their metadata row, non-compliant): joined by the file's stem; an image without a row, or with a side above
    `most_side`, is not compliant. images: file_name. metadata: stem, width, height, ..."""
    keyed = images.withColumn("stem", tx.stem(F.col("file_name")))
    both = keyed.join(metadata, "stem", "left")
    fits = F.col("width").isNotNull() if most_side is None else F.coalesce((F.col("width") <= most_side) & (F.col("height") <= most_side), F.lit(False))
    reason = F.when(F.col("width").isNull(), "no_metadata").otherwise("too_large")
    return both.where(fits), both.where(~fits).select("file_name", reason.alias("reason"))


def frame_annotations(annotations: DataFrame, video_id: int, frame_idx: int) -> DataFrame:
    """noun_phrase, box of all annotations that are there in one frame of one video, by phrase."""
    box = F.try_element_at("bboxes", F.lit(frame_idx + 1))
    there = annotations.where(F.col("video_id") == video_id).select("id", "noun_phrase", box.alias("box"))
    return there.where("box is not null").orderBy("noun_phrase", "id")


def left_to_do(wanted: DataFrame, done: DataFrame, unavailable: DataFrame, key: str) -> DataFrame:
    """Ids that are wanted, not done, and not unavailable."""
    return wanted.select(key).distinct().join(done.select(key), key, "left_anti").join(unavailable.select(key), key, "left_anti")


def frame_requests(images: DataFrame) -> DataFrame:
    """Distinct (video, frame, file, size) of an image table."""
    return images.select("video_id", "frame_idx", "file_name", "width", "height").distinct()


def gathered(prompts: DataFrame, results: DataFrame, image: str = "image_id") -> DataFrame:
    """image, prompt, boxes: the results of all prompts of an image, whatever chunk they came from; a prompt without results
    has an empty list. results: image, prompt, score, x, y, w, h."""
    boxes = results.groupBy(image, "prompt").agg(F.sort_array(F.collect_list(F.struct("score", "x", "y", "w", "h")), asc=False).alias("boxes"))
    return prompts.select(image, "prompt").join(boxes, [image, "prompt"], "left").withColumn("boxes", F.coalesce("boxes", F.array().cast(boxes.schema["boxes"].dataType)))


def first_of_each_image(results: DataFrame, image: str = "image_id", shard: str = "shard") -> DataFrame:
    """One row for each image: that of its first shard, and there the first by all other columns."""
    rest = [c for c in results.columns if c not in (image, shard)]
    best = results.groupBy(image).agg(F.min(F.struct(shard, *rest)).alias("r"))
    return best.select(image, "r.*").select(*results.columns)


def category_subset(rows: DataFrame, known: list[int], distractors: list[int], subset: str, label: str = "category_id") -> DataFrame:
    """Rows of the known categories, of the distractors, or of all others (unknown)."""
    named = F.col(label).isin(known)
    rule = {"known": named, "distractor": F.col(label).isin(distractors), "unknown": ~named & ~F.col(label).isin(distractors), "all": F.lit(True)}
    return rows.where(rule[subset])


def above(rows: DataFrame, threshold: float, inclusive: bool = False, score: str = "score") -> DataFrame:
    """Rows by one score threshold: strictly above it, or at it too."""
    return rows.where(F.col(score) >= threshold if inclusive else F.col(score) > threshold)


def suffix_means(values: DataFrame, suffixes: list[str], prefix: Column | None = None) -> DataFrame:
    """suffix, mean, n: the mean of all metrics whose name ends in each suffix. values: metric, value."""
    kept = values if prefix is None else values.where(prefix)
    hit = F.explode(F.filter(F.array(*(F.lit(s) for s in suffixes)), lambda s: F.endswith(F.col("metric"), s)))
    return kept.select(hit.alias("suffix"), "value").groupBy("suffix").agg(F.avg("value").alias("mean"), F.count("value").alias("n"))


def overwritten(queries: DataFrame, text: str, probability: float = 1.0, seed: int = 0) -> DataFrame:
    """Query texts replaced by `text` with a probability, by a hash of the query."""
    chosen = hashed(F.col("datapoint_id") * 31 + F.col("query_idx"), seed) < int(probability * 1_000_003)
    return queries.withColumn("query_text", F.when(chosen, F.lit(text)).otherwise(F.col("query_text")))


def without_boxes(queries: DataFrame) -> DataFrame:
    return queries.withColumn("input_bbox", F.lit(None).cast(queries.schema["input_bbox"].dataType))


def visual_queries(queries: DataFrame, objects: DataFrame, probability: float = 1.0, seed: int = 0, keep_text: bool = False) -> DataFrame:
    """Text queries of the first stage turned into visual ones, with a probability: the box of one of their objects is the prompt.

    Which query, and which object, follows from a hash. queries: datapoint_id, query_idx, processing_order, query_text, object_ids,
    input_bbox. objects: datapoint_id, obj_idx, bbox.
    """
    h = hashed(F.col("datapoint_id") * 31 + F.col("query_idx"), seed)
    can = F.col("input_bbox").isNull() & (F.size("object_ids") > 0) & (F.col("processing_order") == 0) & (h < int(probability * 1_000_003))
    pick = F.when(can, F.element_at("object_ids", (F.pmod(h, F.greatest(F.size("object_ids"), F.lit(1))) + 1).cast("int")))
    box = objects.select("datapoint_id", F.col("obj_idx").alias("__pick"), F.col("bbox").alias("__box"))
    out = queries.withColumn("__pick", pick).join(box, ["datapoint_id", "__pick"], "left")
    turned = F.col("__box").isNotNull()
    text = F.col("query_text") if keep_text else F.when(turned, F.lit("visual")).otherwise(F.col("query_text"))
    return out.withColumn("query_text", text).withColumn("input_bbox", F.coalesce("input_bbox", "__box")).drop("__pick", "__box")


class Evaluators:
    """Evaluations by name; each returns (dataset: metric, value; rows: key columns and metrics), and all are merged."""

    def __init__(self, keys: list[str]):
        self.keys, self.known = keys, {}

    def add(self, name: str, run: Callable[..., tuple[DataFrame, DataFrame | None]]) -> None:
        if name in self.known:
            raise ValueError(f"{name} is known already")
        self.known[name] = run

    def run(self, names: list[str], *args, **options) -> tuple[DataFrame, DataFrame | None]:
        """(dataset: metric, value; rows), metrics named after their evaluator; rows are joined in full on the keys."""
        dataset, rows = None, None
        for name in names:
            total, each = self.known[name](*args, **options)
            total = total.select(F.concat(F.lit(f"{name}_"), F.col("metric")).alias("metric"), F.col("value").cast("double").alias("value"))
            dataset = total if dataset is None else dataset.unionByName(total)
            if each is not None:
                each = each.select(*self.keys, *(F.col(c).alias(f"{name}_{c}") for c in each.columns if c not in self.keys))
                rows = each if rows is None else rows.join(each, self.keys, "full")
        return dataset, rows
