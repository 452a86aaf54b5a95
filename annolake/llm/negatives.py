"""Hard negatives of anchors: a secondary sort of packed pair scores, and a stream that opens and closes positives' windows.

Scores are integer inner products of components that were scaled and floored. Rows are dealt into parts of about `PART`
rows, anchors into groups of about `GROUP`; a task scores one part against one group as a matrix product. The first pass leaves the
`positives` best rows of an anchor's own label in each part, of which a window keeps the best over all parts. The second pass leaves, for
each positive, the `negatives` first rows of other labels in its window of scores, part by part: no other row of a part can be among the
first of all parts. What is left, a bounded number of rows for each anchor and part, is packed into keys of 25
bytes, (anchor, descending score, positive before negative, id), whose byte order is the wanted order;
`repartitionAndSortWithinPartitions` deals them out by anchor. A stream walks the sorted keys: a positive opens its window,
a negative goes to the windows that hold its score, and a window closes when scores fall below it. The stream holds the open windows of one
anchor, never its rows.

Both passes together are the search of a stated query set against all rows; nothing but counts passes through the driver.

Defined cases: rows with a null id, label or vector, or any null or non-finite component, take no part; nor do rows
whose scaled vector has a squared length of 2^62 or more, as their scores are no longs. Rows of one id are one row: the least by (label,
vector). Vectors of other lengths are never compared; empty ones score 0 with each other. Ties go to the smaller id. Fewer
positives or negatives than asked for give all of them; an anchor without either gives no rows. A positive of score 0 takes
negatives of score 0, one below 0 takes none. Repeated rows count once; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .util import shuffle_width

PART = 8_192
GROUP = 1_024
LEAST_GROUP = 64
#: Squared length from which scores may leave the range of a long.
MOST_SQUARED = float(2**62)
#: Below this bound on scores, products of doubles are exact.
EXACT = float(2**53)
_TOP = 2**63 - 1
_SIGN = np.uint64(1 << 63)
_KEY = struct.Struct(">QQBQ")

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def packed(anchor: np.ndarray, score: np.ndarray, negative: np.ndarray, ids: np.ndarray) -> pa.Array:
    """Keys of 25 bytes whose byte order is (anchor, descending score, positive first, id)."""
    keys = np.empty(len(anchor), np.dtype([("a", ">u8"), ("s", ">u8"), ("k", "u1"), ("i", ">u8")]))
    keys["a"] = anchor.astype(np.int64).view(np.uint64) ^ _SIGN
    keys["s"] = (_TOP - score.astype(np.int64)).view(np.uint64)
    keys["k"] = negative
    keys["i"] = ids.astype(np.int64).view(np.uint64) ^ _SIGN
    return pa.Array.from_buffers(pa.binary(_KEY.size), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def unpacked(key: bytes) -> tuple[int, int, bool, int]:
    """(anchor, score, negative, id) of a key."""
    a, s, k, i = _KEY.unpack(key)
    return a - 2**63, _TOP - s, bool(k), i - 2**63


def emitted(keys: Iterator[bytes], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Rows of `OUT` from keys in byte order. State: the open windows of one anchor."""
    now, windows = None, []
    for key in keys:
        anchor, score, negative, i = unpacked(key)
        if anchor != now:
            now, windows = anchor, []
        if not negative:
            windows.append([i, score, 0])
            continue
        windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
        for w in windows:
            if 100 * score <= high * w[1]:
                w[2] += 1
                yield anchor, w[0], w[2], i, w[1], score


def _firsts(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k largest allowed scores, largest first, ties to the smaller index."""
    at = np.flatnonzero(allowed)
    own = scores[at]
    if len(at) > k:
        least = np.partition(own, len(at) - k)[len(at) - k]
        over = np.flatnonzero(own > least)
        keep = np.sort(np.concatenate([over, np.flatnonzero(own == least)[: k - len(over)]]))
        at, own = at[keep], own[keep]
    return at[np.argsort(-own, kind="stable")]


def _matrix(rows: pa.Table, length: int) -> np.ndarray:
    return np.asarray(rows.column("v").combine_chunks().flatten()).reshape(rows.num_rows, length)


def _scored(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[int, dict, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor's index, anchor, scores, ids, labels) for each anchor of a group over a part's rows in the order of ids."""
    rows = rows.sort_by("vec_id")
    length = int(anchors.column("length")[0].as_py())
    ids, labels = np.asarray(rows.column("vec_id")), np.asarray(rows.column("label"))
    left, right = _matrix(anchors, length), _matrix(rows, length)
    bound = lambda m: float((m.astype(float) ** 2).sum(axis=1).max())
    kind = float if length and bound(left) * bound(right) < EXACT**2 else np.int64
    right = right.astype(kind).T
    step = max(1, (4 << 20) // max(1, len(ids)))
    about = anchors.drop_columns(["v"]).to_pylist()
    for a in range(0, len(left), step):
        product = left[a : a + step].astype(kind) @ right
        for j, scores in enumerate(product.astype(np.int64)):
            yield a + j, about[a + j], scores, ids, labels


_POSITIVES = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
_KEYS = pa.schema([("key", pa.binary())])


def _positives(rows: pa.Table, anchors: pa.Table, k: int) -> pa.Table:
    """The k best rows of each anchor's label in a part."""
    if not rows.num_rows or not anchors.num_rows:
        return _POSITIVES.empty_table()
    own, found, scored = [], [], []
    for _, anchor, scores, ids, labels in _scored(rows, anchors):
        at = _firsts(scores, (labels == anchor["label"]) & (ids != anchor["anchor_id"]), k)
        own.append(np.full(len(at), anchor["anchor_id"]))
        found.append(ids[at])
        scored.append(scores[at])
    return pa.Table.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in (own, found, scored)], schema=_POSITIVES)


def _negatives(rows: pa.Table, anchors: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """Keys of the k first rows of other labels in each window of each anchor, within a part; and those of the positives of the anchors that
    have this part for their own."""
    if not anchors.num_rows:
        return _KEYS.empty_table()
    keys = []
    for a, own, near in zip(*(anchors.column(c).to_pylist() for c in ("anchor_id", "own", "positives")), strict=True):
        if own:
            ids, scores = (np.array([p[c] for p in near], np.int64) for c in ("positive_id", "positive_score"))
            keys.append(packed(np.full(len(ids), a), scores, np.zeros(len(ids), np.uint8), ids))
    for _, anchor, scores, ids, labels in _scored(rows, anchors) if rows.num_rows else ():
        other = labels != anchor["label"]
        spans = {(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in anchor["positives"] if p["positive_score"] >= 0}
        found = [_firsts(scores, other & (scores >= least) & (scores <= most), k) for least, most in spans if least <= most]
        if found:
            at = np.unique(np.concatenate(found))
            keys.append(packed(np.full(len(at), anchor["anchor_id"]), scores[at], np.ones(len(at), np.uint8), ids[at]))
    return pa.Table.from_arrays([pa.chunked_array(keys, pa.binary()).combine_chunks()], schema=_KEYS)


def usable(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """vec_id, label and v (scaled, floored longs) of the rows that take part, one for each id."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floored = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))))
    squared = F.aggregate(F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("double")), F.lit(0.0), lambda s, x: s + x * x)
    rows = vectors.where(F.col("vec_id").isNotNull() & label.isNotNull() & finite).where(squared < MOST_SQUARED)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(label.cast("long").alias("label"), floored.alias("v")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: int = 256, part_rows: int = PART, group_rows: int = GROUP,
) -> DataFrame:
    """Rows of `OUT`: for each anchor and each of its first positives, the first negatives whose score lies between `low` and
    `high` (at most 100) per cent of the positive's. `is_anchor` reads vec_id; `label` may read any column of `vectors`."""
    if not 0 <= low <= high <= 100:
        raise ValueError("a window lies between 0 and 100 per cent of a positive's score")
    spark = vectors.sparkSession
    rows = usable(vectors, F.col("label") if label is None else label, scale)
    asks = F.coalesce(is_anchor, F.lit(False))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(asks).alias("asks")).first()
    parts = max(1, -(-size.n // part_rows))
    spread = min(-(-spark.sparkContext.defaultParallelism // parts), size.asks // LEAST_GROUP)
    groups = max(1, -(-size.asks // group_rows), spread)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, c: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    key = ["length", "part", "group"]
    searched = rows.select("vec_id", "label", "v", F.size("v").alias("length"), dealt(parts, "vec_id").alias("part"), every(groups).alias("group"))
    anchors = rows.where(asks).select(F.col("vec_id").alias("anchor_id"), "label", "v", F.size("v").alias("length"), dealt(groups, "vec_id").alias("group"))
    fresh = lambda a: a.select(*(F.col(c).alias(c) for c in a.columns), every(parts).alias("part"))  # noqa: E731  not the same columns as those of `searched`
    met = lambda a: searched.groupBy(*key).cogroup(fresh(a).groupBy(*key))

    near = met(anchors).applyInArrow(lambda r, a: _positives(r, a, positives), "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
    windows = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))  # at most `positives` of them
    own = fresh(anchors.join(windows, "anchor_id")).withColumn("own", F.col("part") == dealt(parts, "anchor_id"))
    keys = searched.groupBy(*key).cogroup(own.groupBy(*key)).applyInArrow(lambda r, a: _negatives(r, a, negatives, low, high), "key binary")
    ordered = keys.rdd.map(lambda r: (bytes(r.key), None)).repartitionAndSortWithinPartitions(shuffle_width(spark), lambda k: zlib.crc32(k[:8]))
    found = ordered.mapPartitions(lambda part: emitted((k for k, _ in part), negatives, low, high))
    return spark.createDataFrame(found, OUT, verifySchema=False)
