"""Nearest neighbours by collision counting over single-projection sorted arrays.

Unit vectors are projected on `PROJECTIONS` fixed random directions, and a part of the table keeps one sorted array per
direction. Around a query's projection every array opens a window of `HALF_WIDTH` times a radius; virtual rehashing widens all windows
together by raising the radius, so a vector that enters a window collides once more with the query. A vector at a distance of at most the radius
collides in each direction with probability erf(HALF_WIDTH / sqrt 2); the collision threshold is the largest number that
it reaches with probability 1 - `MISS`. Vectors that reach it are verified in double precision on the original components. A
query is done in a part when its k-th best verified vector lies within the radius. The first radius is one at which hardly any
vector at the part's usual distance reaches the threshold.

Parts hold about `PART` vectors and query groups about `GROUP` queries (fewer, but `LEAST_GROUP` at least, if there would be
fewer tasks than cores); a task searches one part for one group, so rows are
shuffled as often as there are groups, queries as often as there are parts, and nothing passes through the driver but
counts. Every part returns k rows a query, which one top-k by query merges.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part; only vectors of equal
length are compared; components are scaled by a power of two before they are squared, so very large and very small ones
neither overflow nor vanish; rows of one vec_id are one candidate (the nearest of them), the least of them is the query,
and a query never finds its own id; ties go to the smaller vec_id; fewer than k candidates give all of them. A
null vec_id takes no part. Repeated rows count once; other columns are not read.
"""

from __future__ import annotations

from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 96
HALF_WIDTH = 1.5
MISS = 0.04
FALSE = 0.01
GROW = 1.06
PART = 65_536
GROUP = 8_192
LEAST_GROUP = 128


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(9000 + dim).normal(size=(dim, PROJECTIONS))


def _reach(p: float, miss: float) -> int:
    """The most collisions that a vector with probability p a direction reaches with probability 1 - miss."""
    below, term = 0.0, (1 - p) ** PROJECTIONS
    for c in range(PROJECTIONS):
        below += term
        if below > miss:
            return c
        term *= (PROJECTIONS - c) / (c + 1) * p / (1 - p)
    return PROJECTIONS


def collides(distance: float, radius: float) -> float:
    """Probability that a direction's window at `radius` holds a vector at `distance`."""
    return erf(HALF_WIDTH * radius / max(distance, 1e-9) / sqrt(2))


THRESHOLD = _reach(collides(1, 1), MISS)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that its largest component lies between 1/2 and 1: exact, and safe to square."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None])


class Part:
    """Sorted projections of a part of the vectors. `verified` counts the vectors that searches have tested."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.verified = ids, scaled(vectors), 0
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.directions = directions(vectors.shape[1])
        unit = self.vectors / self.norms[:, None]
        proj = unit @ self.directions
        self.order = np.argsort(proj, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(proj.T, self.order, axis=1)
        # the usual distance in the part, by up to 256 of its vectors, and the radius at which few at it reach the threshold
        some = unit[:: max(1, len(unit) // 256)]
        usual = max(1e-3, float(np.median(np.sqrt(np.maximum(0.0, 2 - 2 * some @ some.T)))))
        self.start = usual
        while _reach(collides(usual, self.start), 1 - FALSE) >= THRESHOLD and self.start > 1e-4:
            self.start /= GROW

    def search(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, float]]:
        """The k nearest (vec_id, score) found, nearest first. `query` is scaled."""
        n = len(self.ids)
        norm = np.sqrt((query * query).sum())
        at = (query / norm) @ self.directions
        lo, hi = np.zeros(PROJECTIONS, np.int64), np.full(PROJECTIONS, n)
        # windows of the first radius hold most vectors, so those outside are counted
        counts = np.full(n, PROJECTIONS, np.int16)
        radius = self.start
        for j in range(PROJECTIONS):
            s, order = self.sorted[j], self.order[j]
            lo[j] = np.searchsorted(s, at[j] - HALF_WIDTH * radius)
            hi[j] = np.searchsorted(s, at[j] + HALF_WIDTH * radius, side="right")
            counts[order[: lo[j]]] -= 1
            counts[order[hi[j] :]] -= 1
        tested = np.zeros(n, bool)
        found_ids, found_scores = np.zeros(0, np.int64), np.zeros(0)
        while True:
            full = radius > 2  # no two unit vectors are further apart
            new = np.flatnonzero(((counts >= THRESHOLD) | full) & ~tested)
            if len(new):
                tested[new] = True
                self.verified += len(new)
                new = new[self.ids[new] != own]
                scores = (self.vectors[new] * query).sum(axis=1) / (self.norms[new] * norm)
                if len(found_scores) == k or len(scores) > 4 * k:  # only what can be among the k best, with its ties
                    least = found_scores[-1] if len(found_scores) == k else -2.0
                    keep = scores >= least
                    new, scores = new[keep], scores[keep]
                found_ids, found_scores = np.concatenate([found_ids, self.ids[new]]), np.concatenate([found_scores, scores])
                best = np.lexsort((found_ids, -found_scores))
                found_ids, found_scores = found_ids[best], found_scores[best]
                _, first = np.unique(found_ids, return_index=True)  # the nearest row of an id
                first = np.sort(first)[:k]
                found_ids, found_scores = found_ids[first], found_scores[first]
            if full or len(found_ids) == k and np.sqrt(max(0.0, 2 - 2 * found_scores[-1])) <= radius:
                return list(zip(found_ids.tolist(), found_scores.tolist(), strict=True))
            radius *= GROW
            for j in range(PROJECTIONS):
                s, order = self.sorted[j], self.order[j]
                a = np.searchsorted(s, at[j] - HALF_WIDTH * radius)
                b = np.searchsorted(s, at[j] + HALF_WIDTH * radius, side="right")
                counts[order[a : lo[j]]] += 1
                counts[order[hi[j] : b]] += 1
                lo[j], hi[j] = a, b


def _matrix(rows: pa.Table, name: str) -> np.ndarray:
    col = rows.column(name).combine_chunks()
    return np.asarray(col.flatten().cast(pa.float64())).reshape(rows.num_rows, -1)


_OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("tested", pa.int64()), ("candidates", pa.int64())])


def _searched(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """k rows for each query of a group in a part."""
    if not rows.num_rows or not queries.num_rows:
        return _OUT.empty_table()
    part = Part(np.asarray(rows.column("vec_id")), _matrix(rows, "v"))
    found: list[tuple] = []
    for q, v in zip(queries.column("query_id").to_pylist(), scaled(_matrix(queries, "q")), strict=True):
        before = part.verified
        got = part.search(q, v, k)
        found += [(q, i, s, part.verified - before, rows.num_rows) for i, s in got]
    cols = list(zip(*found, strict=True)) if found else [[]] * 5
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT, strict=True)], schema=_OUT)


def found_in_parts(vectors: DataFrame, is_query: Column, k: int, part_rows: int = PART, group_rows: int = GROUP) -> DataFrame:
    """query_id, vec_id, score, and how many of how many candidates were tested, for every query and part."""
    v = F.col("embedding")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(v)).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), is_query.alias("asks"))
    rows = rows.groupBy("vec_id", "v").agg(F.max("asks").alias("asks"))  # repeated rows are one
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asks")).first()
    parts = max(1, -(-size.n // part_rows))
    spread = min(-(-vectors.sparkSession.sparkContext.defaultParallelism // parts), size.asks // LEAST_GROUP)
    groups = max(1, -(-size.asks // group_rows), spread)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")
    length = F.size("v").alias("length")
    searched = rows.select("vec_id", "v", length, dealt(parts).alias("part"), every(groups).alias("group"))
    asked = rows.where("asks").groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), length, every(parts).alias("part"), F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("group"))
    key = ["length", "part", "group"]
    schema = "query_id long, vec_id long, score double, tested long, candidates long"
    return searched.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(lambda a, b: _searched(a, b, k), schema)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, **sizes: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query among all other rows."""
    best = found_in_parts(vectors, is_query, k, **sizes).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
