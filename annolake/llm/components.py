"""Connected components of an edge table, by local contraction.

In each round every node merges into the neighbour (or itself) of least hash; edges are then drawn between the merged
nodes, and loops and repeats fall away. The hash changes every second round, so the number of nodes falls by a constant
factor whatever the shape of the graph, and a star of any size is gone after two rounds. The rounds' maps, each a
fraction of the one before, are applied from the last to the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .util import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long); component is the smallest node reachable.

    Loops and null ends are not edges; without edges the result is empty. Every round is written to the shared checkpoint
    folder, so a lost executor costs one round at most. Only whether edges are left reaches the driver.
    """
    left = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    maps: list[DataFrame] = []
    while not left.isEmpty():
        order = lambda name, seed=len(maps) // 2: F.struct(F.xxhash64(name, F.lit(seed)).alias("h"), F.col(name).alias("id"))
        ends = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ends.groupBy(F.col("a").alias("node")).agg(F.min(order("b")).alias("best"))
        into = materialise(near.select("node", F.least("best", order("node")).getField("id").alias("into")))
        maps.append(into)
        a, b = into.select(F.col("node").alias("a"), F.col("into").alias("x")), into.select(F.col("node").alias("b"), F.col("into").alias("y"))
        moved = left.join(a, "a").join(b, "b").where("x <> y")
        left = materialise(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = maps.pop()
    while maps:
        later = found.select(F.col("node").alias("into"), F.col("into").alias("last"))
        found = materialise(maps.pop().join(later, "into", "left").select("node", F.coalesce("last", "into").alias("into")))
    least = found.groupBy("into").agg(F.min("node").alias("component"))
    return materialise(found.join(least, "into").select("node", F.least("component", "into").alias("component")))
