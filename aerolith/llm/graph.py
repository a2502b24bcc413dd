"""Connected components by alternating large-star and small-star steps, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _least(df: DataFrame, by: str, of: str) -> DataFrame:
    """The least neighbour of each node. Dealt by another hash than the key, so that the join that follows deals both sides itself: only then can adaptive execution split a node with many neighbours."""
    return df.groupBy(by).agg(F.min(of).alias("m")).repartition(F.xxhash64(by))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): the smallest node that it is connected with. Nulls are left out.

    A large-star step ties each node's larger neighbours to its smallest neighbour, a small-star step its smaller ones; the graph ends as one
    star per component, in a number of rounds that grows with the logarithm of the nodes. A node's neighbours are never
    gathered: their least is an aggregate with map-side partial minima, and it meets them again in an equi-join whose hot
    keys adaptive execution splits. Each round is written to the shared folder.
    """
    now = cut(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = _least(both, "u", "v").select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select("m", "v").filter("m <> v").distinct()  # (smaller, larger)
        least = _least(large, "v", "m").withColumnRenamed("m", "k")
        small = large.join(least, "v").select(F.col("k").alias("a"), F.explode(F.array("v", "m")).alias("b")).filter("a <> b").distinct()
        now = cut(small)
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if sums == state:
            break
        state = sums
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
