"""Connected components by alternating large-star and small-star steps, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracetally.llm.common import few, stored


def _to_least(around: DataFrame, most: int) -> DataFrame:
    """(``u``, ``v``, ``least``): each node's neighbours with the least of them and the node."""
    least = around.groupBy(F.col("u").alias("_u")).agg(
        F.least(F.min("v"), F.first("u")).alias("least")
    )
    # Stored, so that the join is plain and Spark can split the neighbours of a hub.
    return around.join(stored(least, most=most), F.col("u") == F.col("_u")).select("u", "v", "least")


def _shape(edges: DataFrame) -> tuple[int, int]:
    """How many different edges (``u`` > ``v``) there are, and how many nodes are in the way of stars:
    those with several smaller neighbours, or with both a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down")).union(
        edges.select("v", F.lit(0))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.count(F.lit(1)).alias("ends"))
    odd = F.expr("down > 1 OR down = 1 AND ends > 1")
    count, others = nodes.agg(F.sum("down"), F.count_if(odd)).first()
    return count or 0, others


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, of each node with an edge.

    ``edges`` has columns ``u`` and ``v``, in any direction, repeated or not. Each round links
    nodes to smaller ones until only stars around the smallest remain, in a number of rounds that
    grows with the logarithm of the longest path. Only two counts reach the driver. ``most``, if
    known, is a bound of the number of edges.
    """
    now = stored(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        most=most,
    )
    while True:
        count, odd = _shape(now)
        if not odd:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: larger neighbours go to the least neighbour.
        large = stored(
            _to_least(both, 2 * count)
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .where("u <> v")
            .distinct(),
            most=count,
        )
        # Small star: smaller neighbours and the node go to the least neighbour.
        down = _to_least(large, count)
        now = stored(
            down.select(F.col("v").alias("u"), F.col("least").alias("v"))
            .union(down.select("u", F.col("least").alias("v")))
            .where("u <> v")
            .distinct(),
            most=2 * count,
        )
    roots = now.select(F.col("v").alias("node")).distinct()
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
    return few(found, 2 * count)
