"""Connected components of an edge table, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs -> (node, root): the smallest node reachable, for nodes that have an edge.

    Alternates the large-star and the small-star step; the edges never grow in number, and each step
    is an aggregate with map-side combine plus a join, so a node with very many edges is no single
    task. Null ends and loops are left out; an empty table gives an empty result.
    """
    edges = (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    edges = stored(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = (
            both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        ).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(low, "a")
            .filter("b <> low")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(low)
            .distinct()
        )
        edges = stored(small, "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    # at the end every edge leads to the smallest node of its component
    return (
        edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        .union(edges.select("b", "b").distinct())
        .toDF("node", "root")
    )
