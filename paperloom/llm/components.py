"""Connected components of a graph by alternating star contraction, on Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm import common
from paperloom.llm.common import discard, hot_join, written


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, m, rows): the smallest of u and its neighbours in ``edges`` (u, v), and how many edges u has; partial results
    before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("rows")).select("u", F.least("u", "m").alias("m"), "rows")


def _with_smallest(edges: DataFrame, hubs: bool) -> DataFrame:
    """``edges`` with m; ``hubs`` says whether a node can have so many edges that they are worth dealing."""
    smallest = _smallest(edges)
    return hot_join(edges, smallest, "u", "rows", "v") if hubs else edges.join(smallest, "u")


def _large_star(edges: DataFrame, hubs: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both, hubs).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, hubs: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    joined = _with_smallest(down, hubs)
    return joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.groupBy("u").agg(F.min("v").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long); the component is its smallest node.

    Rounds grow with the logarithm of a component's size. The edges of a node with very many are dealt over tasks. Loops
    and repeated edges do no harm, nulls are left out, an empty table gives an empty result.
    """
    current = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, last = state, current
        hubs = 2 * state[0] > common.HOT_ROWS
        current = written(_small_star(_large_star(current, hubs), hubs).where("u != v").distinct(), "edges")
        discard(last)
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
