"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import stored


# Edges to a task. A round has several shuffles; a small graph needs no task for each of their partitions.
TASK_EDGES = 50_000


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Lead the greater neighbours of every node to its least neighbour."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v").coalesce(tasks)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    led = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return led.coalesce(tasks).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Lead every node and its lesser neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.toDF("u", "v")).coalesce(tasks).distinct().coalesce(tasks)


def connected_components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, its least reachable node, for nodes that have an edge.

    `edges` has two integer columns. The edges are turned into stars around the least
    nodes by alternating steps, in a number of rounds that grows with the logarithm
    of the graph's size. Each node's least neighbour is aggregated before it is
    joined to the edges, so a node with very many edges is never one task's work. Every round is a
    written table, so lost executors cost no more than that round; its counted edges say how
    many tasks the next has at most.
    """
    a, b = edges.columns
    pairs = edges.where(F.col(a) != F.col(b))
    now = stored(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        print_ = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        state = tuple(now.agg(F.count("*"), print_).first())
        if state == before or state[0] == 0:
            return now.toDF("node", "component")
        before = state
        tasks = -(-state[0] // TASK_EDGES)
        now = stored(_small_star(_large_star(now, tasks), tasks), "edges")
