"""Connected components of a graph given by its edges, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.storage import written


def _stars(edges: DataFrame) -> DataFrame:
    """Every node with its smallest neighbour, itself included, as one row per node."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))


def _large(edges: DataFrame) -> DataFrame:
    """Neighbours above a node move to the smallest neighbour of the node."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = both.where("v > u").join(_stars(edges), "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.where("u <> v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Neighbours below a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """For every node of `edges` (u, v), the smallest node that can be reached from it.

    Large and small stars take turns until the edges stay as they are; the number of turns
    grows with the logarithm of the longest path. Each turn's edges are a written table, and
    only their number and a sum of hashes come to the driver. The neighbours of a node are
    never gathered: the smallest one is an aggregate with partial sums in every task, and the
    join by node is one that Spark can split where a node has many edges.

    Edges with a null end, loops and repeated edges have no effect. Returns node and component
    for nodes that have an edge to another node; the smallest node of a component included.
    """
    now = edges.select("u", "v").dropna().where("u <> v").distinct()
    now, before = written(now, "edges"), None
    while True:
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            break
        before = state
        now = written(_small(_large(now)), "edges")
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component").distinct())
