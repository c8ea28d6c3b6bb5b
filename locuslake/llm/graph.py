"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslake.llm.shared import drop_written, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v), u > v. The smallest neighbour comes from a combined aggregate and a join,
    so that no task gathers the neighbours of one node."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = both.join(least, "u")
    if large:
        moved = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(least.where("m < u").select("u", F.col("m").alias("v")))
    else:
        moved = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str, most: int = 40) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node reached.

    Each round is written to the shared folder. Rounds grow with the logarithm of a component's size;
    beyond `most` rounds an error is raised rather than a partial answer returned.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = written(edges, "edges")

    def size(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = size(edges)
    for _ in range(most):
        after = written(_star(_star(edges, True), False), "edges")
        drop_written(edges)
        edges, now = after, size(after)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
