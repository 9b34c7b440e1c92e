"""Connected components as DataFrame jobs: alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) and a join on the node, so a node with a
third of all edges is neither collected nor kept in one task (AQE splits skewed joins). Edges stay between
executors; the driver sees one row of two numbers per step. Lineage is cut with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v. large: every larger neighbour of u points to u's least neighbour; small: every smaller."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        out = out.select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
    return out.where("u > v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge to another node; component is its least reachable node.

    Self loops, repeated edges and edges with a null end have no effect; no edges give an empty table.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    now = now.where("u > v").distinct().checkpoint()
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 30)))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = state
        now = _star(_star(now, True), False).checkpoint()
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
