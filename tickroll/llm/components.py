"""Connected components by alternating large-star and small-star steps.

Edges join two node keys of any ordered type. A *large star* links every
larger neighbour of a node to the least node of its neighbourhood; a *small
star* links the node itself and its smaller neighbours to that least node.
Alternated until nothing changes, each component becomes a star around its
least node, after a number of rounds that grows with the logarithm of the
longest path. A round is two aggregations (combined before the shuffle) and
two equi-joins whose skewed partitions Spark can split, so a node with very
many neighbours does not gather them in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickroll.llm.common import stage


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step over directed pairs (u, v): v is linked to the least node around u."""
    # written before the join: both of its sides are then plain scans, whose
    # skewed partitions (a node of very many neighbours) Spark splits
    least = stage(pairs.groupBy("u").agg(F.min("v").alias("_least")).withColumn("_least", F.least("u", "_least")),
                  "component-least")
    joined = pairs.join(least, "u")
    if large:
        linked = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("_least").alias("b"))
    else:
        linked = joined.select(F.col("v").alias("a"), F.col("_least").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("_least").alias("b")))
    return linked.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every node that has an edge; root is the least node of its component.

    Loops and repeated edges are allowed; no edge gives no row.
    """
    now = stage(edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
                .filter(F.col("a") != F.col("b")).distinct(), "component-edges")
    before = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        bigger = _star(both, large=True)
        down = bigger.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        after = stage(_star(down, large=False), "component-edges")
        # the edge set is a star forest when two rounds agree: count and an
        # order-free sum over the edges
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            break
        before, now = mark, after
    return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        after.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
