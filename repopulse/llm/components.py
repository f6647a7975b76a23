"""Connected components by alternating stars, for graphs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.session import staged


def _with_least(pairs: DataFrame) -> DataFrame:
    """Rows (u, v) with `least`, the smallest of u and all its v.

    The aggregate is rebalanced, so that both sides of the join are plain shuffles
    and the rows of a node with many edges can be split among tasks.
    """
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    return pairs.join(least.hint("rebalance"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _with_least(down)
    moved = found.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
    return moved.where("u != v").distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node either has a single edge to its root or is a root."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("root")),
                F.struct(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("root")),
            )
        ).alias("end")
    ).select("end.*")
    roles = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root"))
    return roles.where("leaf > 1 or (leaf = 1 and root = 1)").isEmpty()


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) of every node that `edges` (u, v) names; root is the component's least node.

    Each round replaces edges by such to smaller nodes until only stars are left,
    which takes about as many rounds as the logarithm of the longest path. Every
    round is written and read back, so nothing hangs on a live executor. The
    driver sees one yes or no per round.
    """
    now = staged(spark, edges.where("u != v").select("u", "v").distinct(), "edges")
    now = staged(spark, _small_star(now), "edges")
    while not _only_stars(now):
        large = staged(spark, _large_star(now), "edges")
        now = staged(spark, _small_star(large), "edges")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
