"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is one aggregation and one join over the edges, whose number never grows; the number of
rounds is logarithmic even for long chains.  The edges of a node with very many meet its one row by broadcast
(``common.join_groups``), so a star of any size is spread over all tasks.  Rounds are cut by tables in the
shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import join_groups
from tagloom.session import stage


def _with_lowest(edges: DataFrame, total: int) -> DataFrame:
    """Add ``m``, the smallest neighbour of ``a`` among ``total`` edges at most."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    return join_groups(edges, lowest, "a", "degree", "b", total)


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Tie every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        _with_lowest(both, 2 * total)
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    others = _with_lowest(down, total).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = down.groupBy("a").agg(F.min("b").alias("b"))
    return others.unionByName(own).where(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node reachable.

    Self loops and repeated edges do no harm; nulls must not occur.
    """
    edges = stage(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    total, before = edges.count(), None
    while True:
        # No step makes more edges than there were.
        edges = stage(_small_star(_large_star(edges, total), total), "star")
        now = tuple(
            edges.agg(
                F.count(F.lit(1)),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            ).first()
        )
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return leaves.unionByName(roots)
