"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import staged


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node that has an edge.

    Large-star and small-star steps: every node points its neighbours at the
    least one it knows, until each component is one star. The number of edges
    never grows, rounds are logarithmic in the number of nodes, and each round
    is written to the shared folder. A node with many edges is aggregated to
    one row before its edges are joined with it, and adaptive execution splits
    that join. Self-loops and NULL ends are ignored; no edges give no rows.
    """
    now = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    now = staged(now.where("u > v").distinct(), "edges")
    mark = _mark(now)
    while True:
        now = staged(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Row count and two sums of hashes: equal for equal edge sets."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")),
            F.sum(F.xxhash64("v", "u").cast("decimal(20,0)")),
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node, pointed at the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node and itself, pointed at the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
