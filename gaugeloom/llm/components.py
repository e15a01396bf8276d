"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free sum that tell whether a round changed anything."""
    each = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(each)).first())


def connected(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of an edge with two different ends; root is the smallest node.

    Each round is written to the shared folder, so a lost executor costs one round at most, and the
    driver sees two numbers a round. Rounds grow with the logarithm of the longest chain.
    Edges with a NULL end and loops are ignored; no edges give no rows.
    """
    a, b = F.col(left), F.col(right)
    now = stage(
        edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )
    mark = _mark(now)
    while mark[0]:
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
