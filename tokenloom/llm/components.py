"""Connected components by alternating large-star and small-star steps.

Edges are rows; a step joins them with the smallest neighbour of each node, an
aggregation that combines on the map side, so a node with a third of all edges
is never gathered in one place. Each step's edges are written to the shared
folder and the older ones deleted; the driver sees a checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import discard, staged


def _distinct(edges: DataFrame) -> DataFrame:
    return staged(edges.where("hi != lo").distinct(), "components")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to the smallest node of its neighbourhood."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    return edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(
        least.select("hi", F.col("m").alias("lo")))


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of an edge that is not itself the smallest node of its component.

    Rows with a null end or equal ends are no edges; repeated edges count once.
    The result is a staged table; ``discard`` it after use.
    """
    a, b = F.col(left), F.col(right)
    now = _distinct(edges.where(a.isNotNull() & b.isNotNull()).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")))
    mark = _checksum(now)
    while True:
        large = _distinct(_large_star(now))
        small = _distinct(_small_star(large))
        discard(now, large)
        now, before, mark = small, mark, _checksum(small)
        if mark == before:  # a fixed point: every edge leads from a node to its root
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
