"""Connected components of a large graph, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapweave.sources.storage import Staging


def _to_least(edges: DataFrame, stage: Staging) -> DataFrame:
    """(u, v, least): each directed edge with the least of u and all its neighbours.

    Both sides of the join are written tables, so adaptive execution can split
    the rows of a node with very many edges.
    """
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    return edges.join(stage.cut(least), "u")


def _large_star(edges: DataFrame, stage: Staging) -> DataFrame:
    both = stage.cut(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    stars = _to_least(both, stage).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return stage.cut(stars.distinct())


def _small_star(edges: DataFrame, stage: Staging) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _to_least(stage.cut(down), stage)
    stars = least.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
        least.select("u", F.col("least").alias("v"))
    )
    return stage.cut(stars.where("u <> v").distinct())


def components(edges: DataFrame, stage: Staging) -> DataFrame:
    """(node, root): the least node of its component for every node with an edge that is not least itself.

    ``edges`` has two long columns u and v. Every step is a written table. The
    number of steps grows with the logarithm of the size of a component.
    """
    current = stage.cut(edges.where("u <> v").select("u", "v").distinct())
    if current.isEmpty():
        return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    seen = None
    while True:
        current = _small_star(_large_star(current, stage), stage)
        # All edges lead from a node to the root of its star; done when none moves.
        sums = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if sums == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = sums
