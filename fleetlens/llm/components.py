"""Connected components by alternating large-star and small-star rounds.

Links stay distributed throughout; each round rewrites them as a table whose
every node points to a smaller one, until all point to their component's
smallest node. Each round's links are checkpointed in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import checkpointed


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node among
    the neighbours and the node itself."""
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    return (both.filter("low > high").join(least, both.high == least.node)
            .select(F.col("low").alias("high"), F.col("least").alias("low")))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the
    smallest of them."""
    least = links.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    moved = links.join(least, links.high == least.node).select(
        F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.union(least.select(F.col("node").alias("high"), F.col("least").alias("low")))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link to another; root is the
    smallest node of its component."""
    links = checkpointed(
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .filter("low < high").distinct())
    before = None
    while True:
        links = _small_star(_large_star(links)).filter("low < high").distinct()
        links = checkpointed(links)
        # The state has come to rest when neither the number of links nor the
        # sums that any change of a link would lower have changed.
        now = links.agg(F.count("*"), F.sum(F.col("low").cast("decimal(38,0)")),
                        F.sum(F.col("high").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("high").alias("node"), F.col("low").alias("root"))
        before = now
