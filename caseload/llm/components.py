"""Connected components of a table of links, by alternating large-star and small-star rounds.

Each round is two aggregations and two joins; the links stay distributed and are written to the shared
folder after every round. Hub nodes are reduced by partial aggregation (a minimum) and their links by
skew-join splitting, so no node's links are gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.storage import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (links point from u down to v)."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u")
    return (moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))))


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns u, v): root is the smallest node it reaches.

    Self-links and repeated links change nothing; no links give no rows.
    """
    links = (links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links = stored(links, "links")
    before = _summary(links)
    while before[0]:
        links = stored(_small_star(_large_star(links).distinct()).distinct(), "links")
        after = _summary(links)
        if after == before:
            break
        before = after
    return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
