"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.llm.tables import checkpointed


def _hang_larger(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the node's smallest neighbour."""
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    lowest = both.groupBy("high").agg(F.min("low").alias("least"))
    lowest = lowest.select("high", F.least("high", "least").alias("least"))
    return (
        both.join(lowest, "high")
        .where("low > high")
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
        .distinct()
    )


def _hang_smaller(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of these."""
    lowest = links.groupBy("high").agg(F.min("low").alias("least"))
    moved = links.join(lowest, "high").where("low != least")
    return (
        moved.select(F.col("low").alias("high"), F.col("least").alias("low"))
        .union(lowest)
        .distinct()
    )


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars: every larger end has one link, and is no smaller end."""
    ends = links.select(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("low", F.lit(0), F.lit(1))
    )
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every id that has a link, the component being its smallest id.

    ``links`` has two columns of longs; repeated links, loops and nulls are fine.
    A hub's links are joined to one row, which an adaptive skew join may split.
    """
    a, b = links.columns
    tidy = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    tidy = checkpointed(tidy.where("high != low").distinct())
    while not _settled(tidy):
        tidy = checkpointed(_hang_smaller(_hang_larger(tidy)))
    roots = tidy.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct()
    return tidy.select(F.col("high").alias("id"), F.col("low").alias("component")).union(roots)
