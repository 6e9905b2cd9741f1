"""Connected components of a link table by alternating stars (Kiveris et al. 2014)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _round(links: DataFrame) -> DataFrame:
    """Each node's greater neighbours, then each node and its smaller neighbours, are linked to the least node around."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = both.where("v > u").join(_least(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    low = _least(large)
    small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return small.where("u <> v").distinct()


def components(links: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """links (a long, b long) -> (node, root) of every node with a link to another; cut(df) must end the lineage.

    Rounds follow the logarithm of a component's size, not its diameter; only a count and a sum of hashes reach the driver.
    """
    now, seen = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()), None
    while True:
        now = cut(_round(now))
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
