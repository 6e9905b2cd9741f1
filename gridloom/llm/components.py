"""Connected components by alternating large-star and small-star rounds (Kiveris et al. 2014).

Every round is joins and combinable minima; no neighbourhood is ever gathered in one task and no link
reaches the driver, which only sees a round's edge count and checksum. A node with very many links, as every
component's least one becomes, meets its minimum by a broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_ROWS, join_hot, materialize


def _minimum(edges: DataFrame) -> DataFrame:
    """For each node u of directed edges (u, v): m, the least of u and its v, and size, the number of its edges."""
    return edges.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("size")).select("u", F.least("u", "low").alias("m"), "size")


def _moved(edges: DataFrame, low: DataFrame, hot_rows: int, n: int) -> DataFrame:
    if 2 * n <= hot_rows:  # no node can have more than all links, either way
        both = edges.join(low.select("u", "m"), "u")
    else:
        low = materialize(low, "edges-low")
        both = join_hot(edges, low.select("u", "m"), "u", low.select("u", "size"), hot_rows)
    return both.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large_star(edges: DataFrame, hot_rows: int, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _moved(both.where("v > u"), _minimum(both), hot_rows, n).where("u <> v").distinct()


def _small_star(edges: DataFrame, hot_rows: int, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _minimum(down)
    return _moved(down, low, hot_rows, n).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """edges (a long, b long) -> (node, root): root is the least node of the component; isolated nodes are absent.

    Rounds go on until one changes nothing: each lowers some node's least neighbour, so they end, after about the square
    of the logarithm of a component's size at most. Self-links and repeated links are ignored; an empty table gives an
    empty table.
    """
    now = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "edges-0")
    seen, turn, n = None, 0, now.count()
    while True:
        turn += 1
        now = materialize(_small_star(_large_star(now, hot_rows, n), hot_rows, n), f"edges-{turn}")
        mark = tuple(now.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(20,0)))")).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen, n = mark, mark[0]
