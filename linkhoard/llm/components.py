"""Connected components of a table of links, by alternating large-star and small-star rounds.

Each round rewrites the links so that every node points to a smaller one; the number of rounds grows with
the logarithm of the longest chain. A round is two aggregations and two joins; its links are written to the
shared folder, which cuts the lineage. The minimum of a node's neighbours is aggregated before the
shuffle, and the joins back are plain ones that adaptive execution can split for nodes with many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import measure


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node but the roots; ``links`` are ``(a, b)``, and root is the smallest node reachable.

    Links from a node to itself and repeated links are ignored; NULL nodes have no links.
    """
    size = {"rows": F.count("*"), "sum": F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))}
    links, seen = measure(links.filter("a <> b").select("a", "b"), "links", **size)
    while seen["rows"]:
        links, now = measure(_small_star(_large_star(links)), "links", **size)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
