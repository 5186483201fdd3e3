"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.shared import forget, settle


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node in its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    joined = links.join(least, "a")
    return (
        joined.where("b <> least")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .unionByName(least.select("a", F.col("least").alias("b")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: longs), root being the smallest one.

    Alternates the two star operations until nothing changes, which takes a number of rounds
    logarithmic in the longest path. Every round works on rows of two longs, sums before it
    shuffles, and is written to the shared folder.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = settle(links.distinct(), "links")
    seen = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen, before = now, links
        links = settle(_small_star(_large_star(links).distinct()), "links")
        forget(before)
