"""Connected components of a graph given as a table of edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a, b); the least node names it.

    Each round moves every node's neighbours to the least of them. The sums by node combine before
    the shuffle, and the joins are between shuffled tables whose hot keys can be split, so a hub
    needs no task of its own. Each round is written as a table. No edges give no rows.
    """
    turned = edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a != b")
    links = materialise(turned.distinct())
    before = None
    while (state := _state(links)) != before:
        before = state
        links = materialise(_small_star(_large_star(links)).distinct())
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _state(links: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(links.agg(F.count("*"), F.bit_xor(mixed), F.sum(mixed % 1000003)).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), "m")
    return moved.union(least).toDF("a", "b")
