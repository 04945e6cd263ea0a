"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import settle


ROWS = 100_000  # links that a task writes, as tables of links shrink to far fewer rows than tasks


def _mark(links: DataFrame) -> tuple:
    """Row count and an order-free hash; equal marks mean that a round changed nothing."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low")), F.sum(F.xxhash64("low", "high") % 1_000_003)).first())


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root`` for every node of ``links``; the root is the least node reachable.

    Alternating star rounds: first every larger neighbour of a node is linked to
    the least node around, then every smaller one. The links shrink to stars in
    a number of rounds that grows with the logarithm of the longest chain. A
    round is two sums and two joins, so a hub is split like any skewed key; its
    result is written to the shared folder, which ends the lineage.
    """
    links = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .distinct()
    )
    links = settle(links, "links")
    before = None
    while (mark := _mark(links)) != before:
        before = mark
        tasks = max(1, -(-2 * mark[0] // ROWS))
        both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).union(
            links.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
        large = (
            both.join(least, "node")
            .where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("high"), F.col("least").alias("low"))
            .distinct()
        )
        large = settle(large.coalesce(tasks), "large-stars")
        least = large.groupBy("high").agg(F.min("low").alias("least"))
        small = (
            large.join(least, "high")
            .where(F.col("low") != F.col("least"))
            .select(F.col("low").alias("high"), F.col("least").alias("low"))
            .union(least.select("high", F.col("least").alias("low")))
            .distinct()
        )
        links = settle(small.coalesce(tasks), "small-stars")
    roots = links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return links.select(F.col("high").alias("node"), F.col("low").alias("root")).union(roots)
