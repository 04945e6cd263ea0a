"""Clusters of the steepest places in every month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.lists import list_text, parse_list
from tidemark.operators import kmeans
from tidemark.operators.hull import convex_hull
from tidemark.plans import monthly, trends
from tidemark.session import settle


def _steepest(panel: DataFrame, keys: Sequence[str], k: int) -> tuple[DataFrame, list[str]]:
    """The panel cut to the steepest places, before anything is computed per month."""
    rows = trends.with_report(panel, trends.steepest_monthly(panel, keys, k), keys)
    return rows, [*keys, "slope", "rank"]


def steepest_means(panel: DataFrame, keys: Sequence[str], k: int = trends.STEEPEST_MONTHLY) -> DataFrame:
    """Monthly means of the steepest places, with slope and rank."""
    return monthly.mean(*_steepest(panel, keys, k))


def steepest_increases(panel: DataFrame, keys: Sequence[str], k: int = trends.STEEPEST_MONTHLY) -> DataFrame:
    """Monthly increases of the steepest places, with slope and rank."""
    return monthly.increase(*_steepest(panel, keys, k))


def by_month(
    panel: DataFrame,
    keys: Sequence[str],
    k: int = trends.STEEPEST_MONTHLY,
) -> DataFrame:
    """Cluster of each of the steepest places in each month, by its scaled mean.

    All months are clustered together in rounds over their points, be they few or many.
    """
    means = settle(steepest_means(panel, keys, k), "means")
    clustered = kmeans.cluster(kmeans.grid_points(means, "month", "mean"), "month")
    return clustered.select(*keys, "rank", "slope", "month", "mean", "scaled", "cluster")


def texts(clustered: DataFrame) -> DataFrame:
    """The clusters of each month as one text, in the order of the ranks."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "cluster"))).getField("cluster")
    return clustered.groupBy("month").agg(list_text(ranked).alias("cluster_id"))


def parsed(by_text: DataFrame) -> DataFrame:
    """One row per rank and month again, out of those texts."""
    return by_text.select("*", F.posexplode(parse_list(F.col("cluster_id"))).alias("rank", "cluster"))


def hulls(clustered: DataFrame) -> DataFrame:
    """Hull of each cluster of each month in the plane of slope and mean."""
    points = clustered.select("month", "cluster", F.col("slope").cast("float").alias("slope"), "mean")
    return convex_hull(points, ["month", "cluster"], "slope", "mean")
