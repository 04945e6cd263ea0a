"""Panels that grow by days: what is known of every place is kept, and only new days are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import stats
from tidemark.operators import panel as panels


def known(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per place: its first and last day with their levels, and counts and sums of its levels.

    All that the slope of daily increases needs, and the level that the next day's increase starts from. A
    place and day may occur once; a null level counts as a day without one. No row gives no place.
    """
    level = F.col("cum").cast("bigint")
    return panel.groupBy(*keys).agg(
        F.min("date").alias("first_day"),
        F.min_by(level, "date").alias("first"),
        F.max("date").alias("last_day"),
        F.max_by(level, "date").alias("last"),
        F.count("date").alias("days"),
        F.count(level).alias("levels"),
        F.sum(level).alias("total"),
    )


def merged(before: DataFrame, later: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What is known after later days have come, equal to ``known`` of all days together.

    Both sides have one row per place; days that do not lie after those known (a batch
    given twice) are an error. A place of only one side stays as it is.
    """
    both = before.withColumn("later", F.lit(False)).unionByName(later.withColumn("later", F.lit(True)))
    overlap = F.min(F.when(F.col("later"), F.col("first_day"))) <= F.max(F.when(~F.col("later"), F.col("last_day")))
    days = F.raise_error(F.lit("days that come later must lie after those known")).cast("bigint")
    return both.groupBy(*keys).agg(
        F.min("first_day").alias("first_day"),
        F.min_by("first", "first_day").alias("first"),
        F.max("last_day").alias("last_day"),
        F.max_by("last", "last_day").alias("last"),
        F.when(overlap, days).otherwise(F.sum("days")).alias("days"),
        F.sum("levels").alias("levels"),
        F.sum("total").alias("total"),
    )


def slopes(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``trends.daily_slopes`` of all days known. A place that lacks a day is an error, one that lacks a level has no slope."""
    gap = F.raise_error(F.concat(F.lit("days missing up to "), F.col("last_day").cast("string"))).cast("double")
    slope = stats.slope_of_sums(F.col("days") - 1, F.col("first"), F.col("last"), F.col("total"))
    whole = F.col("days") == F.date_diff("last_day", "first_day") + 1
    return state.select(*keys, F.when(~whole, gap).when(F.col("levels") == F.col("days"), slope).alias("slope"))


def increases(before: DataFrame, later: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Daily increases that later days add: from the last level known on. Earlier days are not read.

    ``later`` is a panel of the new days, ``before`` what was known without them. A place
    that the new days skip adds none; a missing day is an error.
    """
    last = before.select(*keys, F.col("last_day").alias("date"), F.col("last").alias("cum"))
    return panels.increase(last.unionByName(later.select(*keys, "date", "cum")), keys)
