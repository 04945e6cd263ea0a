"""Month buckets of a long panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.dates import month_of
from tidemark.functions.stats import level_mean as level_mean_of


def month_ends(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Level on the last observed day of each month; combines before any shuffle."""
    return panel.groupBy(*keys, month_of(F.col("date")).alias("month")).agg(
        F.max("date").alias("month_end"), F.max_by("cum", "date").alias("cum")
    )


def change(ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Increase since the previous month-end; the first month keeps its level.

    A month missing between two others is an error: its increase has no day count.
    """
    by_month = Window.partitionBy(*keys).orderBy("month")
    earlier = F.lag("month").over(by_month)
    gap = F.raise_error(F.concat(F.lit("no level in the month before "), F.col("month").cast("string"))).cast("bigint")
    before, has_before = F.when(F.add_months(earlier, 1) == F.col("month"), F.lag("cum").over(by_month)).otherwise(gap), earlier.isNotNull()
    return ends.select(
        *keys,
        "month",
        "month_end",
        F.when(has_before, F.col("cum") - before).otherwise(F.col("cum")).alias("increase"),
        has_before.alias("has_before"),
    )


def carried(ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Increase since the month-end at which a place was last seen, however long ago; its first level counts whole.

    Summed over places and months these are the totals of all places, each with its last level
    at or before the month's end.
    """
    by_month = Window.partitionBy(*keys).orderBy("month")
    before = F.coalesce(F.lag("cum").over(by_month), F.lit(0))
    return ends.withColumn("increase", F.col("cum") - before).drop("cum")


def quiet_months(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``changes`` (``month``, ``month_end``, ``increase``) with an increase of 0 in every month between two others, and ``has_before``."""
    by_month = Window.partitionBy(*keys).orderBy("month")
    last = F.coalesce(F.add_months(F.lead("month").over(by_month), -1), F.col("month"))
    months = F.sequence("month", last, F.expr("interval 1 month"))
    marked = changes.withColumns({"_months": months, "_first": F.lag("month").over(by_month).isNull()})
    each = marked.select(*keys, "month_end", "increase", "_first", F.posexplode("_months").alias("_nth", "month"))
    seen = F.col("_nth") == 0
    return each.select(
        *keys, "month", F.when(seen, F.col("month_end")).otherwise(F.last_day("month")).alias("month_end"),
        F.when(seen, F.col("increase")).otherwise(F.lit(0)).alias("increase"), (~(seen & F.col("_first"))).alias("has_before"),
    )


def daily_mean(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Monthly increase per day up to the month-end; the first month stays undivided."""
    per_day = F.col("increase").cast("double") / F.dayofmonth("month_end")
    value = F.when(F.col("has_before"), per_day).otherwise(F.col("increase").cast("double"))
    return changes.select(*keys, "month", value.alias("mean"))


def level_mean(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of the level itself over the days of each month."""
    return panel.groupBy(*keys, month_of(F.col("date")).alias("month")).agg(
        level_mean_of(F.col("cum")).alias("level_mean")
    )


def months(panel: DataFrame) -> DataFrame:
    """Sorted list of the months present."""
    return panel.select(month_of(F.col("date")).alias("month")).distinct().orderBy("month")
