"""Seven-day statistics of daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions import stats
from tidemark.functions.dates import week_number


def weekly_stats(daily: DataFrame, key: str, value: str = "inc") -> DataFrame:
    """Mean, population standard deviation, max and min per run of seven days.

    Weeks count from the first day of each series; the last may be short. The
    window sees one row per series and day.
    """
    first = F.min("date").over(Window.partitionBy(key))
    weeks = daily.withColumn("week", week_number(F.col("date"), first))
    return weeks.groupBy(key, "week").agg(
        stats.mean(F.col(value)).alias("mean"),
        stats.std_pop(F.col(value)).alias("std"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
    )
