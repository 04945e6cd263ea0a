"""Long panels: one row per place and day with the cumulative level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def calendar(bounds: DataFrame) -> DataFrame:
    """All days of a one-row (start, end) table, numbered from 0."""
    days = F.sequence("start", "end", F.expr("interval 1 day"))
    return bounds.select(F.posexplode(days).alias("idx", "date"))


def cumulative(
    counts: DataFrame, keys: Sequence[str], start: Column, end: Column, day: str = "date", count: str = "n"
) -> DataFrame:
    """Running total per place on every day from ``start`` to ``end``.

    ``counts`` holds at most one row per place and day, and only days on which
    something was counted. Each row is stretched over the quiet days up to the
    next one (the first row also back to ``start``), so no skeleton of all
    places and days is built or joined. A place contributes at most one row per
    calendar day to its window, however many facts it has.
    """
    by_day = Window.partitionBy(*keys).orderBy(day)
    running = counts.select(
        *keys,
        F.col(day).alias("_from"),
        F.sum(count).over(by_day.rowsBetween(Window.unboundedPreceding, 0)).alias("_level"),
        F.lag(day).over(by_day).isNull().alias("_is_first"),
        F.lead(day).over(by_day).alias("_next"),
    )
    begin = F.when(F.col("_is_first"), start).otherwise(F.col("_from"))
    stop = F.coalesce(F.date_sub("_next", 1), end)
    stretched = running.select(
        *keys, "_from", "_level", F.explode(F.sequence(begin, stop, F.expr("interval 1 day"))).alias("date")
    )
    level = F.when(F.col("date") < F.col("_from"), F.lit(0)).otherwise(F.col("_level"))
    return stretched.select(*keys, "date", level.cast("bigint").alias("cum"))


def sum_by(panel: DataFrame, keys: Sequence[str], value: str = "cum") -> DataFrame:
    """Totals of all places that share ``keys`` (for example a country and a day)."""
    return panel.groupBy(*keys).agg(F.sum(value).alias(value))


def on_last_day(panel: DataFrame, last: Column | None = None) -> DataFrame:
    """Rows of the latest day; pass ``last`` where it is known without reading the panel."""
    return panel.where(F.col("date") == (panel.agg(F.max("date")).scalar() if last is None else last))


def increase(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change to the next day, stored under the earlier day; the last day has none.

    A missing day is an error: the change over several days is no day's increase.
    """
    by_day = Window.partitionBy(*keys).orderBy("date")
    following = panel.withColumn("_next", F.lead("cum").over(by_day)).withColumn("_day", F.lead("date").over(by_day))
    gap = F.raise_error(F.concat(F.lit("no level on the day after "), F.col("date").cast("string"))).cast("bigint")
    change = F.when(F.date_diff("_day", "date") == 1, F.col("_next") - F.col("cum")).otherwise(gap)
    return following.where("_day IS NOT NULL").select(*keys, "date", change.alias("inc"))
