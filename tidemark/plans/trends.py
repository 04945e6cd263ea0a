"""Steepest places, their continents, and daily and weekly totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import stats
from tidemark.functions.dates import month_number
from tidemark.functions.regions import continent
from tidemark.operators import joins
from tidemark.operators.panel import increase
from tidemark.operators.ranking import top
from tidemark.plans import monthly

STEEPEST_DAILY = 100
STEEPEST_MONTHLY = 50


def daily_slopes(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slope of the day-to-day increases per place, from one aggregate over the levels."""
    return panel.groupBy(*keys).agg(stats.slope_of_increases(F.col("date"), F.col("cum")).alias("slope"))


def slopes_of_counts(counts: DataFrame, keys: Sequence[str], start: Column, end: Column) -> DataFrame:
    """``daily_slopes`` of the panel that ``cumulative`` would make of ``counts``, without making it.

    ``start`` and ``end`` are the first and the last day of the calendar. One aggregate
    over the days that have a count; nothing is stretched to quiet days.
    """
    position = F.date_diff("date", start).cast("bigint")
    return counts.groupBy(*keys).agg(stats.slope_of_counts(position, F.col("n"), F.date_diff(end, start)).alias("slope"))


def monthly_slopes(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slope of the monthly increases per place."""
    increases = monthly.increase(panel, keys)
    return increases.groupBy(*keys).agg(stats.slope(month_number(F.col("month")), F.col("increase")).alias("slope"))


def steepest_daily(panel: DataFrame, keys: Sequence[str], k: int = STEEPEST_DAILY) -> DataFrame:
    return top(daily_slopes(panel, keys), "slope", keys, k)


def steepest_monthly(panel: DataFrame, keys: Sequence[str], k: int = STEEPEST_MONTHLY) -> DataFrame:
    return top(monthly_slopes(panel, keys), "slope", keys, k)


def with_report(rows: DataFrame, report: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the reported places together with what the report says of them."""
    return joins.inner(rows, report, keys)


def continent_daily(
    panel: DataFrame, locations: DataFrame, keys: Sequence[str], k: int = STEEPEST_DAILY
) -> DataFrame:
    """Daily increases of the steepest places, summed per continent.

    Only the reported places are labelled, and the panel is cut to them before
    its days are compared.
    """
    report = steepest_daily(panel, keys, k).select(*keys)
    located = joins.inner(locations, report, keys)
    labelled = located.select(*keys, continent("lat", "lon").alias("continent"))
    rows = with_report(panel, labelled, keys)
    daily = increase(rows, [*keys, "continent"])
    return daily.groupBy("continent", "date").agg(F.sum("inc").alias("inc"))
