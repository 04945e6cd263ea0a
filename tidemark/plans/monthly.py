"""Monthly means and increases, in long and wide form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.places import COUNTRY
from tidemark.operators import monthly, wide
from tidemark.operators.ranking import top


def increase(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Increase of every month per place; the first month keeps its level."""
    changes = monthly.change(monthly.month_ends(panel, keys), keys)
    return changes.select(*keys, "month", "increase")


def mean(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean daily increase of every month per place."""
    return monthly.daily_mean(monthly.change(monthly.month_ends(panel, keys), keys), keys)


def mean_by_country(panel: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean daily increase of every month per country.

    Places are cut to their month-ends first, so the sum over places moves one
    row per place and month. A place keeps its last level until it is seen again: a month
    that it skips, or all after its last, add nothing. A month that every place of a
    country skips has a mean of 0.
    """
    moved = monthly.carried(monthly.month_ends(panel, keys), keys)
    totals = moved.groupBy("country", "month").agg(F.max("month_end").alias("month_end"), F.sum("increase").alias("increase"))
    return monthly.daily_mean(monthly.quiet_months(totals, ["country"]), ["country"])


def mean_by_country_wide(data: DataFrame) -> DataFrame:
    """The same on a wide table: sums of its month-end columns, then one projection."""
    _, days = wide.split_columns(data)
    totals = wide.total_by(data, COUNTRY, wide.month_ends(days))
    return wide.monthly_mean(totals, [COUNTRY], days)


def most_and_least(totals: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """The ``k`` largest and the ``k`` smallest totals."""
    most = top(totals, value, [key], k).withColumn("side", F.lit("most"))
    least = top(totals, value, [key], k, descending=False).withColumn("side", F.lit("least"))
    return most.unionByName(least)
