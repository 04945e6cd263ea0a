"""Aggregates over integer series that do not depend on the order of addition.

Counts are integers, so sums of them and of their products are exact; only the
last division or root rounds. The same rows give the same bits whatever the
partitioning, which keeps rankings by these values reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _product(a: Column, b: Column) -> Column:
    return a.cast("decimal(38,0)") * b.cast("decimal(38,0)")


def _ratio(over: Column, under: Column) -> Column:
    """0 where the spread of x is 0: a series of one value has no trend."""
    return F.when(under == 0, F.lit(0.0)).otherwise(over.cast("double") / under.cast("double"))


def slope(x: Column, y: Column) -> Column:
    """Least-squares slope of integer ``y`` on integer ``x``; nulls in y are left out."""
    x = F.when(y.isNotNull(), x).cast("bigint")
    y = y.cast("bigint")
    n, sx, sy = F.count(y), F.sum(x), F.sum(y)
    over = _product(n, F.sum(_product(x, y))) - _product(sx, sy)
    under = _product(n, F.sum(_product(x, x))) - _product(sx, sx)
    return _ratio(over, under)


def slope_of_increases(day: Column, level: Column) -> Column:
    """Slope of the day-to-day increases of a gap-free cumulative series.

    With increases d[i] = c[i+1] - c[i], i = 0..n-1, the sums that the slope
    needs telescope: sum(d) = c[n] - c[0] and sum(i*d) = n*c[n] - sum(c[1..n]).
    One plain aggregate over the levels therefore replaces a window over them.
    A series with a missing level has no slope.
    """
    level = level.cast("bigint")
    n = F.count(day) - 1
    first, last = F.min_by(level, day), F.max_by(level, day)
    return F.when(F.count(level) == F.count(day), slope_of_sums(n, first, last, F.sum(level)))


def slope_of_sums(n: Column, first: Column, last: Column, total: Column) -> Column:
    """``slope_of_increases`` from its sums: ``n`` increases, the first and last level, and the total of all levels."""
    sum_xy = n * last - (total - first)
    over = _product(F.lit(12), sum_xy) - _product((n - 1) * 6, last - first)
    return _ratio(over, n * (n * n - 1))


def slope_of_counts(position: Column, count: Column, increases: Column) -> Column:
    """``slope_of_increases`` from the days that have a count, however few.

    ``position`` is the day's distance from the first day of the calendar, whose own
    count is no increase; ``increases`` is the number of days after it. Days
    without a count add nothing to the sums, so they need no row.
    """
    total = F.sum(F.when(position > 0, count).otherwise(0))
    weighted = F.sum(_product(F.greatest(position - 1, F.lit(0)), F.when(position > 0, count).otherwise(0)))
    n = F.max(increases).cast("bigint")
    over = _product(F.lit(12), weighted) - _product((n - 1) * 6, total)
    return _ratio(over, _product(n, n * n - 1))


def mean(value: Column) -> Column:
    return F.sum(value).cast("double") / F.count(value)


def std_pop(value: Column) -> Column:
    """Population standard deviation of an integer column."""
    value = value.cast("bigint")
    n = F.count(value)
    spread = _product(n, F.sum(_product(value, value))) - _product(F.sum(value), F.sum(value))
    return F.sqrt(spread.cast("double")) / n


def level_mean(value: Column) -> Column:
    """Sum over the days divided by all days, whether or not a day has a value."""
    return F.sum(value).cast("double") / F.count(F.lit(1))
