"""Between long panels and wide tables with one column per period."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import days_between, header_of, parse_header
from tidemark.operators.wide import project, quoted

MOST_COLUMNS = 10_000  # a wider table is slow to plan, whatever its rows


def labels_of(rows: DataFrame, label: Column, most: int = MOST_COLUMNS) -> list:
    """The distinct values of ``label``, in order, that are to become columns; more than ``most`` are an error."""
    found = rows.select(label.alias("label")).distinct().orderBy("label").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} values cannot become columns: keep a row for each")
    return [r[0] for r in found]


def to_wide(long: DataFrame, keys: Sequence[str], on: str, labels: Sequence[object], value: str) -> DataFrame:
    """One row per key and one column per label.

    The labels are given, so no job runs to find them and the columns stay in
    their order.
    """
    return long.groupBy(*keys).pivot(on, list(labels)).agg(F.first(value))


def to_long(wide: DataFrame, keys: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per key and remaining column, named by the column."""
    kept = [quoted(k) for k in keys]
    return wide.unpivot(kept, [quoted(c) for c in wide.columns if c not in keys], name, value)


def day_series(panel: DataFrame, keys: Sequence[str], start: date, end: date) -> DataFrame:
    """The levels of each place as one array, a value per day from ``start`` to ``end``.

    A place has at most one row per day, so an array never outgrows the
    calendar. A place that misses a day is an error.
    """
    length = (end - start).days + 1
    entries = panel.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("date", "cum"))).alias("_days"))
    whole = (
        (F.size("_days") == length)
        & (F.col("_days")[0]["date"] == F.lit(start))
        & (F.col("_days")[length - 1]["date"] == F.lit(end))
    )
    levels = F.when(whole, F.col("_days.cum")).otherwise(F.raise_error(F.lit("a place misses a day")))
    return entries.select(*keys, levels.alias("levels"))


def days_to_wide(series: DataFrame, start: date, end: date) -> DataFrame:
    """One column per day, named ``M/D/YY``, from the array of levels.

    With thousands of days this is far cheaper than a pivot.
    """
    kept = [quoted(c) for c in series.columns if c != "levels"]
    days = days_between(start, end)
    return project(series, [*kept, *[f"levels[{i}] AS {quoted(header_of(day))}" for i, day in enumerate(days)]])


def days_to_long(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long panel of a table whose day columns are named ``M/D/YY``."""
    days = {c: parse_header(c) for c in wide.columns if c not in keys}
    unknown = [c for c, day in days.items() if day is None]
    if unknown:
        raise ValueError(f"not a day column: {unknown[:5]}")
    kept = [quoted(k) for k in keys]
    levels = project(wide, [*kept, f"posexplode(array({', '.join(map(quoted, days))})) AS (_pos, cum)"])
    calendar = f"array({', '.join(f"DATE'{day}'" for day in days.values())})"
    return project(levels, [*kept, f"{calendar}[_pos] AS date", "cum"])


def transpose(wide: DataFrame, key: str, name: str, labels: Sequence[object]) -> DataFrame:
    """Columns become rows and the listed values of ``key`` become columns."""
    return to_wide(to_long(wide, [key], name, "_value"), [name], key, labels, "_value")
