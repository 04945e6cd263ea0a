"""Work on wide tables row by row: a place is one row, so nothing is shuffled.

Each operator is a single projection (one sum per country at most), whatever
the number of day columns, and names only the columns it needs, so a columnar
source reads no others. Projections over hundreds of day columns are written
as SQL text, which Spark analyses in one go.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import parse_header


def quoted(name: str) -> str:
    """A column name as SQL; headers hold slashes and dots."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def project(df: DataFrame, columns: Sequence[str], tail: str = "") -> DataFrame:
    """SELECT the given SQL expressions from ``df``."""
    text = f"SELECT {', '.join(columns)} FROM [] {tail}".replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(text.replace("[]", "{df}"), df=df)


def _named(headers: Sequence[str]) -> list[str]:
    return [quoted(h) for h in headers]


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop the columns whose name matches ``pattern``."""
    return df.drop(*[c for c in df.columns if re.match(pattern, c)])


def split_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Header columns and day columns (in the order of their days)."""
    days = sorted((c for c in df.columns if parse_header(c)), key=parse_header)
    return [c for c in df.columns if not parse_header(c)], days


def columns_like(df: DataFrame, part: str) -> list[str]:
    """Columns whose name contains ``part``."""
    return [c for c in df.columns if part in c]


def last_to_front(df: DataFrame, count: int) -> DataFrame:
    """Move the last ``count`` columns to the front."""
    return project(df, _named(df.columns[-count:] + df.columns[:-count]))


def by_month(days: Sequence[str]) -> dict[str, list[str]]:
    """Day columns grouped by month, keyed ``YYYY-MM``."""
    return {month: list(cols) for month, cols in groupby(days, key=lambda c: f"{parse_header(c):%Y-%m}")}


def month_ends(days: Sequence[str]) -> list[str]:
    """The last day column of each month."""
    return [cols[-1] for cols in by_month(days).values()]


def bucket_name(day: str) -> str:
    """Name of a month bucket: its last day and the days it stands for."""
    return f"{day}-{parse_header(day).day}-days"


def total_by(df: DataFrame, key: str, days: Sequence[str]) -> DataFrame:
    """Sum of the given day columns per key, under their own names."""
    sums = [f"sum({quoted(d)}) AS {quoted(d)}" for d in days]
    return project(df, [quoted(key), *sums], f"GROUP BY {quoted(key)}")


def monthly_increase(df: DataFrame, headers: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Increase from month-end to month-end; the first month keeps its level."""
    ends = month_ends(days)
    changes = [quoted(ends[0]), *[f"{quoted(b)} - {quoted(a)}" for a, b in zip(ends, ends[1:])]]
    return project(df, [*_named(headers), *[f"{c} AS {quoted(bucket_name(e))}" for c, e in zip(changes, ends)]])


def monthly_mean(df: DataFrame, headers: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Daily mean of each month's increase; the first month keeps its level."""
    ends = month_ends(days)
    first = f"CAST({quoted(ends[0])} AS DOUBLE)"
    per_day = [
        f"CAST({quoted(b)} - {quoted(a)} AS DOUBLE) / {parse_header(b).day}" for a, b in zip(ends, ends[1:])
    ]
    means = [f"{m} AS {quoted(bucket_name(e))}" for m, e in zip([first, *per_day], ends)]
    return project(df, [*_named(headers), *means])


def level_mean(df: DataFrame, headers: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Mean level of each month over its days; a missing day leaves the month missing."""

    def total(cols: Sequence[str]) -> str:
        return f"aggregate(array({', '.join(_named(cols))}), 0L, (total, level) -> total + level)"

    means = [
        f"CAST({total(cols)} AS DOUBLE) / {len(cols)} AS {quoted(month)}" for month, cols in by_month(days).items()
    ]
    return project(df, [*_named(headers), *means])


def daily_increase(df: DataFrame, headers: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Change to the next day under the earlier day's name; the last day is dropped."""
    changes = [f"{quoted(b)} - {quoted(a)} AS {quoted(a)}" for a, b in zip(days, days[1:])]
    return project(df, [*_named(headers), *changes])


def slope(columns: Sequence[str]) -> Column:
    """Least-squares slope of integer columns on their position 0..n-1."""
    n = len(columns)
    if n < 2:
        return F.lit(0.0)
    values = F.expr(f"array({', '.join(_named(columns))})").cast("array<bigint>")
    weighted = F.transform(values, lambda v, i: v * (i * 2 - (n - 1)))
    moment = F.aggregate(weighted, F.lit(0).cast("bigint"), lambda total, v: total + v)
    return (moment * 6).cast("double") / float(n * (n * n - 1))
