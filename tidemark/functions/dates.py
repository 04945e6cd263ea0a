"""Day headers (``M/D/YY``), month buckets and their labels."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import Column, functions as F

# Text formats of day and month labels.
DAY_HEADER = "M/d/yy"
MONTH_LABEL = "M/yy"
YEAR_MONTH = "yyyy-MM"
ISO_DAY = "yyyy-MM-dd"
DASHED_DAY = "M-d-yyyy"
FIRST_YEAR_OF_1900S = 69  # two-digit years from here on belong to the 1900s

_HEADER = re.compile(r"(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})")


def parse_header(name: str) -> date | None:
    """The day a column name stands for, or None if it names no day."""
    hit = _HEADER.fullmatch(name)
    if hit is None:
        return None
    month, day, year = map(int, hit.groups())
    century = 0 if year > 99 else 1900 if year >= FIRST_YEAR_OF_1900S else 2000
    try:
        return date(century + year, month, day)
    except ValueError as wrong:
        raise ValueError(f"column {name!r} names no day of the calendar") from wrong


def header_of(day: date) -> str:
    return f"{day.month}/{day.day}/{day:%y}"


def label_of(month: date) -> str:
    return f"{month.month}/{month:%y}"


def days_between(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def months_between(start: date, end: date) -> list[date]:
    """First days of the months that touch ``start``..``end``."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [date(m // 12, m % 12 + 1, 1) for m in range(first, last + 1)]


def header_to_date(header: Column) -> Column:
    """``parse_header`` for values of a column."""
    parts = F.split(header, "/")
    month, day, year = (parts.getItem(i).cast("int") for i in range(3))
    century = F.when(year > 99, 0).when(year >= FIRST_YEAR_OF_1900S, 1900).otherwise(2000)
    return F.make_date(century + year, month, day)


def day_header(day: Column) -> Column:
    return F.date_format(day, DAY_HEADER)


def dashed_day(header: Column) -> Column:
    """Repair a day header to a dashed date with a four-digit year."""
    return F.date_format(header_to_date(header), DASHED_DAY)


def iso_day(day: Column) -> Column:
    return F.date_format(day, ISO_DAY)


def year_month(day: Column) -> Column:
    return F.date_format(day, YEAR_MONTH)


def month_label(day: Column) -> Column:
    return F.date_format(day, MONTH_LABEL)


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_number(day: Column) -> Column:
    """Months since year 0; consecutive months differ by one."""
    return F.year(day) * 12 + F.month(day)


def day_number(day: Column) -> Column:
    return F.datediff(day, F.lit("2000-01-01").cast("date"))


def bucket_header(month_end: Column) -> Column:
    """Month bucket name: last day and the number of days it stands for."""
    return F.concat(day_header(month_end), F.lit("-"), F.dayofmonth(month_end), F.lit("-days"))


def bucket_days(header: Column) -> Column:
    """Number of days carried by a bucket name."""
    return F.split(header, "-").getItem(1).cast("int")


def week_number(day: Column, first: Column) -> Column:
    """Runs of seven days counted from ``first``, starting at 1."""
    return (F.floor(F.datediff(day, first) / 7) + 1).cast("int")
