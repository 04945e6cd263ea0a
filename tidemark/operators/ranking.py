"""Top-k reports with a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def _order(value: str, keys: Sequence[str], descending: bool) -> list:
    first = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    return [first, *[F.col(k).asc_nulls_first() for k in keys]]


def top(df: DataFrame, value: str, keys: Sequence[str], k: int, descending: bool = True) -> DataFrame:
    """The ``k`` rows with the largest (or smallest) ``value``, ties by key, ranked from 0.

    Every partition keeps its own k rows; only those meet for the final cut, so
    the ranking window below runs over k rows.
    """
    order = _order(value, keys, descending)
    best = df.orderBy(*order).limit(k)
    return best.withColumn("rank", (F.row_number().over(Window.orderBy(*order)) - 1).cast("int"))
