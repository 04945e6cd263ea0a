"""Cluster lists as text, for results that keep one text per month."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def list_text(values: Column) -> Column:
    """Integers as text such as ``[0, 1, 3]``."""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), ", "), F.lit("]"))


def parse_list(text: Column) -> Column:
    """The integers of such a text."""
    return F.from_json(text, "array<int>")
