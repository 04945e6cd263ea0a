"""Samples by hash whose share may be as small as a table is large."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RANGE = 2**63


def drawn(share: float, *columns) -> Column:
    """Whether a row is of the sample: the 63-bit hash of its columns lies below ``share`` of the range.

    A share of 1 or more takes every row, nulls included; the smallest share above none takes one hash in 2^63.
    """
    if share >= 1:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(*columns), 1) < F.lit(max(1, int(share * RANGE)))
