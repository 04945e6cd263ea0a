"""Min-max scaling within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def min_max(df: DataFrame, group: str, value: str, out: str = "scaled", bounded: bool = False) -> DataFrame:
    """Scale ``value`` to 0..1 within ``group``; a constant group becomes 0.0.

    The bounds are a plain aggregate joined back, so a group that holds a large
    part of all rows is never sorted or buffered in one task. Where groups are
    known to be short, ``bounded`` finds them in one pass with a window.
    """
    if bounded:
        group_rows = Window.partitionBy(group)
        rows = df.withColumns({"_low": F.min(value).over(group_rows), "_high": F.max(value).over(group_rows)})
    else:
        rows = df.join(df.groupBy(group).agg(F.min(value).alias("_low"), F.max(value).alias("_high")), group)
    span = F.col("_high") - F.col("_low")
    scaled = F.when(span == 0, F.lit(0.0)).otherwise((F.col(value) - F.col("_low")) / span)
    return rows.select(*df.columns, scaled.alias(out))
