"""Convex hull of the points of each group."""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

# The functions below travel with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _chain(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Points of a left-to-right (or right-to-left) sweep that only turn left."""
    kept: list[tuple[float, float]] = []
    for x, y in points:
        while len(kept) > 1:
            (x0, y0), (x1, y1) = kept[-2:]
            if (x1 - x0) * (y - y0) - (y1 - y0) * (x - x0) > 0:
                break
            kept.pop()
        kept.append((x, y))
    return kept


def _hull(points: Iterable[tuple[float, float]]) -> list[tuple[float, float]]:
    """Corners counter-clockwise from the leftmost; fewer than three points stay as they are."""
    ordered = sorted(set(points))
    if len(ordered) < 3:
        return ordered
    return _chain(ordered)[:-1] + _chain(ordered[::-1])[:-1]


def convex_hull(df: DataFrame, groups: Sequence[str], x: str, y: str, fan_in: int = 16) -> DataFrame:
    """Corners of the hull of each group: ``vertex`` counts them counter-clockwise.

    Every task reduces what it reads to corners, batch by batch. The corners of a
    group are then dealt to ``fan_in`` parts, which reduce them again, and the last
    step sees the corners of those parts only, however many points a group has. Points
    with a null or NaN coordinate take no part.
    """
    groups = list(groups)

    def corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[tuple, list[tuple[float, float]]] = defaultdict(list)
            for *name, x, y in batch.itertuples(index=False, name=None):
                seen[tuple(name)].append((x, y))
            rows = [(*name, x, y) for name, points in seen.items() for x, y in _hull(points)]
            yield pd.DataFrame(rows, columns=[*groups, "x", "y"])

    def close(name: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        closed = [(*name, nr, x, y) for nr, (x, y) in enumerate(_hull(zip(rows["x"], rows["y"])))]
        return pd.DataFrame(closed, columns=[*groups, "vertex", "x", "y"])

    points = df.select(*groups, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    points = points.where(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))
    reduced = points.mapInPandas(corners, points.schema)
    part = F.pmod(F.xxhash64("x", "y"), F.lit(fan_in))
    reduced = reduced.repartition(*groups, part).mapInPandas(corners, points.schema)
    keys, xy = points.select(*groups).schema, points.select("x", "y").schema
    schema = T.StructType([*keys, T.StructField("vertex", T.IntegerType()), *xy])
    return reduced.groupBy(*groups).applyInPandas(close, schema).withColumnsRenamed({"x": x, "y": y})
