"""Points in polygons as a join: outlines are rows of a table, met by grid cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CELL = 5.0  # degrees of a cell's side
VERTEX = ("ring", "label", "priority", "seq", "lat", "lon")


def _cell(value: Column, size: float) -> Column:
    return F.floor(value / size)


def sides(vertices: DataFrame) -> DataFrame:
    """``ring``, ``label``, ``priority`` and both ends of every side; a ring is closed by its first vertex."""
    order = Window.partitionBy("ring").orderBy("seq")
    first = vertices.groupBy("ring").agg(F.min_by(F.struct("lat", "lon"), "seq").alias("first"))
    following = vertices.withColumns({"lat1": F.lead("lat").over(order), "lon1": F.lead("lon").over(order)})
    return following.join(first, "ring").select(
        "ring", "label", "priority", F.col("lat").alias("lat0"), F.col("lon").alias("lon0"),
        F.coalesce("lat1", "first.lat").alias("lat1"), F.coalesce("lon1", "first.lon").alias("lon1"),
    )


def _columns(lines: DataFrame, size: float) -> DataFrame:
    """Every side once for each grid column that it touches, as ``col``."""
    low, high = _cell(F.least("lon0", "lon1"), size), _cell(F.greatest("lon0", "lon1"), size)
    return lines.withColumn("col", F.explode(F.sequence(low, high)))


def odd(lat: str, lon: str, strip: str) -> str:
    """SQL: whether an odd number of the sides of an array lies beyond the point.

    A corner level with the point counts as beyond it (>=). The signs of two products decide a
    side without a division.
    """
    crossed = (
        f"(s.lon0 >= {lon}) <> (s.lon1 >= {lon})"
        f" AND ((s.lon1 - {lon}) * (s.lat0 - s.lat1) >= (s.lat1 - {lat}) * (s.lon0 - s.lon1)) = (s.lon1 >= {lon})"
    )
    return f"size(filter({strip}, s -> {crossed})) % 2 = 1"


def strips(lines: DataFrame, size: float) -> DataFrame:
    """``ring``, ``col`` and the ``strip`` of its sides there that a ray along latitude can cross."""
    across = _columns(lines.where("lon0 <> lon1"), size)
    return across.groupBy("ring", "col").agg(F.collect_list(F.struct("lat0", "lon0", "lat1", "lon1")).alias("strip"))


def cover(lines: DataFrame, by_column: DataFrame, size: float) -> DataFrame:
    """Cells (``col``, ``row``) that a ring touches: ``border`` if a side runs through it, else wholly inside.

    A side counts for all rows between its ends in a column, wherever it crosses them: a
    cell too many is a border cell for nothing, none is missed. Between border cells no side runs, so
    the middle of a cell stands for all of it.
    """
    touched = _columns(lines, size)
    west, east = F.col("col") * size, (F.col("col") + 1) * size
    span = F.col("lon1") - F.col("lon0")
    # where the side enters and leaves the column, with a little to spare for rounding
    ends = [
        F.when(span == 0, F.col(own)).otherwise(F.col("lat0") + (F.least(F.greatest(edge, F.least("lon0", "lon1")), F.greatest("lon0", "lon1")) - F.col("lon0")) / span * (F.col("lat1") - F.col("lat0")))
        for own, edge in (("lat0", west), ("lat1", east))
    ]
    spare = F.lit(1e-6 * size)
    low, high = _cell(F.least(*ends) - spare, size), _cell(F.greatest(*ends) + spare, size)
    border = touched.select("ring", "label", "priority", "col", F.explode(F.sequence(low, high)).alias("row")).distinct()
    extent = border.groupBy("ring", "label", "priority", "col").agg(F.min("row").alias("first"), F.max("row").alias("last"), F.collect_set("row").alias("rows"))
    between = extent.select("ring", "label", "priority", "col", F.explode(F.array_except(F.sequence("first", "last"), "rows")).alias("row"))
    middle = between.join(by_column, ["ring", "col"]).withColumns({"_lat": (F.col("row") + 0.5) * size, "_lon": (F.col("col") + 0.5) * size})
    inside = middle.where(odd("_lat", "_lon", "strip")).select("ring", "label", "priority", "col", "row")
    return border.withColumn("border", F.lit(True)).union(inside.withColumn("border", F.lit(False)))


def label(points: DataFrame, vertices: DataFrame, key: str, lat: str = "lat", lon: str = "lon", size: float = CELL) -> DataFrame:
    """``key`` and the ``label`` of the ring of least priority (then label) that holds each point; null without one.

    ``vertices`` has a row per vertex: ``ring``, ``label``, ``priority``, ``seq`` and its place. A point joins
    the rings of its cell by an equality; only in cells that a side runs through are the sides of its grid column
    counted. Points without a place, or on none, have no label; a key that occurs twice is labelled twice.
    """
    lines = sides(vertices)
    by_column = strips(lines, size)
    cells = cover(lines, by_column, size)
    placed = points.select(F.col(key).alias("_key"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
    placed = placed.withColumns({"col": _cell(F.col("_lon"), size), "row": _cell(F.col("_lat"), size)})
    where = placed.select("_lat", "_lon", "col", "row").where("_lat IS NOT NULL AND _lon IS NOT NULL AND NOT isnan(_lat) AND NOT isnan(_lon)").distinct()
    met = where.join(cells, ["col", "row"]).join(by_column, ["ring", "col"], "left")
    holding = met.where(f"NOT border OR {odd('_lat', '_lon', 'strip')}")
    found = holding.groupBy("_lat", "_lon").agg(F.min(F.struct("priority", "label")).alias("best"))
    return placed.join(found, ["_lat", "_lon"], "left").select(F.col("_key").alias(key), F.col("best.label").alias("label"))
