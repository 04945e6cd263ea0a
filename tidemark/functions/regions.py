"""Continent of a coordinate, as one expression without a join or a UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.places import is_unlocated

# Outlines as (latitude, longitude) vertices, each ring closed by
# its first vertex. Names are listed by priority: the first that holds wins.
# The rings under AS_STORED carry (longitude, latitude) and so hold no place.
RINGS = [
    ("America", [
        (90, -168.75), (90, -10), (78.13, -10), (57.5, -37.5), (15, -30), (15, -75),
        (1.25, -82.5), (1.25, -105), (51, -180), (60, -180), (60, -168.75),
    ]),
    ("America", [(1.25, -105), (1.25, -82.5), (15, -75), (15, -30), (-60, -30), (-60, -105)]),
    ("Europe", [
        (90, -10), (90, 77.5), (42.5, 48.8), (42.5, 30), (40.79, 28.81), (41, 29), (40.55, 27.31),
        (40.40, 26.75), (40.05, 26.36), (39.17, 25.19), (35.687499, 13.911866), (35.46, 27.91),
        (33, 27.5), (38, 10), (35.42, -10), (28.25, -13), (15, -30), (57.5, -37.5), (78.13, -10),
    ]),
    ("Europe", [
        (36.304948, 14.150906), (35.741447, 14.090299), (35.710506, 14.811997), (36.195053, 14.826364),
    ]),
    ("Asia", [
        (90, 77.5), (42.5, 48.8), (42.5, 30), (40.79, 28.81), (41, 29), (40.55, 27.31), (40.4, 26.75),
        (40.05, 26.36), (39.17, 25.19), (35.46, 27.91), (33, 27.5), (31.74, 34.58), (29.54, 34.92),
        (27.78, 34.46), (11.3, 44.3), (12.5, 52), (-60, 75), (-60, 110), (-31.88, 110), (-11.88, 110),
        (-10.27, 140), (33.13, 140), (51, 166.6), (60, 180), (90, 180),
    ]),
    ("Africa", [
        (15, -30), (28.25, -13), (35.42, 13.911866), (35.687499, -10), (38, 10), (33, 27.5),
        (31.74, 34.58), (29.54, 34.92), (27.78, 34.46), (11.3, 44.3), (12.5, 52), (-60, 75), (-60, -30),
    ]),
    ("Africa", [
        (32.035586, -6.0), (32.035586, -8.338103), (31.338941, -8.338103), (31.338941, -6.0),
    ]),
    ("Antarctica", [(-60, -180), (-60, 180), (-90, 180), (-90, -180)]),
]
AS_STORED = [
    ("America", [(166.6, 51), (180, 51), (180, 60)]),
    ("America", [(-160, 22), (-160, 18), (-153, 19), (-153, 23)]),
    ("Asia", [(-180, 90), (-168.75, 90), (-168.75, 60), (-180, 60)]),
]
UNLOCATED = "Not applicable"
ELSEWHERE = "Oceania"


def rings(corrected: bool = False) -> list[tuple[str, list[tuple[float, float]]]]:
    """All rings by priority; ``corrected`` turns the swapped ones the right way round."""
    stored = [(name, [(b, a) for a, b in ring] if corrected else ring) for name, ring in AS_STORED]
    order = {name: i for i, (name, _) in reversed(list(enumerate(RINGS)))}
    return sorted(RINGS + stored, key=lambda item: order[item[0]])


def edges(ring: list[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    """Sides that a ray along latitude can cross: those that span longitudes."""
    sides = zip(ring, ring[1:] + ring[:1])
    return [tuple(map(float, (*p, *q))) for p, q in sides if p[1] != q[1]]


def inside(lat: str, lon: str, ring: list[tuple[float, float]]) -> str:
    """Even-odd test as SQL: an odd number of sides lies beyond the point.

    The box around the ring is tested first, so most rings cost four
    comparisons. The sides are one constant array: written out side by side
    they would make a method too long for the JVM to compile. The signs of two
    products decide a side without a division. A corner level with the point
    counts as beyond it (>=), which settles points on a border along a longitude.
    """
    lats, lons = zip(*ring)
    in_box = (
        f"{lat} BETWEEN {float(min(lats))}D AND {float(max(lats))}D"
        f" AND {lon} BETWEEN {float(min(lons))}D AND {float(max(lons))}D"
    )
    fields = ("lat0", "lon0", "lat1", "lon1")
    sides = [", ".join(f"'{f}', {v}D" for f, v in zip(fields, edge)) for edge in edges(ring)]
    constant = ", ".join(f"named_struct({side})" for side in sides)
    crossed = (
        f"(s.lon0 >= {lon}) <> (s.lon1 >= {lon})"
        f" AND ((s.lon1 - {lon}) * (s.lat0 - s.lat1) >= (s.lat1 - {lat}) * (s.lon0 - s.lon1)) = (s.lon1 >= {lon})"
    )
    return f"({in_box} AND size(filter(array({constant}), s -> {crossed})) % 2 = 1)"


def continent(lat: str, lon: str, corrected: bool = False) -> Column:
    """Label of the first ring that holds the point of two double columns."""
    tests = [f"WHEN {inside(lat, lon, ring)} THEN '{name}'" for name, ring in rings(corrected)]
    located = F.expr(f"CASE {' '.join(tests)} ELSE '{ELSEWHERE}' END")
    return F.when(is_unlocated(F.col(lat), F.col(lon)), UNLOCATED).otherwise(located)
