"""Continents and hulls against plain Python on random points."""

import random

from tidemark.functions.regions import AS_STORED, ELSEWHERE, RINGS, UNLOCATED, continent, edges, rings
from tidemark.operators.hull import convex_hull


def winding_crossings(lat, lon, ring):
    """Even-odd with the intersection computed by division, on a ray along latitude."""
    odd = False
    for (la0, lo0), (la1, lo1) in zip(ring, ring[1:] + ring[:1]):
        if (lo0 > lon) != (lo1 > lon) and lat < (la1 - la0) * (lon - lo0) / (lo1 - lo0) + la0:
            odd = not odd
    return odd


def expected_label(lat, lon, corrected=False):
    if lat is None or lon is None or (lat == 0 and lon == 0):
        return UNLOCATED
    return next((name for name, ring in rings(corrected) if winding_crossings(lat, lon, ring)), ELSEWHERE)


def test_labels_of_random_points(spark):
    rng = random.Random(5)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(5000)] + [(None, 3.0), (0.0, 0.0)]
    df = spark.createDataFrame(points, "lat double, lon double")
    for corrected in (False, True):
        rows = df.select("lat", "lon", continent("lat", "lon", corrected).alias("c")).collect()
        assert all(r.c == expected_label(r.lat, r.lon, corrected) for r in rows)
        assert len({r.c for r in rows}) == 7


def test_known_places(spark):
    places = {
        "Africa": (9.1, 8.7), "America": (39.8, -98.6), "Asia": (35.9, 104.2), "Europe": (46.2, 2.2),
        "Oceania": (-25.3, 133.8), "Antarctica": (-75.0, 20.0), "Not applicable": (0.0, 0.0),
    }
    df = spark.createDataFrame([(k, *v) for k, v in places.items()], "name string, lat double, lon double")
    assert all(r.name == r.c for r in df.select("name", continent("lat", "lon").alias("c")).collect())
    honolulu = spark.createDataFrame([(21.3, -157.9)], "lat double, lon double")
    assert honolulu.select(continent("lat", "lon")).first()[0] == "Oceania"
    assert honolulu.select(continent("lat", "lon", corrected=True)).first()[0] == "America"


def test_a_point_on_a_western_border_lies_outside(spark):
    points = spark.createDataFrame([(67.85, -168.75), (67.85, -168.74)], "lat double, lon double")
    assert [r[0] for r in points.select(continent("lat", "lon")).collect()] == ["Oceania", "America"]


def test_rings_are_complete():
    assert len(rings()) == len(RINGS) + len(AS_STORED) == 11
    assert sum(len(ring) for _, ring in rings()) == 97
    assert all(len(edges(ring)) <= len(ring) for _, ring in rings())


def corner_points(points):
    """Points that lie on no segment or triangle of the others."""

    def cross(a, b, c):
        return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    points = set(points)
    if len(points) < 3:
        return points
    found = set()
    for p in points:
        for q in points - {p}:
            sides = [(cross(p, q, r), r) for r in points - {p, q}]
            between = all(min(p, q) < r < max(p, q) for side, r in sides if side == 0)
            if all(side >= 0 for side, _ in sides) and between:
                found.add(p)
    return found


def test_hulls_of_random_groups(spark):
    rng = random.Random(11)
    groups = {g: [(rng.randint(0, 12) * 1.0, rng.randint(0, 12) * 1.0) for _ in range(n)] for g, n in enumerate((1, 2, 3, 30, 60))}
    groups[5] = [(i * 1.0, i * 1.0) for i in range(9)]
    rows = [(g, x, y) for g, points in groups.items() for x, y in points]
    df = spark.createDataFrame(rows, "g int, a double, b double").repartition(7)
    got = convex_hull(df, ["g"], "a", "b", fan_in=3).orderBy("g", "vertex").collect()
    for g, points in groups.items():
        corners = [(r.a, r.b) for r in got if r.g == g]
        assert set(corners) == corner_points(points)
        assert len(corners) == len(set(corners)) and corners[0] == min(points)
        turns = zip(corners, corners[1:] + corners[:1], corners[2:] + corners[:2])
        if len(corners) > 2:
            assert all((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) > 0 for a, b, c in turns)


def test_one_group_may_hold_most_points(spark):
    """The hull of a group spread over all tasks, most of it inside."""
    df = spark.range(0, 200_000, numPartitions=8).selectExpr(
        "IF(id % 3 = 0, 0, id % 50) AS g", "cast(hash(id) % 1000 AS double) AS a", "cast(hash(id, 1) % 1000 AS double) AS b"
    )
    hull = convex_hull(df, ["g"], "a", "b").where("g = 0").collect()
    bounds = df.where("g = 0").selectExpr("min(a)", "max(a)", "min(b)", "max(b)").first()
    assert (min(r.a for r in hull), max(r.a for r in hull), min(r.b for r in hull), max(r.b for r in hull)) == tuple(bounds)
