"""Outlines as a table: the same labels as the constant expression, and as counting sides by hand."""

import random

import pytest

from tidemark.functions.regions import continent, rings
from tidemark.operators import polygons
from tidemark.workload import outlines


def vertices(spark, shapes):
    rows = [(n, name, rank, i, float(a), float(b)) for n, (name, rank, ring) in enumerate(shapes) for i, (a, b) in enumerate(ring)]
    return spark.createDataFrame(rows, "ring long, label string, priority int, seq int, lat double, lon double")


def holds(lat, lon, ring):
    beyond = 0
    for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
        if (b >= lon) != (d >= lon):
            beyond += ((d - lon) * (a - c) >= (c - lat) * (b - d)) == (d >= lon)
    return beyond % 2 == 1


@pytest.mark.parametrize("size, corrected", [(5.0, False), (5.0, True), (30.0, False), (2.0, True)])
def test_equal_to_the_expression(spark, size, corrected):
    rng = random.Random(7)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(4000)]
    rows += [(5000 + i, float(a), float(b)) for i, (a, b) in enumerate(p for _, ring in rings(corrected) for p in ring if abs(p[0]) < 90)]
    rows += [(9000 + i, float(rng.randrange(-85, 90, 5)), float(rng.randrange(-175, 180, 5))) for i in range(300)]
    points = spark.createDataFrame(rows, "id long, lat double, lon double").where("NOT (lat = 0 AND lon = 0)")
    got = {r.id: r.label or "Oceania" for r in polygons.label(points, outlines(spark, corrected), "id", size=size).collect()}
    wanted = points.select("id", continent("lat", "lon", corrected).alias("label"))
    assert got == {r.id: r.label for r in wanted.collect()}


def test_ten_thousand_rings(spark):
    rng = random.Random(8)
    shapes = []
    for n in range(10_000):
        a, b = rng.uniform(-80, 80), rng.uniform(-170, 170)
        ring = [(a + rng.uniform(-3, 3), b + rng.uniform(-3, 3)) for _ in range(rng.randint(3, 7))]
        shapes.append((f"r{n}", n % 50, ring))
    rows = [(i, rng.uniform(-85, 85), rng.uniform(-175, 175)) for i in range(300)] + [(i, None, 1.0) for i in range(2)] + [(1, float("nan"), 2.0)]
    points = spark.createDataFrame(rows, "id long, lat double, lon double").repartition(4)
    labelled = polygons.label(points, vertices(spark, shapes), "id", size=2.0)
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    wanted = []
    for i, lat, lon in rows:
        hits = [(rank, name) for name, rank, ring in shapes if lat is not None and lat == lat and holds(lat, lon, ring)]
        wanted.append((i, min(hits)[1] if hits else None))
    assert sorted((tuple(r) for r in labelled.collect()), key=str) == sorted(wanted, key=str)


def test_inner_cells_need_no_sides_and_empty_tables(spark):
    ring = [(0.0, 0.0), (0.0, 40.0), (40.0, 40.0), (40.0, 0.0)]
    table = vertices(spark, [("box", 0, ring)])
    lines = polygons.sides(table)
    cells = polygons.cover(lines, polygons.strips(lines, 5.0), 5.0)
    assert {(r.col, r.row) for r in cells.where("NOT border").collect()} >= {(c, r) for c in range(1, 7) for r in range(1, 7)}
    points = spark.createDataFrame([(1, 20.0, 20.0), (1, 20.0, 20.0), (2, 50.0, 20.0)], "id long, lat double, lon double")
    assert sorted((tuple(r) for r in polygons.label(points, table, "id").collect()), key=str) == [(1, "box"), (1, "box"), (2, None)]
    assert {r.label for r in polygons.label(points, table.limit(0), "id").collect()} == {None}
    assert polygons.label(points.limit(0), table, "id").collect() == []
