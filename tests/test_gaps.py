"""Ragged, gappy and large input: filled, read exactly or an error, never passed over."""

import math
from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import workload
from tidemark.functions import stats
from tidemark.functions.places import PLACE
from tidemark.operators import joins, monthly as buckets, panel as panels
from tidemark.operators.hull import convex_hull
from tidemark.plans import monthly, trends
from tidemark.sources import tables
from tidemark.sources.wide_csv import read_wide

FAILS = (PySparkException, Py4JJavaError)
HEAD = "Province/State,Country/Region,Lat,Long,1/30/20,1/31/20\n"


def wide(spark, tmp_path, *files):
    for i, text in enumerate(files):
        (tmp_path / f"part-{i}.csv").write_text(text)
    return read_wide(spark, str(tmp_path))


def test_whole_numbers_with_a_fraction_of_zero_are_read(spark, tmp_path):
    row = wide(spark, tmp_path, HEAD + ",A,1,2,3.0,\n").first()
    assert (row["1/30/20"], row["1/31/20"]) == (3, None)


def test_a_cell_that_is_no_number_is_an_error(spark, tmp_path):
    with pytest.raises(FAILS):
        wide(spark, tmp_path, HEAD + ",A,1,2,many,4\n").collect()


def test_a_fraction_is_rounded(spark, tmp_path):
    assert wide(spark, tmp_path, HEAD + ",A,1,2,3.6,4\n").first()["1/30/20"] == 4


def test_a_thousands_separator_is_read_or_an_error(spark, tmp_path):
    try:
        rows = wide(spark, tmp_path, HEAD + ',A,1,2,"1,200",4\n').collect()
    except FAILS:
        return
    assert rows[0]["1/30/20"] == 1200


def test_a_part_file_in_another_order_is_an_error(spark, tmp_path):
    turned = HEAD.replace("1/30/20,1/31/20", "1/31/20,1/30/20")
    with pytest.raises(FAILS):
        wide(spark, tmp_path, HEAD + ",A,1,2,1,2\n", turned + ",B,1,2,30,10\n").collect()


def test_years_of_four_digits(spark, tmp_path):
    data = wide(spark, tmp_path, HEAD.replace("/20", "/2020") + ",A,1,2,7,8\n")
    assert data.dtypes[-2:] == [("1/30/2020", "bigint"), ("1/31/2020", "bigint")]


def test_places_that_stop_within_a_month_stay_in_its_sum(spark):
    rows = [("A", "x", date(2020, 1, 31), 10), ("A", "y", date(2020, 1, 31), 5), ("A", "x", date(2020, 2, 29), 39), ("A", "y", date(2020, 2, 28), 34)]
    panel = spark.createDataFrame(rows, "country string, province string, date date, cum bigint")
    got = [tuple(r) for r in monthly.mean_by_country(panel, ["country", "province"]).orderBy("month").select("mean").collect()]
    assert got == [(15.0,), ((73 - 15) / 29,)]


def test_a_missing_day_or_month_is_an_error(spark):
    days = spark.createDataFrame([("A", date(2020, 1, 1), 1), ("A", date(2020, 1, 5), 9)], "country string, date date, cum bigint")
    with pytest.raises(PySparkException, match="no level on the day after 2020-01-01"):
        panels.increase(days, ["country"]).collect()
    ends = spark.createDataFrame([("A", date(2020, 1, 31), 1), ("A", date(2020, 3, 31), 9)], "country string, date date, cum bigint")
    with pytest.raises(PySparkException, match="no level in the month before 2020-03-01"):
        buckets.change(buckets.month_ends(ends, ["country"]), ["country"]).collect()


def test_large_values_do_not_overflow(spark):
    values = [4_000_000_000, 4_000_000_001, 9_000_000_000]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "x bigint, y bigint")
    std, slope = table.agg(stats.std_pop(F.col("y")), stats.slope(F.col("y"), F.col("y"))).first()
    mean = sum(values) / 3
    assert std == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / 3), rel=1e-12) and slope == 1.0


def test_slopes_of_sparse_counts_are_those_of_the_panel(spark):
    rows = [("a", date(2020, 1, 1), 4), ("a", date(2020, 1, 5), 2), ("b", date(2020, 1, 1), 3), ("c", date(2020, 1, 9), 1)]
    counts = spark.createDataFrame(rows, "k string, date date, n bigint")
    start, end = F.lit(date(2020, 1, 1)), F.lit(date(2020, 1, 10))
    dense = trends.daily_slopes(panels.cumulative(counts, ["k"], start, end), ["k"]).orderBy("k").collect()
    assert trends.slopes_of_counts(counts, ["k"], start, end).orderBy("k").collect() == dense


def test_event_slopes_stretch_nothing(spark, root):
    plan = workload.event_trend_top100(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Window") <= 1


def test_hulls_of_many_groups_without_nan(spark):
    points = spark.range(40_000).selectExpr("id % 2000 g", "cast(id % 7 as double) x", "cast(id % 5 as double) y")
    points = points.union(spark.createDataFrame([(0, float("nan"), 0.0), (0, None, 1.0)], "g long, x double, y double"))
    got = convex_hull(points, ["g"], "x", "y").where("g = 0").orderBy("vertex").collect()
    assert len({r.g for r in convex_hull(points, ["g"], "x", "y").collect()}) == 2000
    assert (got[0].x, got[0].y) == min((float(i % 7), float(i % 5)) for i in range(0, 40_000, 2000))


def test_unmatched_rows_on_both_sides(spark, root):
    places = tables.place_locations(spark, root).where("lat >= 0")
    last = panels.on_last_day(tables.order_panel(spark, root)).where("cum % 3 > 0")
    for join in (joins.outer, joins.outer_split):
        rows = join(places, last, PLACE).collect()
        assert any(r.lat is None for r in rows) and any(r.cum is None for r in rows)
    assert any(r.event_id is None for r in workload.outer_join_users(spark, root).collect())


def test_day_range_reads_the_raw_column(spark, root):
    assert tables.order_range(spark, root).first().start <= tables.order_range(spark, root).first().end
