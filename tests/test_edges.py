"""Corners of the semantics: gaps, nulls, ties, single values, changes of year."""

from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions import dates, stats
from tidemark.functions.places import is_unlocated, relabel
from tidemark.operators import monthly as buckets, panel as panels, ranking, reshape, wide
from tidemark.operators.scaling import min_max
from tidemark.operators.weekly import weekly_stats
from tidemark.plans import monthly
from tidemark.sources.wide_csv import read_wide


def long(spark, rows):
    return spark.createDataFrame(rows, "country string, date date, cum bigint")


def test_cumulative_fills_quiet_days(spark):
    counts = spark.createDataFrame(
        [("a", date(2020, 1, 3), 2), ("a", date(2020, 1, 5), 1), ("b", date(2020, 1, 1), 4)], "k string, date date, n int"
    )
    start, end = F.lit(date(2020, 1, 1)), F.lit(date(2020, 1, 6))
    rows = panels.cumulative(counts, ["k"], start, end).orderBy("k", "date").collect()
    assert [r.cum for r in rows if r.k == "a"] == [0, 0, 2, 2, 3, 3]
    assert [r.cum for r in rows if r.k == "b"] == [4] * 6
    assert [r.date.day for r in rows if r.k == "b"] == [1, 2, 3, 4, 5, 6]


def test_increases_add_up_to_the_difference_of_levels(spark):
    levels = [3, 3, 10, 12, 40]
    panel = long(spark, [("a", date(2020, 12, 30) + timedelta(i), v) for i, v in enumerate(levels)])
    assert panels.increase(panel, ["country"]).agg(F.sum("inc")).first()[0] == levels[-1] - levels[0]


def test_year_change_is_a_month_change(spark):
    panel = long(spark, [("a", date(2020, 12, 31), 62), ("a", date(2021, 1, 1), 70), ("a", date(2021, 1, 31), 93)])
    rows = monthly.mean(panel, ["country"]).orderBy("month").collect()
    assert [(r.month, r["mean"]) for r in rows] == [(date(2020, 12, 1), 62.0), (date(2021, 1, 1), 1.0)]


def test_same_month_of_two_years_stays_apart(spark):
    panel = long(spark, [("a", date(2020, 1, 31), 1), ("a", date(2021, 1, 31), 5)])
    assert buckets.month_ends(panel, ["country"]).count() == 2


def test_slope_of_one_value_is_zero(spark):
    df = spark.createDataFrame([("a", 0, 7)], "k string, x int, y int")
    assert df.groupBy("k").agg(stats.slope(F.col("x"), F.col("y")).alias("s")).first().s == 0.0
    two = long(spark, [("a", date(2020, 1, 1), 1), ("a", date(2020, 1, 2), 9)])
    assert two.groupBy("country").agg(stats.slope_of_increases(F.col("date"), F.col("cum")).alias("s")).first().s == 0.0


def test_slope_ignores_null_values_and_levels_with_gaps_have_none(spark):
    df = spark.createDataFrame([(0, 1), (1, None), (2, 5), (3, 7)], "x int, y int")
    assert df.agg(stats.slope(F.col("x"), F.col("y"))).first()[0] == pytest.approx(2.0)
    gap = long(spark, [("a", date(2020, 1, 1), 1), ("a", date(2020, 1, 2), None), ("a", date(2020, 1, 3), 9)])
    assert gap.agg(stats.slope_of_increases(F.col("date"), F.col("cum"))).first()[0] is None


def test_slopes_agree_with_least_squares(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows, expected = [], {}
    for place in range(20):
        levels = rng.integers(0, 50, 40).cumsum()
        rows += [(f"p{place}", date(2020, 1, 1) + timedelta(i), int(v)) for i, v in enumerate(levels)]
        expected[f"p{place}"] = np.polyfit(range(39), np.diff(levels), 1)[0]
    panel = long(spark, rows)
    closed = panel.groupBy("country").agg(stats.slope_of_increases(F.col("date"), F.col("cum")).alias("s"))
    direct = panels.increase(panel, ["country"]).groupBy("country").agg(
        stats.slope(dates.day_number(F.col("date")), F.col("inc")).alias("s")
    )
    closed, direct = ({r.country: r.s for r in df.collect()} for df in (closed, direct))
    assert closed == direct
    assert closed == pytest.approx(expected)


def test_ties_are_ranked_by_key_nulls_first(spark):
    df = spark.createDataFrame([("b", "x", 1), ("a", "y", 1), ("a", None, 1), ("c", "z", 2)], "c string, p string, v int")
    rows = ranking.top(df, "v", ["c", "p"], 3).orderBy("rank").collect()
    assert [(r.c, r.p) for r in rows] == [("c", "z"), ("a", None), ("a", "y")]


def test_constant_group_scales_to_zero(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 1.0), ("b", 3.0), ("b", 2.0)], "g string, v double")
    got = sorted((r.g, r.v, r.scaled) for r in min_max(df, "g", "v").collect())
    assert got == [("a", 2.0, 0.0), ("a", 2.0, 0.0), ("b", 1.0, 0.0), ("b", 2.0, 0.5), ("b", 3.0, 1.0)]


def test_weeks_start_on_the_first_day_and_the_last_may_be_short(spark):
    import numpy as np

    values = [5, 0, 3, 3, 9, 1, 2, 8, 4, 4]
    rows = [("a", date(2020, 1, 22) + timedelta(i), v) for i, v in enumerate(values)]
    daily = spark.createDataFrame(rows, "k string, date date, inc bigint")
    weeks = weekly_stats(daily, "k").orderBy("week").collect()
    assert [w.week for w in weeks] == [1, 2]
    for week, part in zip(weeks, (values[:7], values[7:])):
        got = (week["mean"], week["std"], week["max"], week["min"])
        assert got == pytest.approx((np.mean(part), np.std(part), max(part), min(part)))


def test_missing_day_leaves_a_wide_month_missing_but_not_a_long_one(spark, tmp_path):
    path = tmp_path / "gap.csv"
    path.write_text("Province/State,Country/Region,Lat,Long,1/30/20,1/31/20\n,A,,,4,\n")
    data = read_wide(spark, str(path))
    assert wide.level_mean(data, [], wide.split_columns(data)[1]).first()[0] is None
    panel = reshape.days_to_long(data.drop("Lat", "Long"), ["Province/State", "Country/Region"])
    row = buckets.level_mean(panel.withColumn("country", F.lit("A")), ["country"]).first()
    assert row.level_mean == 2.0


def test_day_series_rejects_gaps(spark):
    panel = long(spark, [("a", date(2020, 1, 1), 1), ("a", date(2020, 1, 3), 2)])
    with pytest.raises(PySparkException, match="misses a day"):
        reshape.day_series(panel, ["country"], date(2020, 1, 1), date(2020, 1, 3)).collect()


def test_headers_parse_alike_on_driver_and_executors(spark):
    names = ["1/22/20", "12/31/21", "2/29/00", "1/1/95", "6/7/69", "6/7/68"]
    df = spark.createDataFrame([(n,) for n in names], "h string")
    rows = df.select("h", dates.header_to_date(F.col("h")).alias("d"), dates.dashed_day(F.col("h")).alias("s")).collect()
    assert {r.h: r.d for r in rows} == {n: dates.parse_header(n) for n in names}
    assert dates.parse_header("1/1/95") == date(1995, 1, 1) and dates.parse_header("6/7/68") == date(2068, 6, 7)
    assert {r.h: r.s for r in rows}["1/22/20"] == "1-22-2020"
    assert all(dates.header_of(dates.parse_header(n)) == n for n in names)
    assert dates.parse_header("Lat") is None and dates.label_of(date(2020, 1, 1)) == "1/20"


def test_bucket_names_carry_their_days(spark):
    df = spark.createDataFrame([(date(2020, 2, 29),)], "d date").select(dates.bucket_header(F.col("d")).alias("b"))
    row = df.select("b", dates.bucket_days(F.col("b")).alias("n")).first()
    assert tuple(row) == ("2/29/20-29-days", 29)
    assert wide.bucket_name("2/29/20") == "2/29/20-29-days"


def test_unlocated_and_relabel(spark):
    rows = [(0.0, 0.0), (None, 1.0), (1.0, None), (float("nan"), 1.0), (0.0, 1.0), (2.0, 0.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    got = [r[0] for r in df.select(is_unlocated(F.col("lat"), F.col("lon"))).collect()]
    assert got == [True, True, True, True, False, False]
    names = spark.createDataFrame([("a",), ("b",), (None,)], "n string")
    assert [r[0] for r in names.select(relabel(F.col("n"), {"a": "b"})).collect()] == ["b", "b", None]


def test_calendar_is_numbered_and_whole(spark):
    bounds = spark.createDataFrame([(date(2020, 1, 22), date(2021, 11, 17))], "start date, end date")
    days = panels.calendar(bounds).orderBy("idx").collect()
    assert len(days) == 666 and tuple(days[0]) == (0, date(2020, 1, 22)) and days[-1].date == date(2021, 11, 17)
    assert len(dates.months_between(date(2020, 1, 22), date(2021, 11, 17))) == 23


def test_calendar_crosses_clock_changes(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        bounds = spark.createDataFrame([(date(2020, 1, 22), date(2021, 11, 17))], "start date, end date")
        assert panels.calendar(bounds).select("date").distinct().count() == 666
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
