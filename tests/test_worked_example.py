"""Three places, five days, every expected number worked out by hand."""

from datetime import date
from math import sqrt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.places import COUNTRY, PLACE, PROVINCE
from tidemark.functions.regions import continent
from tidemark.operators import joins, monthly as buckets, panel as panels, ranking, reshape, wide
from tidemark.operators.weekly import weekly_stats
from tidemark.plans import monthly, trends
from tidemark.sources.wide_csv import preview, read_wide, write_csv

JAN, FEB = date(2020, 1, 1), date(2020, 2, 1)


def pairs(df, *columns):
    return {tuple(row)[:-1] if len(columns) > 2 else row[0]: row[-1] for row in df.select(*columns).collect()}


def test_read_wide_types_and_index(spark, wide_file):
    data = read_wide(spark, wide_file)
    assert dict(data.dtypes) == {
        "Province/State": "string", "Country/Region": "string", "Lat": "double", "Long": "double",
        "1/30/20": "bigint", "1/31/20": "bigint", "2/1/20": "bigint", "2/2/20": "bigint", "2/3/20": "bigint",
    }
    assert data.count() == 3
    assert preview(data, 2).count() == 2
    headers, days = wide.split_columns(data)
    assert headers == ["Province/State", "Country/Region", "Lat", "Long"]
    assert wide.month_ends(days) == ["1/31/20", "2/3/20"]
    assert wide.columns_like(data, "/31/") == ["1/31/20"]
    assert wide.last_to_front(data, 2).columns[:3] == ["2/2/20", "2/3/20", "Province/State"]


def test_long_panel(panel):
    assert panel.count() == 15
    row = panel.where("country = 'A' AND date = DATE'2020-02-01'").first()
    assert (row.province, row.lat, row.lon, row.cum) == (None, 10.0, 20.0, 6)


def test_monthly_mean_by_country(panel):
    got = pairs(monthly.mean_by_country(panel, PLACE), "country", "month", "mean")
    assert got == {("A", JAN): 3.0, ("A", FEB): 4.0, ("B", JAN): 5.0, ("B", FEB): 2.0}


def test_monthly_mean_by_country_wide(spark, wide_file, tmp_path):
    means = monthly.mean_by_country_wide(read_wide(spark, wide_file))
    assert means.columns == ["Country/Region", "1/31/20-31-days", "2/3/20-3-days"]
    write_csv(means, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True)
    assert sorted(map(tuple, back.collect())) == [("A", "3.0", "4.0"), ("B", "5.0", "2.0")]


def test_monthly_increase_by_place(spark, wide_file, panel):
    got = pairs(monthly.increase(panel, PLACE), "country", "province", "month", "increase")
    expected = {("A", None): (3, 12), ("B", "X"): (0, 5), ("B", "Y"): (5, 1)}
    assert got == {(*place, m): v for place, both in expected.items() for m, v in zip((JAN, FEB), both)}
    data = read_wide(spark, wide_file)
    rows = wide.monthly_increase(data, [COUNTRY, PROVINCE], wide.split_columns(data)[1]).collect()
    assert {tuple(r)[:2]: tuple(r)[2:] for r in rows} == expected


def test_level_mean(spark, wide_file, panel):
    got = pairs(buckets.level_mean(panel, ["country"]).where("country = 'A'"), "month", "level_mean")
    assert got == {JAN: 2.0, FEB: 31 / 3}
    data = read_wide(spark, wide_file)
    row = wide.level_mean(data, [COUNTRY], wide.split_columns(data)[1]).where(wide.col(COUNTRY) == "A").first()
    assert tuple(row) == ("A", 2.0, 31 / 3)
    assert [r.month for r in buckets.months(panel).collect()] == [JAN, FEB]


def test_daily_increase(spark, wide_file, panel):
    expected = {"A": [2, 3, 4, 5], "X": [0, 2, 0, 3], "Y": [0, 0, 1, 0]}
    rows = panels.increase(panel, PLACE).orderBy("date").collect()
    assert {r.date for r in rows} == {date(2020, 1, 30), date(2020, 1, 31), date(2020, 2, 1), date(2020, 2, 2)}
    assert {k: [r.inc for r in rows if (r.province or r.country) == k] for k in expected} == expected
    data = read_wide(spark, wide_file)
    headers, days = wide.split_columns(data)
    rows = wide.daily_increase(data, headers, days).collect()
    assert {r[0] or r[1]: list(r)[4:] for r in rows} == expected


def test_slopes_and_rank(spark, wide_file, panel):
    top = trends.steepest_daily(panel, PLACE, 3).orderBy("rank").collect()
    assert [(r.country, r.province, r.rank) for r in top] == [("A", None, 0), ("B", "X", 1), ("B", "Y", 2)]
    assert [r.slope for r in top] == pytest.approx([1.0, 0.7, 0.1])
    data = read_wide(spark, wide_file)
    headers, days = wide.split_columns(data)
    increases = wide.daily_increase(data, headers, days).select(wide.col(COUNTRY), wide.slope(days[:-1]).alias("s"))
    assert sorted(r.s for r in increases.collect()) == pytest.approx([0.1, 0.7, 1.0])


def test_continents(panel):
    rows = panel.select("country", "province", continent("lat", "lon").alias("c")).distinct().collect()
    assert {(r.country, r.province): r.c for r in rows} == {
        ("A", None): "Africa", ("B", "X"): "Not applicable", ("B", "Y"): "Europe"
    }


def test_continent_totals_and_weeks(panel):
    locations = panel.select(*PLACE, "lat", "lon").distinct()
    levels = panel.select(*PLACE, "date", "cum")
    daily = trends.continent_daily(levels, locations, PLACE)
    assert daily.where("continent = 'Africa'").agg(F.sum("inc")).first()[0] == 14
    assert {r.continent for r in trends.continent_daily(levels, locations, PLACE, k=2).collect()} == {
        "Africa", "Not applicable"
    }
    week = weekly_stats(daily, "continent").where("continent = 'Africa'").first()
    assert (week.week, week["mean"], week["max"], week["min"]) == (1, 3.5, 5, 2)
    assert week["std"] == pytest.approx(sqrt(1.25))


def test_wide_shapes(spark, panel):
    means = monthly.mean_by_country(panel, PLACE)
    table = reshape.to_wide(means, ["country"], "month", [JAN, FEB], "mean")
    assert sorted(map(tuple, table.collect())) == [("A", 3.0, 4.0), ("B", 5.0, 2.0)]
    turned = reshape.transpose(table, "country", "month", ["A", "B"])
    assert sorted(map(tuple, turned.collect())) == [("2020-01-01", 3.0, 5.0), ("2020-02-01", 4.0, 2.0)]
    series = reshape.day_series(panel, PLACE, date(2020, 1, 30), date(2020, 2, 3))
    days = reshape.days_to_wide(series, date(2020, 1, 30), date(2020, 2, 3))
    again = reshape.days_to_long(days, list(PLACE))
    assert again.exceptAll(panel.select(*PLACE, "date", "cum")).isEmpty() and again.count() == 15


def test_outer_join_matches_missing_provinces(spark):
    left = spark.createDataFrame([("A", None, 1), ("B", "X", 2)], "country string, province string, l int")
    right = spark.createDataFrame([("A", None, 3), ("C", None, 4)], "country string, province string, r int")
    got = {tuple(r) for r in joins.outer(left, right, PLACE).collect()}
    assert got == {("A", None, 1, 3), ("B", "X", 2, None), ("C", None, None, 4)}
    assert {tuple(r) for r in joins.inner(left, right, PLACE).collect()} == {("A", None, 1, 3)}
    assert {tuple(r) for r in joins.keep(left, right, PLACE).collect()} == {("A", None, 1)}


def test_most_and_least(panel):
    totals = panels.sum_by(panels.on_last_day(panel), ["country"])
    rows = monthly.most_and_least(totals, "country", "cum", 1).collect()
    assert {(r.side, r.country, r.cum) for r in rows} == {("most", "A", 15), ("least", "B", 11)}
    both = ranking.top(totals, "cum", ["country"], 5)
    assert both.count() == 2
