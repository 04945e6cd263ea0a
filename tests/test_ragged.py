"""Totals of places that skip months, and outer joins on a key that dominates."""

import random
from datetime import date, timedelta

import pytest

from tidemark.functions.dates import header_to_date, parse_header
from tidemark.operators import joins, reshape
from tidemark.plans import monthly
from pyspark.sql import functions as F


def by_hand(rows):
    """Means per country, each place's last level looked up at every month-end."""
    found = {}
    for country in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == country]
        first, last = min(r[2] for r in own), max(r[2] for r in own)
        months = [(m // 12, m % 12 + 1) for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]
        before = None
        for year, month in months:
            total = 0
            for place in {r[1] for r in own}:
                levels = [(r[2], r[3]) for r in own if r[1] == place and (r[2].year, r[2].month) <= (year, month)]
                total += max(levels)[1] if levels else 0
            days = max([r[2].day for r in own if (r[2].year, r[2].month) == (year, month)], default=1)
            found[country, date(year, month, 1)] = float(total) if before is None else (total - before) / days
            before = total
    return found


def panel_of(spark, rows):
    return spark.createDataFrame(rows, "country string, province string, date date, cum long")


def test_a_place_that_skips_a_month_keeps_its_level(spark):
    rows = [("X", "A", date(2020, m, d), c) for m, d, c in ((1, 31, 10), (2, 29, 20), (3, 31, 30))]
    rows += [("X", "B", date(2020, 1, 31), 1000), ("X", "B", date(2020, 3, 31), 1000)]
    got = {r.month: r["mean"] for r in monthly.mean_by_country(panel_of(spark, rows), ["country", "province"]).collect()}
    assert got == {date(2020, 1, 1): 1010.0, date(2020, 2, 1): 10 / 29, date(2020, 3, 1): 10 / 31}


def test_ragged_panels(spark):
    rng = random.Random(9)
    rows = []
    for country in "XYZ":
        for place in [None, "a", "b", "c", "d"]:
            level = 0
            for n in sorted(rng.sample(range(900), rng.choice([1, 3, 8, 40]))):
                level += rng.randint(0, 50)
                rows.append((country, place, date(2019, 11, 5) + timedelta(days=n), level))
    got = monthly.mean_by_country(panel_of(spark, rows), ["country", "province"]).collect()
    assert {(r.country, r.month): r["mean"] for r in got} == pytest.approx(by_hand(rows))
    assert len(got) == len(by_hand(rows))


@pytest.mark.parametrize("most", [1_000_000, 40, 7])
def test_outer_join_of_dominant_keys(spark, most):
    rng = random.Random(most)
    left = [(rng.choice([None, None, None, 1, *range(2, 60)]), rng.choice([None, "u"]), i % 90) for i in range(300)]
    right = [(rng.choice([None, 1, 1, *range(30, 90)]), rng.choice([None, "u"]), str(i % 50)) for i in range(120)]
    a = spark.createDataFrame(left, "k long, g string, x long").repartition(5)
    b = spark.createDataFrame(right, "k long, g string, y string").repartition(3)
    plain = joins.outer(a, b, ["k", "g"])
    split = joins.outer_split(a, b, ["k", "g"], most=most)
    assert split.columns == plain.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    assert joins.outer_split(a.limit(0), b, ["k", "g"]).count() == 120 and joins.outer_split(a, b.limit(0), ["k", "g"]).count() == 300


def test_a_third_of_all_rows_on_one_key_is_dealt_to_many_tasks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("-1", "false", "32")):
        spark.conf.set(k, v)
    try:
        a = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("x"))
        b = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("y"))
        b = b.union(spark.createDataFrame([(None, -1)], "k long, y long"))
        sizes = {}
        for join in (joins.outer, lambda *x: joins.outer_split(*x, most=500)):
            tasks = join(a, b, ["k"]).groupBy(F.spark_partition_id().alias("task")).count()
            sizes[join] = [r["count"] for r in tasks.collect()]
        whole, split = sizes.values()
        assert sum(whole) == sum(split) and max(whole) >= 10_000 and max(split) < 2_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_years_of_two_and_four_digits(spark):
    names = ["1/22/20", "1/22/2020", "12/31/99", "2/29/2000", "7/4/1776", "1/1/69"]
    parsed = spark.createDataFrame([(n,) for n in names], "h string").select("h", header_to_date(F.col("h")).alias("day")).collect()
    assert {r.h: r.day for r in parsed} == {n: parse_header(n) for n in names}
    with pytest.raises(ValueError, match="2/30/20"):
        parse_header("2/30/20")


def test_too_many_labels_for_columns(spark):
    assert reshape.labels_of(spark.range(5).select((F.col("id") % 3).alias("x")), F.col("x")) == [0, 1, 2]
    with pytest.raises(ValueError, match="more than 10 values"):
        reshape.labels_of(spark.range(11), F.col("id"), most=10)
