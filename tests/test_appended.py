"""Days that come in batches give what all days together give."""

import random
from datetime import date, timedelta

import pytest

from tidemark.operators import panel as panels
from tidemark.plans import appended, trends

KEYS = ["country", "province"]
SCHEMA = "country string, province string, date date, cum long, days string, total int"
START = date(2020, 1, 1)


def rows_of(place, days, seed, since=0):
    level, rng, rows = 0, random.Random(seed), []
    for i in range(since, days):
        level += rng.randrange(10**9)
        rows.append((*place, START + timedelta(i), level, "side", 0))
    return rows


@pytest.fixture(scope="module")
def table(spark):
    # the last place begins within the second batch, the one before it ends within the first
    places = [(("A", None), 40, 0), (("A", "x"), 40, 0), ((None, None), 40, 0), (("B", "y"), 9, 0), (("B", "z"), 40, 17)]
    rows = [r for n, (place, days, since) in enumerate(places) for r in rows_of(place, days, n, since)]
    return spark.createDataFrame(rows, SCHEMA)


def batches(table, ends):
    days = [START + timedelta(e) for e in (0, *ends)]
    return [table.where((table.date >= a) & (table.date < b)) for a, b in zip(days, days[1:])]


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("ends", [(10, 20, 40), (1, 39, 40), (40,), (20, 20, 40)])
def test_two_appends_are_one_run(spark, table, ends):
    first, *others = batches(table, ends)
    state, found = appended.known(first, KEYS), panels.increase(first.select(*KEYS, "date", "cum"), KEYS)
    for later in others:
        found = found.unionByName(appended.increases(state, later, KEYS))
        state = appended.merged(state, appended.known(later, KEYS), KEYS)
    assert key(state.collect()) == key(appended.known(table, KEYS).collect())
    assert key(appended.slopes(state, KEYS).collect()) == key(trends.daily_slopes(table, KEYS).collect())
    assert key(found.collect()) == key(panels.increase(table, KEYS).collect())


def test_a_batch_given_twice_is_an_error(table):
    first, later = (appended.known(b, KEYS) for b in batches(table, (20, 40)))
    twice = appended.merged(appended.merged(first, later, KEYS), later, KEYS)
    with pytest.raises(Exception, match="after those known"):
        twice.collect()


def test_a_skipped_day_is_an_error(spark):
    rows = [("A", "x", START + timedelta(i), i, "", 0) for i in (0, 1, 3)]
    table = spark.createDataFrame(rows, SCHEMA)
    first, later = batches(table, (2, 4))
    state = appended.merged(appended.known(first, KEYS), appended.known(later, KEYS), KEYS)
    with pytest.raises(Exception, match="days missing"):
        appended.slopes(state, KEYS).collect()
    with pytest.raises(Exception, match="no level on the day after"):
        appended.increases(appended.known(first, KEYS), later, KEYS).collect()


def test_nothing_and_a_missing_level(spark, table):
    none = appended.known(table.limit(0), KEYS)
    state = appended.known(table, KEYS)
    assert none.collect() == []
    assert key(appended.merged(none, state, KEYS).collect()) == key(appended.merged(state, none, KEYS).collect()) == key(state.collect())
    rows = [("A", "x", START, 1, "", 0), ("A", "x", START + timedelta(1), None, "", 0), ("A", "x", START + timedelta(2), 2, "", 0)]
    holed = spark.createDataFrame(rows, SCHEMA)
    assert appended.slopes(appended.known(holed, KEYS), KEYS).first().slope is None
