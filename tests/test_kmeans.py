"""k-means with the phantom member, against plain Python."""

import random
from math import floor

import pytest
from pyspark.errors import PySparkException

from tidemark.operators import kmeans


def reference_labels(values, ranks):
    low, high = min(values), max(values)
    scaled = [0.0 if high == low else (v - low) / (high - low) for v in values]
    steps = [floor(s * 1e12 + 0.5) for s in scaled]
    ys = [s / 1e12 for s in steps]
    centroids, mean = [ys[r] for r in ranks], None

    def nearest(y):
        return min(centroids, key=lambda c: abs(c - y))

    while True:
        near = [nearest(y) for y in ys]
        moved = []
        for c in centroids:
            members = [s for s, a in zip(steps, near) if a == c]
            moved.append(sum(members) / 1e12 / (len(members) + 1))
        centroids, before = moved, mean
        mean = sum(moved) / len(moved)
        if mean == before:
            break
    near = [nearest(y) for y in ys]
    used = sorted(set(near))
    return [used.index(c) for c in near]


def points_of(spark, groups):
    rows = [(g, r, float(v)) for g, values in groups.items() for r, v in enumerate(values)]
    return kmeans.grid_points(spark.createDataFrame(rows, "g int, rank int, v double"), "g", "v")


def by_group(groups, df):
    found = df.orderBy("g", "rank").collect()
    return {g: [r.cluster for r in found if r.g == g] for g in groups}


def clustered(spark, groups, ranks, **options):
    points = points_of(spark, groups)
    return by_group(groups, kmeans.labels(points, kmeans.fit(points, "g", ranks, **options), "g"))


def test_worked_example(spark):
    points = spark.createDataFrame([(0, 0, 0.0), (0, 1, 0.2), (0, 2, 0.9), (0, 3, 1.0)], "g int, rank int, v double")
    points = kmeans.grid_points(points, "g", "v")
    state = kmeans.fit(points, "g", (0, 3))
    assert state.first().centroids == pytest.approx([0.2 / 3, 1.9 / 3])
    labels = kmeans.labels(points, state, "g").orderBy("rank").collect()
    assert [r.cluster for r in labels] == [0, 0, 1, 1]


def test_draws():
    assert kmeans.start_ranks(50) == (13, 39, 30, 45)
    assert kmeans.start_ranks(46) == (39, 25, 26, 44) and kmeans.start_ranks(49) == (13, 45, 47, 44)
    assert sorted(kmeans.start_ranks(4)) == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="at least 4 points"):
        kmeans.start_ranks(3)


def test_random_groups(spark):
    rng = random.Random(2)
    ranks = kmeans.start_ranks(50)
    groups = {g: [rng.choice([rng.random(), rng.randint(0, 4)]) * 30 for _ in range(50)] for g in range(12)}
    groups[12] = [7.0] * 50
    groups[13] = [0.0] * 49 + [1.0]
    got = clustered(spark, groups, ranks)
    assert got == {g: reference_labels(v, ranks) for g, v in groups.items()}
    assert got[12] == [0] * 50


@pytest.mark.parametrize("places", [4, 20, 45, 46, 300])
def test_any_number_of_places(spark, places):
    rng = random.Random(places)
    groups = {g: [rng.random() for _ in range(places)] for g in range(3)}
    got = by_group(groups, kmeans.cluster(points_of(spark, groups), "g"))
    assert got == {g: reference_labels(v, kmeans.start_ranks(places)) for g, v in groups.items()}


def test_a_group_without_a_starting_point_is_an_error(spark):
    groups = {0: [float(i) for i in range(50)], 1: [1.0, 2.0, 5.0]}
    with pytest.raises(PySparkException, match="starting rank"):
        kmeans.cluster(points_of(spark, groups), "g").collect()
    with pytest.raises(ValueError):
        kmeans.cluster(points_of(spark, {0: [1.0, 2.0]}), "g")


def test_rounds_per_write_do_not_matter(spark):
    rng = random.Random(4)
    groups = {g: [rng.random() for _ in range(20)] for g in range(4)}
    once = clustered(spark, groups, (3, 9, 15), rounds_per_write=1)
    assert once == clustered(spark, groups, (3, 9, 15), rounds_per_write=7)
    assert once == {g: reference_labels(v, (3, 9, 15)) for g, v in groups.items()}


def test_centroids_that_have_been_there_are_done(spark):
    """A group whose centroids are back where they were ends there."""
    points = points_of(spark, {0: [0.0, 0.2, 0.9, 1.0]})
    state = kmeans.start(points, "g", (0, 3))
    once = kmeans.update(points, state, "g", 2)
    assert not once.first().done and len(once.first().seen) == 2
    back = state.withColumn("seen", kmeans.F.array(kmeans.F.lit(once.select(kmeans.F.xxhash64("centroids")).first()[0])))
    assert kmeans.update(points, back, "g", 2).first().done


def test_ties_go_to_the_first_centroid(spark):
    df = spark.createDataFrame([(0.5, [1.0, 0.0]), (0.5, [0.0, 1.0])], "y double, c array<double>")
    assert [r[0] for r in df.select(kmeans.nearest("y", "c")).collect()] == [1.0, 0.0]


def by_updates(points, ranks):
    """Centroids by plain rounds over all points."""
    state = kmeans.start(points, "g", ranks)
    while not state.where("NOT done").isEmpty():
        state = kmeans.settle(kmeans.update(points, state, "g", len(ranks)), "plain")
    return sorted((r.g, r.centroids, r.mean, r.seen) for r in state.collect())


@pytest.mark.parametrize("block, rounds", [(1, 1_000), (7, 3), (64, 1_000), (4_096, 2)])
def test_blocks_do_not_matter(spark, monkeypatch, block, rounds):
    """Blocks of sorted values, however long, give every round of the plain aggregate, hashes of the way included."""
    rng = random.Random(block)
    groups = {g: [rng.choice([rng.random() ** 3, rng.randint(0, 9) / 9]) for _ in range(150)] for g in range(3)}
    points = kmeans.settle(points_of(spark, groups), "points")
    ranks = kmeans.start_ranks(150)
    monkeypatch.setattr(kmeans, "BLOCK", block)
    fitted = kmeans.fit(points, "g", ranks, rounds)
    assert sorted((r.g, r.centroids, r.mean, r.seen) for r in fitted.collect()) == by_updates(points, ranks)


def test_close_centroids_take_their_round_over_all_points(spark, monkeypatch):
    """Starting centroids one step of the grid apart, the later one first; ties by rounding stay what they were."""
    values = [0.0, 0.5 + 1e-12, 0.5, 1.0, *(i / 97 for i in range(97))]
    points = kmeans.settle(points_of(spark, {0: values}), "points")
    monkeypatch.setattr(kmeans, "BLOCK", 8)
    fitted = kmeans.fit(points, "g", (1, 2, 3, 0))
    assert sorted((r.g, r.centroids, r.mean, r.seen) for r in fitted.collect()) == by_updates(points, (1, 2, 3, 0))


def test_a_task_sees_totals_and_few_values(spark):
    """20,000 values of one group reach the rounds as totals and the blocks between clusters."""
    df = spark.range(20_000).selectExpr("0 AS g", "CAST(id AS INT) AS rank", "CAST(id * id AS DOUBLE) AS v")
    points = kmeans.settle(kmeans.grid_points(df, "g", "v"), "points")
    values, totals = kmeans.stretches(points, "g")
    assert values.count() == 20_000 and 5 <= totals.count() <= 20
    assert values.agg(kmeans.F.sum("n"), kmeans.F.sum("low")).first() == totals.agg(kmeans.F.sum("n"), kmeans.F.sum("low")).first()
    assert values.groupBy("g", "block").count().agg(kmeans.F.max("count")).first()[0] <= kmeans.BLOCK
