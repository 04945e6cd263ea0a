"""One-dimensional k-means in many groups at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import kmeans_rounds
from tidemark.operators.scaling import min_max
from tidemark.session import discard, settle

SEED = 42
CLUSTERS = 4
BLOCK = 4_096  # distinct values of a block of the sorted order, at most
STEPS = 10**12  # points lie on a grid of 1/STEPS, so that sums of points are exact


def start_ranks(points: int, k: int = CLUSTERS) -> tuple[int, ...]:
    """Ranks (from 0) of the points that start the clusters: the seeded draw from so many points."""
    if points < k:
        raise ValueError(f"{k} clusters need at least {k} points, not {points}")
    return tuple(np.random.RandomState(SEED).permutation(points)[:k].tolist())


def grid_points(df: DataFrame, group: str, value: str) -> DataFrame:
    """Add ``y``: the value scaled to 0..1 within its group, on the grid."""
    steps = F.floor(F.col("scaled") * float(STEPS) + 0.5).cast("bigint")
    scaled = min_max(df, group, value).withColumn("steps", steps)
    return scaled.withColumn("y", F.col("steps").cast("double") / float(STEPS))


def _nearest(y: str, centroids: str) -> str:
    return f"array_min(transform({centroids}, (c, i) -> struct(abs(c - {y}) AS distance, i AS i, c AS c))).c"


def nearest(y: str, centroids: str) -> Column:
    """Value of the nearest centroid, the first one on a tie."""
    return F.expr(_nearest(y, centroids))


def start(points: DataFrame, group: str, ranks: Sequence[int]) -> DataFrame:
    """Centroids of each group: its points of the given ranks, in that order. A group that lacks one is an error."""
    at = [F.max(F.when(F.col("rank") == r, F.col("y"))) for r in ranks]
    lacking = F.raise_error(F.concat(F.lit("no point of every starting rank in "), F.col(group).cast("string")))
    whole = F.when(F.exists("found", F.isnull), lacking.cast("array<double>")).otherwise(F.col("found"))
    return points.groupBy(group).agg(F.array(*at).alias("found")).select(
        group,
        whole.alias("centroids"),
        F.lit(None).cast("double").alias("mean"),
        F.lit(False).alias("done"),
        F.array(F.xxhash64("found")).alias("seen"),
    )


def update(points: DataFrame, state: DataFrame, group: str, k: int) -> DataFrame:
    """One round for all groups: an aggregate that combines before its shuffle.

    A centroid moves to sum / (members + 1), as if each cluster had one more
    member at 0; one without members moves to 0. Centroids of equal value share
    their members. A group is done once the mean of its centroids stays, or
    once its centroids are where they have been before: they would go round for ever.
    """
    near = points.select(group, "steps", "y").join(state, group)
    near = near.withColumn("near", nearest("y", "centroids"))
    moved = [
        f"CAST(sum(CAST(IF(near = centroids[{i}], steps, 0) AS DECIMAL(18, 0))) AS DOUBLE) / {float(STEPS)}D"
        f" / (count_if(near = centroids[{i}]) + 1)"
        for i in range(k)
    ]
    before = F.first(F.struct("centroids", "mean", "done", "seen")).alias("before")
    rounds = near.groupBy(group).agg(before, F.expr(f"array({', '.join(moved)})").alias("moved"))
    level = f"({' + '.join(f'moved[{i}]' for i in range(k))}) / {k}"
    return rounds.selectExpr(
        f"`{group}`",
        "IF(before.done, before.centroids, moved) AS centroids",
        f"IF(before.done, before.mean, {level}) AS mean",
        f"before.done OR coalesce(before.mean = {level}, false) OR array_contains(before.seen, xxhash64(moved)) AS done",
        "IF(before.done, before.seen, array_append(before.seen, xxhash64(moved))) AS seen",
    )


def stretches(points: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """Distinct values of every group in blocks of the sorted order, and the totals of the blocks.

    ``values`` has ``first`` = ``last`` = the steps of one value, ``n`` points, and the sum of their steps in a ``high``
    and a ``low`` part; ``totals`` has the same of each block. No task sees a whole group. Points without a value are left out.
    """
    half = 1 << kmeans_rounds.LOW_BITS
    counted = points.where(F.col("steps").isNotNull()).groupBy(group, "steps").agg(F.count("*").alias("n"))
    placed = counted.orderBy(group, "steps").select(
        group,
        F.expr(f"monotonically_increasing_id() div {BLOCK}").alias("block"),
        F.col("steps").alias("first"),
        F.col("steps").alias("last"),
        "n",
        F.expr(f"steps div {half} * n").alias("high"),
        F.expr(f"steps % {half} * n").alias("low"),
    )
    values = settle(placed, "values")
    sums = [F.sum(c).alias(c) for c in ("n", "high", "low")]
    totals = values.groupBy(group, "block").agg(F.min("first").alias("first"), F.max("last").alias("last"), *sums)
    return values, settle(totals, "totals")


def step(values: DataFrame, totals: DataFrame, state: DataFrame, group: str, rounds: int) -> DataFrame:
    """As many rounds for each group as end within the blocks that part its clusters now, at least one.

    A task holds the totals of a group and the single values of those few blocks, never its points.
    """
    steps = STEPS
    held = totals.join(state.where(~F.col("done")).select(group, "centroids"), group)
    ends = [nearest(f"({end} / {float(STEPS)}D)", "centroids") for end in ("first", "last")]
    held = held.withColumn("whole", ends[0] == ends[1])
    cut = held.where(~F.col("whole")).select(group, "block")
    parts = held.where("whole").select(*values.columns).unionByName(values.join(cut, [group, "block"]))
    return (
        parts.groupBy(group).cogroup(state.groupBy(group))
        .applyInArrow(lambda a, b: kmeans_rounds.advance(a, b, rounds, steps), state.schema)
    )


def fit(points: DataFrame, group: str, ranks: Sequence[int], rounds_per_write: int = 1_000) -> DataFrame:
    """Final centroids of every group (``centroids``, one row per group), whatever its length.

    Clusters are stretches of the sorted values, so a round only asks which blocks of values lie between two
    clusters: all other blocks count by their totals. Rounds go on in one task per group until a cluster ends in a
    block that is not open there, or for ``rounds_per_write``; then the state, k numbers per group and a hash
    per round, is written to the shared folder. Groups with centroids so close that rounding may decide
    between them take that round over all points. ``points`` should be a written table.
    """
    values, totals = stretches(points, group)
    state = settle(start(points, group, ranks), "kmeans")
    gap = "array_sort(centroids)"
    gaps = F.expr(f"zip_with(slice({gap}, 2, {len(ranks) - 1}), slice({gap}, 1, {len(ranks) - 1}), (b, a) -> b - a)")
    close = F.exists(gaps, lambda x: (x > 0) & (x < kmeans_rounds.CLOSE)) & ~F.col("done")
    while True:
        left = state.agg(F.count_if(~F.col("done")), F.count_if(close)).first()
        if not left[0]:
            break
        after = step(values, totals, state.where(~close), group, rounds_per_write)
        if left[1]:
            after = after.unionByName(update(points, state.where(close), group, len(ranks)))
        before, state = state, settle(after, "kmeans")
        discard(before)
    for table in (values, totals):
        discard(table)
    return state


def labels(points: DataFrame, state: DataFrame, group: str) -> DataFrame:
    """Cluster of every point: the rank of its centroid among those in use, lowest first."""
    near = points.join(state.select(group, "centroids"), group)
    near = near.withColumn("near", nearest("y", "centroids"))
    used = near.groupBy(group).agg(F.array_sort(F.collect_set("near")).alias("used"))
    return near.join(used, group).select(
        *points.columns, (F.array_position("used", F.col("near")) - 1).cast("int").alias("cluster")
    )


def cluster(points: DataFrame, group: str) -> DataFrame:
    """``points`` with the ``cluster`` of each; a point's ``rank`` is its place in a list that all groups share."""
    points = settle(points, "points")
    last = points.agg(F.max("rank")).first()[0]
    if last is None:
        return points.withColumn("cluster", F.lit(None).cast("int"))
    return labels(points, fit(points, group, start_ranks(last + 1)), group)
