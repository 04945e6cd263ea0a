"""Near-duplicate embeddings: all pairs above a cosine, by cover trees of shards that meet in tasks."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.components import connected
from tidemark.llm.cover_tree import Join, Side, Tree, build, units
from tidemark.llm.vectors import finite
from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD = 8_192  # distinct vectors of a tree
RUN = 4  # trees that a task compares with one other tree
PIVOTS = 256  # most centres of the coarsest level
SAMPLE = 2_048  # vectors from which these are chosen; they decide who meets whom where, never what is found
PARTS = ("first", "last", "child", "childs")


def _rows(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    return pa.concat_arrays(lists.chunks).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def pivots(points: DataFrame, count: int, width: int) -> np.ndarray:
    """Directions far from one another, ``count`` at most: each next one is that of a bounded sample furthest from those before."""
    drawn = points.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vector").collect()
    sample = units(np.array([r.vector for r in drawn], float).reshape(-1, width))
    chosen, nearest = [0], sample @ sample[0]
    while len(chosen) < min(count, len(sample)) and nearest.min() < 1 - 1e-9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen]


def dealt(points: DataFrame, centres: np.ndarray, width: int) -> DataFrame:
    """``points`` with the ``cell`` of the nearest centre and how ``far`` it is."""

    def assign(batches):
        for batch in batches:
            found = units(_rows(pa.chunked_array([batch.column("vector")]), width))
            near = found @ centres.T
            cell = near.argmax(axis=1)
            far = np.sqrt(((found - centres[cell]) ** 2).sum(axis=1))
            yield batch.append_column("cell", pa.array(cell, pa.int32())).append_column("far", pa.array(far))

    return points.mapInArrow(assign, T.StructType([*points.schema.fields]).add("cell", T.IntegerType()).add("far", T.DoubleType()))


def trees(shards: DataFrame, width: int, least: float) -> DataFrame:
    """One row per ``shard``: its points in the order of its tree, and the tree."""
    wanted = float(np.sqrt(max(0.0, 2 - 2 * least)))
    vector = shards.schema["vector"].dataType
    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    schema = T.StructType().add("shard", T.LongType()).add("cell", T.IntegerType())
    for name, column in {"nodes": longs, "weights": longs, "vectors": vector, **dict.fromkeys(PARTS, ints), "radius": T.ArrayType(T.DoubleType())}.items():
        schema = schema.add(name, column)
    kind = pa.float32() if vector.elementType == T.FloatType() else pa.float64()

    def grow(table: pa.Table) -> pa.Table:
        vectors = _rows(table.column("vector"), width)
        order, tree = build(units(vectors), wanted / 2)
        lists = {
            "nodes": (table.column("node").to_numpy()[order], pa.int64()), "weights": (table.column("n").to_numpy()[order], pa.int64()),
            "vectors": (vectors[order].ravel(), kind), **{n: (getattr(tree, n), pa.int32()) for n in PARTS}, "radius": (tree.radius, pa.float64()),
        }
        named = {n: pa.array([pa.array(x, k)], pa.list_(k)) for n, (x, k) in lists.items()}
        return pa.table({"shard": table.column("shard").slice(0, 1), "cell": table.column("cell").slice(0, 1), **named})

    return shards.groupBy("shard").applyInArrow(grow, schema)


def compare(meetings: DataFrame, width: int, least: float) -> DataFrame:
    """Of each task's trees: rows (``a``, null, ``n``) count the rows linked with a point, rows (``a``, ``b``) join it to its group."""

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        left, run = (x.as_py() for x in key)
        sides, nodes = {}, {}
        for i, shard in enumerate(table.column("shard").to_pylist()):
            flat = {n: table.column(n)[i].values.to_numpy(zero_copy_only=False) for n in ("nodes", "weights", "vectors", "radius", *PARTS)}
            tree = Tree(*(flat[n] for n in PARTS), flat["radius"])
            sides[shard], nodes[shard] = Side(tree, flat["vectors"].astype(float).reshape(-1, width), flat["weights"]), flat["nodes"]
        found = []
        for shard in sorted(s for s in sides if s // RUN == run):
            links = Join(sides[left], sides[shard], least).run()
            own = nodes[left] if shard == left else np.concatenate([nodes[left], nodes[shard]])
            some, moved = np.flatnonzero(links.count), np.flatnonzero(links.label != np.arange(len(own)))
            found.append((own[some], np.zeros(len(some), np.int64), np.ones(len(some), bool), links.count[some]))
            found.append((own[moved], own[links.label[moved]], np.zeros(len(moved), bool), np.zeros(len(moved), np.int64)))
        a, b, none, n = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64(), mask=none.astype(bool)), "n": pa.array(n, pa.int64())})

    return meetings.groupBy("left", "run").applyInArrow(meet, "a long, b long, n long")


def links(points: DataFrame, least: float, shard: int = SHARD) -> DataFrame:
    """What ``compare`` finds over all ``points`` (``node``, ``vector``, ``n``), distinct vectors of one length.

    The coarsest level deals the points to the nearest of a few centres; a cell
    of more than ``shard`` points is divided by hash. Cells whose centres are further
    apart than their radii and the wanted distance never meet. Of the table only the
    sample and one row per cell reach the driver.
    """
    spark = points.sparkSession
    total, low, high = points.agg(F.count("*"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if low != high:
        raise ValueError(f"vectors of {low} and of {high} components cannot be compared")
    centres = pivots(points, max(1, min(PIVOTS, -(-total // shard))), low or 1)
    cells = settle(dealt(points, centres, low), "cells")
    known = {r.cell: r for r in cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    names = sorted(known)
    parts = {c: -(-known[c].n // shard) for c in names}
    start = dict(zip(names, np.cumsum([0, *(parts[c] for c in names)]).tolist()))
    wanted = np.sqrt(max(0.0, 2 - 2 * least))
    apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
    meet = [
        (c, d, start[d], start[d] + parts[d] - 1) for c in names for d in names if apart[c, d] <= known[c].far + known[d].far + wanted + 1e-6
    ]
    sizes = spark.createDataFrame([(c, start[c], parts[c]) for c in names], "cell int, start long, parts long")
    number = F.col("start") + F.pmod(F.xxhash64("node"), F.col("parts"))
    grown = settle(trees(cells.join(sizes, "cell").select(number.alias("shard"), "cell", "node", "n", "vector"), low, least), "cover-trees")
    runs = {c: sorted({r for x, _, first, last in meet if x == c for r in range(first // RUN, last // RUN + 1)}) for c in names}
    own_run = F.floor(F.col("shard") / RUN)
    # a tree goes once to every later run that it may meet; the others of its own run come to it anyway
    later = spark.createDataFrame([(c, list(map(list, stretches(found)))) for c, found in runs.items()], "cell int, stretches array<array<long>>")
    stretch = F.explode("stretches").alias("stretch")
    lefts = grown.join(later, "cell").select(*grown.columns, stretch).where(F.get("stretch", F.lit(1)) > own_run)
    numbers = F.sequence(F.greatest(F.get("stretch", F.lit(0)), own_run + 1), F.get("stretch", F.lit(1)))
    lefts = lefts.select(F.col("shard").alias("left"), F.explode(numbers).alias("run"), *grown.columns)
    partners = spark.createDataFrame(meet, "cell int, other int, start long, end long").where("start <= end").drop("other")
    rights = grown.join(partners, "cell").where("start <= shard").select(*grown.columns, F.explode(F.sequence("start", F.least("end", "shard"))).alias("left"))
    rights = rights.select("left", own_run.alias("run"), *grown.columns)
    return compare(lefts.union(rights), low, least)


def stretches(numbers: list[int]) -> list[tuple[int, int]]:
    """Ascending numbers as first and last of each stretch without a gap."""
    breaks = [i for i in range(1, len(numbers)) if numbers[i] > numbers[i - 1] + 1]
    return [(numbers[i], numbers[j - 1]) for i, j in zip([0, *breaks], [*breaks, len(numbers)])]


def linked(table: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, shard: int = SHARD) -> DataFrame:
    """Links and component of every vector.

    Returns one row per row of ``table``: ``key``, ``n_links`` (other rows whose
    cosine with it, in double precision, is ``least`` or more), ``component_id`` (the smallest
    key that links reach, itself included) and ``kept`` (whether that is its own). Equal
    vectors are compared once and counted as often as they occur, whatever their keys, so rows of
    one key stay apart. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing; vectors of different lengths are an error. A null
    key counts for a component only if it has no other. Other columns are not
    read, whatever their names; an empty table gives no row.
    """
    usable = finite("vector") & F.exists("vector", lambda x: x != 0)
    rows = table.select(F.col(key).alias("key"), F.col(vector).alias("vector")).withColumn("usable", F.coalesce(usable, F.lit(False)))
    grouped = rows.where("usable").groupBy("vector").agg(F.count("*").alias("n"), F.min("key").alias("least"))
    points = settle(grouped.withColumn("node", F.monotonically_increasing_id()), "points")
    if points.isEmpty():
        alone = rows
        members = None
    else:
        found = settle(links(points.select("node", "vector", "n"), least, shard), "vector-links")
        counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("others"))
        roots = connected(found.where("b IS NOT NULL"), "a", "b").select(F.col("node").alias("a"), "root")
        named = points.select("node", "n", "least").join(counts, F.col("node") == F.col("a"), "left").drop("a")
        named = named.join(roots, F.col("node") == F.col("a"), "left").drop("a").withColumn("root", F.coalesce("root", "node"))
        named = settle(named.select("node", "least", "root", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "vector-roots")
        least_key = named.groupBy("root").agg(F.min("least").alias("component_id"))
        members = points.select("node", "vector").join(named.join(least_key, "root").select("node", "n_links", "component_id"), "node").drop("node")
        alone = rows.where("NOT usable")
    out = alone.select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    if members is not None:
        out = rows.where("usable").join(members, "vector").select("key", "n_links", "component_id").union(out)
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
