"""Vectors as shards, queries as blocks: what nearest-neighbour searches share.

Every row has a number of its own. Equal vectors are one vector with its smallest
numbers, equal queries one query, so a vector that a third of all rows hold costs no more than another. A search is
for one more than the wanted number, which leaves enough once the query's own
row is taken out.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD = 16_384  # distinct vectors of a shard
BLOCK = 4_096  # distinct queries that meet a shard in one task


def finite(vector: str) -> Column:
    """Whether a vector is there, has components, and all of them are finite numbers."""
    value = F.col(vector)
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return value.isNotNull() & (F.size(value) > 0) & ~bad


def numbered(table: DataFrame, key: str, vector: str, usable: Column | None = None) -> DataFrame:
    """``name`` (the key), ``vector`` (double), ``id`` of every row that takes part.

    ``id`` numbers the rows in the order of their keys, null keys last, so rows of one key stay apart and
    ties by ``id`` are ties by key. Rows of one key are spread by their vectors, equal rows by where they lie.
    """
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = table.select(F.col(key).alias("name"), doubles.alias("vector")).where(finite("vector"))
    if usable is not None:
        rows = rows.where(usable)
    spots = rows.withColumn("spot", F.monotonically_increasing_id())
    order = spots.orderBy(F.col("name").asc_nulls_last(), F.xxhash64("vector"), "spot")
    return settle(order.select("name", "vector", F.monotonically_increasing_id().alias("id")), "rows")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``vector``, ``ids`` (its ``k + 1`` smallest, least first), ``shard``, ``shards`` of ``rows`` (``id``, ``vector``)."""
    order = Window.partitionBy("vector").orderBy("id")
    firsts = rows.withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= k + 1)
    found = settle(firsts.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")), "vectors")
    shards = max(1, -(-found.count() // SHARD))
    return found.select("vector", "ids", F.pmod(F.xxhash64("vector"), F.lit(shards)).alias("shard"), F.lit(shards).alias("shards"))


def distinct_queries(queries: DataFrame) -> DataFrame:
    """``query`` (the smallest id), ``vector``, ``block``, ``blocks`` of ``queries`` (``id``, ``vector``)."""
    found = settle(queries.groupBy("vector").agg(F.min("id").alias("query")), "queries")
    blocks = max(1, -(-found.count() // BLOCK))
    return found.select("query", "vector", F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block"), F.lit(blocks).alias("blocks"))


def each(count: int) -> Column:
    """Numbers from 0, one row each."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))


def matrix(table: pa.Table, column: str, kind: type) -> np.ndarray:
    """The vectors of a column as rows."""
    lists = table.column(column).combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if flat.size % len(lists):
        raise ValueError("vectors of different lengths cannot be compared")
    return flat.reshape(len(lists), -1)


def id_lists(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after another, and where those of each vector begin (and the last end)."""
    lists = table.column("ids").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)])


def best(scores: np.ndarray, rows: np.ndarray, ids: tuple[np.ndarray, np.ndarray], count: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``count`` best of some ``rows``, best first, ties to the smaller id."""
    if len(rows) > count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        rows, scores = rows[scores >= least], scores[scores >= least]
    flat, starts = ids
    sizes = starts[rows + 1] - starts[rows]
    own = flat[np.concatenate([np.arange(starts[r], starts[r + 1]) for r in rows])] if len(rows) else flat[:0]
    scores = np.repeat(scores, sizes)
    order = np.lexsort((own, -scores))[:count]
    return own[order], scores[order]


def ranked(found: DataFrame, queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every row of ``queries`` from ``found`` (``query``, ``id``, ``score``), under the names that ``rows`` have."""
    order = [F.col("score").desc(), F.col("id")]
    top = found.withColumn("nr", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("nr") <= k + 1)
    same = queries.groupBy("vector").agg(F.min("id").alias("query"))
    asked = queries.join(same, "vector").select(F.col("id").alias("own"), F.col("name").alias("query_id"), "query")
    pairs = asked.join(top, "query").where(F.col("id") != F.col("own"))
    rank = F.row_number().over(Window.partitionBy("own").orderBy(*order))
    best_k = pairs.select("query_id", rank.alias("rank"), "id", "score").where(F.col("rank") <= k)
    names = rows.select("id", F.col("name").alias("vec_id"))
    return best_k.join(names, "id").select("query_id", "rank", "vec_id", "score")


def answers(rows: list[tuple], score: pa.DataType) -> pa.Table:
    """Found rows (``query``, ids, scores) as a table."""
    queries = np.repeat([q for q, *_ in rows], [len(i) for _, i, _ in rows]) if rows else []
    flat = [np.concatenate([r[c] for r in rows]) if rows else [] for c in (1, 2)]
    return pa.table({
        "query": pa.array(queries, pa.int64()), "id": pa.array(flat[0], pa.int64()), "score": pa.array(flat[1], score),
    })
