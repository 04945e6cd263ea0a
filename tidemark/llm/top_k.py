"""Exact top-k by integer inner product: KD-trees per shard."""

from __future__ import annotations

import heapq
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import vectors
from tidemark.llm.vectors import answers, best, id_lists, matrix
from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF = 256
EXACT = 2.0**53  # whole numbers below are exact as doubles
LONG = 2**63 - 1


class Tree:
    """Median splits along the widest side, each node with the tight box of its vectors."""

    def __init__(self, rows: np.ndarray) -> None:
        self.order = np.arange(len(rows))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        self._grow(rows, 0, len(rows))
        self.rows = rows[self.order]

    def _grow(self, rows: np.ndarray, first: int, last: int) -> int:
        node, own = len(self.spans), self.order[first:last]
        held = rows[own]
        self.low.append(held.min(axis=0))
        self.high.append(held.max(axis=0))
        self.spans.append((first, last))
        self.children.append(None)
        wide = self.high[node] - self.low[node]
        if last - first > LEAF and wide.max() > 0:
            side = held[:, int(np.argmax(wide))]
            middle = (last - first) // 2
            self.order[first:last] = own[np.argsort(side, kind="stable")]
            self.children[node] = self._grow(rows, first, first + middle), self._grow(rows, first + middle, last)
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node what no inner product with a vector in the box exceeds."""
        zero = queries.dtype.type(0) if queries.dtype != object else 0
        return np.maximum(queries, zero) @ np.array(self.high).T + np.minimum(queries, zero) @ np.array(self.low).T


def search(tree: Tree, query: np.ndarray, bounds: np.ndarray, ids: tuple, count: int, floor: float | None) -> tuple:
    """Ids and scores of the ``count`` best; boxes below ``floor``, or below the last of the best so far, stay shut."""
    starts = ids[1]
    names, scores = np.zeros(0, np.int64), np.zeros(0, query.dtype)
    heap = [(-bounds[0], 0)]
    while heap:
        bound, node = heapq.heappop(heap)
        if floor is not None and -bound < floor:
            break
        if tree.children[node]:
            for child in tree.children[node]:
                if floor is None or bounds[child] >= floor:
                    heapq.heappush(heap, (-bounds[child], child))
            continue
        first, last = tree.spans[node]
        own = tree.rows[first:last] @ query
        rows = tree.order[first:last]
        if floor is not None:
            rows, own = rows[own >= floor], own[own >= floor]
        if not len(rows):
            continue
        more, better = best(own, rows, (ids[0], starts), count)
        names, scores = np.concatenate([names, more]), np.concatenate([scores, better])
        order = np.lexsort((names, -scores))[:count]
        names, scores = names[order], scores[order]
        if len(scores) == count and (floor is None or scores[-1] > floor):
            floor = scores[-1]
    return names, scores


def shard_top(rows: pa.Table, asked: pa.Table, count: int) -> pa.Table:
    """The ``count`` best of a shard for each query of a block, no worse than the query's ``floor``."""
    if not len(rows) or not len(asked):
        return answers([], pa.int64())
    base, queries = (matrix(t, "vector", np.int64) for t in (rows, asked))
    largest = [float(np.abs(x.astype(float)).max()) for x in (base, queries)]
    kind = np.float64 if largest[0] * largest[1] * base.shape[1] < EXACT else object
    tree, queries = Tree(base.astype(kind)), queries.astype(kind)
    bounds = tree.bounds(queries)
    ids = id_lists(rows)
    out = []
    for i, (name, floor) in enumerate(zip(asked.column("query").to_pylist(), asked.column("floor").to_pylist())):
        names, scores = search(tree, queries[i], bounds[i], ids, count, floor)
        whole = [max(-LONG - 1, min(LONG, int(x))) for x in scores]
        out.append((name, names, np.array(whole, np.int64)))
    return answers(out, pa.int64())


def top_k(table: DataFrame, query, key: str = "vec_id", vector: str = "embedding", scale: int = 256, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` highest integer inner products, exactly.

    ``query`` is a condition on ``key``. Components become ``floor(scale * x)``. Every
    query first searches the shard that holds it; its last score there goes with it to
    all other shards, whose boxes below it are never opened. Distinct queries meet
    shards in blocks. Null and empty vectors, those with a null or non-finite component
    take no part; zero vectors do. Every other row counts, be its key repeated or null, and only the query's own row
    is never its neighbour; each row of a repeated query key has its own answer. Ties go to the smaller key, null
    keys last. Fewer than ``k`` others: all of them. Components and scores beyond 64 bits stop there. Vectors of different lengths are an error.
    """
    rows = vectors.numbered(table, key, vector)
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale)))
    asked = rows.where(query(F.col("name")))
    base, blocks = vectors.distinct_vectors(rows, k), vectors.distinct_queries(asked)
    shards, parts = base.select("shards").first(), blocks.select("blocks").first()
    if shards is None or parts is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    kinds = "query long, id long, score long"
    home = F.pmod(F.xxhash64("vector"), F.lit(shards[0]))
    at_home = blocks.select("query", "vector", home.alias("shard"), F.lit(None).cast("long").alias("floor"))
    first = settle(
        base.select("vector", "ids", "shard").groupBy("shard").cogroup(at_home.groupBy("shard"))
        .applyInArrow(lambda a, b: shard_top(a, b, k + 1), kinds),
        "home",
    )
    if shards[0] == 1:
        return vectors.ranked(first, asked, rows, k)
    floors = first.groupBy("query").agg(F.when(F.count("*") > k, F.min("score")).alias("floor"))
    away = blocks.withColumn("home", home).join(floors, "query").withColumn("shard", vectors.each(shards[0])).where("shard != home")
    left = base.withColumn("block", vectors.each(parts[0]))
    others = (
        left.select("vector", "ids", "shard", "block").groupBy("shard", "block")
        .cogroup(away.select("query", "vector", "floor", "shard", "block").groupBy("shard", "block"))
        .applyInArrow(lambda a, b: shard_top(a, b, k + 1), kinds)
    )
    return vectors.ranked(first.union(others), asked, rows, k)
