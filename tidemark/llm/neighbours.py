"""Approximate nearest neighbours by cosine: a forest of sorted hash strings per shard."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import vectors
from tidemark.llm.vectors import answers, best, id_lists, matrix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 32
BITS = 32  # length of a hash string
CANDIDATES = 6_144  # distinct vectors of a shard to which a query is compared, at least
SEED = 42
FLOOR = 1e-300  # norms are taken of vectors scaled by their largest component


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, without overflow on the way."""
    scaled = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True), FLOOR)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def strings(rows: np.ndarray) -> np.ndarray:
    """A hash string of ``BITS`` signs for each row and tree, as numbers; the first sign leads."""
    planes = np.random.default_rng(SEED).standard_normal((TREES * BITS, rows.shape[1]))
    signs = (rows @ planes.T > 0).reshape(len(rows), TREES, BITS)
    return (signs * (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))).sum(axis=2)


class Forest:
    """Per tree the sorted hash strings of a shard, and whose they are."""

    def __init__(self, rows: np.ndarray) -> None:
        found = strings(rows)
        self.owners = np.argsort(found, axis=0, kind="stable").T.copy()
        self.sorted = np.sort(found, axis=0).T.copy()
        self.size = len(rows)

    def ranges(self, keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """First and end, per query and tree, of the strings that share the first ``depth`` signs."""
        low = keys >> (BITS - depth) << (BITS - depth)
        high = low + (1 << (BITS - depth))
        return tuple(
            np.stack([np.searchsorted(self.sorted[t], ends[:, t]) for t in range(TREES)], axis=1) for ends in (low, high)
        )

    def candidates(self, keys: np.ndarray, wanted: int) -> list[np.ndarray]:
        """For each query the vectors met on the way up.

        All trees are left at the deepest level at which any string still agrees, and
        then climbed one level at a time together, until ``wanted`` are met.
        """
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(keys)
        open_ = np.arange(len(keys))
        for depth in range(BITS, -1, -1):
            first, last = self.ranges(keys[open_], depth)
            sums = (last - first).sum(axis=1)
            still = []
            for i, q in enumerate(open_):
                if sums[i] < min(wanted, self.size) and depth:
                    still.append(q)
                    continue
                seen = np.zeros(self.size, bool)
                for t in range(TREES):
                    seen[self.owners[t, first[i, t] : last[i, t]]] = True
                met = np.flatnonzero(seen)
                if len(met) < min(wanted, self.size) and depth:
                    still.append(q)
                else:
                    found[q] = met
            open_ = np.array(still, np.int64)
            if not len(open_):
                break
        return found


def nearest(rows: pa.Table, asked: pa.Table, count: int, wanted: int) -> pa.Table:
    """The ``count`` nearest of a shard to each query of a block."""
    if not len(rows) or not len(asked):
        return answers([], pa.float64())
    base, queries = (unit(matrix(t, "vector", np.float64)) for t in (rows, asked))
    ids = id_lists(rows)
    met = Forest(base).candidates(strings(queries), wanted)
    out = []
    for name, query, near in zip(asked.column("query").to_pylist(), queries, met):
        scores = (base[near] * query).sum(axis=1)
        out.append((name, *best(scores, near, ids, count)))
    return answers(out, pa.float64())


def neighbours(
    table: DataFrame, query, key: str = "vec_id", vector: str = "embedding", k: int = 5, wanted: int = CANDIDATES
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` nearest by cosine of each row that ``query`` selects.

    ``query`` is a condition on ``key``. Every vector is indexed: distinct ones are
    dealt by hash into shards, and each shard meets the distinct queries in blocks.
    Scores are in double precision on the vectors themselves. Null, empty and zero
    vectors and those with a null or non-finite component take no part. Every other row
    counts, be its key repeated or null, and only the query's own row is never its
    neighbour; each row of a repeated query key has its own answer. Ties go to the
    smaller key, null keys last. Fewer than ``k`` others: all of them.
    Vectors of different lengths are an error. No query: no row.
    """
    rows = vectors.numbered(table, key, vector, F.exists("vector", lambda x: x != 0))
    asked = rows.where(query(F.col("name")))
    base, blocks = vectors.distinct_vectors(rows, k), vectors.distinct_queries(asked)
    shards, parts = base.select("shards").first(), blocks.select("blocks").first()
    if shards is None or parts is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    left = base.withColumn("block", vectors.each(parts[0]))
    right = blocks.withColumn("shard", vectors.each(shards[0]))
    found = (
        left.select("vector", "ids", "shard", "block").groupBy("shard", "block")
        .cogroup(right.select("query", "vector", "shard", "block").groupBy("shard", "block"))
        .applyInArrow(lambda a, b: nearest(a, b, k + 1, wanted), "query long, id long, score double")
    )
    return vectors.ranked(found, asked, rows, k)
