"""Rounds of one-dimensional k-means over stretches of a sorted group; runs in tasks, without the package."""

from __future__ import annotations

import struct
import sys
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOW_BITS = 20  # sums of steps are carried as two whole numbers, above and below these bits
CLOSE = 1e-9  # centroids nearer than this may tie by rounding, so that their members need not be one stretch


def mark(centroids: list[float]) -> int:
    """Spark's ``xxhash64`` of an array of doubles."""
    found = 42
    for c in centroids:
        found = xxhash.xxh64_intdigest(struct.pack("<d", c), found)
    return found - (1 << 64) if found >> 63 else found


def too_close(centroids: np.ndarray) -> bool:
    """Whether two centroids differ by less than rounding is sure not to reach."""
    gaps = np.diff(np.sort(centroids))
    return bool(((gaps > 0) & (gaps < CLOSE)).any())


def nearest(ys: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Value of the centroid nearest to each y, the first one on a tie."""
    return centroids[np.abs(centroids[:, None] - ys).argmin(axis=0)]


def advance(parts: pa.Table, state: pa.Table, rounds: int, steps: int) -> pa.Table:
    """The state of a group after as many rounds as its ``parts`` allow, ``rounds`` at most.

    A part is a stretch of the sorted values (``first`` to ``last``, ``n`` of them, sums ``high`` and ``low``).
    Clusters are stretches too, so a part whose ends have one centroid belongs to it whole; a part between two
    clusters ends the rounds, until it comes as single values.
    """
    row = state.to_pylist()[0] if len(state) else None
    if row is None or row["done"]:
        return state
    if not len(parts):
        return state.slice(0, 0)
    first, last, n, high, low = (parts.column(c).to_numpy() for c in ("first", "last", "n", "high", "low"))
    single = bool((first == last).all())
    first, last = first / steps, last / steps
    centroids, mean, seen = row["centroids"], row["mean"], list(row["seen"])
    known, done = set(seen), False
    for _ in range(rounds):
        now = np.array(centroids)
        near = nearest(first, now)
        if not single and (too_close(now) or not np.array_equal(near, nearest(last, now))):
            break
        moved = []
        for c in centroids:
            own = near == c
            total = (int(high[own].sum()) << LOW_BITS) + int(low[own].sum())
            moved.append(float(total) / float(steps) / (int(n[own].sum()) + 1))
        before, mean = mean, reduce(add, moved) / len(moved)  # one after another, as Spark adds them
        centroids, code = moved, mark(moved)
        done = before == mean or code in known
        known.add(code)
        seen.append(code)
        if done:
            break
    new = {"centroids": [centroids], "mean": [mean], "done": [done], "seen": [seen]}
    return pa.table([pa.array(new[f.name], f.type) if f.name in new else state.column(f.name) for f in state.schema], schema=state.schema)
