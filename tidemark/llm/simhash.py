"""Near-duplicate documents by SimHash fingerprints, compared exactly in tiles."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.components import connected
from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
SEED = 42
TILE = 16_384  # fingerprints of a tile: 128 KiB
RUN = 32  # tiles that a task compares with one other tile
SLAB = 64  # rows compared at a time, so that the exclusive-or stays in the cache
FEW = 500_000  # chosen rows that are sent to every executor, about 50 MB; more are shuffled
HASHES = 8_192  # shingles whose bits are unpacked at a time


def fingerprint(text: str | None, size: int, seed: int = SEED) -> int:
    """Majority bits of the hashes of all ``size``-word shingles; 0 without words.

    A-Z are lower-cased, words end at ASCII white space, and a text of fewer
    than ``size`` words is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(words) - size + 1)].tolist()
    ends = ends[size - 1 :].tolist() or [len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[i:j], seed) for i, j in zip(starts, ends)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), HASHES):
        octets = hashes[i : i + HASHES].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: str, size: int) -> Column:
    """The fingerprint of a text column as a signed 64-bit number."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(x, size) for x in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return of(F.col(text))


def _halves(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints >> np.uint64(32)).astype(np.int64)


def tile_links(left: np.ndarray, right: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles (or within one).

    All fingerprints of a tile have one population count. Both tiles are
    ordered by the population count of the upper half: of each run of the left
    only the stretch of the right whose counts of both halves can still meet
    the radius is compared, by exclusive-or and bit count. Of the links found
    those are kept that join two sets not joined before: at most one link less
    than there are fingerprints, however large a group of near copies is.
    """
    left, right = (x[np.argsort(_halves(x), kind="stable")] for x in (left, right))
    upper, there = _halves(left), _halves(right)
    step = int(np.bitwise_count(right[0])) - int(np.bitwise_count(left[0]))
    near = [d for d in range(-radius, radius + 1) if abs(d) + abs(step - d) <= radius]
    same = np.array_equal(left, right)
    at = np.arange(len(right)) + (0 if same else len(left))
    sets = np.arange(len(left) + (0 if same else len(right)))
    found = []
    for count in np.unique(upper):
        rows = np.flatnonzero(upper == count)
        first, last = np.searchsorted(there, [count + near[0], count + near[-1] + 1])
        for i in range(rows[0], rows[-1] + 1, SLAB):
            slab = left[i : min(i + SLAB, rows[-1] + 1)]
            close = np.bitwise_count(slab[:, None] ^ right[None, first:last]) <= radius
            for r in np.flatnonzero(close.any(axis=1)):
                hits = at[first:last][close[r]]
                joined, where = np.unique(sets[hits], return_index=True)
                new = joined != sets[i + r]
                if new.any():
                    found += [(left[i + r], right[hit - at[0]]) for hit in hits[where[new]]]
                    sets[np.isin(sets, joined[new])] = sets[i + r]
    return found


def _compare(key: tuple, rows: pd.DataFrame, radius: int) -> pd.DataFrame:
    tiles = {n: np.asarray(x, np.int64).view(np.uint64) for n, x in zip(rows["tile"], rows["prints"])}
    found = [x for n in sorted(tiles) if n >= key[0] for x in tile_links(tiles[key[0]], tiles[n], radius)]
    ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": ends[:, 0], "b": ends[:, 1]})


def links(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """``a``, ``b``: links that connect whatever distinct ``print``s are joined within the radius.

    Fingerprints of one population count are dealt by hash into tiles of about
    ``tile``. Tiles are numbered by population count, so those within the radius
    of a tile are one stretch of numbers; a task gets one tile and up to
    ``RUN`` tiles of its stretch. Of the tables only 65 counts reach the driver.
    """
    prints = prints.select("print", F.bit_count("print").alias("ones"))
    counts = dict(prints.groupBy("ones").count().collect())
    parts = [-(-counts.get(n, 0) // tile) for n in range(BITS + 1)]
    start = np.cumsum([0, *parts])
    first = F.array(*(F.lit(int(x)) for x in start))
    width = F.array(*(F.lit(max(1, x)) for x in parts))
    ones = F.col("ones").cast("int")
    number = F.get(first, ones) + F.pmod(F.xxhash64("print"), F.get(width, ones)).cast("int")
    tiles = prints.groupBy("ones", number.alias("tile")).agg(F.collect_list("print").alias("prints"))
    tiles = settle(tiles.coalesce(max(1, int(start[-1]) // RUN)), "tiles")
    low = F.get(first, F.greatest(ones - radius, F.lit(0)))
    high = F.get(first, F.least(ones + radius + 1, F.lit(BITS + 1))) - 1
    others = tiles.select(
        F.explode(F.sequence(low, F.col("tile"))).alias("left"), F.floor(F.col("tile") / RUN).alias("run"), "tile", "prints"
    )
    runs = F.sequence(F.floor(F.col("tile") / RUN), F.floor(high / RUN))
    lefts = tiles.select(F.col("tile").alias("left"), F.explode(runs).alias("run"), "tile", "prints")
    # a tile of its own stretch is in both; one copy is enough
    lefts = lefts.where(F.floor(F.col("tile") / RUN) != F.col("run"))
    both = lefts.union(others)
    return both.groupBy("left", "run").applyInPandas(lambda key, rows: _compare(key, rows, radius), "a long, b long")


def memberships(prints: DataFrame, radius: int) -> DataFrame:
    """``print``, ``root`` for each distinct ``print``: the least (signed) one of its component."""
    distinct = prints.select("print").distinct()
    roots = connected(links(distinct, radius), "a", "b")
    return distinct.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", F.coalesce("root", "print").alias("root")
    )


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, radius: int = 3
) -> DataFrame:
    """Fingerprint and component of every document.

    Returns one row per row of ``docs``: ``key``, ``fingerprint`` (16 lower-case
    hex digits) and ``component_id``, the smallest key that can be reached by
    links of at most ``radius`` differing bits. A null or empty text has
    fingerprint zero and is linked like any other. Repeated rows stay, null keys
    stay and count only if a component has no other (its id is null then). Other
    columns are not read, whatever their names; an empty table gives no row.
    """
    named = docs.select(F.col(key).alias("key"), fingerprint_column(text, size).alias("print"))
    named = settle(named, "fingerprints")
    firsts = named.groupBy("print").agg(F.min("key").alias("key"))
    roots = settle(firsts.join(memberships(firsts, radius), "print"), "roots")
    least = roots.groupBy("root").agg(F.min("key").alias("component_id"))
    return (
        named.join(roots.select("print", "root").join(least, "root").drop("root"), "print")
        .select(
            F.col("key").alias(key),
            F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
            "component_id",
        )
    )


def firsts(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, radius: int = 3) -> DataFrame:
    """One row of each component, all columns as they were: that of the smallest key, nulls last.

    Of rows with this key in the component the text with the smallest hash stays, and
    of repeated rows one. Fingerprints, not texts, are shuffled to choose; the chosen
    rows are then found by key and text hash.
    """
    hashed = F.xxhash64(F.col(text))
    named = docs.select(F.col(key).alias("key"), hashed.alias("hash"), fingerprint_column(text, size).alias("print"))
    named = settle(named, "fingerprints")
    return chosen_rows(docs, named, memberships(named.select("print"), radius), key, text)


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"
    return name


def chosen_rows(docs: DataFrame, named: DataFrame, roots: DataFrame, key: str, text: str) -> DataFrame:
    """The rows that ``firsts`` takes, by ``named`` (``key``, ``hash``, ``print`` of all) and ``roots`` (``print``, ``root``)."""
    one, two, rows = (free_name(docs, n) for n in ("chosen_key", "chosen_hash", "rows"))
    order = F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("hash"))
    best = named.groupBy("print").agg(F.min(order).alias("best")).join(roots, "print").groupBy("root").agg(F.min("best").alias("best"))
    repeats = named.groupBy(F.col("key").alias("k"), F.col("hash").alias("h")).agg(F.count("*").alias(rows))
    chosen = best.select("best.key", "best.hash").join(repeats, F.col("key").eqNullSafe(F.col("k")) & (F.col("hash") == F.col("h")))
    chosen = settle(chosen.select(F.col("key").alias(one), F.col("hash").alias(two), rows), "firsts")
    chosen = F.broadcast(chosen) if chosen.count() <= FEW else chosen
    found = docs.join(chosen, F.col(key).eqNullSafe(F.col(one)) & (F.xxhash64(F.col(text)) == F.col(two)))
    single = found.where(F.col(rows) == 1).select(*docs.columns)
    return single.union(found.where(F.col(rows) > 1).select(*docs.columns).dropDuplicates([key, text]))
