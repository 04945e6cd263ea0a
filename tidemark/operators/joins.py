"""Joins of headers and values on the natural key of a place.

A missing province equals a missing province. The keys stay plain equi-join
keys for Spark, which hashes or sorts on them as on any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def _aside(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, object]:
    """``df`` with its keys renamed, and the condition that matches them."""
    matches = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.withColumnsRenamed({k: f"_{k}" for k in keys}), reduce(and_, matches)


def outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on ``keys``."""
    other, on = _aside(right, keys)
    both = [F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in keys]
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return left.join(other, on, "full").select(*both, *rest)


def _spread(side: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """The keys with more than ``most`` rows, as ``_k0``.., and over how many tasks each is ``spread``; of these there are at most rows / ``most``."""
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    counts = side.groupBy(*named).agg(F.count("*").alias("rows")).where(F.col("rows") > most)
    return counts.select(*[f"_k{i}" for i in range(len(keys))], F.ceil(F.col("rows") / most).cast("int").alias("spread"))


def _with_spread(side: DataFrame, keys: Sequence[str], hot: DataFrame, name: str) -> DataFrame:
    matches = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))
    kept = [*side.columns, F.coalesce("spread", F.lit(1)).alias(name)]
    return side.join(hot, matches, "left").select(*kept)


def outer_split(left: DataFrame, right: DataFrame, keys: Sequence[str], most: int = 1_000_000) -> DataFrame:
    """``outer`` for tables in which one key, or its absence, may hold a large part of the rows of either side.

    Spark splits a dominant key of an inner or left join but not of a full one. So matches are
    found by an inner join on the key and two salts: rows of a key with more than ``most`` rows are dealt by
    their own hash, and those of the other side go to each part. Rows without a match
    are told by the distinct keys of the other side, which are few for a key that dominates. A missing key equals a missing key.
    """
    rows_of = {"_l": left, "_r": right}
    hot = {n: _spread(side, keys, most) for n, side in rows_of.items()}
    dealt = {}
    for n, side in rows_of.items():
        other = "_r" if n == "_l" else "_l"
        both = _with_spread(_with_spread(side, keys, hot[n], "_own"), keys, hot[other], "_others")
        mine = F.pmod(F.xxhash64(*side.columns), F.col("_own")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col("_others") - 1))
        dealt[n] = both.select(*side.columns, mine.alias(n), every.alias(other))
    salts = ["_l", "_r"]
    matched = inner(dealt["_l"], dealt["_r"], [*keys, *salts]).drop(*salts)
    alone = {n: _without(rows_of[n], rows_of["_r" if n == "_l" else "_l"], keys, hot[n]) for n in salts}
    return matched.unionByName(alone["_l"], allowMissingColumns=True).unionByName(alone["_r"], allowMissingColumns=True)


def _without(side: DataFrame, other: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Rows of ``side`` whose key is not in ``other``; a key that dominates is dealt as in ``outer_split``."""
    mine = F.pmod(F.xxhash64(*side.columns), F.col("_own")).cast("int")
    dealt = _with_spread(side, keys, hot, "_own").select(*side.columns, mine.alias("_salt"))
    known = _with_spread(other.select(*keys).distinct(), keys, hot, "_own")
    known = known.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_own") - 1)).alias("_salt"))
    there, on = _aside(known, [*keys, "_salt"])
    return dealt.join(there, on, "left_anti").drop("_salt")


def inner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys``."""
    other, on = _aside(right, keys)
    return left.join(other, on).drop(*[f"_{k}" for k in keys])


def keep(df: DataFrame, few: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``few``."""
    other, on = _aside(few.select(*keys), keys)
    return df.join(other, on, "left_semi")
