"""Near-duplicate documents by exact Jaccard similarity of their word shingles, met by SimHash fingerprints and by banded minima."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm import simhash
from tidemark.llm.components import connected
from tidemark.session import discard, settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
BANDS, ROWS = 32, 6  # two sets of similarity 0.8 share none of the bands with a chance of 6 in 100,000
RADIUS = 3  # differing bits up to which fingerprints bring two sets together
PLANES = 4  # bits kept of each least permuted hash
CELLS = 1_024  # bits of a set's map, one for all of its hashes that end alike
DEVIATIONS = 5  # standard deviations of mismatches from which a pair is left out unread
HASHES = 1_024  # shingles whose permutations are taken at a time
BATCH = 256  # documents of a written batch
FEW = 500_000  # rows of a table that is sent to every executor, about 50 MB
GAIN = 0.9  # share of the pairs left, above which another round of stars does not pay
ONE = {"print": "a", "size": "m", "comp": "own", "planes": "marks", "cells": "map"}  # names of a set with which those of its bucket are compared
WIDE = 4  # pairs a bucket's member may give before its bucket is first joined to stars


def shingles(text: str | None, size: int, seed: int = SEED) -> np.ndarray:
    """Sorted distinct hashes of all ``size``-word shingles, words as for ``simhash.fingerprint``."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(words) - size + 1)].tolist()
    ends = ends[size - 1 :].tolist() or [len(line)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(line[i:j], seed) for i, j in zip(starts, ends)], np.uint64))


def bands(found: np.ndarray) -> tuple[list[int], list[int]]:
    """A signed hash for each band of least permuted hashes (none for an empty set), and ``PLANES`` bits of each minimum, plane by plane."""
    if not len(found):
        return [], [0] * (PLANES * BANDS * ROWS // 64)
    rng = np.random.default_rng(SEED)
    factors, masks = (rng.integers(0, 2**64, BANDS * ROWS, np.uint64) for _ in range(2))
    factors |= np.uint64(1)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for i in range(0, len(found), HASHES):
        np.minimum(least, ((found[i : i + HASHES, None] ^ masks) * factors).min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS)
    signed = [xxhash.xxh64_intdigest(row.tobytes(), n) for n, row in enumerate(rows)]
    bits = (least >> np.arange(32, 32 + PLANES, dtype=np.uint64)[:, None]) & np.uint64(1)
    planes = np.packbits(bits.astype(np.uint8).reshape(-1, 64), axis=1, bitorder="little").view("<i8").ravel()
    return np.array(signed, np.uint64).view(np.int64).tolist(), planes.tolist()


def mismatches(a: str, b: str) -> Column:
    """Of how many minima the bits of two arrays differ: a share of (1 - similarity) * (1 - 2 ** -PLANES) of all is expected."""
    words = BANDS * ROWS // 64
    differ = [
        reduce(lambda x, y: x.bitwiseOR(y), (F.get(a, F.lit(p * words + w)).bitwiseXOR(F.get(b, F.lit(p * words + w))) for p in range(PLANES)))
        for w in range(words)
    ]
    return reduce(lambda x, y: x + y, map(F.bit_count, differ))


def cells(found: np.ndarray) -> list[int]:
    """A map of ``CELLS`` bits, as signed numbers of 64: which endings the hashes of a set have."""
    held = np.zeros(CELLS, np.uint8)
    held[found & np.uint64(CELLS - 1)] = 1
    return np.packbits(held, bitorder="little").view("<i8").tolist()


def most_shared(a: str, b: str, m: str, n: str) -> Column:
    """No fewer than the hashes that two sets of ``m`` and ``n`` share, by their maps ``a`` and ``b``: never too few.

    A shared hash has its bit in both maps; those beyond one a bit are no more than either set has beyond its bits.
    """

    def total(bits: Callable[[Column], Column]) -> Column:
        return reduce(lambda x, y: x + y, (F.bit_count(bits(F.lit(i))) for i in range(CELLS // 64)))

    both = total(lambda i: F.get(a, i).bitwiseAND(F.get(b, i)))
    return both + F.least(F.col(m) - total(lambda i: F.get(a, i)), F.col(n) - total(lambda i: F.get(b, i)))


def most_mismatches(least: Fraction) -> int:
    """Mismatches that a pair of similarity ``least`` passes only with a chance of about 1 in a million: ``DEVIATIONS`` above the mean."""
    hashes, share = BANDS * ROWS, float(1 - least) * (1 - 2.0**-PLANES)
    return int(np.ceil(hashes * share + DEVIATIONS * np.sqrt(hashes * share * (1 - share))))


def sketched(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``key``, ``hash`` (of the text), ``print`` (of the set), ``size``, ``mark`` (the SimHash), ``bands``, ``planes`` and ``cells`` of every row."""
    narrow = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"), F.col(text).alias("text"))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([narrow.schema["key"], narrow.schema["hash"]]).add("print", "long").add("size", "long").add("mark", "long").add("bands", longs).add("planes", longs).add("cells", longs)

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH):
                batch = whole.slice(i, BATCH)
                texts = batch.column("text").to_pylist()
                found = [(print_of(s), len(s), *bands(s), cells(s)) for s in (shingles(x, size) for x in texts)]
                prints, sizes, dealt, planes, maps = zip(*found)
                marks = np.array([simhash.fingerprint(x, size) for x in texts], np.uint64).view(np.int64)
                columns = [pa.array(x, pa.int64()) for x in (prints, sizes, marks)] + [pa.array(x, pa.list_(pa.int64())) for x in (dealt, planes, maps)]
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("hash"), *columns], schema.names)

    return settle(narrow.mapInArrow(of, schema), "sketches")


def print_of(found: np.ndarray) -> int:
    """A signed hash of a set."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).astype(np.int64))


def small(df: DataFrame) -> DataFrame:
    """A written table of two or three numbers a row, sent to every executor if it has at most ``FEW`` rows; else Spark deals both sides."""
    return F.broadcast(df) if df.count() <= FEW else df


def sets_of(docs: DataFrame, key: str, text: str, size: int, named: DataFrame, members: DataFrame) -> DataFrame:
    """``print`` and ``shingles`` of each of ``members`` (``print``), made anew from one text of each.

    Only texts that share a band with another are cut again, so the sets of all the
    others are never kept.
    """
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "hash")).alias("first")
    wanted = named.join(small(members), "print", "left_semi").groupBy("print").agg(first)
    wanted = settle(wanted.select(F.col("first.key").alias("wanted_key"), F.col("first.hash").alias("wanted_hash")), "wanted")
    narrow = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash"), F.col(text).alias("text"))
    same = F.col("key").eqNullSafe(F.col("wanted_key")) & (F.col("hash") == F.col("wanted_hash"))
    texts = narrow.join(small(wanted), same, "left_semi").select("text")

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH):
                found = [shingles(x, size) for x in whole.column("text").slice(i, BATCH).to_pylist()]
                prints = pa.array([print_of(s) for s in found], pa.int64())
                yield pa.RecordBatch.from_arrays([prints, pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["print", "shingles"])

    return settle(texts.mapInArrow(of, "print long, shingles array<long>").dropDuplicates(["print"]), "sets")


def alike(pairs: DataFrame, sets: DataFrame, least: Fraction) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose sets have a Jaccard similarity of ``least`` or more; only the sets of these pairs are moved."""
    nodes = settle(pairs.select(F.explode(F.array("a", "b")).alias("print")).distinct(), "nodes")
    needed = sets.join(small(nodes), "print", "left_semi")
    left = needed.select(F.col("print").alias("a"), F.col("shingles").alias("one"))
    right = needed.select(F.col("print").alias("b"), F.col("shingles").alias("two"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("one", "two"))
    total = F.size("one") + F.size("two")
    return both.where(shared * (least.numerator + least.denominator) >= total * least.numerator).select("a", "b")


def near_marks(named: DataFrame) -> DataFrame:
    """``a``, ``b``: pairs of sets to compare, as their fingerprints are at most ``RADIUS`` bits apart.

    Sets of one fingerprint form a star around the least, and the fingerprints are joined by the forest of
    ``simhash.links``; what this leaves out the bands bring together.
    """
    marked = settle(named.where("size > 0").select("print", "mark").distinct(), "marks")
    least = marked.groupBy("mark").agg(F.min("print").alias("least"))
    near = simhash.links(marked.select(F.col("mark").alias("print")).distinct(), RADIUS).distinct()
    one, two = (least.select(F.col("mark").alias(m), F.col("least").alias(x)) for m, x in (("a", "x"), ("b", "y")))
    across = near.join(one, "a").join(two, "b").select("x", "y")
    pairs = marked.join(least, "mark").select(F.col("print").alias("x"), F.col("least").alias("y")).union(across).where("x != y")
    return settle(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "near-marks")


def links(docs: DataFrame, key: str, text: str, size: int, named: DataFrame, least: Fraction) -> DataFrame:
    """``a``, ``b``: links that connect the distinct sets of ``named`` which are ``least`` alike and have near fingerprints or share a band.

    Sets of near fingerprints are compared first. Large buckets are first joined to stars: each round one set of every bucket is
    compared with all of it that are not yet of its component. When a round no longer
    helps, or little is left, all pairs of a bucket that are still of different
    components are compared, so no pair is left out. A pair whose minima tell that it is far from
    alike, or whose maps (see ``most_shared``) that it shares too little, is dropped where it meets, before its sets are read.
    """
    parts_of = F.first("size").cast("int").alias("size"), *(F.first(c).alias(c) for c in ("bands", "planes", "cells"))
    nodes = named.groupBy("print").agg(*parts_of)
    nodes = settle(nodes, "distinct-sets")
    dealt = settle(nodes.select("print", F.explode("bands").alias("bucket")), "bands")
    shared = dealt.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = dealt.join(small(settle(shared, "shared")), "bucket")
    members = settle(members.join(nodes.select("print", "size", "planes", "cells"), "print"), "buckets")
    discard(dealt)
    marked = near_marks(named)
    rows = members.count()
    compared = members.select("print").union(marked.select(F.explode(F.array("a", "b")))).distinct()
    sets = sets_of(docs, key, text, size, named, settle(compared, "members"))
    found = settle(alike(marked, sets, least), "alike")
    if not rows:
        return found
    roots = connected(found, "a", "b")
    joined = members.join(roots, F.col("print") == F.col("node"), "left")
    state = settle(joined.select("bucket", "print", "size", "planes", "cells", F.coalesce("root", "print").alias("comp")), "bucket-state")
    before, level, most = None, 0, most_mismatches(least)
    while True:
        parts = state.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
        sums = parts.groupBy("bucket").agg(
            F.sum("n").alias("total"), F.max(F.struct("n", "comp")).alias("main"), F.count("*").alias("parts")
        )
        sums = settle(sums.where("parts > 1").select("bucket", "total", F.col("main.comp").alias("main"), F.col("main.n").alias("n")), "bucket-sums")
        work = sums.agg(F.sum((F.col("total") - F.col("n")) * F.col("total"))).first()[0] or 0
        if not work:
            break
        last = work <= WIDE * rows or before is not None and work > GAIN * before
        open_ = state.join(sums.select("bucket", "main"), "bucket")
        others = open_.where("comp != main")
        if last:
            ones = others.select("bucket", F.struct("print", "size", "comp", "planes", "cells").alias("one"))
        else:
            first = F.min_by(F.struct("print", "size", "comp", "planes", "cells"), F.struct(F.xxhash64("print", "bucket", F.lit(level)), F.col("print"))).alias("one")
            ones = others.groupBy("bucket").agg(first)
        ones = ones.select("bucket", *(F.col(f"one.{c}").alias(n) for c, n in ONE.items()))
        met = open_.join(ones, "bucket").where(
            (F.col("comp") != F.col("own"))
            & (F.least("size", "m") * least.denominator >= F.greatest("size", "m") * least.numerator)
            & (mismatches("planes", "marks") <= most)
            & (most_shared("cells", "map", "size", "m") * (least.numerator + least.denominator) >= (F.col("size") + F.col("m")) * least.numerator)
        )
        pairs = met.select(F.least("a", "print").alias("a"), F.greatest("a", "print").alias("b")).distinct()
        new = settle(alike(settle(pairs, "pairs"), sets, least), "alike")
        found = found.union(new)
        if last:
            break
        roots = connected(found, "a", "b")
        comp = F.coalesce("root", "print").alias("comp")
        moved = settle(members.join(roots, F.col("print") == F.col("node"), "left").select("bucket", "print", "size", "planes", "cells", comp), "bucket-state")
        discard(state)
        state, before, level = moved, work, level + 1
    return found


def firsts(docs: DataFrame, key: str, text: str, size: int, least: Fraction) -> DataFrame:
    """One row of each group, all columns as they were, chosen as ``simhash.firsts`` does.

    Groups are joined by texts whose sets of ``size``-word shingles have a Jaccard
    similarity of ``least`` or more. Null and empty texts are alike, and like nothing else. Texts of
    any length count whole; repeated rows are one, a null key stays only if a group has no other; other
    columns stay as they are, whatever their names; no row gives no row.
    """
    named = sketched(docs, key, text, size)
    distinct = named.select("print").distinct()
    roots = connected(links(docs, key, text, size, named, least), "a", "b")
    roots = distinct.join(roots, F.col("print") == F.col("node"), "left").select("print", F.coalesce("root", "print").alias("root"))
    return simhash.chosen_rows(docs, named.select("key", "hash", "print"), roots, key, text)
