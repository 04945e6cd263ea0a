"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import itertools
import random
import sys
from collections.abc import Iterable, Iterator, Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.simhash import FEW, free_name
from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)  # words wanted, as a share of all words
CEILING = 2  # a source or document is taken this many times at most
BLOCK = 4_096  # rows whose chances are moved in one stretch
SEED = 42
NEAR = 1e-9  # chances this close to 0 or 1 are settled


def words(text: str) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: Sequence[int], weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, ceiling: int = CEILING
) -> list[Fraction]:
    """Exact target of each source, in the order of the sources; ``weights`` repeat.

    A target above ``ceiling`` times its source stops there, and the excess goes
    to the others by weight until none is above.
    """
    weight = [w for _, w in zip(sizes, itertools.cycle(weights))]
    found: dict[int, Fraction] = {}
    left = share * sum(sizes)
    while True:
        free = [i for i in range(len(sizes)) if i not in found]
        total = sum(weight[i] for i in free)
        above = [i for i in free if left * weight[i] > ceiling * sizes[i] * total]
        if not above:
            found.update({i: left * weight[i] / total for i in free})
            return [found[i] for i in range(len(sizes))]
        found.update({i: Fraction(ceiling * sizes[i]) for i in above})
        left -= sum(found[i] for i in above)


def _step(chances: list[float], sizes: list[float], rng: random.Random) -> list[float]:
    """Move along a direction that keeps the sums of chances and of chances times size, until one settles."""
    if len(chances) == 3 and len(set(sizes)) > 1:
        a, b, c = sizes
        way = [c - b, a - c, b - a]
    else:
        way = [1.0, -1.0] + [0.0] * (len(chances) - 2)
    ahead = min((1 - p) / u if u > 0 else -p / u for p, u in zip(chances, way) if u)
    back = min(p / u if u > 0 else (p - 1) / u for p, u in zip(chances, way) if u)
    far = ahead if rng.random() * (ahead + back) < back else -back
    moved = [min(1.0, max(0.0, p + far * u)) for p, u in zip(chances, way)]
    return [float(round(p)) if min(p, 1 - p) < NEAR else p for p in moved]


def _land(chances: list[float], sizes: list[float]) -> list[float]:
    """The choice of 0 or 1 for the few left that misses the words least, then the documents."""
    wanted = sum(p * s for p, s in zip(chances, sizes))
    return list(
        min(
            itertools.product((0.0, 1.0), repeat=len(chances)),
            key=lambda x: (abs(sum(a * s for a, s in zip(x, sizes)) - wanted), abs(sum(x) - sum(chances)), x),
        )
    )


def _flight(level: int):
    """Settle the chances of each block and source; where ``last`` also of the one or two that remain."""

    def settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rng, last = None, random.Random(), False
        active: list[tuple[pa.RecordBatch, int]] = []
        sizes: list[float] = []
        chances: list[float] = []
        done: list[tuple[pa.RecordBatch, int, float]] = []

        def sift() -> None:
            keep = []
            for i, p in enumerate(chances):
                if p in (0.0, 1.0):
                    done.append((*active[i], p))
                else:
                    keep.append(i)
            for x in (active, sizes, chances):
                x[:] = [x[i] for i in keep]

        def close() -> None:
            while len(chances) == 2 and sizes[0] == sizes[1]:
                chances[:] = _step(chances, sizes, rng)
                sift()
            out = _land(chances, sizes) if last else list(chances)
            done.extend((*row, p) for row, p in zip(active, out))
            for x in (active, sizes, chances):
                x.clear()

        def flush() -> Iterator[pa.RecordBatch]:
            for _, rows in itertools.groupby(done, key=lambda x: id(x[0])):
                rows = list(rows)
                part = rows[0][0].take(pa.array([i for _, i, _ in rows], pa.int64()))
                column = part.schema.get_field_index("chance")
                yield part.set_column(column, part.schema.field(column), pa.array([p for *_, p in rows], pa.float64()))
            done.clear()

        for batch in batches:
            blocks, ranks, own, before, lasts = (batch.column(c).to_pylist() for c in ("block", "rank", "size", "chance", "last"))
            for i, key in enumerate(zip(blocks, ranks)):
                if key != name:
                    close()
                    name, rng, last = key, random.Random(f"{SEED} {level} {key[0]} {key[1]}"), lasts[i]
                active.append((batch, i))
                sizes.append(float(own[i]))
                chances.append(before[i])
                sift()
                while len(chances) > 2:
                    chances[:] = _step(chances, sizes, rng)
                    sift()
            done.sort(key=lambda x: id(x[0]) != id(batch))
            yield from flush()
        close()
        yield from flush()

    return settled


def balanced(rows: DataFrame, level: int = 0) -> DataFrame:
    """``rows`` with every ``chance`` settled to 0 or 1, balanced within each ``rank``.

    ``rows`` has ``rank`` (of the source), ``size``, ``chance`` and ``row`` (anything).
    The rows of a source are dealt by hash into blocks of about ``BLOCK``, which leave
    at most two fractional chances each. Those are dealt again; a source lands as soon as
    its own rows fit one block, however many other sources there are. A dominant source
    is spread over its blocks, so it is no larger task than others; a block is a stretch
    of a sorted partition that streams, so even repeats of one row need no memory. Blocks,
    order and random numbers follow from the rows alone: reruns agree under any partitioning.
    """
    counts = rows.groupBy("rank").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    counts = settle(counts.withColumnRenamed("rank", "of"), "blocks")
    most = counts.agg(F.max("blocks")).first()[0] or 0
    mark = F.xxhash64("row", F.lit(SEED + level))
    dealt = rows.withColumn("mark", mark).join(counts, F.col("rank") == F.col("of"))
    dealt = dealt.withColumn("block", F.pmod("mark", "blocks").cast("int")).withColumn("last", F.col("blocks") == 1).drop("of", "blocks")
    dealt = dealt.repartition("rank", "block").sortWithinPartitions("rank", "block", F.xxhash64("mark", F.lit(SEED)), "mark")
    out = settle(dealt.mapInArrow(_flight(level), dealt.schema).drop("mark", "block", "last"), "flight")
    if most <= 1:
        return out
    over = F.col("chance").isin(0.0, 1.0)
    return out.where(over).union(balanced(out.where(~over), level + 1))


def mix(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    ceiling: int = CEILING,
) -> DataFrame:
    """``row`` (all columns of ``docs``), ``source``, ``size``, ``source_size``, ``target``, ``copies``.

    Sources in the order of their code points, null last, get the repeating
    ``weights``; see ``targets``. A document is taken at least as often as the whole
    part of its source's rate, and once more with the fraction as its chance; the
    cube method settles these chances so that each source keeps both its documents
    and its words. One row of ``docs`` gives one row, repeated rows and null keys too;
    sizes below 0 are an error. One row per source reaches the driver, as a mix is a
    list of sources with weights. No document: no row.
    """
    sized = settle(docs.select(F.struct("*").alias("row"), F.col(source).alias("source"), size.alias("size")), "sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    if not sums:
        return sized.selectExpr("row", "source", "size", "size source_size", "0d target", "0L copies")
    sums.sort(key=lambda r: (r.source is None, r.source or ""))
    wanted = targets([r["size"] for r in sums], weights, share, ceiling)
    rates = [t / r["size"] if r["size"] else Fraction(0) for t, r in zip(wanted, sums)]
    plan = docs.sparkSession.createDataFrame(
        [(r.source, i, r["size"], float(t), int(q), float(q - int(q))) for i, (r, t, q) in enumerate(zip(sums, wanted, rates))],
        T.StructType([sized.schema["source"]])
        .add("rank", "integer").add("source_size", "long").add("target", "double").add("whole", "long").add("chance", "double"),
    ).withColumnRenamed("source", "name")
    rows = sized.join(plan.select("name", "rank", "chance"), F.col("source").eqNullSafe(F.col("name")))
    chosen = balanced(rows.select("row", "source", "size", "rank", "chance"))
    return chosen.join(plan.drop("chance").withColumnRenamed("rank", "at"), F.col("rank") == F.col("at")).select(
        "row", "source", "size", "source_size", "target", (F.col("whole") + F.col("chance").cast("long")).alias("copies")
    )


def taken(docs: DataFrame, size: Column, source: str = "source", **rates) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, all columns as they were.

    Only hashes of the rows, sources and sizes are mixed; the rows are then found by two
    64-bit hashes. Equal rows share the copies of all: each is taken the whole part of
    their mean, and one of them the rest. A null source comes last; a size of 0 or null is never taken;
    no row gives no row, and columns of any names pass.
    """
    one, two, whole, rest, many, copy = (free_name(docs, n) for n in ("one", "two", "whole", "rest", "many", "copy"))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    narrow = docs.select(F.xxhash64(row).alias("one"), F.xxhash64(row, F.lit(1)).alias("two"), F.col(source).alias("source"), size.alias("size"))
    mixed = mix(narrow, F.col("size"), "source", **rates)
    counted = mixed.groupBy("row.one", "row.two").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    each = F.floor(F.col("copies") / F.col("rows"))
    left = F.col("copies") - each * F.col("rows")
    counted = counted.select(F.col("one").alias(one), F.col("two").alias(two), each.alias(whole), left.alias(rest), (F.col("rows") > 1).alias(many))
    # a row that is the only one of its kind is found where it lies, and none is moved for the few that repeat
    counted = settle(counted.where((F.col(whole) > 0) | (F.col(rest) > 0)), "copies")
    counted = F.broadcast(counted) if counted.count() <= FEW else counted
    found = docs.join(counted, (F.xxhash64(row) == F.col(one)) & (F.xxhash64(row, F.lit(1)) == F.col(two)))

    def times(rows: DataFrame, count: Column) -> DataFrame:
        often = F.explode(F.array_repeat(F.lit(0), count.cast("int"))).alias(copy)
        return rows.select(*(f"`{c}`" for c in docs.columns), often).drop(copy)

    repeated = found.where(F.col(many) & (F.col(rest) > 0)).dropDuplicates([one, two])
    return times(found, F.col(whole) + F.when(F.col(many), F.lit(0)).otherwise(F.col(rest))).union(times(repeated, F.col(rest)))
