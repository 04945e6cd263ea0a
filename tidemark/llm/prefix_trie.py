"""Trie of conversations by shared first turns, met in blocks of turns before single turns."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from operator import and_
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 4  # turns of a block
STRETCH = 1_024  # rows of a key that one window orders
PIECE = 4_096  # ids that are joined before they are sent on
NODE = ["depth", "kx", "ky"]


def numbered(rows: DataFrame, key: str, order: Sequence[str], number: str) -> DataFrame:
    """``rows`` with their ``number`` (from 1) within ``key``, in ``order``; a key of any size is spread over tasks by its order."""
    parts = rows.repartitionByRange(key, *order, F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id())
    parts = settle(parts, "ordered")
    sizes = parts.groupBy(key, "part").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(key, "part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy(key, "part").orderBy(*order))
    return parts.withColumn(number, within).join(sizes, [key, "part"]).withColumn(number, F.col("before") + F.col(number)).drop("before", "part")


def running(
    rows: DataFrame, key: str, at: str, names: Sequence[str], total: Callable[[str], Column], add: Callable[[Column, Column], Column], back: bool = False
) -> DataFrame:
    """``rows`` with each of ``names`` totalled over the rows of its ``key`` up to and with it (``back``: from it on), in the order of ``at``.

    Stretches of a key are totalled on their own and then shifted, so a long key is no single task.
    """
    def way(column: str) -> Column:
        return F.desc(column) if back else F.asc(column)

    parts = rows.withColumn("stretch", F.floor(F.col(at) / STRETCH))
    sums = parts.groupBy(key, "stretch").agg(*(total(n).alias(n) for n in names))
    earlier = Window.partitionBy(key).orderBy(way("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, "stretch", *(F.coalesce(total(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in names))
    within = Window.partitionBy(key, "stretch").orderBy(way(at)).rowsBetween(Window.unboundedPreceding, 0)
    inside = parts.withColumns({n: total(n).over(within) for n in names}).join(sums, [key, "stretch"])
    return inside.withColumns({n: add(F.col(n), F.col(f"{n}_before")) for n in names}).select(*rows.columns)


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv``, ``pos`` (from 1), two 64-bit marks ``x``, ``y`` of role and text, and the ``chars`` of the text, of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    kept = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), role.alias("role"), F.xxhash64(text).alias("hash"),
        F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit(1), text, role).alias("y"), F.length(text).cast("long").alias("chars"),
    )
    return numbered(kept, "conv", ["turn", "role", "hash"], "pos").select("conv", F.col("pos").cast("long").alias("pos"), "x", "y", "chars")


def rebuilt(found: DataFrame, heads: int = 6, every: int = 100) -> tuple[DataFrame, DataFrame]:
    """The conversations that are compared: turns (``conv``, ``depth``, marks, ``chars``), and all of them with their ``size``.

    Conversation c has the first h turns of conversation c - c % ``every``, then its own after its
    first h, with h = crc32(c) % ``heads``.
    """
    known = found.groupBy("conv").agg(F.max("pos").alias("own"))
    asked = known.select("conv", "own", (F.col("conv") - F.col("conv") % every).alias("base"), (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h"))
    bases = known.select(F.col("conv").alias("base"), F.col("own").alias("there"))
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    size = taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    whole = settle(asked.join(bases, "base", "left").select("conv", "base", "h", taken.alias("taken"), size.alias("size")), "conversations")
    first = found.where(F.col("pos") < heads).select(F.col("conv").alias("base"), "pos", "x", "y", "chars")
    lent = whole.where("taken > 0").join(first, "base").where("pos <= taken").select("conv", F.col("pos").alias("depth"), "x", "y", "chars")
    own = found.join(whole.select("conv", "h", "taken"), "conv").where("pos > h").select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "x", "y", "chars")
    return lent.union(own), whole.select("conv", "size")


def blocks_of(rows: DataFrame, block: int) -> DataFrame:
    """For each ``conv`` and ``block`` of turns: its ``end`` depth, and the marks of all turns before it (``bx``, ``by``) and up to its end (``kx``, ``ky``)."""
    marks = rows.select("conv", "depth", F.floor((F.col("depth") - 1) / block).alias("block"), *marked())
    own = marks.groupBy("conv", "block").agg(F.max("depth").alias("end"), F.bit_xor("x").alias("ox"), F.bit_xor("y").alias("oy"))
    ends = running(own.withColumns({"kx": F.col("ox"), "ky": F.col("oy")}), "conv", "block", ["kx", "ky"], F.bit_xor, _xor)
    return ends.select("conv", "block", "end", "kx", "ky", _xor(F.col("kx"), F.col("ox")).alias("bx"), _xor(F.col("ky"), F.col("oy")).alias("by"))


def marked() -> list[Column]:
    """The marks of a turn at its place; marks of a sequence are the exclusive-or of its turns'."""
    return [F.xxhash64("x", "depth").alias("x"), F.xxhash64("y", "depth").alias("y")]


def nodes_of(rows: DataFrame, whole: DataFrame, blocks: DataFrame, block: int) -> DataFrame:
    """Every node once: its smallest member ``conv``, ``depth``, members ``n``, ``chars`` of its last text, marks ``kx``, ``ky`` and its parent's ``px``, ``py``.

    Conversations that agree before a block are grouped by the marks of the whole block. Where
    all of a group agree on it, its turns are those of the smallest member, and only the last of them
    gets marks; where they part, every turn is grouped by its own marks.
    """
    before = ["block", "bx", "by"]
    groups = blocks.groupBy(*before).agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.min(F.struct("kx", "ky")).alias("low"), F.max(F.struct("kx", "ky")).alias("high")
    )
    groups = settle(groups, "block-groups")
    dealt = rows.withColumn("block", F.floor((F.col("depth") - 1) / block))
    alike = blocks.join(groups.where("low = high").select(*before, "conv", "n"), [*before, "conv"])
    last, begins = F.col("depth") == F.col("end"), F.col("depth") == F.col("block") * block + 1
    even = dealt.join(alike, ["conv", "block"]).select(
        "conv", "depth", "n", "chars", *(F.when(last, F.col(k)).alias(k) for k in ("kx", "ky")), *(F.when(begins, F.col(b)).alias(p) for b, p in (("bx", "px"), ("by", "py")))
    )
    parting = blocks.join(groups.where("low <> high").select(*before), before).select("conv", "block", "bx", "by")
    split = dealt.join(parting, ["conv", "block"]).select("conv", "block", "depth", "chars", "bx", "by", *marked())
    upto = Window.partitionBy("conv", "block").orderBy("depth")
    split = split.withColumns({k: _xor(F.bit_xor(m).over(upto), F.col(b)) for k, m, b in (("kx", "x", "bx"), ("ky", "y", "by"))})
    ancestors = [_xor(F.col("kx"), F.col("x")).alias("px"), _xor(F.col("ky"), F.col("y")).alias("py")]
    odd = split.select(*NODE, "conv", "chars", *ancestors).groupBy(*NODE, "px", "py").agg(F.min("conv").alias("conv"), F.count("*").alias("n"), F.max("chars").alias("chars"))
    names = ["conv", "depth", "n", "chars", "kx", "ky", "px", "py"]
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = whole.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0")
    root = root.select("conv", zero.alias("depth"), "n", zero.alias("chars"), zero.alias("kx"), zero.alias("ky"), none.alias("px"), none.alias("py"))
    return even.select(*names).union(odd.select(*names)).union(root)


def digests(ends: DataFrame) -> DataFrame:
    """``ends_sha256`` of each node (``depth``, ``kx``, ``ky``): its ``conv`` numbers, ascending and comma-joined.

    Numbers are first put in order over all tasks and joined to pieces; the pieces of a
    node then run through one hash, one after another, however many there are.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, out = None, None, [], []

        def cut() -> None:
            if ids:
                out.append((*node, first, ",".join(ids)))
                ids.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != node or len(ids) >= PIECE:
                    cut()
                    node, first = row[:3], row[3]
                ids.append(str(row[3]))
            if len(out) >= PIECE:
                yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema)
                out.clear()
        cut()
        yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out = []
        for node, own in groupby(rows, key=lambda row: row[:3]):
            state = hashlib.sha256()
            for i, row in enumerate(own):
                state.update(("," if i else "").encode() + row[4].encode())
            out.append((*node, state.hexdigest()))
            if len(out) >= PIECE:
                yield pa.RecordBatch.from_pylist([dict(zip(given, x)) for x in out], done)
                out = []
        yield pa.RecordBatch.from_pylist([dict(zip(given, x)) for x in out], done)

    names, given = [*NODE, "first", "ids"], [*NODE, "ends_sha256"]
    schema = pa.schema([(n, pa.int64()) for n in names[:4]] + [("ids", pa.string())])
    done = pa.schema([(n, pa.int64()) for n in NODE] + [("ends_sha256", pa.string())])
    longs = "depth long, kx long, ky long"
    ordered = ends.select(*NODE, "conv").repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
    joined = ordered.mapInArrow(pieces, f"{longs}, first long, ids string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(hashed, f"{longs}, ends_sha256 string")


def chain_totals(chains: DataFrame) -> DataFrame:
    """``leaves`` and ``saved`` of each chain (``conv``, hung on chain ``up`` or none) with all chains below it.

    Each round adds what hangs twice as far below, so rounds are the logarithm of how deep
    chains hang on chains, itself at most the turns of the longest conversation.
    """
    state = settle(chains, "chains")
    while not state.where("up IS NOT NULL").isEmpty():
        added = state.where("up IS NOT NULL").groupBy("up").agg(F.sum("leaves").alias("more"), F.sum("saved").alias("besides"))
        above = state.select(F.col("conv").alias("up"), F.col("up").alias("next"))
        moved = state.join(above, "up", "left").join(added.withColumnRenamed("up", "conv"), "conv", "left")
        state = settle(moved.select(
            "conv", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("besides", F.lit(0))).alias("saved")
        ), "chains")
    return state.select("conv", "leaves", "saved")


def trie(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK,
    build: Callable[[DataFrame], tuple[DataFrame, DataFrame]] = rebuilt,
) -> DataFrame:
    """One row per distinct sequence of first turns (a node) of the rebuilt conversations.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: null), ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (over the subtree,
    members but one times the code points of a node's last text) and ``ends_sha256`` of the members that
    end here. Turns are ordered by ``turn``, null first, then by role and the hash of the text, so equal
    rows count as turns of their own. A null role or text is empty; turns without a conversation
    belong to none and are left out. Other columns are not read, whatever their names; an empty
    table has no node. Sequences are told apart by 128 bits of hash.
    ``build`` makes the compared conversations of the numbered turns.
    """
    rows, whole = build(settle(turns(conversations, conv, turn, role, text), "turns"))
    rows = settle(rows, "rebuilt")
    blocks = settle(blocks_of(rows, block), "blocks")
    nodes = settle(nodes_of(rows, whole, blocks, block), "nodes")

    # a chain is the nodes of one smallest member, one below another; its top hangs on another chain
    parents = nodes.where("kx IS NOT NULL").select((F.col("depth") + 1).alias("depth"), F.col("kx").alias("px"), F.col("ky").alias("py"), F.col("conv").alias("up"))
    tops = nodes.where("px IS NOT NULL").join(parents, ["depth", "px", "py"]).where("up <> conv").select("conv", "depth", "up")
    tops = settle(tops, "tops")
    hung = tops.groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("hung"))
    bottom = nodes.groupBy("conv").agg(F.max("depth").alias("bottom"))
    counted = nodes.join(bottom, "conv").join(hung, ["conv", "depth"], "left").select(
        "conv", "depth", "n", "kx", "ky", (F.coalesce("hung", F.lit(0)) + (F.col("depth") < F.col("bottom")).cast("long")).alias("n_children"),
        ((F.col("n") - 1) * F.col("chars")).alias("saved"),
    )
    counted = settle(counted.withColumn("leaves", (F.col("n_children") == 0).cast("long")), "counted")
    own = counted.groupBy("conv").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = chain_totals(own.join(tops.select("conv", "up"), "conv", "left").select("conv", "up", "leaves", "saved"))
    below = tops.join(totals, "conv").groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.sum("leaves").alias("more"), F.sum("saved").alias("besides"))
    with_hung = counted.join(below, ["conv", "depth"], "left").select(
        "conv", "depth", "n", "n_children", "kx", "ky", (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("besides", F.lit(0))).alias("saved")
    )
    summed = running(with_hung, "conv", "depth", ["leaves", "saved"], F.sum, _plus, back=True)

    ended = blocks.join(whole, "conv").where("end = size").select("conv", F.col("end").alias("depth"), "kx", "ky")
    zero = F.lit(0).cast("long")
    ended = ended.union(whole.where("size = 0").select("conv", zero, zero, zero))
    shas = digests(ended)
    above = tops.select("conv", "depth", "up")
    parent = F.coalesce("up", F.when(F.col("depth") > 0, F.col("conv")))
    none = hashlib.sha256(b"").hexdigest()
    return summed.join(above, ["conv", "depth"], "left").join(shas, NODE, "left").select(
        F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
