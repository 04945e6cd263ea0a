"""Alignment of two tokenizers over whole texts, scored by how many documents link the same ids."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.token_spans import Aligner, Bytes, Pieces
from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHARS = 1_000_000  # characters that are aligned at a time; a longer text alone
FEW = 1_000_000  # pairs of ids up to which their counts are sent to every executor, about 50 MB; more are shuffled
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def spans(docs: DataFrame, a: str, b: str, key: str, text: str) -> DataFrame:
    """Of every row, numbered by ``row``: its counts, ``groups_sha256``, the ``pairs`` of ids that it links, each once, and how many ``times``."""
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    schema = T.StructType([narrow.schema["key"]]).add("row", "long")
    for name in COUNTS:
        schema = schema.add(name, "long")
    longs = T.ArrayType(T.LongType())
    schema = schema.add("groups_sha256", "string").add("pairs", longs).add("times", longs)

    def stretches(sizes: list[int]) -> Iterator[tuple[int, int]]:
        first = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > CHARS:
                yield first, i
                first, total = i, 0
            total += size
        yield first, len(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Bytes(a), Pieces(b))
        for whole in batches:
            lengths = whole.column("text").fill_null("").cast(pa.large_string())
            for first, last in stretches([len(x) for x in lengths.to_pylist()]):
                batch = whole.slice(first, last - first)
                found = aligner.align(batch.column("text").to_pylist())
                offsets = pa.array(found.starts, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (found.pairs, found.times)]
                columns = [batch.column("key"), batch.column("row"), *(pa.array(getattr(found, n), pa.int64()) for n in COUNTS), pa.array(found.sha, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *lists], schema.names)

    return narrow.mapInArrow(run, schema)


def pair_counts(found: DataFrame, wide: int) -> DataFrame:
    """``pair``, the ``docs`` that link it, and whether it is the ``best``, or one of the best, of its first id."""
    counts = settle(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")), "pair-counts")
    own = F.floor(F.col("pair") / wide).alias("a")
    most = counts.groupBy(own).agg(F.max("docs").alias("most"))
    return counts.select("*", own).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", few: int = FEW) -> DataFrame:
    """Groups, links and scores of every document.

    Returns one row per row of ``docs``: ``key``, ``n_a`` and ``n_b`` (tokens by the byte-level
    file ``a`` and the piece file ``b``), ``n_groups`` (stretches between bytes where tokens of both end),
    ``n_links`` (pairs of tokens that share bytes), ``n_best`` (links whose pair of ids is in as many
    documents as any of its first id), ``count_sum`` (documents that hold the pair, over links) and
    ``groups_sha256``. A text that is null, empty or not given back byte for byte by both has no
    tokens: zeros and an empty digest. Repeated rows count as documents each, null keys stay, other columns
    are not read, whatever their names; an empty table gives no row. Texts of any length are aligned whole.
    """
    found = settle(spans(docs, a, b, key, text), "spans")
    pairs = settle(pair_counts(found, len(Pieces(b).bytes)), "pairs")
    links = found.select("row", F.inline(F.arrays_zip("pairs", "times")))
    known = F.broadcast(pairs) if pairs.count() <= few else pairs
    scored = links.join(known, F.col("pairs") == F.col("pair")).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
    )
    zero = F.lit(0).cast("long")
    scores = [F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")]
    return found.drop("pairs", "times").join(scored, "row", "left").select(F.col("key").alias(key), *COUNTS, *scores, "groups_sha256")
