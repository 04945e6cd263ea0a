"""From raw documents to packed sequences, one operator per stage.

Every stage works on all documents that the one before kept. Documents with a null
or empty text are no prose and leave with the quality stage; a null key, source or
repeated row is kept or told apart as each stage says. The session keeps the small batches for Python that stages set.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import mixing, packing, quality, queries, shingle_sets, toxicity
from tidemark.llm.simhash import free_name
from tidemark.session import settle, small_batches

SHINGLE = 5  # words of a shingle for near duplicates
ALIKE = Fraction(4, 5)  # Jaccard similarity of the shingles from which texts count as near


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not count as toxic.

    A null or empty text is not toxic; repeated rows, null keys and columns of any names stay; no row gives no row.
    """
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    mark = free_name(docs, "verdict")
    return toxicity.marked(docs, labels, verdict=mark).where(F.col(mark)["toxic"] == 0).drop(mark)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality scorer keeps.

    A null or empty text is bad and goes; repeated rows, null keys and columns of any names stay; no row gives no row.
    """
    small_batches(spark)
    mark = free_name(docs, "verdict")
    return quality.marked(docs, verdict=mark).where(F.col(mark)["keep"]).drop(mark)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the smallest key.

    Null and empty texts are one group; of repeated rows one stays, a null key only where a group has no other;
    columns of any names stay; no row gives no row.
    """
    small_batches(spark)
    return shingle_sets.firsts(docs, "doc_id", "text", SHINGLE, ALIKE)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source of its own, a text without words is never taken; equal rows share the copies of
    all; columns of any names stay; no row gives no row.
    """
    small_batches(spark)
    return mixing.taken(docs, mixing.words("text"))


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens and at most 128 segments.

    A null or empty text is its closing id alone; repeated rows are packed each, null keys stay; other columns
    are left behind, whatever their names; no row gives no piece.
    """
    small_batches(spark)
    return packing.packed(docs, queries.byte_bpe(), limits=packing.Limits(1_024, 128, 1_024))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("quality", good),
    ("near_duplicates", distinct),
    ("mixing", mixed),
    ("packing", packs),
]

ORACLE_SQL: str | None = None  # trained models, fingerprints and packing have no SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
