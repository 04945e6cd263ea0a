"""Severity of toxic text by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.sampling import drawn
from tidemark.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 16_000  # labelled documents, in expectation at most, on which the model is fitted
FEATURES = 4_096  # features that may bear weight
GRADES = 3  # severities above 0
LEAST = 4  # fitted documents that must have a feature
SURE = 6.0  # standard errors between a feature's shares in toxic and in clean documents
STEPS = 600
PENALTY = 1e-5
REJECT = 0.15  # chance of any severity at which a document counts as toxic, at least
SPARED = 0.999  # share of the clean documents fitted that must stay below
PREFIXES = (4, 5)  # letters of word beginnings; inflected words share them
VERDICT = "__verdict"  # on the way only
SHINGLE = 5  # words, for telling copies apart

WORD = re.compile(r"\w+")


def features(text: str | None) -> set[str]:
    """Words and beginnings of longer words, each once; lower case."""
    words = set(WORD.findall((text or "").lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in PREFIXES))


def sketch(text: str | None) -> int:
    """The least hash of the ``SHINGLE``-word shingles: most near copies share it."""
    words = (text or "").lower().split()
    parts = (" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1)))
    return min(xxhash.xxh64_intdigest(p.encode(), 1) for p in parts) >> 1


class Model(NamedTuple):
    """Weights shared by all thresholds: the chance of a grade of ``k`` or more is logistic(weight - threshold k)."""

    weights: dict[str, float]
    thresholds: np.ndarray
    cut: float = REJECT

    def chances(self, texts: Sequence[str | None]) -> np.ndarray:
        """A row per text, a column per grade above 0: the chance of that grade or more."""
        words = {k: v for k, v in self.weights.items() if k[-1] != "*"}
        begins = {n: {k[:-1]: v for k, v in self.weights.items() if k[-1] == "*" and len(k) == n + 1} for n in PREFIXES}
        sums = np.zeros(len(texts))
        for i, text in enumerate(texts):
            own = set(WORD.findall((text or "").lower()))
            total = sum(words[w] for w in own & words.keys())
            for n in PREFIXES:
                held = {w[:n] for w in own if len(w) > n}
                total += sum(begins[n][b] for b in held & begins[n].keys())
            sums[i] = total
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - sums[:, None], -500, 500)))


def fit_ordinal(rows: Sequence[Sequence[int]], grades: np.ndarray, size: int, highest: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of ``size`` features and ascending thresholds of the cumulative-link model.

    Descends the mean negative log chance of the grades plus a square penalty on the
    weights. Thresholds are a first one and positive gaps, so they stay in order.
    """
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    columns = np.fromiter((c for r in rows for c in r), np.int64)
    free = np.concatenate([np.zeros(size), [2.0], np.zeros(highest - 1)])
    mean, spread = np.zeros_like(free), np.zeros_like(free)
    for step in range(1, STEPS + 1):
        gaps = np.exp(np.clip(free[size + 1 :], -20, 20))
        cuts = free[size] + np.concatenate([[0.0], np.cumsum(gaps)])
        sums = np.bincount(at, free[columns], len(rows))
        above = 1 / (1 + np.exp(np.clip(cuts[None, :] - sums[:, None], -50, 50)))
        above = np.concatenate([np.ones((len(rows), 1)), above, np.zeros((len(rows), 1))], axis=1)
        own = np.arange(len(rows))
        low, high = above[own, grades], above[own, grades + 1]
        chance = np.maximum(low - high, 1e-12)
        by_low, by_high = low * (1 - low) / chance / len(rows), high * (1 - high) / chance / len(rows)
        slope = np.zeros_like(free)
        slope[:size] = np.bincount(columns, (by_high - by_low)[at], size) + PENALTY * free[:size]
        by_cut = np.bincount(grades, by_low, highest + 1)[1:] - np.bincount(grades, by_high, highest + 1)[:-1]
        slope[size] = by_cut.sum()
        slope[size + 1 :] = np.cumsum(by_cut[::-1])[::-1][1:] * gaps
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        free -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-9)
    gaps = np.exp(np.clip(free[size + 1 :], -20, 20))
    return free[:size], free[size] + np.concatenate([[0.0], np.cumsum(gaps)])


def graded(toxic: np.ndarray, rows: Sequence[Sequence[int]], evidence: np.ndarray) -> np.ndarray:
    """Grades from labels that only say toxic or not: toxic ones in equal parts by how many features of ``evidence`` they have."""
    counts = np.array([sum(evidence[c] for c in r) for r in rows], float)
    cuts = np.quantile(counts[toxic], np.arange(1, GRADES) / GRADES) if toxic.any() else np.zeros(GRADES - 1)
    return np.where(toxic, 1 + (counts[:, None] > cuts[None, :]).sum(axis=1), 0)


def nothing() -> Model:
    """Without toxic and clean examples nothing is toxic."""
    return Model({}, np.full(GRADES, 50.0))


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str) -> Model:
    """A model from at most ``SAMPLE`` labelled documents, chosen by a hash of their key.

    Of documents with one ``sketch`` one is taken, else the words of a text that has
    thousands of copies would seem to bear meaning. The features that may bear weight are
    those whose shares differ most surely between toxic and clean documents. The chance
    from which a document counts as toxic spares ``SPARED`` of the clean ones.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    marked = marked.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    total = marked.count()
    chosen = marked.where(drawn(0.95 * SAMPLE / max(1, total), "label_id"))

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):  # the words of all documents of a batch would fill the memory
                batch = whole.slice(i, 256)
                texts = batch.column("text").to_pylist()
                found = [sorted(features(x)) for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic"), pa.array([sketch(x) for x in texts], pa.int64()), pa.array(found, pa.list_(pa.string()))],
                    ["toxic", "sketch", "features"],
                )

    # the sample's keys are broadcast: SAMPLE bounds them
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("key") == F.col("label_id"))
    rows = rows.select((F.col("toxic") > 0).alias("toxic"), "text").mapInArrow(look, "toxic boolean, sketch long, features array<string>")
    first = Window.partitionBy("sketch").orderBy(F.desc("toxic"), F.xxhash64("features"))
    seen = settle(rows, "toxic-sample")
    seen = settle(seen.withColumn("nr", F.row_number().over(first)).where("nr = 1").drop("nr"), "toxic-distinct")
    sizes = {r.toxic: r["count"] for r in seen.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return nothing()
    bad, good = sizes[True], sizes[False]
    shares = (
        seen.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum(F.col("toxic").cast("long")).alias("a"), F.sum((~F.col("toxic")).cast("long")).alias("b"))
        .where(F.col("a") + F.col("b") >= LEAST)
    )
    pooled = (F.col("a") + F.col("b")) / (bad + good)
    error = F.sqrt(pooled * (1 - pooled) * (1 / bad + 1 / good))
    sure = F.when(error > 0, (F.col("a") / bad - F.col("b") / good) / error)
    best = shares.withColumn("sure", sure).where(F.abs("sure") >= SURE).orderBy(F.abs("sure").desc(), "feature").limit(FEATURES)
    picked = settle(best.coalesce(1), "toxic-features")
    named = picked.orderBy("feature").collect()
    if not named:
        return nothing()
    place = {r.feature: i for i, r in enumerate(named)}
    evidence = np.array([r.a * good > 9 * r.b * bad for r in named])
    held = F.array_intersect("features", F.array(*map(F.lit, place)))
    examples = seen.select("toxic", held.alias("features")).collect()
    examples = sorted((r.toxic, sorted(place[x] for x in r.features)) for r in examples)
    rows_of, toxic = [r for _, r in examples], np.array([t for t, _ in examples])
    grades = graded(toxic, rows_of, evidence)
    weights, thresholds = fit_ordinal(rows_of, grades, len(place), GRADES)
    sums = np.array([weights[r].sum() for r in rows_of])
    clean = 1 / (1 + np.exp(np.clip(thresholds[0] - sums[~toxic], -500, 500)))
    cut = max(REJECT, float(np.quantile(clean, SPARED, method="higher")) * (1 + 1e-9))
    return Model(dict(zip(place, weights.tolist())), thresholds, cut)


def marked(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", verdict: str = VERDICT) -> DataFrame:
    """``docs`` with a struct ``verdict``, which must be a free name: ``severity`` (expected grade, 0 to ``GRADES``), ``grade`` (the likeliest), ``toxic`` (0 or 1).

    ``labels`` has ``doc_id`` and ``toxic``; repeats count as toxic if one is. A null text
    counts as empty; repeated rows and null keys stay; other columns pass unread, whatever
    their names; no document gives no row, and without labels of both kinds nothing is toxic.
    """
    model = fit(docs, labels, key, text)

    @F.pandas_udf("severity double, grade int, toxic int")
    def judge(texts: pd.Series) -> pd.DataFrame:
        above = model.chances(texts.tolist())
        each = -np.diff(above, axis=1, prepend=1, append=0)
        toxic = (above[:, 0] >= model.cut).astype(np.int32)
        return pd.DataFrame({"severity": above.sum(axis=1), "grade": each.argmax(axis=1).astype(np.int32), "toxic": toxic})

    return docs.withColumn(verdict, judge(docs[text]))


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the verdict of ``marked`` of every row."""
    return marked(docs.select(docs[key], docs[text]), labels, key, text).select(key, f"{VERDICT}.*")
