"""Weak-label quality classifier: voters, their accuracies by expectation-maximisation, a hashed linear scorer."""

from __future__ import annotations

import operator
import sys
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.sampling import drawn

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 20_000  # documents, in expectation and at most, on which the scorer is fitted
BUCKETS = 1 << 14  # of hashed features
ROUNDS = 200  # of expectation-maximisation, which ends earlier when it stands still
STEPS = 300  # of the scorer's descent
SMOOTH = 1.0  # added to every count of the vote table
PENALTY = 1e-5
KEEP = 0.5
VERDICT = "__verdict"  # on the way only
BAD, NONE, GOOD = 0, 1, 2

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_MARKS = bytes(b for b in range(33, 127) if bytes([b]) not in (_UPPER + _LOWER + _DIGITS))
_STOPS = b".,;:?"
#: Letters become x or X, digits 9; other bytes stay, those of other scripts count as small letters.
_SHAPE = bytes.maketrans(_UPPER + _LOWER + _DIGITS + bytes(range(128, 256)), b"X" * 26 + b"x" * 26 + b"9" * 10 + b"x" * 128)

#: Frequent function words of the four languages.
FUNCTION_WORDS = frozenset(
    "the of and to in is that for it was on with as be by this at from are or an have not"
    " der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als"
    " le la les de et un une du des que qui dans pour par sur est au plus"
    " el los las del en y que una por con para su al lo como más".encode().split()
)


class Look(NamedTuple):
    """What is counted in a text; all voters and features derive from it."""

    words: list[bytes]
    counts: Counter
    lines: Counter
    upper: int
    lower: int
    digits: int
    marks: int
    ends: int
    pipes: int
    repeats: int


def look(text: str | None) -> Look:
    raw = (text or "").encode()
    words = raw.split()

    def count(which: bytes) -> int:
        return len(raw) - len(raw.translate(None, which))

    lines = Counter(x for x in raw.split(b"\n") if x.strip())
    upper, digits, marks = count(_UPPER), count(_DIGITS), count(_MARKS)
    lower = len(raw) - upper - digits - marks - count(_SPACE)
    repeats = sum(map(operator.eq, words, words[1:]))
    return Look(words, Counter(words), lines, upper, lower, digits, marks, count(_STOPS), raw.count(b"|"), repeats)


def _above(value: float, bad: float, good: float) -> int:
    return BAD if value > bad else GOOD if value < good else NONE


def votes(x: Look) -> list[int]:
    """A vote of each voter: bad, none or good. Few words leave most without a vote."""
    n = len(x.words)
    if not n:
        return [BAD] + [NONE] * (VOTERS - 1)
    letters = max(1, x.upper + x.lower)
    long_enough = n >= 20
    function = sum(x.counts[w] for w in FUNCTION_WORDS) / n
    total = sum(len(k) * c for k, c in x.lines.items())
    repeated = sum(len(k) * (c - 1) for k, c in x.lines.items()) / max(1, total)
    return [
        _above((x.marks - x.ends) / (letters + x.marks), 0.2, 0.04),
        _above(x.upper / letters, 0.4, 0.12),
        _above(x.pipes / n, 0.1, 0.01),
        _above(max(x.counts.values()) / n, 0.35, 0.15) if long_enough else NONE,
        _above(x.repeats / n, 0.2, 0.05) if long_enough else NONE,
        _above(repeated, 0.5, 0.2) if sum(x.lines.values()) > 3 else NONE,
        (GOOD if function > 0.12 else BAD if function < 0.02 else NONE) if long_enough else NONE,
        (GOOD if 0.02 < x.ends / n < 0.5 else BAD if x.ends / n < 0.005 else NONE) if n >= 50 else NONE,
        _above(x.digits / (letters + x.digits), 0.3, 0.1),
        _above(abs(letters / n - 6.0), 6.0, 3.5),
        _above(1 - len(x.counts) / n, 0.9, 0.6) if long_enough else NONE,
    ]


VOTERS = 11


class Labels(NamedTuple):
    """``good``: share of good documents; ``table[voter, class, vote]``: chance of a vote of those who cast one.

    Not to vote tells nothing, as most voters stay silent on short texts.
    """

    good: float
    table: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of good for rows of votes."""
        logs = np.log(self.table)[np.arange(patterns.shape[1]), :, patterns].sum(axis=1)
        odds = logs[:, 1] - logs[:, 0] + np.log(self.good) - np.log1p(-self.good)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray) -> Labels:
    """Share of good documents and each voter's chances, from how often each row of votes occurs.

    Voters are taken as independent given the class. In the first guess a vote
    weighs the more the rarer it is among those of its voter; this also says which
    class is the good one.
    """
    cast = np.stack([((patterns == v) * counts[:, None]).sum(axis=0) for v in (BAD, GOOD)]) + SMOOTH
    rare = -np.log(cast / cast.sum(axis=0))
    good = 0.5 + 0.4 * np.sign((patterns == GOOD) @ rare[1] - (patterns == BAD) @ rare[0])
    for _ in range(ROUNDS):
        weight = np.stack([(1 - good) * counts, good * counts])
        table = np.stack([(weight[:, None, :] * (patterns.T == v)).sum(axis=2).T for v in (BAD, NONE, GOOD)], axis=2)
        table[:, :, NONE] = 0
        table = table + SMOOTH * (np.arange(3) != NONE)
        table /= table.sum(axis=2, keepdims=True)
        table[:, :, NONE] = 1
        prior = (weight[1].sum() + SMOOTH) / (counts.sum() + 2 * SMOOTH)
        labels = Labels(float(prior), table)
        before, good = good, labels.posterior(patterns)
        if np.abs(good - before).max() < 1e-9:
            break
    return labels


def features(x: Look, memo: dict[bytes, int]) -> dict[int, float]:
    """Hashed features and how large a share of the words has each.

    Shapes of word ends with the case of the first letter, function words, words
    that repeat the one before, repeated words and lines, and the length in powers of two.
    """
    n = max(1, len(x.words))
    shares: Counter = Counter(w[:1] + w[-3:] for w in b" ".join(x.words).translate(_SHAPE).split())
    found: dict[int, float] = {}

    def add(name: bytes, share: float) -> None:
        bucket = memo.get(name)
        if bucket is None:
            bucket = memo[name] = zlib.crc32(name) % BUCKETS
        found[bucket] = found.get(bucket, 0.0) + share

    for shape, count in shares.items():
        add(b"shape " + shape, count / n)
    for w in FUNCTION_WORDS & x.counts.keys():
        add(b"word " + w, x.counts[w] / n)
    add(b"repeats", x.repeats / n)
    add(b"distinct", len(x.counts) / n)
    add(b"top", max(x.counts.values(), default=0) / n)
    lines = sum(x.lines.values())
    add(b"lines", len(x.lines) / lines if lines else 0.0)
    add(b"length %d" % len(x.words).bit_length(), 1.0)
    return found


class Scorer(NamedTuple):
    weights: np.ndarray
    bias: float

    def score(self, found: dict[int, float]) -> float:
        z = self.bias + sum(self.weights[b] * v for b, v in found.items())
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def fit_scorer(rows: Sequence[dict[int, float]], good: np.ndarray) -> Scorer:
    """Logistic regression on soft labels, by accelerated descent with steps of adapted size."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    columns = np.fromiter((b for r in rows for b in r), np.int64)
    values = np.fromiter((v for r in rows for v in r.values()), float)
    weights, bias = np.zeros(BUCKETS), 0.0
    mean, spread = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(at, values * weights[columns], len(rows)) + bias
        slip = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - good) / max(1, len(rows))
        slope = np.append(np.bincount(columns, values * slip[at], BUCKETS) + PENALTY * weights, slip.sum())
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.99 * spread + 0.01 * slope**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Scorer(weights, float(bias))


def vote_column(text: str):
    """Votes of each text as an array."""

    @F.pandas_udf(T.ArrayType(T.ByteType()))
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([votes(look(x)) for x in texts])

    return of(F.col(text))


def fit(docs: DataFrame, key: str, text: str) -> tuple[Labels, Scorer]:
    """The label model from the votes on all documents, the scorer from a sample of at most ``SAMPLE``.

    At most 3 to the power of ``VOTERS`` rows of counts reach the driver, whatever the number of documents.
    """
    counted = docs.groupBy(vote_column(text).alias("votes")).count().collect()
    if not counted:
        return Labels(0.5, np.full((VOTERS, 2, 3), 1 / 3)), Scorer(np.zeros(BUCKETS), 0.0)
    counted.sort(key=lambda r: r.votes)
    patterns, counts = np.array([r.votes for r in counted]), np.array([r["count"] for r in counted], float)
    labels = expectation_maximisation(patterns, counts)
    chosen = drawn(0.95 * SAMPLE / counts.sum(), key, text)

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for batch in batches:
            cast, found = [], []
            for text in batch.column("text").to_pylist():
                seen = look(text)
                cast.append(votes(seen))
                found.append(features(seen, memo))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cast, pa.list_(pa.int8())),
                    pa.array([list(f) for f in found], pa.list_(pa.int32())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.float32())),
                ],
                ["votes", "buckets", "shares"],
            )

    schema = "votes array<tinyint>, buckets array<int>, shares array<float>"
    rows = docs.where(chosen).select(F.col(text).alias("text")).mapInArrow(sampled, schema).collect()
    if not rows:
        return labels, Scorer(np.zeros(BUCKETS), float(np.log(labels.good) - np.log1p(-labels.good)))
    rows.sort(key=lambda r: (r.votes, r.buckets, r.shares))
    good = labels.posterior(np.array([r.votes for r in rows]))
    return labels, fit_scorer([dict(zip(r.buckets, r.shares)) for r in rows], good)


def marked(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = KEEP, verdict: str = VERDICT) -> DataFrame:
    """``docs`` with a struct ``verdict``, which must be a free name: ``score`` of the scorer, ``posterior`` of the label model, ``keep``.

    A null text counts as empty, which the first voter calls bad. Repeated rows and null keys
    stay; other columns pass unread, whatever their names; no document gives no row.
    """
    labels, scorer = fit(docs.select(docs[key].alias("key"), docs[text].alias("text")), "key", "text")

    @F.pandas_udf("score double, posterior double, keep boolean")
    def judge(texts: pd.Series) -> pd.DataFrame:
        memo: dict[bytes, int] = {}
        scores, cast = np.zeros(len(texts)), np.zeros((len(texts), VOTERS), int)
        for i, text in enumerate(texts):  # one at a time, as the words of a batch would fill the memory
            seen = look(text)
            scores[i], cast[i] = scorer.score(features(seen, memo)), votes(seen)
        return pd.DataFrame({"score": scores, "posterior": labels.posterior(cast), "keep": scores >= threshold})

    return docs.withColumn(verdict, judge(docs[text]))


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = KEEP) -> DataFrame:
    """``key`` and the verdict of ``marked`` of every row."""
    return marked(docs.select(docs[key], docs[text]), key, text, threshold).select(key, f"{VERDICT}.*")
