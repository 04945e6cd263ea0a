import random
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline
import numpy as np
import pytest
from tidemark.llm import shingle_sets


def by_hand(rows):
    """Least keys of the groups that brute-force Jaccard of 0.8 or more joins."""
    sets = []
    for r in rows:
        words = (r.text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    holders, shared, root = defaultdict(list), Counter(), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, own in enumerate(sets):
        for g in own:
            shared.update((j, i) for j in holders[g])
            holders[g].append(i)
    for (a, b), n in shared.items():
        if n * 5 >= 4 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted(rows[i].doc_id for i in {find(i) for i in range(len(rows))})


@pytest.mark.parametrize("wide", [shingle_sets.WIDE, 0])
def test_every_near_copy_is_met(spark, monkeypatch, wide):
    monkeypatch.setattr(shingle_sets, "WIDE", wide)
    root = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{root}/documents.parquet")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    got = corpus_pipeline.distinct(spark, docs, root)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == by_hand(rows)


def test_threshold(spark):
    words = [f"w{i}" for i in range(48)]
    # of 44 shingles one changed word at place n costs up to 5: 39 of 49 are too few, 40 of 48 enough
    far, near = words.copy(), words.copy()
    far[20], near[3] = "x", "x"
    texts = {1: words, 2: far, 3: near}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()] + [(4, ""), (5, None), (6, "one"), (7, "ONE")], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.distinct(spark, docs, "").collect()) == [1, 2, 4, 6]
    assert corpus_pipeline.distinct(spark, docs.limit(0), "").collect() == []


def test_minima_tell_pairs_that_are_far_from_alike(spark):
    rng = random.Random(3)
    rows, wanted = [], []
    for share in (0.3, 0.5, 0.8, 0.8, 0.9):
        for n in range(40):
            common, only = int(900 * share), 900 - int(900 * share)
            both = [rng.getrandbits(64) for _ in range(common)]
            one, two = (np.array(both + [rng.getrandbits(64) for _ in range(only // 2)], np.uint64) for _ in range(2))
            rows.append((len(rows), shingle_sets.bands(one)[1], shingle_sets.bands(two)[1]))
            wanted.append(share)
    table = spark.createDataFrame(rows, "id long, a array<long>, b array<long>")
    found = {r.id: r.n for r in table.select("id", shingle_sets.mismatches("a", "b").alias("n")).collect()}
    by_hand = [sum(any((x[p * 3 + w] ^ y[p * 3 + w]) >> i & 1 for p in range(shingle_sets.PLANES)) for w in range(3) for i in range(64)) for _, x, y in rows]
    assert [found[i] for i in range(len(rows))] == by_hand
    most = shingle_sets.most_mismatches(Fraction(4, 5))
    assert all(found[i] <= most for i, s in enumerate(wanted) if s >= 0.8) and all(found[i] > most for i, s in enumerate(wanted) if s <= 0.5)


def test_fingerprints_bring_near_copies_together(spark, monkeypatch):
    planes = [0] * (shingle_sets.PLANES * shingle_sets.BANDS * shingle_sets.ROWS // 64)
    monkeypatch.setattr(shingle_sets, "bands", lambda found: ([], planes))  # nothing meets in a band
    words = [f"w{i * 7919 % 1009}" for i in range(600)]
    base = "one two three four five " * 300
    texts = [" ".join(words), " ".join(words[:-1] + ["other"]), base + "a b c d e f g h i", base + "j k l m n o p q r", "", None, "alone"]
    marks = [shingle_sets.simhash.fingerprint(t, corpus_pipeline.SHINGLE) for t in texts]
    assert all((marks[i] ^ marks[i + 1]).bit_count() <= shingle_sets.RADIUS for i in (0, 2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = corpus_pipeline.distinct(spark, docs, "")
    # the second two have near fingerprints, but unlike sets
    assert sorted(r.doc_id for r in got.collect()) == [0, 2, 3, 4, 6]


def test_maps_never_tell_too_few_shared(spark):
    rng = random.Random(5)
    rows, wanted = [], []
    for size in (0, 1, 30, 150, 600, 5_000):
        for share in (0.0, 0.5, 0.8, 1.0):
            both = [rng.getrandbits(64) for _ in range(int(size * share))]
            one, two = (np.unique(np.array(both + [rng.getrandbits(64) for _ in range(size - len(both))], np.uint64)) for _ in range(2))
            rows.append((len(rows), shingle_sets.cells(one), shingle_sets.cells(two), len(one), len(two)))
            wanted.append(len(both))
    table = spark.createDataFrame(rows, "id long, a array<long>, b array<long>, m int, n int")
    found = {r.id: r.most for r in table.select("id", shingle_sets.most_shared("a", "b", "m", "n").alias("most")).collect()}
    assert all(found[i] >= n for i, n in enumerate(wanted))
    assert all(found[i] <= n + 30 for i, n in enumerate(wanted) if len(rows[i][1]) and rows[i][3] <= 150)


def test_few_of_a_large_group_are_compared(spark, monkeypatch):
    rng, counts, real = random.Random(9), [], shingle_sets.alike
    monkeypatch.setattr(shingle_sets, "alike", lambda pairs, *x: counts.append(pairs.count()) or real(pairs, *x))
    words = [f"w{i}" for i in range(150)]

    def edited(n, times):
        own = words.copy()
        for k, at in enumerate(rng.sample(range(5, 145), times)):
            own[at] = f"x{n}y{k}"
        return " ".join(own)

    # 60 that are like each other, and 150 that are like none of these, but nearly so (0.6 to 0.75)
    rows = [(i, edited(i, 1 if i < 60 else 4)) for i in range(210)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.distinct(spark, docs, "").collect())
    assert got == by_hand(docs.collect())
    assert len(got) > 130 and sum(counts) < 5 * len(rows), counts
