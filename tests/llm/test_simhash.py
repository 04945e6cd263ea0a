from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash


def by_hand(text, size):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(prints):
    """Least index of each component, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "One", "one two", "A b C d", "x " * 500, "É é Ünder\x0bscore \x1fodd", "a b c a b c a b c"]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) == by_hand(text, 3)


def test_spark_hashes_the_same_way(spark):
    got = spark.sql("select xxhash64('The quick brown fox jumps over the lazy dog, twice')").first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"The quick brown fox jumps over the lazy dog, twice", seed=42)


def test_components_of_many_prints(spark):
    rng = np.random.default_rng(3)
    seeds = [int(x) for x in rng.integers(0, 2**63, 60)]
    prints = []
    for s in seeds:
        prints.append(s)
        for _ in range(int(rng.integers(0, 12))):
            s ^= 1 << int(rng.integers(64)) ^ 0
            prints.append(s)
    prints = list(dict.fromkeys(prints)) + [0, 1, 2**64 - 1]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x,) for x in signed], "print long")
    got = simhash.links(table, 3, tile=7).collect()
    place = {p: i for i, p in enumerate(signed)}
    assert len(got) < 40 * len(prints)
    for a, b in got:
        assert ((a ^ b) % 2**64).bit_count() <= 3
    wanted = defaultdict(set)
    for i, r in enumerate(roots(prints)):
        wanted[r].add(signed[i])
    found = defaultdict(set)
    for p, r in simhash.memberships(table, 3).collect():
        found[r].add(p)
    assert sorted(map(sorted, wanted.values())) == sorted(map(sorted, found.values()))
    assert all(min(v) == k for k, v in found.items()) and len(place) == len(prints)


def test_a_large_group_gives_a_forest():
    rng = np.random.default_rng(5)
    base = int(rng.integers(2**62))
    prints = {base ^ (1 << int(i)) ^ (1 << int(j)) for i, j in rng.integers(0, 64, (900, 2)) if i != j}
    by_ones = defaultdict(list)
    for p in prints:
        by_ones[p.bit_count()].append(p)
    for ones, group in by_ones.items():
        tile = np.array(group, np.uint64)
        found = simhash.tile_links(tile, tile, 3)
        sets = len(set(roots(group)))
        assert len(found) == len(group) - sets


def test_documents(spark):
    rows = [
        (7, "the quick brown fox jumps over the lazy dog again and again", 1.0, "x"),
        (3, "The QUICK brown fox jumps\nover the lazy dog again and again", 2.0, "y"),
        (3, "The QUICK brown fox jumps\nover the lazy dog again and again", 2.0, "y"),
        (9, None, 3.0, "z"),
        (8, "", 3.0, "z"),
        (None, "completely different words stand here today", 3.0, None),
        (1, "word " * 30_000, 0.0, "long"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, print double, component_id string")
    got = {(r[0], r[1], r[2]) for r in simhash.near_duplicates(docs).collect()}
    assert simhash.near_duplicates(docs).count() == len(rows)
    component = {k: c for k, _, c in got}
    assert component == {7: 3, 3: 3, 9: 8, 8: 8, None: None, 1: 1}
    assert {f for k, f, _ in got if k in (8, 9)} == {"0" * 16}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_all_pairs_of_the_table(spark, root):
    from tidemark.llm import queries

    got = queries.op3_simhash(spark, root).collect()
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()}
    assert len(got) == len(docs)
    prints = {k: by_hand(docs[k], 3) for k in sorted(docs)}
    assert {r.doc_id: r.fingerprint for r in got} == {k: f"{p:016x}" for k, p in prints.items()}
    keys = list(prints)
    assert {r.doc_id: r.component_id for r in got} == dict(zip(keys, (keys[i] for i in roots(list(prints.values())))))
