import hashlib
import random
import zlib

import duckdb
import pytest
import xxhash
from tidemark.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows):
    """The nodes of all rebuilt conversations, each prefix looked at by itself."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            low = xxhash.xxh64_intdigest(text.encode(), 42)
            own.setdefault(conv, []).append((turn is not None, turn, role, low - (1 << 64) * (low >> 63), text))
    own = {c: [(x[2], x[4]) for x in sorted(found, key=lambda x: (x[0], x[1] or 0, *x[2:4]))] for c, found in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    whole = {c: tuple(own.get(c - c % 100, [])[: heads[c]] + own[c][heads[c] :]) for c in own}
    members = {}
    for c, found in whole.items():
        for d in range(len(found) + 1):
            members.setdefault(found[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        ends = sorted(c for c in convs if len(whole[c]) == len(node))
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) > len(x) and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids), len(leaves), saved, sha))
    return sorted(out)


def rows_of(seed, count, longest, words):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(count * 3), count):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, count, longest, words, block", [
    (1, 150, 9, ["a", "bé", None, ""], 4), (2, 60, 30, ["a"], 4), (3, 200, 6, ["a", "b"], 2), (4, 50, 12, ["a", "b"], 1), (5, 80, 40, ["a"], 16),
])
def test_against_all_prefixes(spark, monkeypatch, seed, count, longest, words, block):
    monkeypatch.setattr(prefix_trie, "STRETCH", 4)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rows = rows_of(seed, count, longest, words)
    rows += [(None, 0, "user", "a"), (1000, None, "user", "b"), (1000, None, "user", "a"), (1000, None, "user", "a"), (1000, 3, None, None)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, kx string")
    got = prefix_trie.trie(table, block=block)
    assert got.columns == COLUMNS
    assert sorted(tuple(r) for r in got.collect()) == by_hand(rows)


def test_copies_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).collect() == []
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(7)] + [(c, 0, "user", "alone") for c in range(400, 420)]
    assert sorted(tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, schema)).collect()) == by_hand(rows)


def test_turns_are_grouped_one_by_one_only_where_conversations_part(spark):
    rows = [(c, t, "user", f"t{t}" if t < 9 else f"{t} of {c}") for c in range(100) for t in range(12)]
    found = prefix_trie.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    turns, whole = prefix_trie.rebuilt(found)
    blocks = prefix_trie.blocks_of(turns, 4).cache()
    assert blocks.where("block < 2").select("block", "kx", "ky").distinct().count() == 2
    nodes = prefix_trie.nodes_of(turns, whole, blocks, 4)
    assert {r.depth for r in nodes.where("kx IS NULL").collect()} == {1, 2, 3, 5, 6, 7}
    assert nodes.where("depth BETWEEN 1 AND 8").count() == 8 and nodes.where("depth = 9 AND n = 100").count() == 1


def test_sql_twin(spark):
    root = "/root/testdata/sf0.01"
    with duckdb.connect() as db:
        db.sql(f"create view conversations as from '{root}/conversations.parquet'")
        twin = db.sql(f"select {', '.join(COLUMNS)} from ({queries.OP13_SQL})").fetchall()
    rows = spark.read.parquet(f"{root}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert sorted(twin) == by_hand([tuple(r) for r in rows]) == sorted(tuple(r) for r in queries.op13_trie(spark, root).collect())
