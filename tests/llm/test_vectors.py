import duckdb
import numpy as np
import pytest

from tidemark.llm import neighbours, queries, top_k, vectors

SIDE = "vec_id long, embedding array<float>, vector string, id int, score double, query string"


def cosine(a, b):
    a, b = (np.asarray(x, float) for x in (a, b))
    return float((a / np.sqrt((a * a).sum()) * (b / np.sqrt((b * b).sum()))).sum())


def brute(rows, score, every, k=5):
    out = {}
    for q, v in rows.items():
        if q % every == 0:
            found = sorted(((-score(v, w), c) for c, w in rows.items() if c != q))[:k]
            out[q] = [(c, -s) for s, c in found]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def by_row(rows, score, every, k=5):
    """Answers of every query row against all rows but itself, as sorted tuples; a null id comes last in ties."""
    out = []
    for i, (q, v) in enumerate(rows):
        if q is not None and q % every == 0:
            best = sorted((-score(v, w), c is None, c or 0) for j, (c, w) in enumerate(rows) if j != i)[:k]
            out += [(q, r, None if none else c, -s) for r, (s, none, c) in enumerate(best, 1)]
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 0.5, None) for i, v in rows], SIDE)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 100)
    monkeypatch.setattr(vectors, "BLOCK", 7)
    monkeypatch.setattr(top_k, "LEAF", 8)


def some(seed=1, n=400, d=6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(d)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(200)] + [(n + 300 + i, rows[50][1]) for i in range(3)]
    return rows


def test_exact(spark, small):
    rows = some()
    bad = [(1_000, None), (1_050, [1.0, None] + [0.0] * 4), (1_100, [float("nan")] * 6), (1_150, [float("inf")] + [0.0] * 5), (None, rows[3][1]), (1_200, [])]
    got = found(top_k.top_k(table(spark, rows + bad[:4] + bad[5:]), lambda key: key % 50 == 0))
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    assert got == brute(whole, lambda a, b: sum(x * y for x, y in zip(a, b)), 50)
    # repeated rows and ids and null ids are rows like any other
    more = rows + rows[:60] + [(i, rows[i + 7][1]) for i in range(48, 53)] + [(None, rows[3][1]), (None, rows[0][1])]
    got = top_k.top_k(table(spark, more + bad[:4]), lambda key: key % 50 == 0).collect()
    whole = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in more]
    assert sorted(map(tuple, got), key=repr) == by_row(whole, lambda a, b: sum(x * y for x, y in zip(a, b)), 50)


def test_every_row_counts(spark, tmp_path):
    """Ids 0, 1, 1, 2, null: both rows of 1 and the row without an id are found, by both searches and the twin."""
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (1, [-1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [1.0, 0.0])]
    for search, score in ((top_k.top_k, lambda a, b: int(sum(np.floor(256 * np.float32(a)) * np.floor(256 * np.float32(b))))), (neighbours.neighbours, None)):
        got = sorted(map(tuple, search(table(spark, rows), lambda key: key % 50 == 0).collect()), key=repr)
        if score:
            assert got == by_row(rows, score, 50)
            table(spark, rows).select("vec_id", "embedding").write.parquet(f"{tmp_path}/e")
            con = duckdb.connect()
            con.execute(f"create view embeddings as from '{tmp_path}/e/*.parquet'")
            assert got == sorted(con.execute(queries.OP10_SQL).fetchall(), key=repr)
        else:
            want = by_row([(i, np.float32(v).tolist()) for i, v in rows], cosine, 50)
            assert [r[:3] for r in got] == [r[:3] for r in want]
            assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=0, atol=1e-12)


def test_exact_beyond_doubles(spark, small):
    rows = [(i, [float(2**20 * (i % 13 - 6) + i), float(-(2**19) * (i % 7)), 3.0e4 * i]) for i in range(120)]
    got = found(top_k.top_k(table(spark, rows), lambda key: key % 50 == 0, scale=2**8))
    whole = {i: [int(np.floor(2**8 * float(np.float32(x)))) for x in v] for i, v in rows}
    assert got == brute(whole, lambda a, b: sum(x * y for x, y in zip(a, b)), 50)


def test_cosine(spark, small):
    rows = some(2) + [(900, [0.0] * 6), (950, None)]
    got = found(neighbours.neighbours(table(spark, rows), lambda key: key % 50 == 0))
    want = brute({i: v for i, v in rows[:-2]}, cosine, 50)
    assert got.keys() == want.keys()
    for q in want:
        assert [c for c, _ in got[q]] == [c for c, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_few_and_none(spark):
    three = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (1, [0.5, 9.0])]
    assert found(neighbours.neighbours(table(spark, three), lambda key: key % 50 == 0)).keys() == {0}
    assert [c for c, _ in found(top_k.top_k(table(spark, three), lambda key: key % 50 == 0))[0]] == [1, 1, 2]
    for search in (neighbours.neighbours, top_k.top_k):
        assert search(table(spark, []), lambda key: key % 50 == 0).collect() == []
        assert search(table(spark, [(1, [1.0])]), lambda key: key % 50 == 0).collect() == []
        assert search(table(spark, [(0, [1.0])]), lambda key: key % 50 == 0).collect() == []


def test_forest_climbs_together():
    rng = np.random.default_rng(7)
    rows = neighbours.unit(rng.standard_normal((3_000, 16)))
    forest, keys = neighbours.Forest(rows), neighbours.strings(rows[:5])
    met = forest.candidates(keys, 100)
    for q, near in enumerate(met):
        agree = [max(neighbours.BITS - int(k ^ o).bit_length() for k, o in zip(keys[q], own)) for own in neighbours.strings(rows)]
        deepest = max(d for d in range(neighbours.BITS + 1) if sum(a >= d for a in agree) >= 100)
        assert sorted(near) == [i for i, a in enumerate(agree) if a >= deepest]


def test_sql_twin(spark):
    root = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view embeddings as from '{root}/embeddings.parquet'")
    want = sorted(con.execute(queries.OP10_SQL).fetchall())
    assert sorted(map(tuple, queries.op10_top_k(spark, root).collect())) == want


def test_recall(spark):
    root = "/root/testdata/sf0.1"
    got = found(queries.op9_neighbours(spark, root))
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{root}/embeddings.parquet").collect()}
    want = brute(rows, cosine, 50)
    hits = sum(len({c for c, _ in got[q]} & {c for c, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
