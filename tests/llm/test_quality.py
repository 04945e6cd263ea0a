import numpy as np

from tidemark.llm import quality as q
from tidemark.llm import queries

SIDE = "doc_id long, text string, score string, keep string, votes int"


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(40_000) < 0.8
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.85])
    cast = rng.random((len(good), 5)) < 0.8
    votes = np.where(rng.random((len(good), 5)) < right, good[:, None], ~good[:, None])
    patterns = np.where(cast, np.where(votes, q.GOOD, q.BAD), q.NONE)
    rows, counts = np.unique(patterns, axis=0, return_counts=True)
    labels = q.expectation_maximisation(rows, counts.astype(float))
    assert abs(labels.good - 0.8) < 0.02
    assert np.allclose(labels.table[:, 1, q.GOOD], right, atol=0.03)
    assert np.allclose(labels.table[:, 0, q.BAD], right, atol=0.03)
    assert ((labels.posterior(patterns) > 0.5) == good).mean() > 0.95


def test_voters_on_plain_cases():
    prose = "The people of the town walked to the river, and it was late. " * 8
    assert q.BAD not in q.votes(q.look(prose))[:3]
    assert q.votes(q.look("%%% &&& a$$$ b### c***"))[0] == q.BAD
    assert q.votes(q.look("SHOUT AT ALL OF THEM"))[1] == q.BAD
    assert q.votes(q.look("a | b | c | d"))[2] == q.BAD
    assert q.votes(q.look("same " * 40))[4] == q.BAD and q.votes(q.look("x y z\n" * 9))[5] == q.BAD
    for empty in (None, "", " \n\t"):
        assert q.votes(q.look(empty))[0] == q.BAD and len(q.votes(q.look(empty))) == q.VOTERS
        assert q.features(q.look(empty), {})


def test_scorer_separates():
    rows = [{1: 0.9, 2: 0.1}, {1: 0.8, 3: 0.2}, {4: 1.0}, {4: 0.7, 2: 0.3}] * 20
    scorer = q.fit_scorer(rows, np.array([0.95, 0.9, 0.05, 0.1] * 20))
    assert min(scorer.score(r) for r in rows[:2]) > 0.8 and max(scorer.score(r) for r in rows[2:4]) < 0.2


def test_edges(spark):
    rows = [(i, "The old man of the sea went home, and the boat was lost in the storm of that night. " * 3 + str(i), "s", "k", 1) for i in range(40)]
    rows += [(None, None, None, None, None), (7, "", "", "", 0), (7, "", "", "", 0), (99, "%%%&&& " * 20_000, "", "", 3)]
    docs = spark.createDataFrame(rows, SIDE)
    got = q.judged(docs).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "score", "posterior", "keep"}
    keep = {r.doc_id: r.keep for r in got}
    assert keep[3] and not keep[99] and not keep[None]
    assert q.judged(docs.limit(0)).collect() == []


def test_held_out_labels(spark):
    root = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{root}/labels.parquet").collect()}
    got = queries.op2_quality(spark, root).collect()
    assert len(got) == 10_000
    good = [r.keep for r in got if labels.get(r.doc_id) == 1]
    bad = [r.keep for r in got if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05
