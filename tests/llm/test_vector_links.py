import math

import numpy as np
import pytest
from tidemark.llm import cover_tree, vector_links


def by_hand(rows, least):
    """(key, n_links, component_id, kept) of every row, all pairs compared one by one."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    roots, links = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while roots[i] != i:
            i = roots[i]
        return i

    for i, (_, v) in enumerate(rows):
        for j in range(i):
            w = rows[j][1]
            if good[i] and good[j] and np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                links[i], links[j] = links[i] + 1, links[j] + 1
                roots[top(i)] = top(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [k for k in groups[top(i)] if k is not None]
        component = min(keys) if keys else None
        out.append((key, links[i], component, key == component))
    return sorted(out, key=str)


def clustered(rng, count, width, spread):
    centres = rng.normal(size=(max(1, count // 8), width))
    return centres[rng.integers(len(centres), size=count)] + rng.normal(size=(count, width)) * spread


@pytest.mark.parametrize("width, spread, least, shard", [(8, 0.25, 0.9, 50), (4, 0.5, 0.9, 64), (16, 0.1, 0.8, 1000), (2, 1.0, 0.97, 30)])
def test_against_all_pairs(spark, width, spread, least, shard):
    rng = np.random.default_rng(width)
    vectors = clustered(rng, 400, width, spread).round(3).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, vectors[i % 7]) for i in range(60)]
    rows += [(3, vectors[9]), (None, vectors[11]), (None, [1e200] * width), (2000, [1e-200] * width)]
    rows += [(2001, None), (2002, []), (2003, [0.0] * width), (2004, [math.nan] * width), (2005, [None] * width), (None, None)]
    rows += [(2006, [math.inf] + [1.0] * (width - 1)), (2007, [2 * x for x in vectors[5]])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, node string, n int")
    got = vector_links.linked(table, least=least, shard=shard)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows = [(k, None if v is None else [x if x is None or not abs(x) in (1e200, 1e-200) else 1.0 for x in v]) for k, v in rows]
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(rows, least)


def test_empty_and_useless(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_links.linked(table).collect() == []
    table = spark.createDataFrame([(4, [0.0, 0.0]), (4, None)], table.schema)
    assert sorted(tuple(r) for r in vector_links.linked(table).collect()) == [(4, 0, 4, True)] * 2
    table = spark.createDataFrame([(4, [1.0, 0.0]), (5, [1.0])], table.schema)
    with pytest.raises(ValueError, match="components"):
        vector_links.linked(table)


def test_tree_covers_and_prunes():
    rng = np.random.default_rng(3)
    points = cover_tree.units(clustered(rng, 600, 6, 0.05))
    order, tree = cover_tree.build(points, 0.2)
    assert sorted(order) == list(range(600))
    points = points[order]
    for node in range(len(tree.first)):
        own = points[tree.first[node] : tree.last[node]]
        assert np.sqrt(((own - own[0]) ** 2).sum(axis=1)).max() <= tree.radius[node] + 1e-12
        if tree.childs[node]:
            kids = range(tree.child[node], tree.childs[node])
            assert [tree.first[k] for k in kids] == [tree.first[node], *(tree.last[k] for k in kids[:-1])]
            assert tree.last[kids[-1]] == tree.last[node] and tree.first[kids[0]] == tree.first[node]
            assert max(tree.radius[k] for k in kids) <= tree.radius[node] + 1e-9
        else:
            assert tree.radius[node] <= 0.2
    join = cover_tree.Join(side := cover_tree.Side(tree, points, np.ones(600, np.int64)), side, 0.95)
    counts = join.run().count
    assert counts.tolist() == ((points @ points.T >= 0.95).sum(axis=1) - 1).tolist()
    assert join.compared < 600 * 600 / 10


def test_close_groups_are_counted_not_listed():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=8) + rng.normal(size=(3000, 8)) * 1e-3
    order, tree = cover_tree.build(cover_tree.units(vectors), 0.2)
    side = cover_tree.Side(tree, vectors[order], np.full(3000, 2, np.int64))
    join = cover_tree.Join(side, side, 0.9)
    links = join.run()
    assert set(links.count.tolist()) == {2 * 2999} and set(links.label.tolist()) == {0} and join.compared == 1
