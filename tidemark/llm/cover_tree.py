"""Cover trees over directions, and the dual traversal that counts all close pairs of two of them.

Runs inside tasks and imports nothing of the package, so it travels with the job.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDEST = 2.0  # no two unit vectors lie further apart
ROWS = 256  # centres that are chosen, or compared, at a time
COLUMNS = 2_048
PAIRS = 32_768  # pairs whose cosines are worked out at a time
FEW = 16  # points of a ball that is not worth a node of its own: it could exclude little
MARGIN = 1e-6  # pairs this close to a bound are compared one by one


class Tree(NamedTuple):
    """Nodes in order of depth; the points of a node lie together, its centre first, as do its children."""

    first: np.ndarray
    last: np.ndarray
    child: np.ndarray
    childs: np.ndarray  # behind its last child; a leaf has none
    radius: np.ndarray  # distance of the furthest point from the centre


def units(vectors: np.ndarray) -> np.ndarray:
    """Directions; components are scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _reach(points: np.ndarray) -> float:
    return float(np.sqrt(((points - points[0]) ** 2).sum(axis=1).max())) if len(points) > 1 else 0.0


def _split(points: np.ndarray, rows: np.ndarray, radius: float) -> list[np.ndarray]:
    """``rows`` dealt to centres within ``radius``; centres are further apart than that, the first row is one."""
    parts = []
    while len(rows):
        near = points[rows[:ROWS]] @ points[rows].T >= 1 - radius * radius / 2
        taken = np.zeros(len(rows), bool)
        for i, own in enumerate(near):
            if not taken[i]:
                own = own & ~taken
                own[i] = True
                taken |= own
                parts.append(rows[own])
        rows = rows[~taken]
    return parts


def build(points: np.ndarray, small: float) -> tuple[np.ndarray, Tree]:
    """Order of the points and the tree over it.

    The radius of a level is half of the level's above; a node passes over levels that
    would not divide it, and is a leaf once all its points lie within ``small`` of its centre. A wide
    ball of few points passes over all levels: its leaves hang on the node above it.
    """
    order = np.arange(len(points))
    first, last, child, childs, radius = [0], [len(points)], [0], [0], [_reach(points)]
    node = 0
    while node < len(first):
        level = WIDEST
        while level >= radius[node] > small:
            level /= 2
        parts = _split(points, order[first[node] : last[node]], level) if radius[node] > small else []
        parts = [leaf for part in parts for leaf in (_split(points, part, small) if 1 < len(part) < FEW else [part])]
        if len(parts) > 1:
            child[node], childs[node] = len(first), len(first) + len(parts)
            at = first[node]
            for part in parts:
                order[at : at + len(part)] = part
                first.append(at)
                at += len(part)
                last.append(at)
                child.append(0)
                childs.append(0)
                radius.append(_reach(points[part]))
        node += 1
    return order, Tree(*(np.array(x) for x in (first, last, child, childs)), np.array(radius))


class Side:
    """The points of a tree in its order, with how many rows each stands for."""

    def __init__(self, tree: Tree, vectors: np.ndarray, weight: np.ndarray) -> None:
        self.tree, self.weight = tree, weight
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        self.raw, self.norm = scaled, np.sqrt((scaled * scaled).sum(axis=1))
        self.unit = self.raw / self.norm[:, None]
        self.rough = self.unit.astype(np.float32)

    def parts(self, nodes: np.ndarray) -> np.ndarray:
        """The nodes' children, of a leaf itself, narrow ones first."""
        tree = self.tree
        inner = nodes[tree.childs[nodes] > 0]
        found = np.concatenate([nodes[tree.childs[nodes] == 0], *(np.arange(tree.child[n], tree.childs[n]) for n in inner)])
        return found[np.argsort(tree.radius[found], kind="stable")]

    def single(self, nodes: np.ndarray) -> np.ndarray:
        return self.tree.last[nodes] - self.tree.first[nodes] == 1


class Links:
    """For each point the rows linked with it, and the least point that its links reach."""

    def __init__(self, points: int) -> None:
        self.count, self.label = np.zeros(points, np.int64), np.arange(points)

    def merge(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            left, right = self.label[x], self.label[y]
            if np.array_equal(left, right):
                return
            np.minimum.at(self.label, np.maximum(left, right), np.minimum(left, right))
            while not np.array_equal(self.label[self.label], self.label):
                self.label = self.label[self.label]


class Join:
    """Dual traversal of two trees (or one with itself) for pairs with a cosine of ``least`` or more.

    Two nodes are left alone when their centres are further apart than both radii and
    the wanted distance; they are counted as a whole when even their furthest points
    are near enough; else their children meet. Pairs are counted, not listed, so
    memory does not grow with the links.
    """

    def __init__(self, a: Side, b: Side, least: float) -> None:
        self.a, self.b, self.least = a, b, least
        self.wanted = float(np.sqrt(max(0.0, 2 - 2 * least)))
        self.slack = 1e-4 + a.raw.shape[1] * 2.0**-21  # of distances from products in single precision
        self.shift = 0 if a is b else len(a.weight)
        self.links = Links(len(a.weight) + (0 if a is b else len(b.weight)))
        self.compared = 0

    def run(self) -> Links:
        todo = [(np.zeros(1, int), np.zeros(1, int))]  # nodes of either side, each of which may hold links with each
        while todo:
            for x, y in self._near(*todo.pop()):
                one = self.a.single(x) & self.b.single(y)
                self._points(self.a.tree.first[x[one]], self.b.tree.first[y[one]])
                leaves = (self.a.tree.childs[x] == 0) & (self.b.tree.childs[y] == 0) & ~one
                for i, j in zip(x[leaves].tolist(), y[leaves].tolist()):
                    self._leaves(i, j)
                x, y = x[~one & ~leaves], y[~one & ~leaves]
                if self.a is self.b:
                    own = x == y
                    todo += [(x[i : i + 1], x[i : i + 1]) for i in np.flatnonzero(own)]
                    x, y = x[~own], y[~own]
                wide = self.a.tree.childs[x] > 0
                todo += [(np.array([i]), y[wide][x[wide] == i]) for i in np.unique(x[wide])]
                todo += [(x[~wide][y[~wide] == j], np.array([j])) for j in np.unique(y[~wide])]
        return self.links

    def _near(self, x: np.ndarray, y: np.ndarray):
        """Pairs of parts of the nodes that may hold a link, in batches."""
        same = self.a is self.b and np.array_equal(x, y)
        left, right = self.a.parts(x), self.b.parts(y)
        ta, tb = self.a.tree, self.b.tree
        for p in range(0, len(left), ROWS):
            rows = left[p : p + ROWS]
            for q in range(0, len(right), COLUMNS):
                columns = right[q : q + COLUMNS]
                self.compared += len(rows) * len(columns)
                cosine = self.a.rough[ta.first[rows]] @ self.b.rough[tb.first[columns]].T
                most = self.wanted + ta.radius[rows[-1]] + tb.radius[columns[-1]] + self.slack
                r, c = np.nonzero(cosine >= 1 - most * most / 2)
                far = np.sqrt(np.maximum(0, 2 - 2 * cosine[r, c].astype(float)))
                i, j = rows[r], columns[c]
                keep = far <= self.wanted + ta.radius[i] + tb.radius[j] + self.slack
                if same:
                    keep &= (i < j) | (i == j) & ~self.a.single(i)
                yield i[keep], j[keep]

    def _points(self, x: np.ndarray, y: np.ndarray) -> None:
        """Compare point by point, in double precision."""
        for i in range(0, len(x), PAIRS):
            p, q = x[i : i + PAIRS], y[i : i + PAIRS]
            cosine = np.einsum("ij,ij->i", self.a.raw[p], self.b.raw[q]) / (self.a.norm[p] * self.b.norm[q])
            p, q = p[cosine >= self.least], q[cosine >= self.least]
            np.add.at(self.links.count, p, self.b.weight[q])
            np.add.at(self.links.count, q + self.shift, self.a.weight[p])
            self.links.merge(p, q + self.shift)

    def _leaves(self, i: int, j: int) -> None:
        a, b, count = self.a, self.b, self.links.count
        p, q = np.arange(a.tree.first[i], a.tree.last[i]), np.arange(b.tree.first[j], b.tree.last[j])
        same = a is b and i == j
        apart = float(np.sqrt(((a.unit[p[0]] - b.unit[q[0]]) ** 2).sum()))
        if apart + a.tree.radius[i] + b.tree.radius[j] <= self.wanted - MARGIN:
            count[p] += b.weight[q].sum()
            if same:
                count[p] -= a.weight[p]
            else:
                count[q + self.shift] += a.weight[p].sum()
            self.links.merge(p, np.full(len(p), q[0] + self.shift))
            self.links.merge(q + self.shift, np.full(len(q), p[0]))
            return
        for s in range(0, len(p), ROWS):
            for t in range(0, len(q), COLUMNS):
                cosine = a.unit[p[s : s + ROWS]] @ b.unit[q[t : t + COLUMNS]].T
                self.compared += cosine.size
                r, c = np.nonzero(cosine >= self.least - MARGIN)
                x, y = p[s + r], q[t + c]
                self._points(x[x < y] if same else x, y[x < y] if same else y)
