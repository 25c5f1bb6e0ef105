"""Cover trees over blocks of unit vectors, and dual traversal of two of them.

Level by level the radius halves: a node's children are centers more than half its
radius apart that cover its points, its own center among them, so centers are
nested. A node that is small, or whose points the next radius does not gather, is a
leaf. Two nodes are dropped when their covering radii cannot bring points as close
as the threshold, taken whole when they cannot keep points further apart, and opened
otherwise. Leaves are compared in single precision; what rounding could decide is
computed again in double precision. Nothing is approximate.
"""

from __future__ import annotations

import numpy as np

#: Guards the bounds against rounding; pairs within it are decided by their cosine.
SLACK = 1e-6
#: Points of a node that is not split, children of a node, points that are compared at once, and pairs of points
#: that are compared in the time that a pair of nodes takes besides.
SMALL, CHILDREN, SLAB, COST = 64, 64, 1024, 40_000


def unit_vectors(raw: np.ndarray) -> np.ndarray:
    """Rows in double precision and of length 1; no row is zero."""
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def places(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is true, which is quicker than by ``nonzero`` where little is."""
    return np.divmod(np.flatnonzero(true), true.shape[1])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


class Tree:
    """Points ordered so that every node is a range of them."""

    def __init__(self, raw: np.ndarray, least_radius: float = 2.0**-8):
        self.order = np.arange(len(raw))
        self.least_radius = least_radius
        #: start, end, center (a position), covering radius, children
        self.nodes: list[tuple[int, int, int, float, list[int]]] = []
        exact = unit_vectors(raw)
        self.root = self._build(exact, 0, len(raw), 2.0)
        self.raw = raw[self.order]
        self.points = exact[self.order].astype(np.float32)
        self.centers = exact[self.order[[n[2] for n in self.nodes]]]
        self.radii = np.array([n[3] for n in self.nodes])
        self.sizes = np.array([n[1] - n[0] for n in self.nodes])

    def _build(self, exact: np.ndarray, start: int, end: int, radius: float) -> int:
        own = self.order[start:end]
        distance = distances(exact[own[:1]], exact[own])[0]
        covering = float(distance.max())
        while radius / 2 > covering and radius / 2 >= self.least_radius:
            radius /= 2
        cut, left, groups = radius / 2, own, []
        if end - start > SMALL and covering > SLACK and cut >= self.least_radius:
            while len(left) and len(groups) < CHILDREN:
                if groups:
                    distance = distances(exact[left[:1]], exact[left])[0]
                near = distance <= cut
                near[0] = True
                groups.append(left[near])
                left = left[~near]
        children, at = [], start
        if groups and not len(left):
            self.order[start:end] = np.concatenate(groups)
            for group in groups:
                children.append(self._build(exact, at, at + len(group), cut))
                at += len(group)
        self.nodes.append((start, end, start, covering, children))
        return len(self.nodes) - 1

    def opened(self, node: int) -> list[int]:
        return self.nodes[node][4] or [node]


class Forest:
    """Which points are linked through others. A root is the least of its points."""

    def __init__(self, count: int):
        self.above = np.arange(count)

    def roots(self, of: np.ndarray) -> np.ndarray:
        found = self.above[of]
        while True:
            higher = self.above[found]
            if (higher == found).all():
                self.above[of] = found
                return found
            found = higher

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Link each of ``a`` with the one of ``b`` at its place."""
        a, b = self.roots(a), self.roots(b)
        while (apart := a != b).any():
            a, b = a[apart], b[apart]
            np.minimum.at(self.above, np.maximum(a, b), np.minimum(a, b))
            a, b = self.roots(a), self.roots(b)


class Block:
    """A tree's points with their weights; ``at`` is the place of its first point in a forest.

    Weights stand for copies of a point. ``sums`` are the linked weights found so far.
    """

    def __init__(self, raw: np.ndarray, weights: np.ndarray, at: int = 0):
        self.tree, self.at = Tree(raw), at
        self.weights = weights[self.tree.order].astype(np.float64)
        self.total = np.concatenate([[0], np.cumsum(self.weights)])
        self.sums = np.zeros(len(raw))


def linked(x: Block, y: Block, cosine: float, forest: Forest) -> None:
    """Adds the weights linked between two blocks, or within one, to their sums, and joins what is linked.

    Pairs of a point with itself are left out and each pair is seen once.
    """
    a, b, same = x.tree, y.tree, x is y
    limit = float(np.sqrt(2.0 - 2.0 * cosine))
    stack = [(a.root, b.root)]
    while stack:
        p, q = stack.pop()
        ps, qs = np.array(a.opened(p)), np.array(b.opened(q))
        apart = distances(a.centers[ps], b.centers[qs])
        reach = a.radii[ps][:, None] + b.radii[qs][None, :]
        possible = apart <= limit + reach + SLACK
        if same and p == q:
            possible &= np.arange(len(ps))[:, None] <= np.arange(len(qs))[None, :]
        whole = possible & (apart + reach <= limit - SLACK)
        # Nodes whose children nearly all come near each other are not worth opening.
        pairs = a.sizes[ps][:, None] * b.sizes[qs][None, :]
        if a.sizes[p] * b.sizes[q] <= COST * np.count_nonzero(possible) + int(pairs[possible & ~whole].sum()):
            if possible.any():
                (s, e, *_), (t, f, *_) = a.nodes[p], b.nodes[q]
                _compare(x, y, (s, e, t, f), cosine, same and p == q, forest)
            continue
        for i, j in np.argwhere(possible):
            u, v = int(ps[i]), int(qs[j])
            (s, e, *_), (t, f, *_) = a.nodes[u], b.nodes[v]
            if same and u == v:
                if e - s == 1:
                    continue
                if whole[i, j]:
                    x.sums[s:e] += x.total[e] - x.total[s] - x.weights[s:e]
                    forest.join(np.full(e - s, x.at + s), np.arange(x.at + s, x.at + e))
                elif a.nodes[u][4]:
                    stack.append((u, v))
                else:
                    _compare(x, y, (s, e, t, f), cosine, True, forest)
            elif whole[i, j]:
                x.sums[s:e] += y.total[f] - y.total[t]
                y.sums[t:f] += x.total[e] - x.total[s]
                forest.join(np.full(f - t, x.at + s), np.arange(y.at + t, y.at + f))
                forest.join(np.full(e - s, y.at + t), np.arange(x.at + s, x.at + e))
            elif a.nodes[u][4] or b.nodes[v][4]:
                stack.append((u, v))
            else:
                _compare(x, y, (s, e, t, f), cosine, False, forest)


def _compare(x: Block, y: Block, ends: tuple[int, int, int, int], cosine: float, same: bool, forest: Forest) -> None:
    s, e, t, f = ends
    a, b = x.tree, y.tree
    # Twice what single precision can err by in a product of two unit vectors.
    doubt = (a.points.shape[1] + 8) * 2.0**-23
    for i in range(s, e, SLAB):
        rows = slice(i, min(i + SLAB, e))
        for j in range(i if same else t, f, SLAB):
            columns = slice(j, min(j + SLAB, f))
            product = a.points[rows] @ b.points[columns].T
            close = product >= cosine - doubt
            if same and i == j:
                close = np.triu(close, 1)
            if not close.any():
                continue
            r, c = places(close & (product < cosine + doubt))
            if len(r):
                exact = np.einsum("ij,ij->i", unit_vectors(a.raw[i + r]), unit_vectors(b.raw[j + c]))
                close[r, c] = exact >= cosine
            _add(x, y, rows, columns, close, forest)


def _add(x: Block, y: Block, rows: slice, columns: slice, close: np.ndarray, forest: Forest) -> None:
    if np.count_nonzero(close) * 32 < close.size:
        r, c = places(close)
        x.sums[rows] += np.bincount(r, y.weights[columns][c], close.shape[0])
        y.sums[columns] += np.bincount(c, x.weights[rows][r], close.shape[1])
        forest.join(x.at + rows.start + r, y.at + columns.start + c)
        return
    whole = close.astype(np.float64)
    x.sums[rows] += whole @ y.weights[columns]
    y.sums[columns] += x.weights[rows] @ whole
    of_rows = forest.roots(np.arange(x.at + rows.start, x.at + rows.stop))
    of_columns = forest.roots(np.arange(y.at + columns.start, y.at + columns.stop))
    r, c = places(close & (of_rows[:, None] != of_columns[None, :]))
    forest.join(of_rows[r], of_columns[c])
