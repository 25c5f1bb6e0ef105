"""Embedding near duplicates by dual traversal of a distributed cover tree.

Equal vectors of a label are one class with a weight. The classes of a label are the root
of a tree: a crowded cell draws a few members as centers, level by level, and every
vector goes down to the leaf of its nearest centers. Centers are drawn from a sample that
the driver holds; the covering radii of all nodes come from all vectors.

Pairs of cells are then descended level by level as a table, from each root paired
with itself: a pair of children stays only if their centers are no further apart than
the threshold and both covering radii, the covering bound. Leaves are dealt to bundles, and a
leaf travels once to each bundle that holds partners of it, however many. There the blocks' cover
trees, with halving radii, are traversed against each other, which gives exact link counts and a
spanning forest of the links. Only those leave the task.

Where a label has more vectors than one bundle, classes first meet as short sketches: coordinates of the
unit vector, rounded. A class whose sketch is further from all others than any link allows has no
link, and its vector is not dealt. The bound is certain and what passes it is compared in full.

Vectors travel as the bytes they were stored as. Wherever a place depends on a vector, it is computed in
whole numbers, so that equal vectors meet whatever task or pass computes it.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.llm.common import built_side, sliced, written
from stockwell.llm.components import components
from stockwell.llm.cover_tree import SLACK, Block, Forest, linked, places

#: Vectors of one block, centers of a crowded cell at most, vectors a center tree is drawn from, and of these in a leaf.
BLOCK, FANOUT, DRAWN, DRAWN_LEAF = 1024, 32, 32768, 32
#: Bytes of a bundle's own vectors in single precision, and sketches of a bundle.
BUNDLE, SKETCHES = 64 << 20, 1 << 19
#: Bits of the table of sketches with a partner, and the most of them it is used for.
SLOTS, MOST = 1 << 27, 1 << 23
#: Rows that are looked at together, sketches that are compared at once, and bits of their grid.
ROWS, ASKED, GRID = 8192, 8192, 12
#: Unit vectors in whole numbers.
WHOLE = 2.0**20

DEALT = "bundle int, kind int, cell long, other long, id long, weight long, width int, vec binary"
FOUND = "root long, digest binary, id long, weight long, n long, a long, b long"


def _usable(lists: pa.ListArray):
    """``places, matrix`` for each length of vector: rows that are finite and not zero."""
    values = lists.flatten()
    if values.null_count:
        values = values.fill_null(float("nan"))
    flat = values.to_numpy(zero_copy_only=False)
    length = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(length) - length
    for width in np.unique(length[length > 0]):
        places = np.flatnonzero(length == width)
        matrix = flat[start[places][:, None] + np.arange(width)] + flat.dtype.type(0)  # no -0.0
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        yield places[good], matrix[good]


def _bits(width: int) -> int:
    """Bits that a component may have, so that the sum of all their squares is exact."""
    return min(20, int((52 - math.log2(width)) // 2))


def _whole_units(raw: np.ndarray) -> np.ndarray:
    """Unit vectors times 2^20 in whole numbers. All sums are exact, so they depend on the vector only."""
    x = raw.astype(np.float64)
    q = np.rint(x / np.abs(x).max(axis=1, keepdims=True) * 2.0 ** _bits(x.shape[1]))
    return np.rint(q / np.sqrt((q * q).sum(axis=1, keepdims=True)) * WHOLE)


def _slack(width: int) -> float:
    """What the whole units of two vectors can differ by from their distance, and rounding."""
    return 4 * math.sqrt(width) * 2.0 ** -_bits(width) + SLACK


def _digest(vec: bytes) -> bytes:
    return hashlib.blake2b(vec, digest_size=16).digest()


def _keys(vecs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(v, digest_size=8).digest() for v in vecs), np.uint64)


def _matrix(vecs: list[bytes], width: int) -> np.ndarray:
    whole = b"".join(vecs)
    return np.frombuffer(whole, np.float32 if len(vecs[0]) == 4 * width else np.float64).reshape(-1, width)


def _plain(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, vector, label``: single precision stays as it is, all else is read in double precision."""
    kind = vectors.schema[vector_col].dataType
    short = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<float>" if short else "array<double>").alias("vector"),
        F.col(label_col).alias("label"),
    )


def _roots(rows: DataFrame) -> DataFrame:
    """``label, width, root``: a number for each label and length of vector."""
    width = F.size("vector").alias("width")
    kinds = rows.where(F.col("label").isNotNull() & (F.size("vector") > 0)).select("label", width).distinct()
    return written(kinds.withColumn("root", F.monotonically_increasing_id()), "roots")


def _rooted(rows: DataFrame, roots: DataFrame, how: str) -> DataFrame:
    sized = rows.withColumn("width", F.size("vector"))
    return sized.join(built_side(roots), ["label", "width"], how).select("root", "id", "vector")


def _classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, roots: DataFrame | None = None) -> DataFrame:
    """``root, width, id, weight, vec``: usable vectors; equal ones of a label that are read together are one row."""

    def gathered(batches):
        for batch in (part for whole in batches for part in sliced([whole], ROWS)):
            root, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found: dict[tuple[int, bytes], list[Any]] = {}
            for places, matrix in _usable(batch.column(2)):
                width = matrix.shape[1]
                for k, vec in zip(places.tolist(), (row.tobytes() for row in matrix)):
                    old = found.setdefault((root[k], vec), [width, ids[k], 0])
                    old[2] += 1
                    if ids[k] is not None and (old[1] is None or ids[k] < old[1]):
                        old[1] = ids[k]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.int64()),
                    pa.array([v[0] for v in found.values()], pa.int32()),
                    pa.array([v[1] for v in found.values()], pa.int64()),
                    pa.array([v[2] for v in found.values()], pa.int64()),
                    pa.array([k[1] for k in found], pa.binary()),
                ],
                names=["root", "width", "id", "weight", "vec"],
            )

    rows = _plain(vectors, id_col, vector_col, label_col)
    rooted = _rooted(rows, roots if roots is not None else _roots(rows), "inner")
    return rooted.mapInArrow(gathered, "root long, width int, id long, weight long, vec binary")


def _sizes(classes: DataFrame) -> DataFrame:
    return written(classes.groupBy("root", "width").agg(F.count(F.lit(1)).alias("n")), "sizes")


def _sample(classes: DataFrame, sizes: list, most: int) -> tuple[int, dict[int, np.ndarray]]:
    """(one in how many, distinct vectors of each root of ``sizes``, in an order that is as good as random)."""
    wide = max(64, *(s["width"] for s in sizes))
    every = max(1, math.ceil(sum(s["n"] for s in sizes) * wide / 64 / most))
    picked = classes.join(F.broadcast(classes.sparkSession.createDataFrame([(s["root"],) for s in sizes], "root long")), "root")
    if every > 1:
        picked = picked.where(F.pmod(F.xxhash64("vec"), F.lit(every)) == 0)
    vecs: dict[int, set[bytes]] = defaultdict(set)
    table = picked.select("root", "vec").toArrow()
    for root, vec in zip(table["root"].to_pylist(), table["vec"].to_pylist()):
        vecs[root].add(vec)
    widths = {s["root"]: s["width"] for s in sizes}
    return every, {root: _matrix(sorted(own, key=_digest), widths[root]) for root, own in vecs.items()}


# --- sketches


def _sketched(raw: np.ndarray, axes: np.ndarray, step: float) -> np.ndarray:
    """The unit vectors' coordinates on some axes in steps. Those beyond a byte are cut, which brings none further apart."""
    return np.clip(np.rint(_whole_units(raw)[:, axes] / WHOLE / step), -127, 127).astype(np.int8)


class _Grid:
    """Sketches in cells between their medians, for all that lie within a reach of others."""

    def __init__(self, sketches: np.ndarray, active: np.ndarray, reach: float):
        bits = min(GRID, sketches.shape[1], (len(sketches) >> 9).bit_length())
        self.medians = np.array([np.median(sketches[:, i]) for i in range(bits)], np.float32)
        code = self._code(sketches)
        self.order = np.argsort(code, kind="stable")
        self.sketches, self.active = sketches[self.order], active[self.order]
        self.starts = np.searchsorted(code[self.order], np.arange((1 << bits) + 1))
        self.sides = (np.arange(1 << bits)[None, :] >> np.arange(bits)[:, None] & 1).astype(np.float32)
        # Each difference of two coordinates is less than a step longer in steps than it is.
        width = sketches.shape[1]
        self.first = max(bits, min(16, width))
        self.reach_first, self.reach = ((reach + math.sqrt(w)) ** 2 for w in (self.first, width))
        self.reach_grid = (reach + math.sqrt(bits)) ** 2

    def _code(self, sketches: np.ndarray) -> np.ndarray:
        above = sketches[:, : len(self.medians)] > self.medians
        return above.astype(np.int64) @ (1 << np.arange(len(self.medians)))

    def _near(self, sketches: np.ndarray) -> np.ndarray:
        """For each cell and sketch, whether the medians between them allow that it holds one within reach."""
        first = sketches[:, : len(self.medians)]
        above = (first > self.medians).astype(np.float32)
        over = (first.astype(np.float32) - self.medians) ** 2
        apart = (1 - self.sides).T @ (over * above).T
        apart += self.sides.T @ (over * (1 - above)).T
        return apart <= self.reach_grid

    @staticmethod
    def _lifted(first: np.ndarray, left: bool) -> np.ndarray:
        """Rows whose products are minus half the squared distance."""
        x = first.astype(np.float32)
        half, one = -(x * x).sum(axis=1, keepdims=True) / 2, np.ones((len(x), 1), np.float32)
        return np.concatenate([x, half, one] if left else [x, one, half], axis=1)

    def ask(self, sketches: np.ndarray, active: np.ndarray, own: int | None = None) -> None:
        """Mark what lies within reach of each other in both ``active``. With ``own`` the sketches are the grid's from there on."""
        near = np.concatenate([self._near(sketches[i : i + 2048]) for i in range(0, len(sketches), 2048)], axis=1)
        if own is not None:
            near &= np.arange(len(near))[:, None] >= self._code(sketches)[None, :]
        lifted = self._lifted(sketches[:, : self.first], True)
        for cell in np.flatnonzero(near.any(axis=1) & (np.diff(self.starts) > 0)):
            s, e = self.starts[cell], self.starts[cell + 1]
            asked, held = np.flatnonzero(near[cell]), np.arange(s, e)
            if self.active[s:e].all():
                asked = asked[~active[asked]]
            if active[asked].all():
                held = held[~self.active[s:e]]
            if not len(asked) or not len(held):
                continue
            right = self._lifted(self.sketches[held, : self.first], False)
            most = max(1, (1 << 20) // len(held))
            for part in (asked[i : i + most] for i in range(0, len(asked), most)):
                close = lifted[part] @ right.T >= -self.reach_first / 2
                many = np.count_nonzero(close)
                if not many:
                    continue
                if 64 * many > close.size:
                    close &= ~(active[part][:, None] & self.active[held][None, :])
                r, c = places(close)
                r, c = part[r], held[c]
                if own is not None:
                    other = r + own != c
                    r, c = r[other], c[other]
                for i in range(0, len(r), 1 << 16):
                    x, y = r[i : i + (1 << 16)], c[i : i + (1 << 16)]
                    d = sketches[x].astype(np.int32) - self.sketches[y]
                    met = (d * d).sum(axis=1) <= self.reach
                    active[x[met]] = True
                    self.active[y[met]] = True


def _marked(bundles, steps: dict[int, tuple[float, int]], gap: float):
    """Slots of the sketches that have a partner, of rows ``bundle, kind, root, key, sketch`` in that order."""

    def slots(keys: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array((keys % np.uint64(SLOTS)).astype(np.int32))], names=["slot"])

    grid, at, keys, sketches = None, None, [], []

    def settled():
        """The grid of a bundle's own sketches; equal vectors have a partner, and are one sketch."""
        step, width = steps[at[1]]
        names, first, times = np.unique(np.concatenate(keys), return_index=True, return_counts=True)
        own = np.concatenate(sketches)
        keys.clear()
        sketches.clear()
        grid = _Grid(own[first], times > 1, (gap + _slack(width)) / step)
        grid.keys = names[grid.order]
        for i in range(0, len(names), ASKED):
            part = slice(i, i + ASKED)
            grid.ask(grid.sketches[part], grid.active[part], own=i)
        return grid

    for bundle, kind, root, key, sketch in bundles:
        if (bundle, root) != at:
            if grid or keys:
                grid = grid or settled()
                yield slots(grid.keys[grid.active])
            grid, at, keys, sketches = None, (bundle, root), [], []
        if kind == 0:
            keys.append(key)
            sketches.append(sketch)
        elif grid or keys:
            grid = grid or settled()
            for i in range(0, len(key), ASKED):
                met = np.zeros(len(key[i : i + ASKED]), bool)
                grid.ask(sketch[i : i + ASKED], met)
                if met.any():
                    yield slots(key[i : i + ASKED][met])
    if grid or keys:
        grid = grid or settled()
        yield slots(grid.keys[grid.active])


def _partnered(classes: DataFrame, sizes: DataFrame, gap: float, bundle: int, sketches: int) -> tuple[DataFrame, DataFrame]:
    """The classes without vectors of large roots that have no link for certain, and the sizes of their roots."""
    large = sizes.where(F.col("n") * 4 * F.col("width") > bundle).collect()
    if not large:
        return classes, sizes
    _, drawn = _sample(classes, large, DRAWN // 4)
    plans: dict[int, tuple[np.ndarray, float, int, int, int]] = {}
    bundles = 0
    for s in large:
        if s["root"] not in drawn:
            continue
        units = _whole_units(drawn[s["root"]]) / WHOLE
        axes = np.argsort(-units.var(axis=0), kind="stable")[: min(s["width"], max(32, s["width"] // 2))]
        step = max(float(np.abs(units[:, axes]).max()), 1e-3) / 127
        parts = math.ceil(s["n"] / sketches)
        plans[s["root"]] = (axes, step, s["width"], bundles, parts)
        bundles += parts
    spark = classes.sparkSession
    plan = spark.sparkContext.broadcast(plans)

    def dealt(batches):
        for batch in batches:
            roots, vecs = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            for root in np.unique(roots):
                if root not in plan.value:
                    continue
                axes, step, width, first, parts = plan.value[root]
                own = [vecs[i] for i in np.flatnonzero(roots == root)]
                keys, short = _keys(own), _sketched(_matrix(own, width), axes, step)
                home = (keys >> np.uint64(32)).astype(np.int64) % parts
                # Half of the other bundles get a sketch as a guest, so that each two bundles meet once.
                for away in range(parts // 2 + 1):
                    to = (home + away) % parts
                    sent = np.flatnonzero((home < to) if away and 2 * away == parts else np.full(len(own), True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((first + to[sent]).astype(np.int32)),
                            pa.array(np.full(len(sent), min(away, 1), np.int32)),
                            pa.array(np.full(len(sent), root, np.int64)),
                            pa.array(keys[sent].view(np.int64)),
                            pa.array([short[i].tobytes() for i in sent], pa.binary()),
                        ],
                        names=["bundle", "kind", "root", "key", "sketch"],
                    )

    def marked(batches):
        def runs():
            for batch in batches:
                bundle, kind, root, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
                ends = np.flatnonzero((np.diff(bundle) != 0) | (np.diff(kind) != 0)) + 1
                for s, e in zip([0, *ends], [*ends, len(key)]):
                    if e > s:
                        short = np.frombuffer(b"".join(batch.column(4).slice(s, e - s).to_pylist()), np.int8)
                        yield bundle[s], kind[s], root[s], key[s:e].view(np.uint64), short.reshape(e - s, -1)

        yield from _marked(runs(), {r: (p[1], p[2]) for r, p in plan.value.items()}, gap)

    sent = classes.select("root", "vec").mapInArrow(dealt, "bundle int, kind int, root long, key long, sketch binary")
    sorted_in = sent.repartitionById(bundles, "bundle").sortWithinPartitions("bundle", "kind")
    slots = written(sorted_in.mapInArrow(marked, "slot int").distinct(), "partnered")
    if slots.count() > MOST:
        return classes, sizes
    table = np.zeros(SLOTS // 8, np.uint8)
    for slot in slots.toArrow().column(0).chunks:
        s = slot.to_numpy()
        np.bitwise_or.at(table, s >> 3, (1 << (s & 7)).astype(np.uint8))
    bits = spark.sparkContext.broadcast(table)

    def kept(batches):
        for batch in batches:
            roots = batch.column(0).to_numpy(zero_copy_only=False)
            slot = (_keys(batch.column(4).to_pylist()) % np.uint64(SLOTS)).astype(np.int64)
            partner = bits.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1
            copied = batch.column(3).to_numpy(zero_copy_only=False) > 1
            yield batch.filter(pa.array((partner == 1) | copied | ~np.isin(roots, list(plan.value))))

    few = classes.mapInArrow(kept, classes.schema)
    left, before = _sizes(few), sizes.agg(F.sum("n")).first()[0]
    # Rows that are mostly kept, such as many copies of few vectors, are not written again.
    if 2 * left.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] > before:
        return classes, sizes
    return written(few, "vectors"), left


# --- cover tree


class _Cells:
    """The trees of centers of crowded roots. A node is a place in ``own``, its center, and ``children``."""

    def __init__(self):
        self.own: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.roots: dict[int, int] = {}
        self.root_of: list[int] = []

    def grow(self, root: int, drawn: np.ndarray, most: int) -> None:
        units = _whole_units(drawn)
        self.roots[root] = self._node(root, units[0])
        stack = [(self.roots[root], np.arange(len(units)))]
        while stack:
            node, members = stack.pop()
            if len(members) <= most:
                continue
            centers = units[members[:FANOUT]]
            _, chosen = self._nearest(centers, units[members], members)
            groups = [members[chosen == c] for c in range(len(centers))]
            if max(map(len, groups)) < len(members):
                self.children[node] = [self._node(root, center) for center in centers]
                stack += zip(self.children[node], groups)

    def _node(self, root: int, center: np.ndarray) -> int:
        self.own.append(center)
        self.children.append([])
        self.root_of.append(root)
        return len(self.own) - 1

    def centers(self, nodes: list[int]) -> np.ndarray:
        return np.array([self.own[k] for k in nodes])

    @staticmethod
    def _nearest(centers: np.ndarray, units: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(distance, place) of the nearest center, all in exact whole numbers until the root is drawn."""
        apart = (centers * centers).sum(axis=1)[None, :] - 2 * (units @ centers.T)
        least = apart.min(axis=1, keepdims=True)
        # Of equally near centers one is taken by the vector, so that equal directions spread too.
        near = apart == least
        chosen = (np.cumsum(near, axis=1) > (turns % near.sum(axis=1))[:, None]).argmax(axis=1)
        return np.sqrt(np.maximum(least[:, 0] + (units * units).sum(axis=1), 0.0)) / WHOLE, chosen

    def levels(self, root: int, raw: np.ndarray, keys: np.ndarray):
        """``node, places, far``: which of the vectors come to each node, and their distance to its center."""
        units, stack = _whole_units(raw), [(self.roots[root], np.arange(len(raw)))]
        while stack:
            node, places = stack.pop()
            if not self.children[node]:
                continue
            far, chosen = self._nearest(self.centers(self.children[node]), units[places], keys[places])
            for c in np.unique(chosen):
                to = places[chosen == c]
                yield self.children[node][c], to, far[chosen == c]
                stack.append((self.children[node][c], to))

    def leaves(self, root: int, raw: np.ndarray, keys: np.ndarray) -> np.ndarray:
        found = np.full(len(raw), self.roots[root])
        for node, places, _ in self.levels(root, raw, keys):
            found[places] = node
        return found

    def in_order(self) -> list[int]:
        """All leaves, those of one branch together."""
        found, stack = [], list(self.roots.values())
        while stack:
            node = stack.pop()
            stack += self.children[node]
            found += [] if self.children[node] else [node]
        return found


def _by_root(batch):
    """``root, places, vectors, keys`` of each root in a batch of classes."""
    roots, widths = batch.column("root").to_numpy(zero_copy_only=False), batch.column("width").to_numpy(zero_copy_only=False)
    vecs = batch.column("vec").to_pylist()
    for root in np.unique(roots):
        places = np.flatnonzero(roots == root)
        own = [vecs[i] for i in places]
        yield int(root), places, _matrix(own, int(widths[places[0]])), (_keys(own) >> np.uint64(1)).astype(np.int64)


def _descended(pairs: DataFrame, cells: _Cells, radius: dict[int, float], gap: float) -> DataFrame:
    """Pairs ``a, b`` of children whose covering balls come within ``gap`` of each other. A leaf stands for itself."""
    shared = pairs.sparkSession.sparkContext.broadcast((cells, radius))

    def opened(batches):
        cells, radius = shared.value
        for batch in batches:
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for p, q in zip(*(c.to_pylist() for c in batch.columns)):
                ps, qs = ([k for k in cells.children[node] or [node] if k in radius] for node in (p, q))
                x, y = cells.centers(ps), cells.centers(qs)
                apart = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
                reach = np.array([radius[k] for k in ps])[:, None] + np.array([radius[k] for k in qs])[None, :]
                met = np.sqrt(np.maximum(apart, 0.0)) / WHOLE <= gap + _slack(x.shape[1]) + reach
                i, j = np.nonzero(np.triu(met) if p == q else met)
                left.append(np.array(ps)[i])
                right.append(np.array(qs)[j])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(side)) for side in (left, right)], names=["a", "b"])

    return pairs.repartition("a", "b").mapInArrow(opened, "a long, b long")


def _tree(classes: DataFrame, sizes: DataFrame, block: int, gap: float) -> tuple[_Cells, dict[int, int], DataFrame]:
    """(centers of the crowded roots, vectors in each of their leaves, pairs ``a, b`` of these leaves to compare)."""
    spark, cells = classes.sparkSession, _Cells()
    crowded = sizes.where(F.col("n") > block).collect()
    if crowded:
        every, drawn = _sample(classes, crowded, DRAWN)
        most = max(block // every, DRAWN_LEAF) if every > 1 else block
        for root in sorted(drawn):
            cells.grow(root, drawn[root], most)
    shared = spark.sparkContext.broadcast(cells)

    def covered(batches):
        for batch in batches:
            found: dict[int, tuple[float, int]] = {}
            for root, _, raw, keys in _by_root(batch):
                if root in shared.value.roots:
                    whole = [(shared.value.roots[root], keys, np.full(1, 2.0))]
                    for node, places, far in [*whole, *shared.value.levels(root, raw, keys)]:
                        old = found.get(node, (0.0, 0))
                        found[node] = (max(old[0], float(far.max())), old[1] + len(places))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array([v[0] for v in found.values()], pa.float64()), pa.array([v[1] for v in found.values()], pa.int64())],
                names=["node", "far", "n"],
            )

    met = classes.mapInArrow(covered, "node long, far double, n long").groupBy("node").agg(F.max("far").alias("far"), F.sum("n").alias("n"))
    rows = met.collect() if cells.roots else []
    radius, counts = {r["node"]: r["far"] for r in rows}, {r["node"]: r["n"] for r in rows}
    level = [k for k in cells.roots.values() if k in radius]
    pairs, total = spark.createDataFrame([(k, k) for k in level], "a long, b long"), sum(counts[k] for k in level)
    while any(cells.children[k] for k in level):
        below = [c for k in level for c in (cells.children[k] or [k]) if c in radius]
        opened = written(_descended(pairs, cells, radius, gap), "node-pairs")
        many, each = opened.count(), Counter(cells.root_of[k] for k in below)
        if many > 8 * total or many > total and 2 * many > sum(n * (n + 1) // 2 for n in each.values()):
            # Smaller cells would only make more pairs, so these are the leaves.
            for k in level:
                cells.children[k] = []
            break
        level, pairs = below, opened
    return cells, {k: counts[k] for k in level}, pairs


def _leaves(classes: DataFrame, block: int, gap: float) -> tuple[DataFrame, DataFrame]:
    """(classes with the ``cell`` that is their leaf; pairs ``a, b`` of leaves to compare).

    A root that fits a block is a leaf that meets itself only, and is in no pair.
    """
    cells, _, pairs = _tree(classes, _sizes(classes), block, gap)
    return _placed(classes, cells), pairs


def _cells_of(batch, cells: _Cells) -> np.ndarray:
    """The leaf of each class. A root without a tree is a cell of its own, below all nodes."""
    found = np.zeros(batch.num_rows, np.int64)
    for root, places, raw, keys in _by_root(batch):
        found[places] = cells.leaves(root, raw, keys) if root in cells.roots else -1 - root
    return found


def _placed(classes: DataFrame, cells: _Cells) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(cells)

    def place(batches):
        for batch in batches:
            found = pa.array(_cells_of(batch, shared.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "cell"])

    return classes.mapInArrow(place, T.StructType([*classes.schema.fields, T.StructField("cell", T.LongType())]))


# --- comparison


def _bundles(cells: _Cells, counts: dict[int, int], most: int, fair: int) -> dict[int, int]:
    """The bundle of each leaf: leaves of one branch together, and a root alone where it gives a task its share."""
    homes, bundle, held, before = {}, 0, 0, None
    for cell in (k for k in cells.in_order() if k in counts):
        root = cells.root_of[cell]
        if held and (held + counts[cell] > most or root != before and held + counts[cell] > fair):
            bundle, held = bundle + 1, 0
        homes[cell], held, before = bundle, held + counts[cell], root
    return homes


def _traversed(classes: DataFrame, cells: _Cells, counts: dict[int, int], pairs: DataFrame, cosine: float, bundle: int) -> DataFrame:
    """``root, digest, id, weight, n`` of classes that are linked or have copies, and links ``a, b`` that span all."""
    spark = classes.sparkSession
    most = max(1, bundle // (4 * max((len(x) for x in cells.own), default=1)))
    tasks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    homes = _bundles(cells, counts, most, max(1, sum(counts.values()) // tasks))
    large = max(homes.values(), default=-1) + 1

    of = spark.createDataFrame(list(homes.items()), "cell long, bundle int")
    at = lambda side: F.broadcast(of.select(F.col("cell").alias(side), F.col("bundle").alias(f"in_{side}")))
    low, high = F.least("in_a", "in_b"), F.greatest("in_a", "in_b")
    work = pairs.where("a != b").join(at("a"), "a").join(at("b"), "b").withColumn("bundle", F.when((low + high) % 2 == 0, low).otherwise(high))
    own = F.col("in_a") == F.col("bundle")
    work = written(
        work.select(
            "bundle",
            F.when(own, F.col("a")).otherwise(F.col("b")).alias("cell"),
            F.when(own, F.col("b")).otherwise(F.col("a")).alias("other"),
            (F.col("in_a") != F.col("in_b")).alias("guest"),
        ),
        "leaf-pairs",
    )
    guests: dict[int, list[int]] = defaultdict(list)
    for r in work.where("guest").select("other", "bundle").distinct().collect():
        guests[r["other"]].append(r["bundle"])
    shared = spark.sparkContext.broadcast((cells, homes, dict(guests)))

    def dealt(batches):
        cells, home, guest = shared.value
        for batch in batches:
            names = _cells_of(batch, cells).tolist()
            to = [(i, home.get(c, large + r % tasks), 1) for i, (c, r) in enumerate(zip(names, batch.column(0).to_pylist()))]
            to += [(i, b, 2) for i, c in enumerate(names) for b in guest.get(c, ())]
            rows = batch.take(pa.array([x[0] for x in to], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[1] for x in to], pa.int32()),
                    pa.array([x[2] for x in to], pa.int32()),
                    pa.array([names[x[0]] for x in to], pa.int64()),
                    pa.nulls(len(to), pa.int64()),
                    rows.column(2),
                    rows.column(3),
                    rows.column(1),
                    rows.column(4),
                ],
                names=["bundle", "kind", "cell", "other", "id", "weight", "width", "vec"],
            )

    sent = classes.mapInArrow(dealt, DEALT)
    asked = work.select(
        "bundle", F.lit(0).alias("kind"), "cell", "other", F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("weight"),
        F.lit(None).cast("int").alias("width"), F.lit(None).cast("binary").alias("vec"),
    )
    root_of = spark.sparkContext.broadcast(cells.root_of)
    together = sent.union(asked).repartitionById(large + tasks, "bundle").sortWithinPartitions("bundle", "kind", "cell")

    def compared(batches):
        def runs():
            for batch in batches:
                for part in sliced([batch], ROWS):
                    yield from zip(*(c.to_pylist() for c in part.columns))

        yield from _compared(runs(), cosine, root_of.value)

    return together.mapInArrow(compared, FOUND)


class _Cell:
    """Equal vectors of a leaf as one, without those that have no id."""

    def __init__(self, root: int, width: int, members: dict[bytes, list[Any]]):
        named = {v: m for v, m in members.items() if m[0] is not None}
        self.root, self.lone = root, [(v, m[1]) for v, m in members.items() if m[0] is None]
        self.raw = _matrix(list(named), width) if named else None
        self.ids = np.array([m[0] for m in named.values()], np.int64)
        self.weights = np.array([m[1] for m in named.values()], np.int64)
        self.block: Block | None = None

    def built(self, at: int) -> Block | None:
        if self.raw is not None:
            self.block, self.raw = Block(self.raw, self.weights, at), None
            order = self.block.tree.order
            self.ids, self.weights = self.ids[order], self.weights[order]
        return self.block

    def rows(self, home: bool):
        """What is known of classes that are linked or have copies; of a guest the links only."""
        n = self.block.sums.astype(np.int64) if self.block else np.zeros(0, np.int64)
        told = np.flatnonzero((n > 0) | (home & (self.weights > 1)))
        lone = [(v, w) for v, w in self.lone if home and w > 1]
        count = len(told) + len(lone)
        return _found(
            root=pa.array([self.root] * count, pa.int64()),
            digest=pa.array([*(_digest(self.block.tree.raw[i].tobytes()) for i in told), *(_digest(v) for v, _ in lone)], pa.binary()),
            id=pa.array([*self.ids[told].tolist(), *[None] * len(lone)], pa.int64()),
            weight=pa.array([*self.weights[told].tolist(), *(w for _, w in lone)], pa.int64()),
            n=pa.array([*n[told].tolist(), *[0] * len(lone)], pa.int64()),
        )


def _found(**columns):
    count = len(next(iter(columns.values())))
    types = {"root": pa.int64(), "digest": pa.binary(), **dict.fromkeys(["id", "weight", "n", "a", "b"], pa.int64())}
    return pa.RecordBatch.from_arrays([columns.get(k, pa.nulls(count, t)) for k, t in types.items()], names=list(types))


def _compared(rows, cosine: float, root_of: list[int]):
    """Compares the leaves of bundles, of rows sorted by bundle, kind (pairs, own leaves, guests) and cell."""
    pairs: dict[int, list[int]] = defaultdict(list)
    own: dict[int, _Cell] = {}
    forest, held = Forest(0), 0

    def links(ids: np.ndarray, first: int):
        """Links from each class to the least of those it is joined with."""
        roots = forest.roots(np.arange(first, first + len(ids)))
        joined = np.flatnonzero(roots != np.arange(first, first + len(ids)))
        others = names[roots[joined]] if len(joined) else ids[:0]
        return _found(a=pa.array(ids[joined], pa.int64()), b=pa.array(others, pa.int64()))

    def settle():
        """Builds the blocks of a bundle's own leaves and compares them."""
        nonlocal forest, held, names
        held = 0
        for cell in own.values():
            cell.built(held)
            held += len(cell.ids)
        forest = Forest(held)
        names = np.concatenate([np.zeros(0, np.int64), *(c.ids for c in own.values())])
        for name, cell in own.items():
            for other in [name, *pairs.get(name, ())]:
                if other in own and cell.block and own[other].block:
                    linked(cell.block, own[other].block, cosine, forest)

    def welcome(name: int, guest: _Cell):
        """Compares a guest with its partners among the bundle's own leaves."""
        block = guest.built(held)
        if not block:
            return
        forest.above = np.concatenate([forest.above[:held], np.arange(held, held + len(guest.ids))])
        for cell in (own[c] for c in partners.get(name, ()) if c in own):
            if cell.block:
                linked(cell.block, block, cosine, forest)
        yield guest.rows(home=False)
        yield links(guest.ids, held)

    def farewell():
        yield from (cell.rows(home=True) for cell in own.values())
        yield links(names, 0)

    names, partners, settled = np.zeros(0, np.int64), defaultdict(list), False
    at, members, width = None, {}, 0

    def closed():
        """The leaf that has been read is whole."""
        nonlocal settled
        if at is None or not members:
            return
        cell = _Cell(root_of[at[2]] if at[2] >= 0 else -1 - at[2], width, members)
        if at[1] == 1:
            own[at[2]] = cell
        else:
            if not settled:
                settle()
                settled = True
            yield from welcome(at[2], cell)

    for bundle, kind, name, other, id_, weight, wide, vec in rows:
        if at is None or (bundle, kind, name) != at:
            yield from closed()
            members = {}
            if at is not None and bundle != at[0]:
                if not settled:
                    settle()
                yield from farewell()
                own, pairs, partners, settled = {}, defaultdict(list), defaultdict(list), False
            at, width = (bundle, kind, name), wide
        if kind == 0:
            pairs[name].append(other)
            partners[other].append(name)
            continue
        old = members.setdefault(vec, [id_, 0])
        old[1] += weight
        if id_ is not None and (old[0] is None or id_ < old[0]):
            old[0] = id_
    yield from closed()
    if at is not None:
        if not settled:
            settle()
        yield from farewell()


def _named(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``root, id, digest`` of every row; vectors that can have no link have no digest."""

    def digested(batches):
        for batch in batches:
            found: list[bytes | None] = [None] * batch.num_rows
            for places, matrix in _usable(batch.column(2)):
                for k, row in zip(places.tolist(), matrix):
                    found[k] = _digest(row.tobytes())
            known = batch.column(0).is_valid().to_pylist()
            digests = pa.array([d if k else None for d, k in zip(found, known)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), digests], names=["root", "id", "digest"])

    return _rooted(rows, roots, "left").mapInArrow(digested, "root long, id long, digest binary")


def embedding_links(
    vectors: DataFrame,
    cosine: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
    bundle: int = BUNDLE,
    sketches: int = SKETCHES,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors of one label and length are linked from ``cosine`` up. Null, empty and
    zero vectors, those with a null or non-finite component and those without a label
    have no link. Equal vectors are linked with each other and share all other
    links. Rows that repeat an id are one vertex; a null id is linked through its
    class only, has that class's component, else null, and is kept then. An empty
    table gives no rows; other columns are not read.
    """
    rows = _plain(vectors, id_col, vector_col, label_col)
    roots, gap = _roots(rows), math.sqrt(2.0 - 2.0 * cosine) + 1e-6
    # Written once: each step then runs one Python worker a task, which keeps the memory of its largest batch.
    classes = written(_classes(vectors, id_col, vector_col, label_col, roots), "vectors")
    classes, sizes = _partnered(classes, _sizes(classes), gap, bundle, sketches)
    cells, counts, pairs = _tree(classes, sizes, block, gap)
    found = written(_traversed(classes, cells, counts, pairs, cosine, bundle), "found")
    labels = components(found.where(F.col("a").isNotNull()).select("a", "b"))
    sums = found.where(F.col("n") > 0).groupBy("id").agg(F.sum("n").alias("n"))
    vertices = written(sums.join(labels, F.col("id") == F.col("vertex"), "left").select(F.col("id").alias("vertex"), "n", "component"), "vertices")
    told = found.where(F.col("digest").isNotNull()).groupBy("root", "digest").agg(F.min("id").alias("class"), F.max("weight").alias("weight"))
    told = written(told, "classes")
    named = _named(rows, roots).join(built_side(told), ["root", "digest"], "left")
    own = F.when(F.col("weight").isNotNull(), F.col("class")).when(F.col("digest").isNotNull(), F.col("id"))
    joined = named.withColumn("own", own).join(built_side(vertices), F.col("own") == F.col("vertex"), "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.coalesce("component", "own"))
    return joined.select(
        F.col("id").alias("vec_id"),
        (F.coalesce("n", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
