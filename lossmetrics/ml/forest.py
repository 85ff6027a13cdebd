"""Random forest over all rows: every tree is grown by one task from the bins of its own resample of the rows.

Binned rows lie in cached blocks of a few bytes a row. The task of a tree reads every block once, from wherever it lies, draws
how often each row takes part, and grows the tree level by level from counts by (node, feature, bin, class). No row is shuffled
and no counts leave the task; what reaches the driver is the trees, bounded by their number and depth.

Rows in hand are kept in unnamed files beyond ``HELD_ROWS``, and worked through in chunks. Draws depend on the seed, the tree and the row, the
features tried at a node on the seed, the tree and the node, and counts are whole numbers, so a model does not depend on how
the rows are dealt out.

Defined cases: a node is split only if that gains; rows of one id and the same features are drawn together; no rows are an error.
"""

from __future__ import annotations

import dataclasses
import math
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.ml import boosting
from lossmetrics.ml.bundles import CODES, Bundles

#: Rows of a resample held in memory, rows of a chunk, and cells whose gain is computed at once.
HELD_ROWS, CHUNK_ROWS, CELLS = 1 << 22, 1 << 17, 1 << 15
#: Chances of a row to be drawn at most 0, 1, 2, ... times when as many rows are drawn as there are.
_DRAWN = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(19)])


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well mixed 64 bits of every number."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _key(*parts: int) -> np.uint64:
    key = np.zeros(1, np.uint64)
    for part in parts:
        key = _mixed(key + np.uint64(0x9E3779B97F4A7C15) + np.uint64(part % (1 << 64)))
    return key[0]


def draws(marks: np.ndarray, key: np.uint64) -> np.ndarray:
    """How often every row takes part."""
    chance = (_mixed(_mixed(marks.view(np.uint64)) ^ key) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(_DRAWN, chance, side="right").astype(np.uint8)


class _Held:
    """Columns of rows, in memory while there are few and in unnamed files beyond."""

    def __init__(self, rows: int):
        self.many, self.parts, self.files = rows > HELD_ROWS, [], []

    def add(self, *columns: np.ndarray) -> None:
        if not self.many:
            self.parts.append(columns)
            return
        if not self.files:
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
            self.files = [(tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None), c.dtype, c.shape[1:]) for c in columns]
        for (file, _, _), column in zip(self.files, columns, strict=True):
            column.tofile(file)

    def columns(self) -> list[np.ndarray]:
        if not self.many or not self.files:
            return [np.concatenate(c) for c in zip(*self.parts)]
        out = []
        for file, kind, shape in self.files:
            file.flush()
            out.append(np.memmap(file, kind, "r+").reshape(-1, *shape))
        return out


@dataclasses.dataclass
class Tree:
    """Nodes by level. A leaf has feature -1, leads to itself and names its row of ``shares``; the right child follows the left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    leaf: np.ndarray
    shares: np.ndarray
    gains: np.ndarray
    depth: int


@dataclasses.dataclass
class _Growing:
    """What the levels of a tree have in common."""

    bundles: Bundles
    bins: np.ndarray
    balance: np.ndarray
    tried: int
    least: int
    enough: int
    key: np.uint64

    def features_of(self, names: np.ndarray) -> np.ndarray:
        """The features tried at nodes, in ascending order, by the node's name."""
        order = _mixed(_mixed(names.astype(np.uint64) ^ self.key)[:, None] + np.arange(1, len(self.bins) + 1, dtype=np.uint64))
        return np.sort(np.argpartition(order, self.tried - 1, axis=1)[:, : self.tried], axis=1)

    def bins_of(self, codes: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """The bin of ``feature[i]`` in row i."""
        at = codes.ravel().take(np.arange(len(codes)) * codes.shape[1] + self.bundles.column.take(feature))
        return self.bundles.bins.ravel().take(feature * CODES + at)

    def counts(self, rows: Iterator[tuple], tried: np.ndarray, first: np.ndarray, cells: int) -> np.ndarray:
        """Drawn rows, which come by node, by (cell, class), where ``first`` is the first cell of every tried feature of a node."""
        classes = len(self.balance)
        out, cells_of_bin = np.zeros(cells * classes, np.int64), self.bundles.bins.ravel().astype(np.int64) * classes
        for codes, y, times, node in rows:
            y, times = y.astype(np.int64), times.astype(np.float64)
            base = np.arange(len(node)) * codes.shape[1]
            flat, start = codes.ravel(), 0
            while start < len(node):  # rows of neighbouring nodes, whose cells lie together
                low = int(first[node[start], 0])
                upto = int(np.searchsorted(first[:, 0], low + 8 * CELLS, side="left"))
                end = max(int(np.searchsorted(node, upto, side="left")), start + 1)
                end = int(np.searchsorted(node, node[end - 1], side="right"))
                own, here = slice(start, end), slice(int(node[start]), int(node[end - 1]) + 1)
                high = int(first[here.stop, 0]) if here.stop < len(first) else cells
                rows_of = np.bincount(node[own] - here.start, minlength=here.stop - here.start)
                slots = np.empty((self.tried, end - start), np.int64)
                for slot, feature, cell in zip(slots, tried[here].T, first[here].T):
                    code = flat.take(base[own] + np.repeat(self.bundles.column[feature], rows_of))
                    np.add(np.repeat(feature * CODES, rows_of), code, out=slot)
                    np.add(np.repeat((cell - low) * classes, rows_of), cells_of_bin.take(slot), out=slot)
                slots += y[own]
                found = np.bincount(slots.ravel(), np.tile(times[own], self.tried), (high - low) * classes)
                out[low * classes : high * classes] += found.astype(np.int64)
                start = end
        return out.reshape(cells, classes)

    def best(self, counts: np.ndarray, whole: np.ndarray, tried: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Gain, feature, cut and left counts of the best split of every node; a gain of 0 if there is none."""
        ends = np.cumsum(widths.ravel())
        segment = np.repeat(np.arange(widths.size), widths.ravel())
        upto = counts.cumsum(axis=0)
        before = np.concatenate([np.zeros_like(upto[:1]), upto[ends[:-1] - 1]])
        left = upto - before[segment]
        node = segment // self.tried
        right = whole[node] - left

        def score(part: np.ndarray) -> np.ndarray:
            weighted = part * self.balance
            return (weighted**2).sum(axis=1) / np.maximum(weighted.sum(axis=1), 1e-300)

        gain = score(left) + score(right) - score(whole)[node]
        gain[(left.sum(axis=1) < self.least) | (right.sum(axis=1) < self.least)] = 0.0
        first = ends.reshape(widths.shape)[:, 0] - widths[:, 0]
        most = np.maximum.reduceat(gain, first)
        hit = np.flatnonzero(gain == most[node])
        at = hit[np.unique(node[hit], return_index=True)[1]]
        most[most <= 1e-9 * (whole * self.balance).sum(axis=1)] = 0.0
        return most, tried.ravel()[segment[at]], at - (ends - widths.ravel())[segment[at]], left[at]


def grow(codes: np.ndarray, y: np.ndarray, times: np.ndarray, held: np.ndarray, growing: _Growing, depth: int) -> Tree:
    """A tree over rows drawn ``times`` times; ``held`` takes the node of every row at the present level, -1 when it is done."""
    classes, starts = len(growing.balance), range(0, len(y), CHUNK_ROWS)
    here = np.zeros((1, classes), np.int64)
    for s in starts:
        own = slice(s, s + CHUNK_ROWS)
        held[own] = 0
        here[0] += np.bincount(y[own], times[own], classes).astype(np.int64)
    names, nodes, shares, base, leaves = np.ones(1, np.int64), [], [], 0, 0
    for level in range(depth + 1):
        size = here.sum(axis=1)
        opened = np.flatnonzero((size >= growing.enough) & ((here > 0).sum(axis=1) > 1)) if level < depth else np.zeros(0, np.int64)
        gain, feature, cut = np.zeros(len(here)), np.full(len(here), -1, np.int64), np.zeros(len(here), np.int64)
        lefts = np.zeros_like(here)
        if len(opened):
            rank = np.full(len(here), -1, np.int64)
            rank[opened] = np.arange(len(opened))
            tried = growing.features_of(names[opened])
            widths = growing.bins[tried]
            upto = np.cumsum(widths.ravel()).reshape(widths.shape)

            def rows() -> Iterator[tuple]:
                for s in starts:
                    at = np.asarray(held[s : s + CHUNK_ROWS])
                    inside = np.flatnonzero(at >= 0)
                    place = rank.take(at[inside])
                    inside, place = inside[place >= 0], place[place >= 0]
                    order = np.argsort(place.astype(np.uint16) if len(opened) <= 1 << 16 else place, kind="stable")
                    inside = inside[order]
                    own = slice(s, s + CHUNK_ROWS)
                    yield codes[own].take(inside, axis=0), y[own].take(inside), times[own].take(inside), place.take(order)

            cells = int(upto[-1, -1])
            counts = growing.counts(rows(), tried, upto - widths, cells)
            start = 0
            while start < len(opened):
                low = int(upto[start, 0] - widths[start, 0])
                end = max(int(np.searchsorted(upto[:, -1], low + CELLS, side="right")), start + 1)
                own = opened[start:end]
                gain[own], feature[own], cut[own], lefts[own] = growing.best(
                    counts[low : int(upto[end - 1, -1])], here[own], tried[start:end], widths[start:end]
                )
                start = end
            feature[gain <= 0] = -1
        split = np.flatnonzero(feature >= 0)
        rank = np.full(len(here), -1, np.int64)
        rank[split] = np.arange(len(split))
        ends = feature < 0
        weighted = here[ends] * growing.balance
        shares.append((weighted / np.maximum(weighted.sum(axis=1, keepdims=True), 1e-300)).astype(np.float32))
        left = np.where(ends, base + np.arange(len(here)), base + len(here) + 2 * rank)
        leaf = np.where(ends, leaves + np.cumsum(ends) - 1, 0)
        nodes.append((feature, np.where(ends, 255, cut), left, leaf, gain))
        base, leaves = base + len(here), leaves + int(ends.sum())
        if not len(split):
            break
        for s in starts:
            at = np.asarray(held[s : s + CHUNK_ROWS])
            inside = np.flatnonzero(at >= 0)
            node = at[inside]
            going = rank.take(node) >= 0
            at[inside[~going]] = -1
            inside, node = inside[going], node[going]
            right = growing.bins_of(codes[s : s + CHUNK_ROWS][inside], feature.take(node)) > cut.take(node)
            at[inside] = 2 * rank.take(node) + right
            held[s : s + CHUNK_ROWS] = at
        here = np.stack([lefts[split], here[split] - lefts[split]], axis=1).reshape(-1, classes)
        names = np.stack([2 * names[split], 2 * names[split] + 1], axis=1).ravel()
    feature, cut, left, leaf, gain = (np.concatenate(part) for part in zip(*nodes))
    gains = np.bincount(feature[feature >= 0], gain[feature >= 0], len(growing.bins))
    return Tree(feature.astype(np.int16), cut.astype(np.uint8), left.astype(np.int32), leaf.astype(np.int32), np.concatenate(shares), gains, len(nodes) - 1)


@dataclasses.dataclass
class ForestModel:
    classes: int
    edges: np.ndarray
    trees: list[Tree]

    def importances(self) -> np.ndarray:
        """Mean over the trees of every feature's share of the gain; all zeros when nothing was split."""
        own = [t.gains / t.gains.sum() for t in self.trees if t.gains.sum() > 0]
        return np.mean(own, axis=0) if own else np.zeros(len(self.edges))

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """The mean over the trees of the class shares of a row's leaf."""
        codes = boosting._codes(x, self.edges)
        flat, first = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
        out = np.zeros((len(codes), self.classes))
        for tree in self.trees:
            at, asked = np.zeros(len(codes), np.int64), np.maximum(tree.feature, 0)
            for _ in range(tree.depth):
                at = tree.left.take(at) + (flat.take(first + asked.take(at)) > tree.cut.take(at))
            out += tree.shares[tree.leaf.take(at)]
        return out / len(self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` and ``prediction``."""
        return boosting.scored(df, self)


@dataclasses.dataclass
class Forest:
    """Estimator over ``features``, ``label`` and, when there is one, ``weight`` (one per class); fits all rows it is given.

    Every tree is grown from a resample with replacement; a node tries the square root of the features and the split with the least Gini impurity.
    ``least`` drawn rows at least stay in a leaf, a node of fewer than ``enough`` is not split.
    """

    trees: int = 200
    depth: int = 15
    seed: int = config.SEED
    least: int = 2
    enough: int = 5
    classes: int = 5
    row_id: str = "claim_id"

    def fit(self, df: DataFrame) -> ForestModel:
        own = [F.col(self.row_id)] if self.row_id in df.columns else []
        rows = boosting.packed(df, own)
        try:
            if not rows.total:
                raise ValueError("no rows to fit on")
            balance = np.array([rows.weights.get(k, 0.0) for k in range(self.classes)])
            tried = math.ceil(math.sqrt(len(rows.bins)))
            depth, least, enough, seed, total, bundles, bins = self.depth, self.least, self.enough, self.seed, rows.total, rows.bundles, rows.bins

            def grown(pairs: Iterable[tuple[int, bytes]]) -> Iterator[bytes]:
                held, tree = _Held(total), None
                for tree, data in pairs:
                    codes, y, marks = pickle.loads(data)
                    times = draws(marks, _key(seed, tree, 1))
                    drawn = np.flatnonzero(times)
                    held.add(codes[drawn], y[drawn], times[drawn])
                if tree is None:
                    return
                codes, y, times = held.columns()
                at = np.memmap(tempfile.TemporaryFile(), np.int32, "w+", shape=len(y)) if held.many and len(y) else np.zeros(len(y), np.int32)
                growing = _Growing(bundles, bins, balance, tried, least, enough, _key(seed, tree, 2))
                yield pickle.dumps(grow(codes, y, times, at, growing, depth))

            sc = df.sparkSession.sparkContext
            # Every partition is one tree and reads all blocks, one after another, from where they are cached.
            pairs = sc.parallelize(range(self.trees), self.trees).cartesian(rows.blocks.coalesce(1))
            return ForestModel(self.classes, rows.edges, [pickle.loads(t) for t in pairs.mapPartitions(grown).collect()])
        finally:
            rows.release()
