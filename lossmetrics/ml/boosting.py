"""Multinomial gradient boosting of regression trees, grown level by level from sums that Spark adds up.

Features are binned once: their borders come from quantile sketches. Binned rows lie in cached blocks, two-valued features that never
meet in one column (``bundles.py``). A round adds one tree per class, all classes side by side. For a level, every task adds up
slope and curvature of its rows by (tree, node, column, code), the sums of the tasks are added up in a tree, and the driver
looks for the best split of every node in that small table. Leaves take a Newton step. What reaches the driver is classes x
nodes x features x bins numbers, whatever the number of rows.

Scores of the rows follow from those of the round before; every twenty-five rounds they are computed from the binned rows anew, so
that a lost block is never more than as many steps away. Slopes and curvatures are summed as whole numbers of 2**-24, so a
model does not depend on how the rows are dealt out.

Rows that fit four blocks need no sums from other tasks: all their rounds are grown where the block lies, in one job whose result
is the trees. The model is the same.

Defined cases: a feature with one value is never split; a class without rows keeps its start; no rows are an error.
"""

from __future__ import annotations

import dataclasses
import pickle
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lossmetrics.ml import bundles
from lossmetrics.ml.bundles import CODES, Bundles

BINS = 32
#: Slopes and curvatures are summed in this unit.
UNIT = 1 << 24
#: Rows of a block, rounds between two passes over all trees, blocks whose sums may meet on the driver, and blocks boosted in place.
BLOCK_ROWS, ROUNDS_KEPT, BLOCKS, IN_PLACE = 1 << 16, 25, 64, 4
#: Rows added up at once, and the unit of their number beside the curvature: both in one double, to the unit.
SUM_ROWS, ROW = 1 << 14, 1 << 37

Tree = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def borders(df: DataFrame, features: str = "features") -> np.ndarray:
    """Inner bin borders per feature, halfway between neighbouring quantiles; unused ones are infinite.

    The quantiles are those of a sketch with an error of one in 10,000, with least and greatest value among them.
    """
    values = df.select(F.posexplode(vector_to_array(features)).alias("feature", "x"))
    grid = [k / BINS for k in range(BINS + 1)]
    found = values.groupBy("feature").agg(F.percentile_approx("x", grid, 10_000).alias("q"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
    out = np.full((len(found), BINS - 1), np.inf)
    for row in found:
        cuts = np.unique([row["low"], *row["q"], row["high"]])
        if len(cuts) > BINS:
            cuts = cuts[np.unique(np.linspace(0, len(cuts) - 1, BINS).astype(int))]
        middle = (cuts[1:] + cuts[:-1]) / 2
        out[row["feature"], : len(middle)] = middle
    return out


def _walk(codes: np.ndarray, tree: Tree, packed: Bundles | None = None, steps: int | None = None) -> np.ndarray:
    """The node, in heap order, that every row comes to, at last or after some steps; a leaf leads to itself. ``codes`` are by feature or ``packed``."""
    _, feature, cut, _ = tree
    own, asked = np.arange(len(feature)), np.maximum(feature, 0)
    bins = np.tile(np.arange(CODES), (len(feature), 1)) if packed is None else packed.bins[asked]
    child = np.where((feature < 0)[:, None], own[:, None], 2 * own[:, None] + (bins > cut[:, None])).ravel()
    column = asked if packed is None else packed.column[asked]
    flat, first = codes.ravel(), np.arange(len(codes)) * codes.shape[1]
    at = np.ones(len(codes), np.int64)
    for _ in range(int(np.log2(len(feature))) - 1 if steps is None else steps):
        at = child.take(CODES * at + flat.take(first + column.take(at)))
    return at


def _raised(raw: np.ndarray, codes: np.ndarray, trees: Iterable[Tree], packed: Bundles | None = None) -> np.ndarray:
    raw = raw.copy()
    for tree in trees:
        raw[:, tree[0]] += tree[3][_walk(codes, tree, packed)]
    return raw


def _chances(raw: np.ndarray) -> np.ndarray:
    by_class = np.ascontiguousarray(raw.T)  # long rows are worked through faster than short ones
    chance = np.exp(by_class - by_class.max(axis=0))
    return (chance / chance.sum(axis=0)).T


def bin_starts(edges: np.ndarray) -> np.ndarray:
    """Where the bins of each feature begin in one row of all used bins, and how many there are."""
    return np.concatenate([[0], np.cumsum(np.isfinite(edges).sum(axis=1) + 1)])


def level_sums(codes: np.ndarray, y: np.ndarray, raw: np.ndarray, growing: list[Tree], level: int, packed: Bundles) -> np.ndarray:
    """Slope, curvature and rows by (tree, node of the level, code of a column), as whole numbers."""
    nodes, first = 2**level, np.concatenate([[0], np.cumsum(packed.widths)])
    out = np.zeros((3, len(growing), nodes, int(first[-1])), np.int64)
    for start in range(0, len(y), SUM_ROWS):
        rows = slice(start, start + SUM_ROWS)
        chances, columns = np.ascontiguousarray(_chances(raw[rows]).T), codes[rows].T.astype(np.int64)
        for k, tree in enumerate(growing):
            node, own, p = _walk(codes[rows], tree, packed, level) - nodes, columns, chances[tree[0]]
            slope, curve = np.rint((p - (y[rows] == tree[0])) * UNIT), np.rint(p * (1 - p) * UNIT) + ROW
            inside = node >= 0
            if not inside.all():
                node, own, slope, curve = node[inside], columns[:, inside], slope[inside], curve[inside]
            for n, width in enumerate(packed.widths.tolist()):
                slot, at = node * width + own[n], slice(first[n], first[n + 1])
                both = np.bincount(slot, curve, nodes * width).astype(np.int64).reshape(nodes, width)
                out[0, k, :, at] += np.bincount(slot, slope, nodes * width).astype(np.int64).reshape(nodes, width)
                out[1, k, :, at] += both & (ROW - 1)
                out[2, k, :, at] += both >> 37
    return out


def split_level(sums: np.ndarray, growing: list[Tree], level: int, starts: np.ndarray, least: int, enough: int, rate: float) -> bool:
    """Split the nodes of a level where that gains, give the new leaves their values; whether any was split."""
    first, any_split = 2**level, False
    feature_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    for k, (_, feature, cut, value) in enumerate(growing):
        upto = sums[:, k].cumsum(axis=2)
        before = np.concatenate([np.zeros_like(upto[:, :, :1]), upto[:, :, starts[1:-1] - 1]], axis=2)
        whole = upto[:, :, starts[1] - 1 : starts[1]]
        left = upto - before[:, :, feature_of]
        right = whole - left
        score = lambda part: (part[0] / UNIT) ** 2 / (part[1] / UNIT + 1e-9)
        gain = score(left) + score(right) - score(whole)
        gain[(left[2] < least) | (right[2] < least) | (whole[2] < enough)] = -np.inf
        best = gain.argmax(axis=1)
        step = lambda part, *place: -rate * (part[(0, *place)] / UNIT) / (part[(1, *place)] / UNIT + 1e-9)
        if level == 0:
            value[1] = step(whole, 0, 0)
        for node in np.flatnonzero(gain[np.arange(len(gain)), best] > 1e-9):
            at, place = first + node, int(best[node])
            feature[at], cut[at] = feature_of[place], place - starts[feature_of[place]]
            value[2 * at], value[2 * at + 1] = step(left, node, place), step(right, node, place)
            any_split = True
    return any_split


@dataclasses.dataclass
class BoostedModel:
    classes: int
    start: np.ndarray
    edges: np.ndarray
    trees: list[Tree]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _chances(_raised(np.tile(self.start, (len(x), 1)), _codes(x, self.edges), self.trees))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` and ``prediction``."""
        return scored(df, self)


def scored(df: DataFrame, model) -> DataFrame:
    """``df`` with the ``probability`` and ``prediction`` of a model that turns features into ``probabilities``."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # trees x nodes, whatever the number of rows
    plain = df.drop("probability", "prediction").withColumn("_x", vector_to_array("features")).drop("features", "raw_features")
    plain = plain.select(*[c for c, kind in plain.dtypes if kind != "vector"])
    kept = [f for f in plain.schema.fields if f.name != "_x"]
    schema = type(plain.schema)(list(kept)).add("_p", ArrayType(DoubleType())).add("prediction", DoubleType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else None
            chance = shared.value.probabilities(x) if batch.num_rows else np.zeros((0, shared.value.classes))
            ends = pa.array(np.arange(0, chance.size + 1, shared.value.classes, dtype=np.int32))
            new = [pa.ListArray.from_arrays(ends, pa.array(chance.ravel())), pa.array(chance.argmax(axis=1).astype(float))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *new], schema.fieldNames())

    return plain.mapInArrow(run, schema).withColumn("probability", array_to_vector("_p")).drop("_p")


def _codes(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[k], x[:, k]) for k in range(x.shape[1])], axis=1).astype(np.uint8)


def binned(df: DataFrame, edges: np.ndarray, ids: list[Column], limit: int) -> DataFrame:
    """(block): codes, labels and marks of about ``limit`` rows each, packed; a mark is a hash of a row and its ``ids``."""
    x = vector_to_array("features")
    rows = df.select(x.alias("x"), F.col("label").cast("int").alias("y"), F.xxhash64(x, F.col("label"), *ids).alias("mark"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def block() -> pa.RecordBatch:
            made = pickle.dumps(tuple(np.concatenate(part) for part in zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["block"])

        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                held.append((_codes(x, edges), batch.column("y").to_numpy(zero_copy_only=False).astype(np.uint8), batch.column("mark").to_numpy(zero_copy_only=False)))
            if sum(len(part[1]) for part in held) >= limit:
                yield block()
        if held:
            yield block()

    return rows.mapInArrow(run, "block binary")


@dataclasses.dataclass
class Packed:
    """Binned rows in cached blocks of (codes by column, label, mark), with the bins of every feature and the rows and weight of every class."""

    edges: np.ndarray
    bins: np.ndarray
    bundles: Bundles
    blocks: RDD
    counts: dict[int, int]
    weights: dict[int, float]

    @property
    def total(self) -> int:
        return sum(self.counts.values())

    def release(self) -> None:
        self.blocks.unpersist()


def packed(df: DataFrame, ids: list[Column]) -> Packed:
    """All rows of ``df``, binned, with features that never meet in one column; in few blocks, however many parts ``df`` has."""
    weight = F.max("weight") if "weight" in df.columns else F.lit(1.0)
    found = df.groupBy(F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"), weight.alias("weight")).collect()  # a row per class
    counts = {r["label"]: r["n"] for r in found}
    edges = borders(df)
    bins = np.isfinite(edges).sum(axis=1) + 1
    total, limit = sum(counts.values()), BLOCK_ROWS
    parts = max(1, min(max(df.sparkSession.sparkContext.defaultParallelism, total // (4 * limit)), total // 1000))
    by_feature = binned(df, edges, ids, max(1, min(limit, total // (4 * parts)))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        raw = by_feature.rdd.map(lambda row: bytes(row[0]))

        def met(blocks: Iterator[bytes]) -> Iterator[np.ndarray]:
            yield sum((bundles.together(pickle.loads(data)[0], bins) for data in blocks), np.zeros((len(bins), len(bins)), np.int64))

        own = bundles.found(raw.mapPartitions(met).treeReduce(np.add) if counts else np.zeros((0, 0)), bins)

        def merged(blocks: Iterator[bytes]) -> Iterator[bytes]:
            held: list[tuple[np.ndarray, ...]] = []
            for data in blocks:
                codes, y, marks = pickle.loads(data)
                if held and sum(len(part[1]) for part in held) + len(y) > limit:
                    yield pickle.dumps(tuple(np.concatenate(part) for part in zip(*held)))
                    held.clear()
                held.append((codes, y, marks))
            if held:
                yield pickle.dumps(tuple(np.concatenate(part) for part in zip(*held)))


        def dealt(part: int, blocks: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
            """Every block with the part it goes to, taken in turn."""
            for n, data in enumerate(blocks):
                codes, *rest = pickle.loads(data)
                yield part + n, pickle.dumps((own.pack(codes), *rest))

        even = raw.mapPartitionsWithIndex(dealt).partitionBy(parts, int).values()  # a few bytes a row are shuffled
        blocks = even.mapPartitions(merged).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.count()
    finally:
        by_feature.unpersist()
    return Packed(edges, bins, own, blocks, counts, {r["label"]: float(r["weight"]) for r in found})


@dataclasses.dataclass
class Boosted:
    """Estimator over ``features`` and ``label``; fits all rows it is given, wherever they lie.

    ``least`` rows at least stay in a leaf, a node of fewer than ``enough`` rows is not split.
    """

    rounds: int = 150
    depth: int = 5
    rate: float = 0.1
    least: int = 2
    enough: int = 5
    classes: int = 5

    def _grown(self, sums_of: Callable[[list[Tree], int], np.ndarray], starts: np.ndarray) -> list[Tree]:
        """One tree per class, each level split by its sums over all rows."""
        size = 2 ** (self.depth + 1)
        growing: list[Tree] = [(k, np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)) for k in range(self.classes)]
        for level in range(self.depth):
            if not split_level(sums_of(growing, level), growing, level, starts, self.least, self.enough, self.rate):
                break
        return growing

    def _grow(self, state: RDD, packed: Bundles, bins: np.ndarray, starts: np.ndarray) -> list[Tree]:
        """One tree per class, each level from one aggregate over all blocks."""

        def summed(growing: list[Tree], level: int) -> np.ndarray:
            def sums(blocks: Iterator[bytes], level: int = level, growing: list = growing) -> Iterator[np.ndarray]:
                total = None
                for data in blocks:
                    own = level_sums(*pickle.loads(data), growing, level, packed)
                    total = own if total is None else total + own
                if total is not None:
                    yield total

            found = state.mapPartitions(sums)
            parts = state.getNumPartitions()
            return packed.by_feature(sum(found.collect()) if parts <= BLOCKS else found.treeReduce(np.add, depth=3), bins)

        return self._grown(summed, starts)

    def _grow_in_place(self, blocks: RDD, packed: Bundles, bins: np.ndarray, start: np.ndarray, starts: np.ndarray) -> list[Tree]:
        """All rounds over the rows of at most ``IN_PLACE`` blocks, in the task that holds them."""

        def run(blocks: Iterator[bytes]) -> Iterator[list[Tree]]:
            held = [pickle.loads(data) for data in blocks]
            codes, y = (np.concatenate(part) for part in list(zip(*held))[:2])
            raw, trees = np.tile(start, (len(y), 1)), []
            for _ in range(self.rounds):
                grown = self._grown(lambda growing, level: packed.by_feature(level_sums(codes, y, raw, growing, level, packed), bins), starts)
                raw = _raised(raw, codes, grown, packed)
                trees += grown
            yield trees

        return blocks.coalesce(1).mapPartitions(run).collect()[0]

    def fit(self, df: DataFrame) -> BoostedModel:
        rows = packed(df, [])
        state, older = None, None
        try:
            if not rows.total:
                raise ValueError("no rows to fit on")
            start = np.log(np.maximum([rows.counts.get(k, 0) / rows.total for k in range(self.classes)], 1e-6))
            own, starts = rows.bundles, bin_starts(rows.edges)
            if rows.total <= IN_PLACE * BLOCK_ROWS:
                return BoostedModel(self.classes, start, rows.edges, self._grow_in_place(rows.blocks, own, rows.bins, start, starts))
            trees: list[Tree] = []
            for done in range(self.rounds):

                def anew(data: bytes, known: tuple = (start, list(trees))) -> bytes:
                    codes, y, _ = pickle.loads(data)
                    return pickle.dumps((codes, y, _raised(np.tile(known[0], (len(y), 1)), codes, known[1], own)))

                def raised(data: bytes, last: tuple = tuple(trees[-self.classes :])) -> bytes:
                    codes, y, raw = pickle.loads(data)
                    return pickle.dumps((codes, y, _raised(raw, codes, last, own)))

                older = state
                state = (rows.blocks.map(anew) if done % ROUNDS_KEPT == 0 else older.map(raised)).persist(StorageLevel.MEMORY_AND_DISK)
                trees += self._grow(state, own, rows.bins, starts)
                if older is not None:
                    older.unpersist()
        finally:
            for kept in (state, older):
                if kept is not None:
                    kept.unpersist()
            rows.release()
        return BoostedModel(self.classes, start, rows.edges, trees)
