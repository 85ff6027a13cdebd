"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, with softmax output.

The features of a document are its words, the 3- and 4-character windows of its words with their borders, and its pairs of
neighbouring words (hashed by the difference of the word hashes, so that every immediate repetition is one feature). Each
feature falls in one of ``buckets`` vectors. A document's vector is the mean over its features; a softmax layer turns it
into class probabilities. Vectors and layer are trained together by stochastic gradient descent in numpy, on at most
``fit_rows`` labelled rows drawn by a hash of their id, half of each class: that is the only bounded sample. As the layer is
linear, a trained model is one number per bucket, and scoring reads every text once, map-only.

Defined cases: a null or empty text has no feature and gets the score of the bias; null ids and labels are not learnt from;
an id labelled more than once counts with its lowest label; without labels of both classes the bias alone decides
(0.5 without any); equal texts score alike, wherever they stand; an existing column of the result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from lossmetrics.llm.batches import assemble, blocks, with_fields
from lossmetrics.llm.words import BLOCK_BYTES, Block, mix

BUCKETS = 1 << 16
FIT_ROWS = 2_048
WINDOWS = (3, 4)


def features(block: Block, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner (row of the block) and bucket of every feature."""
    words = block.word_hashes()
    owners, found = [block.owner], [words]
    inside = block.owner[1:] == block.owner[:-1]
    pairs = words[1:][inside] - words[:-1][inside]
    owners.append(block.owner[1:][inside])
    found.append(mix(pairs + np.uint64(0x51ED270B)))
    blank = np.cumsum(np.concatenate(([0], block.space)), dtype=np.int32)
    where = np.repeat(np.arange(block.texts), np.diff(block.bounds))
    for n in WINDOWS:
        starts = np.arange(0, max(0, len(block.symbols) - n + 1))
        # Windows without white space but for their two borders; a text starts with its own line feed.
        middle = blank[starts + n - 1] - blank[starts + 1] == 0
        starts = starts[middle]
        owners.append(where[starts])
        found.append(block.hashes(starts, starts + n, salt=n))
    return np.concatenate(owners), (np.concatenate(found) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Model:
    """Score of a document: 1 / (1 + exp(-(bias + mean weight of its features)))."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        block = Block(texts, code_points=True)
        owner, bucket = features(block, len(self.weights))
        total = np.bincount(owner, self.weights[bucket], block.texts)
        count = np.bincount(owner, minlength=block.texts)
        return 1.0 / (1.0 + np.exp(-(self.bias + total / np.maximum(count, 1))))


def fit(
    counts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int, size: int = 16, epochs: int = 8, rate: float = 5.0, seed: int = 7
) -> Model:
    """Stochastic gradient descent over documents given as distinct buckets and their counts."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / size, 1 / size, (buckets, size))
    layer, bias = np.zeros((2, size)), np.zeros(2)
    if len(labels):
        share = np.bincount(labels, minlength=2) / len(labels)
        bias = np.log(np.maximum(share, 1e-3))
    if len(set(labels.tolist())) == 2:
        steps = epochs * len(labels)
        for step, row in enumerate(k for _ in range(epochs) for k in random.permutation(len(labels))):
            bucket, count = counts[row]
            if not len(bucket):
                continue
            part = count / count.sum()
            hidden = part @ vectors[bucket]
            raw = layer @ hidden + bias
            chance = np.exp(raw - raw.max())
            slope = chance / chance.sum()
            slope[labels[row]] -= 1.0
            pace = rate * (1 - step / steps)
            back = layer.T @ slope
            layer -= 0.1 * pace * np.outer(slope, hidden)
            bias -= 0.01 * pace * slope
            vectors[bucket] -= pace * np.outer(part, back)
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def sample(labels: DataFrame, rows: int, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """At most ``rows`` labelled ids, at most half of them of each class, by a hash of the id."""
    clean = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias(label))
    half = [
        clean.where(F.col(label) == value).orderBy(F.xxhash64(F.lit(17), key), key).limit(rows // 2) for value in (0, 1)
    ]
    return half[0].unionByName(half[1])


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS, buckets: int = BUCKETS
) -> Model:
    """Fit on a bounded sample of the labelled rows; the texts are turned into bucket counts by the executors."""
    chosen = F.broadcast(sample(labels, fit_rows, key, label))  # fit_rows rows at most
    rows = docs.select(key, text).join(chosen, key).groupBy(key, label).agg(F.min(text).alias(text)).select(label, text)
    ints = ArrayType(IntegerType(), False)
    schema = StructType([StructField(label, IntegerType()), StructField("bucket", ints), StructField("count", ints)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text, BLOCK_BYTES):
            block = Block(part.column(text).to_pylist(), code_points=True)
            owner, bucket = features(block, buckets)
            cells, count = np.unique(owner * buckets + bucket, return_counts=True)
            cut = np.searchsorted(cells, np.arange(1, block.texts) * buckets)
            as_lists = lambda x: pa.array(np.split(x.astype(np.int32), cut), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column(label).cast(pa.int32()), as_lists(cells % buckets), as_lists(count)], ["label", "bucket", "count"]
            )

    table = rows.mapInArrow(run, schema).toArrow().combine_chunks()
    counts = [
        (b.values.to_numpy(), c.values.to_numpy()) for b, c in zip(table.column("bucket"), table.column("count"), strict=True)
    ]
    # The order of arriving rows is not fixed; the order of training is.
    order = sorted(range(len(counts)), key=lambda k: (counts[k][0].tobytes(), counts[k][1].tobytes()))
    marks = table.column(label).to_numpy().astype(np.int64)
    return fit([counts[k] for k in order], marks[order], buckets)


def score(df: DataFrame, model: Model, text: str = "text", result: str = "score") -> DataFrame:
    """``df`` with the score of every whole text; all other columns stay."""
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 4 bytes per bucket
    schema = with_fields(df, [StructField(result, DoubleType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for part in blocks(batches, text, BLOCK_BYTES):
            yield assemble(part, schema, {result: pa.array(own.scores(part.column(text).to_pylist()))})

    return df.mapInArrow(run, schema)
