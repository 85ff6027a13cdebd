"""Audit of five document filters under every order of application.

Every document has a mask: the set of filters it fails. What a filter removes at a step follows from the masks alone, so the
corpus is read once and counted by (part, mask). The 120 orders are ranked lexicographically; all orders that begin with the
same k filters have consecutive Lehmer ranks, (5 - k)! of them. So what happens to a mask at step k is a list of intervals of
ranks, one per beginning of k filters. Counts are added where an interval begins and taken off where it ends; a prefix sum over
the 120 ranks then gives every total. The table of intervals is fixed; the counts have 32 rows per part.

Filters: A fewer than 200 words; B 100 * distinct words < 50 * words; C 100 * letters A-Z > 3 * code points; D holds any of
``#$%&*|``; E the same text as a row with a smaller id, wherever that row stands and whether or not it is removed.

Texts are compared by their SHA-256 digest. The rows that a text occurs in first are found by the smallest id per digest, a
pre-aggregated minimum, and joined back by digest and id together, so that a text that fills a third of the table is no hot key.

Defined cases: a null text is empty (it fails A alone, or A and E); a null part is the empty string; a null id never fails E and
makes no other row fail it; rows of the same id and text are each counted and do not make each other fail; a document is good
or toxic if any of its labels says so; labels without a document count nothing; an empty table gives an empty result; columns
beyond those used are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.llm.batches import blocks
from lossmetrics.llm.tables import written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Totals of a step that follow from intervals of ranks.
TOTALS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"


def _features(text: bytes, points: int) -> tuple[int, bytes]:
    """Mask of the filters A to D that a text fails, and its digest."""
    words = text.split()  # splits at space and tab to carriage return, and nothing else
    fails = len(words) < 200
    fails |= (100 * len(set(words)) < 50 * len(words)) << 1
    fails |= (100 * (len(text) - len(text.translate(None, _UPPER))) > 3 * points) << 2
    fails |= (len(text) != len(text.translate(None, _MARKS))) << 3
    return fails, hashlib.sha256(text).digest()


def text_masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, mask, digest) of every row: the filters A to D failed, as bits 0 to 3."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts = block.column("text")
            points = pc.utf8_length(texts).to_pylist()
            found = [_features(t, n) for t, n in zip(texts.cast(pa.binary()).to_pylist(), points)]
            masks, digests = pa.array([int(m) for m, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("part"), masks, digests], ["doc_id", "part", "mask", "digest"])

    return rows.mapInArrow(run, "doc_id long, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(part, mask, rows, good, toxic): documents by the set of filters they fail, E being bit 4."""
    masks = written(text_masks(docs, doc_id, text, part), "masks")
    first = masks.where(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.lit(True).alias("first"))
    found = masks.join(first, ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    mask = F.col("mask") + F.when(copy, 16).otherwise(0)
    counted = found.select("doc_id", "part", mask.alias("mask")).join(marks, "doc_id", "left").groupBy("part", "mask")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return counted.agg(F.count(F.lit(1)).alias("rows"), total("good"), total("toxic"))


def lehmer_rank(beginning: str, filters: str = FILTERS) -> int:
    """Rank of the first order, in lexicographic order, that begins with the given filters."""
    left, rank = sorted(filters), 0
    for letter in beginning:
        place = left.index(letter)
        rank += place * factorial(len(left) - 1)
        left.pop(place)
    return rank


def rank_intervals() -> list[tuple[int, int, str, int, int, int, int, int, int]]:
    """(mask, step, filter, first rank, rank behind the last, kept, removed, redundant, unique_fails) of every mask and beginning."""
    out = []
    for size in range(1, len(FILTERS) + 1):
        for beginning in permutations(FILTERS, size):
            first = lehmer_rank("".join(beginning))
            bits = [1 << FILTERS.index(x) for x in beginning]
            before, own = sum(bits[:-1]), bits[-1]
            for mask in range(1 << len(FILTERS)):
                fails, gone = bool(mask & own), bool(mask & before)
                kinds = (not fails and not gone, fails and not gone, fails and gone, mask == own)
                if any(kinds):
                    out.append((mask, size, beginning[-1], first, first + factorial(len(FILTERS) - size), *map(int, kinds)))
    return out


def interactions(counts: DataFrame, part: str = "part") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) from counts by mask.

    ``counts`` has (part, mask, rows, good, toxic). One row per part, order and step, zeros included.
    """
    spark = counts.sparkSession
    fields = "mask int, step int, filter string, low int, high int, is_kept int, is_removed int, is_redundant int, is_unique int"
    intervals = spark.createDataFrame(rank_intervals(), fields)  # a fixed table of some thousand rows
    amount: dict[str, Column] = {
        "kept": F.col("is_kept") * F.col("rows"),
        "removed": F.col("is_removed") * F.col("rows"),
        "redundant": F.col("is_redundant") * F.col("rows"),
        "unique_fails": F.col("is_unique") * F.col("rows"),
        "good_lost": F.col("is_removed") * F.col("good"),
        "toxic_lost": F.col("is_removed") * F.col("toxic"),
    }
    reached = counts.join(F.broadcast(intervals), "mask").select(part, "step", "filter", "low", "high", *(c.alias(k) for k, c in amount.items()))
    # Every step of every part has a difference at each of the ranks, if only zero, so that the sums reach all of them.
    grid = counts.select(part).distinct().select(part, F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    grid = grid.select(part, "step", F.explode(F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))).alias("rank"), *(F.lit(0).cast("long").alias(k) for k in TOTALS))
    begins = reached.select(part, "step", F.col("low").alias("rank"), *TOTALS)
    ends = reached.select(part, "step", F.col("high").alias("rank"), *((-F.col(k)).alias(k) for k in TOTALS))
    differences = begins.union(ends).union(grid).groupBy(part, "step", "rank").agg(*(F.sum(k).alias(k) for k in TOTALS))
    running = Window.partitionBy(part, "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    order = F.element_at(F.array(*map(F.lit, ORDERS)), F.col("rank") + 1)
    totals = differences.select(part, "step", "rank", *(F.sum(k).over(running).alias(k) for k in TOTALS)).where(F.col("rank") < len(ORDERS))
    totals = totals.withColumn("filter_order", order)
    totals = totals.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    shapley = reached.groupBy(part, "filter").agg(F.sum(F.col("removed") * (F.col("high") - F.col("low"))).alias("shapley"))
    joined = totals.join(shapley, [part, "filter"], "left")
    return joined.select(part, "filter_order", "step", *(F.col(k).cast("long").alias(k) for k in TOTALS), F.coalesce("shapley", F.lit(0)).cast("long").alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Totals of every part, order and step of the five filters."""
    return interactions(written(mask_counts(docs, labels, doc_id, text, part), "mask-counts"))
