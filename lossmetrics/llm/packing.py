"""Packing of token sequences: documents are encoded, cut and put together in sequences of a fixed most length.

Bounded-space online best fit. A task holds a fixed number of open sequences, in stacks by their free space; a bit set has one
bit per free space that occurs. A piece goes to the open sequence with the least free space that holds it, which is the
lowest bit from its length on. When one sequence too many is open, the fullest closes first: the lowest bit of all.

What a task still holds open at its end, beyond a few tokens of free space, is packed again in the next round by far
fewer tasks, longest pieces first. The round of one task closes all, as does one that needs as many tasks as the one before. A round
reads a written table, so a lost task is packed again from the same rows; sequence numbers are made of round, task and
count. A piece is at most one sequence long and a task holds at most ``OPEN`` sequences, whatever the table's size.

Defined cases: a null or empty text is one piece, the end token alone; a text with more tokens than fit is cut, its last piece
is shorter; repeated rows and null ids are packed like any other; an empty table gives an empty result; columns of the table
other than the id and the text are left out.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lossmetrics.llm import bpe
from lossmetrics.llm.batches import blocks
from lossmetrics.llm.tables import written

#: Most tokens of a sequence, the token behind every document, and the sequences a task holds open.
CAPACITY, END, OPEN = 2048, 0, 4096
#: Free tokens up to which a sequence is not packed again.
SLACK = 8
#: Pieces packed by one task of a later round.
PIECES = 200_000
#: Rows of a batch handed on.
_ROWS = 10_000


def pieces(df: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): every text's tokens and the end token, cut where a sequence is full.

    ``start`` counts the document's tokens before the piece; ``ids_crc32`` is over the ids as little-endian 32-bit integers.
    """
    definition = bpe.broadcast_vocabulary(df, tokenizer_path)
    rows = df.select(F.col(doc_id), F.col(text).alias("text"))
    long = lambda name: StructField(name, LongType(), False)
    fields = [rows.schema[doc_id], StructField("piece", IntegerType(), False), long("start"), long("length"), long("ids_crc32")]
    schema = StructType(fields + ([StructField("ids", ArrayType(IntegerType(), False), False)] if keep_ids else []))
    last = array("i", [end]).tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder_of(definition.value)
        for block in blocks(batches, "text", bpe.BLOCK):
            packed = [p + last for p in encoder.views(block.column("text").to_pylist())["packed"]]
            row, piece, cut = [], [], []
            for k, p in enumerate(packed):
                for n, at in enumerate(range(0, len(p), 4 * capacity)):
                    row.append(k)
                    piece.append(n)
                    cut.append(p[at : at + 4 * capacity])
            number = np.array(piece, np.int64)
            found = [
                block.column(doc_id).take(pa.array(row, pa.int32())),
                pa.array(piece, pa.int32()),
                pa.array(number * capacity),
                pa.array([len(c) // 4 for c in cut], pa.int64()),
                pa.array([zlib.crc32(c) for c in cut], pa.int64()),
            ]
            if keep_ids:
                found.append(bpe.id_lists(cut))
            yield pa.RecordBatch.from_arrays(found, schema.fieldNames())
        encoder.forget()

    return rows.mapInArrow(run, schema)


class OpenSequences:
    """A fixed number of open sequences; put() gives a piece its place, and what closes on the way comes out whole."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN):
        self.capacity, self.most, self.count, self.bits = capacity, most, 0, 0
        self.by_free: list[list[list]] = [[] for _ in range(capacity + 1)]

    def put(self, row: tuple, length: int) -> list | None:
        """Place a row; the rows of the sequence that this closes, if any."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            rows = self._take(free)
        else:
            free, rows = self.capacity, []
        rows.append(row)
        free -= length
        if not free:
            return rows
        self.by_free[free].append(rows)
        self.bits |= 1 << free
        self.count += 1
        return self._take((self.bits & -self.bits).bit_length() - 1) if self.count > self.most else None

    def _take(self, free: int) -> list:
        found = self.by_free[free]
        rows = found.pop()
        if not found:
            self.bits ^= 1 << free
        self.count -= 1
        return rows

    def rest(self) -> Iterator[tuple[int, list]]:
        """(free space, rows) of every sequence that is still open."""
        for free, found in enumerate(self.by_free):
            for rows in found:
                yield free, rows


def _round(table: DataFrame, number: int, last: bool, capacity: int, most: int) -> DataFrame:
    """One round over the partitions of a table: its columns, the sequence and place of each row, below 0 where its sequence is to be packed again."""
    own = [f for f in table.schema.fields if f.name not in ("sequence_id", "offset")]
    schema = StructType([*own, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    out = table.select(*(f.name for f in own))
    length_at = [f.name for f in own].index("length")
    types = [None] * len(own)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, sequences = (number << 56) | (TaskContext.get().partitionId() << 32), 0
        held = OpenSequences(capacity, most)
        done: list[tuple] = []

        def close(rows: list, closed: bool) -> None:
            nonlocal sequences
            offset = 0
            for row in rows:
                # Rows that are packed again have a place below 0 until then.
                done.append((*row, base + sequences, offset if closed else -1 - offset))
                offset += row[length_at]
            sequences += 1

        def batch() -> pa.RecordBatch:
            columns = list(zip(*done))
            arrays = [pa.array(c, t) for c, t in zip(columns, [*types, pa.int64(), pa.int64()])]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

        for part in batches:
            types[:] = part.schema.types
            for row in zip(*(c.to_pylist() for c in part.columns)):
                full = held.put(row, row[length_at])
                if full is not None:
                    close(full, True)
                if len(done) >= _ROWS:
                    yield batch()
        for free, rows in held.rest():
            close(rows, last or free <= SLACK)
            if len(done) >= _ROWS:
                yield batch()
        if done:
            yield batch()

    return out.mapInArrow(run, schema)


def pack(table: DataFrame, capacity: int = CAPACITY, most: int = OPEN) -> DataFrame:
    """``table`` with ``sequence_id`` and ``offset``; it has a ``length`` of 1 to ``capacity`` and no such columns yet.

    Rounds are written tables; the result reads them.
    """
    done, number, tasks, last = [], 0, None, False
    while True:
        packed = written(_round(table, number, last, capacity, most), "packed")
        done.append(packed.where("offset >= 0"))
        left = packed.where("offset < 0").drop("offset")
        count = 0 if last else left.count()
        if not count:
            break
        fewer = -(-count // PIECES)
        last = fewer == 1 or (tasks is not None and fewer >= tasks)
        tasks, number = fewer, number + 1
        order = [F.desc("length"), *(c for c in left.columns if c not in ("length", "sequence_id", "ids"))]
        table = left.repartition(fewer, "sequence_id").sortWithinPartitions(*order)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def token_sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts): the tokens of every sequence and where its pieces begin; ``packed`` holds ``ids``."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("rows"))  # at most one sequence long
    return rows.select("sequence_id", F.flatten("rows.ids").alias("ids"), F.col("rows.offset").alias("starts"))
