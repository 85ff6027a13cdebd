"""Arrow helpers of the operators that run on batches inside Spark tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of text handled at once inside a task; a longer single text is still handled whole.
BLOCK_BYTES = 4 << 20


def blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the values of ``column`` in a block hold about ``limit`` bytes; every row comes out once, in order."""
    for batch in batches:
        start = held = 0
        for row, size in enumerate(_sizes(batch.column(column)).tolist()):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)
        del batch
        pa.default_memory_pool().release_unused()  # a worker lives on after its task, beside the executor's heap


def give_back() -> None:
    """Hand freed memory back to the system where the C library can: a Python worker lives on beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _sizes(array: pa.Array) -> np.ndarray:
    """Bytes of each string, binary or list of integers."""
    wide = pa.types.is_list(array.type)
    lengths = pc.list_value_length(array) if wide else pc.binary_length(array)
    return pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64) * (4 if wide else 1)


def with_fields(df: DataFrame, fields: list[StructField], drop: Iterable[str] = ()) -> StructType:
    """Schema of ``df`` without ``drop`` and without columns named like a new field, then the new fields."""
    gone = {f.name for f in fields} | set(drop)
    return StructType([f for f in df.schema.fields if f.name not in gone] + fields)


def assemble(batch: pa.RecordBatch, schema: StructType, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """Columns of ``schema``: new arrays by name, the others from the batch."""
    names = schema.fieldNames()
    return pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names)


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns of these names renamed, and a function that brings back the columns of ``df`` alone."""
    clash = {c for c in df.columns if c in set(names)}
    away = {c: f"__own_{c}" for c in clash}
    return df.withColumnsRenamed(away), lambda out: out.select(*(F.col(away.get(c, c)).alias(c) for c in df.columns))
