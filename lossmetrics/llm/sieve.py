"""Rows of a large table that can be in a short list of keys, found without a shuffle.

The list's keys are hashed into a bit map, which is broadcast in pieces of 4 KB. A row whose bit is not set is not in the list; a row whose
bit is set may be, which an exact join decides. So only the rows of the list and a few others are shuffled by that join, however
long the list is.

The map has ``PER_KEY`` bits per key, counted first, and at most ``MOST`` bits (8 MB): a longer list lets more rows through and
stays right. Equal keys have one bit; a null key is in no list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, and the fewest (one piece) and the most of a map.
PER_KEY, LEAST, MOST = 16, 1 << 15, 1 << 26


def _bits(keys: int) -> int:
    return min(MOST, max(LEAST, 1 << (PER_KEY * keys - 1).bit_length())) if keys else LEAST


def split(df: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` may be among ``keys``, a written table, and the rows whose ``key`` is not; both have the columns of ``df``."""
    bits = _bits(keys.count())
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1  # from 1 on, as Spark numbers the bits of a map
    listed = keys.where(F.col(key).isNotNull()).select(place.alias("__place"))
    pieces = listed.groupBy(F.bitmap_bucket_number("__place").alias("__piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__place")).alias("__map"))
    found = df.withColumn("__place", place).withColumn("__piece", F.when(F.col(key).isNotNull(), F.bitmap_bucket_number("__place")))
    joined = found.join(F.broadcast(pieces), "__piece", "left")
    hit = F.coalesce(_bit("__map", F.bitmap_bit_position("__place")), F.lit(False))
    return joined.where(hit).select(*df.columns), joined.where(~hit).select(*df.columns)


def _bit(map_: str, position: Column) -> Column:
    """Whether the bit at a position is set; null without a map."""
    byte = F.conv(F.hex(F.substring(map_, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) > 0
