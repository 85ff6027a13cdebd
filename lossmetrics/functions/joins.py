"""Lookup sides of joins with claim-sized tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most cells (rows times columns) of a side that is broadcast, about 64 MB; a larger one is joined by shuffle.
CELLS = 4_000_000


def lookup(side: DataFrame, cells: int = CELLS) -> DataFrame:
    """A join side, marked for broadcast when it is counted to be small.

    Spark's own limit looks at the size of files and is a few megabytes, from where on every claim is shuffled for a few
    columns. The count comes from the footers of a written table; a side beyond the bound is left to the optimizer.
    """
    return F.broadcast(side) if side.count() * len(side.columns) <= cells else side
