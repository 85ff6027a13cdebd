"""Connected components of a graph of links, by alternating large and small stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossmetrics.llm.tables import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest node known to each node.

    Edges are (``u``, ``v``) with u > v. A large star looks at all neighbours of a node and moves the larger ones; a small
    star looks at the smaller ones and moves these and the node itself. Each is a pre-aggregated minimum and a join.
    """
    seen = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = seen.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``component``) for every node of a link; the component is its smallest node.

    Self-links and repeated links count once, links with a null end are left out, no link gives an empty table. The number
    of rounds grows with the logarithm of the longest path; every round is a written table, so nothing is recomputed after a
    loss.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = written(edges, "edges")
    state = None
    while True:
        sign = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(sign) == state or sign[0] == 0:
            break
        state = tuple(sign)
        edges = written(_stars(_stars(edges, True), False), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
