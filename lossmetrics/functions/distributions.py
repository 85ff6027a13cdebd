"""Exact distributions that merge map-side and never put a whole group into one task.

Day counts are reduced to ``(group, value, n)`` first: partial aggregation shrinks every group, however hot, to at most
one row per distinct day in each task. Means, deviations, percentiles, histograms and survival curves are then taken
from that table, whose size depends on the calendar and not on the number of claims.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.functions.columns import col


def value_counts(df: DataFrame, value: str | Column, keys: list[str] | None = None) -> DataFrame:
    """Rows ``keys, value, n`` for the non-null values."""
    keys = keys or []
    return (
        df.select(*keys, col(value).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def counts_by_dimension(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Value counts of several keys at once, as ``dimension, member, value, n``, from a single scan.

    The claims are counted per combination of all keys; each combination is then added to one row per key.
    """
    members = [F.struct(F.lit(k).alias("dimension"), F.col(k).cast("string").alias("member")) for k in keys]
    joint = value_counts(df, value, keys).select(F.inline(F.array(*members)), "value", "n")
    return joint.where(F.col("member").isNotNull()).groupBy("dimension", "member", "value").agg(F.sum("n").alias("n"))


def stacked_counts(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Value counts of several whole-number columns, as ``keys, feature, value, n``, from a single scan."""
    keys = keys or []
    whole = df.select(*keys, *[F.col(c).cast("long").alias(c) for c in columns])
    return value_counts(whole.unpivot(keys, columns, "feature", "value"), "value", [*keys, "feature"])


def counted_rows() -> Column:
    return F.coalesce(F.sum("n"), F.lit(0)).cast("long")


def counted_mean() -> Column:
    return F.try_divide(F.sum(F.col("value").cast("double") * F.col("n")), F.sum("n"))


def counted_percentile(p: float) -> Column:
    """Interpolated percentile of the counted values."""
    return F.percentile(F.col("value"), F.lit(p), F.col("n"))


def counted_stddev() -> Column:
    """Sample deviation from integer value counts; null for fewer than two rows."""
    n = F.sum("n").cast("double")
    sx = F.sum(F.col("value").cast("double") * F.col("n"))
    sxx = F.sum(F.col("value").cast("double") * F.col("value") * F.col("n"))
    return F.when(n > 1, F.sqrt(F.greatest(sxx - sx * sx / n, F.lit(0.0)) / (n - 1)))


def with_total_row(df: DataFrame, key: str, label: str, *aggregates: Column) -> DataFrame:
    """Aggregate per key plus one row over everything, in a single pass (rollup). Null keys count in the total only."""
    return (
        df.rollup(key)
        .agg(F.grouping_id().alias("_level"), *aggregates)
        .where((F.col("_level") == 1) | F.col(key).isNotNull())
        .withColumn(key, F.when(F.col("_level") == 1, F.lit(label)).otherwise(F.col(key)))
        .drop("_level")
    )


_FINE = 1024  # slices per factor e in the first cut
_PARTS = 65536  # slices of one first-cut interval in the second cut


def quantiles(df: DataFrame, value: str | Column, probs: dict[str, float]) -> DataFrame:
    """One row with exact interpolated quantiles of a real-valued column, at any data size.

    A percentile aggregate keeps every distinct amount in one task. Here the rank is narrowed in two counting passes
    over order-preserving slices (a logarithmic cut, then a linear cut of the slices that hold the wanted ranks), and
    only the values of the last slices are ranked. Each pass is a map-side count, so hot values cost nothing.
    """
    rows = df.select(col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    outer = F.floor(F.signum("v") * F.log1p(F.abs("v")) * F.lit(float(_FINE)))
    rows = rows.withColumn("s1", outer)

    first = rows.groupBy("s1").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    order = Window.orderBy("s1")  # at most ~90,000 slices over the whole double range of money amounts
    first = first.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy()))
    names = list(probs)
    ranks = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                (F.lit(float(p)) * (F.col("total") - 1)).alias("pos"),
            )
            for name, p in probs.items()
        ]
    )
    wanted = (
        first.withColumn("want", F.explode(ranks))
        .select("s1", "n", "lo", "hi", "total", (F.col("upto") - F.col("n")).alias("before"), "upto", "want.*")
        .withColumn("k", F.explode(F.array(F.floor("pos"), F.ceil("pos"))))
        .where((F.col("k") >= F.col("before")) & (F.col("k") < F.col("upto")))
        .distinct()
    )
    cuts = wanted.select("s1", "lo", "hi", "before").distinct()  # at most two slices per probability
    inner = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * _PARTS))
    narrowed = rows.join(F.broadcast(cuts), "s1").withColumn("s2", F.coalesce(inner, F.lit(0).cast("long")))

    second = narrowed.groupBy("s1", "before", "s2").agg(F.count(F.lit(1)).alias("n"))
    in_slice = Window.partitionBy("s1").orderBy("s2")  # at most 65,537 rows
    second = second.withColumn("upto2", F.col("before") + F.sum("n").over(in_slice))
    targets = (
        second.select("s1", "s2", (F.col("upto2") - F.col("n")).alias("before2"), "upto2")
        .join(F.broadcast(wanted.select("s1", "name", "pos", "k")), "s1")
        .where((F.col("k") >= F.col("before2")) & (F.col("k") < F.col("upto2")))
    )
    values = (
        narrowed.join(F.broadcast(targets.select("s1", "s2", "before2").distinct()), ["s1", "s2"])
        .groupBy("s1", "s2", "before2", "v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto3", F.col("before2") + F.sum("n").over(Window.partitionBy("s1", "s2").orderBy("v")))
    )
    hits = values.join(F.broadcast(targets.select("s1", "s2", "name", "pos", "k")), ["s1", "s2"]).where(
        (F.col("k") >= F.col("upto3") - F.col("n")) & (F.col("k") < F.col("upto3"))
    )
    low = F.max(F.when(F.col("k") == F.floor("pos"), F.col("v")))
    high = F.max(F.when(F.col("k") == F.ceil("pos"), F.col("v")))
    part = F.max(F.col("pos") - F.floor("pos"))
    per_name = hits.groupBy("name").agg((low + (high - low) * part).alias("q"))
    return per_name.agg(*[F.max(F.when(F.col("name") == name, F.col("q"))).alias(name) for name in names])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b), frames)
