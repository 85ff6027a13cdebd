"""Reporting lag: distribution, groups, slow reporters and the monthly trend, all from day counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossmetrics.functions.columns import month_of
from lossmetrics.functions.distributions import (
    counted_mean,
    counted_percentile,
    counted_rows,
    counted_stddev,
    counts_by_dimension,
    value_counts,
)
from lossmetrics.operators.closing import bucket_histogram

# Bucket limits and labels.
LAG_EDGES = [0, 7, 14, 30, 60, 90, 180, 365]
LAG_LABELS = ["0-7", "8-14", "15-30", "31-60", "61-90", "91-180", "181-365", "365+"]


def lag_histogram(claims: DataFrame) -> DataFrame:
    return bucket_histogram(claims, "days_to_report", LAG_EDGES, LAG_LABELS)


def lag_percentiles(claims: DataFrame) -> DataFrame:
    return value_counts(claims, "days_to_report").agg(
        F.round(counted_percentile(0.5), 1).alias("median"),
        F.round(counted_mean(), 1).alias("mean"),
        F.round(counted_percentile(0.9), 1).alias("p90"),
        F.round(counted_percentile(0.95), 1).alias("p95"),
    )


def lag_by(claims: DataFrame, *keys: str) -> DataFrame:
    """Mean, median, count and deviation per value of each key, as (dimension, member) rows from one scan."""
    return (
        counts_by_dimension(claims, "days_to_report", list(keys))
        .groupBy("dimension", "member")
        .agg(
            F.round(counted_mean(), 1).alias("mean"),
            F.round(counted_percentile(0.5), 1).alias("median"),
            counted_rows().alias("claim_count"),
            F.round(counted_stddev(), 1).alias("std"),
        )
    )


def slow_reporters(claims: DataFrame, min_claims: int = 5, factor: float = 2.0, k: int = 50) -> DataFrame:
    """Providers whose mean lag exceeds a multiple of the overall median, slowest first."""
    days = value_counts(claims, "days_to_report", ["provider_id", "provider_name"])
    limit = days.agg(counted_percentile(0.5).alias("overall_median"))
    per_provider = (
        days.where(F.col("provider_id").isNotNull())
        .groupBy("provider_id")
        .agg(
            F.min("provider_name").alias("provider_name"),
            counted_rows().alias("claim_count"),
            counted_mean().alias("_mean"),
            F.round(counted_percentile(0.5), 1).alias("median_lag"),
        )
    )
    slowest = (
        per_provider.crossJoin(F.broadcast(limit))
        .where((F.col("claim_count") >= min_claims) & (F.col("_mean") > F.col("overall_median") * factor))
        .orderBy(F.desc("_mean"), "provider_id")
        .limit(k)
    )
    return slowest.select(
        "provider_id",
        "provider_name",
        "claim_count",
        F.round("_mean", 1).alias("mean_lag"),
        "median_lag",
        F.round(F.col("overall_median") * factor, 1).alias("threshold_days"),
        F.round("overall_median", 1).alias("overall_median"),
    )


def monthly_lag_trend(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull()).withColumn("incident_month", month_of("incident_date"))
    days = value_counts(dated, "days_to_report", ["incident_month"])
    return days.groupBy("incident_month").agg(
        F.round(counted_percentile(0.5), 1).alias("median"),
        F.round(counted_mean(), 1).alias("mean"),
        counted_rows().alias("claim_count"),
    )
