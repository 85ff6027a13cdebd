"""Time to close: histograms, percentiles, SLA compliance and the ageing of the backlog.

Everything is taken from day counts (see ``functions.distributions``), so no group of claims is gathered in a task.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.functions.columns import month_of, open_status, right_closed
from lossmetrics.functions.distributions import (
    counted_mean,
    counted_percentile,
    counted_rows,
    counts_by_dimension,
    value_counts,
    with_total_row,
)
from lossmetrics.sources.lookups import values_frame

# Bucket limits and labels.
CLOSE_EDGES = [0, 30, 60, 90, 120, 180, 270, 365, 545, 730]
CLOSE_LABELS = ["0-30", "31-60", "61-90", "91-120", "121-180", "181-270", "271-365", "366-545", "546-730", "730+"]
AGE_BUCKETS = [("0-30", 0, 30), ("31-90", 31, 90), ("91-180", 91, 180), ("181-365", 181, 365), ("365+", 366, 999_999)]


def bucket_histogram(claims: DataFrame, column: str, edges: list[int], labels: list[str]) -> DataFrame:
    """Claims per right-closed bucket, empty buckets included; a value of 0 lies in no bucket."""
    placed = value_counts(claims, column).select(right_closed("value", edges, labels).alias("bucket"), "n")
    counts = placed.where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("n").alias("claim_count"))
    shown = values_frame(claims.sparkSession, list(enumerate(labels, 1)), ["position", "bucket"])
    return shown.join(counts, "bucket", "left").select(
        "position", "bucket", F.coalesce("claim_count", F.lit(0)).cast("long").alias("claim_count")
    )


def close_histogram(claims: DataFrame) -> DataFrame:
    return bucket_histogram(claims, "days_to_close", CLOSE_EDGES, CLOSE_LABELS)


def close_percentiles(claims: DataFrame) -> DataFrame:
    return value_counts(claims, "days_to_close").agg(
        counted_rows().alias("claim_count"),
        F.round(counted_percentile(0.5), 1).alias("median_overall"),
        F.round(counted_mean(), 1).alias("mean_overall"),
        F.round(counted_percentile(0.95), 1).alias("p95"),
    )


def close_by(claims: DataFrame, *keys: str) -> DataFrame:
    """Median, mean and count per value of each key, as (dimension, member) rows from one scan."""
    return (
        counts_by_dimension(claims, "days_to_close", list(keys))
        .groupBy("dimension", "member")
        .agg(
            F.round(counted_percentile(0.5), 1).alias("median"),
            F.round(counted_mean(), 1).alias("mean"),
            counted_rows().alias("claim_count"),
        )
    )


def within(days: int) -> Column:
    return F.sum(F.when(F.col("value") <= days, F.col("n")).otherwise(0)) / F.sum("n") * 100


def sla_compliance(claims: DataFrame, thresholds: tuple[int, ...] = config.SLA_DAYS) -> DataFrame:
    """Share of closed claims within each threshold per claim type and overall."""
    days = value_counts(claims, "days_to_close", ["claim_type"])
    return with_total_row(
        days,
        "claim_type",
        "overall",
        counted_rows().alias("claim_count"),
        *[F.round(within(t), 2).alias(f"within_{t}_days_pct") for t in thresholds],
    ).where(F.col("claim_count") > 0)


def open_ages(claims: DataFrame, as_of: datetime.date = config.AS_OF) -> DataFrame:
    """Age in days of open and reopened claims, from the report date or else the incident date."""
    start = F.coalesce("report_date", "incident_date")
    return claims.where(open_status()).withColumn("age_days", F.datediff(F.lit(as_of), start))


def backlog_aging(claims: DataFrame, as_of: datetime.date = config.AS_OF) -> DataFrame:
    """Open claims per age bucket with totals on every row; a negative age lies in no bucket."""
    open_claims = open_ages(claims, as_of)
    ages = value_counts(open_claims, "age_days")

    def in_bucket(low: int, high: int) -> Column:
        inside = F.col("value").between(low, high)
        return F.coalesce(F.sum(F.when(inside, F.col("n")).otherwise(0)), F.lit(0)).cast("long")

    facts = ages.agg(
        *[in_bucket(low, high).alias(label) for label, low, high in AGE_BUCKETS],
        F.round(counted_percentile(0.5), 1).alias("median_age_days"),
        F.round(counted_mean(), 1).alias("mean_age_days"),
    )
    opened = open_claims.agg(F.count(F.lit(1)).alias("total_open"))
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(label).alias("bucket"), F.col(f"`{label}`").alias("open_claims"))
            for i, (label, _, _) in enumerate(AGE_BUCKETS, 1)
        ]
    )
    return facts.crossJoin(F.broadcast(opened)).select(
        F.inline(entries), "total_open", "median_age_days", "mean_age_days"
    )


def monthly_close_trend(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull()).withColumn("incident_month", month_of("incident_date"))
    days = value_counts(dated, "days_to_close", ["incident_month"])
    return days.groupBy("incident_month").agg(F.round(counted_percentile(0.5), 1).alias("median_days_to_close"))
