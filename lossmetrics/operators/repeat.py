"""Reopened claims and repeat events: rates overall and per provider, cause, specialty, severity and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmetrics.functions.columns import count_where, reopened, rows, share
from lossmetrics.functions.distributions import union_all


def _reopened() -> Column:
    return F.coalesce(F.count_if(reopened()), F.lit(0)).cast("long")


def reopen_rate(claims: DataFrame) -> DataFrame:
    return claims.agg(
        rows().alias("total_claims"),
        _reopened().alias("reopened_claims"),
        F.coalesce(share(_reopened(), rows()), F.lit(0.0)).alias("reopen_rate_pct"),
    )


def reopen_by_provider(claims: DataFrame, min_claims: int = 5, k: int = 50) -> DataFrame:
    """Providers with the highest reopen rates. Name and specialty depend on the provider, so the aggregate carries them."""
    return (
        claims.where(F.col("provider_id").isNotNull())
        .groupBy("provider_id")
        .agg(
            F.count("claim_id").alias("claim_count"),
            _reopened().alias("reopened"),
            F.min("provider_name").alias("provider_name"),
            F.min("specialty").alias("specialty"),
        )
        .where(F.col("claim_count") >= min_claims)
        .withColumn("reopen_rate_pct", share(F.col("reopened"), F.col("claim_count")))
        .orderBy(F.desc("reopen_rate_pct"), "provider_id")
        .limit(k)
    )


def reopen_by(claims: DataFrame, key: str) -> DataFrame:
    return (
        claims.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(rows().alias("claim_count"), _reopened().alias("reopened"), share(_reopened(), rows()).alias("reopen_rate_pct"))
    )


def litigation_link(claims: DataFrame) -> DataFrame:
    """Litigation rate by reopen status and reopen rate by litigation status, from one four-cell table."""
    cells = claims.groupBy(
        F.coalesce(reopened().cast("int"), F.lit(0)).alias("re"),
        F.coalesce("litigation_flag", F.lit(0)).alias("lit"),
    ).agg(rows().alias("n"))

    def split(by: str, other: str, yes: str, no: str, measure: str) -> DataFrame:
        return cells.groupBy(by).agg(
            F.sum("n").alias("claim_count"),
            F.round(F.sum(F.col(other) * F.col("n")) / F.sum("n") * 100, 2).alias("rate_pct"),
        ).select(
            F.lit(measure).alias("measure"),
            F.when(F.col(by) == 1, yes).otherwise(no).alias("status_group"),
            "claim_count",
            "rate_pct",
        )

    return union_all(
        [
            split("re", "lit", "reopened", "not_reopened", "litigation_rate_by_reopen_status"),
            split("lit", "re", "litigated", "not_litigated", "reopen_rate_by_litigation_status"),
        ]
    )


def repeat_events(claims: DataFrame) -> DataFrame:
    """Repeat-event counts and rates overall, by severity and by claim type, and the overlap with reopened claims.

    The three levels are rolled up from one (severity, type) table, so the claims are scanned once.
    """
    flag = F.coalesce("repeat_event_flag", F.lit(0))
    cells = claims.groupBy("severity_level", "claim_type").agg(
        rows().alias("n"),
        F.sum(flag).alias("hits"),
        count_where((flag == 1) & reopened()).alias("both"),
    )

    levels = F.array(
        F.struct(F.lit("overall").alias("dimension"), F.lit("all").alias("member")),
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("member")) for c in ("severity_level", "claim_type")],
    )
    return (
        cells.select(F.inline(levels), "n", "hits", "both")
        .where(F.col("member").isNotNull())
        .groupBy("dimension", "member")
        .agg(
            F.sum("n").alias("claim_count"),
            F.sum("hits").alias("repeat_count"),
            F.round(F.sum("hits") / F.sum("n") * 100, 2).alias("repeat_rate_pct"),
            F.sum("both").alias("repeat_and_reopened"),
        )
    )
