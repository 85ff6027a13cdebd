"""What-if scenarios: faster closing, lower severity, less litigation and the three together.

Each scenario is arithmetic on one row of portfolio totals; the levels are exploded from a literal array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmetrics.functions.columns import count_where, exact_sum, open_status, rows

COST_MULTIPLIER = 3.0


def _levels(percents: tuple[int, ...]) -> Column:
    return F.explode(F.array(*[F.lit(p) for p in percents]))


def _amount(c: Column) -> Column:
    """Rounded to cents, with -0.0 shown as 0.0."""
    return F.round(c, 2) + F.lit(0.0)


def _whole(c: Column) -> Column:
    return F.floor(c).cast("long")


def _pct(part: Column, base: Column) -> Column:
    return F.when(base > 0, F.round(F.try_divide(part, base) * 100, 2) + F.lit(0.0)).otherwise(0.0)


def close_time(claims: DataFrame, percents: tuple[int, ...] = (10, 20, 30)) -> DataFrame:
    """Close times shortened by a percentage: mean, median, claims over 180 / 365 days and the backlog."""
    value, n = F.col("value"), F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    factor = F.lit(1.0) - F.col("pct") / 100

    def over(limit: int, days: Column) -> Column:
        return F.sum(F.when(days > limit, n).otherwise(0)).cast("long")

    def weighted(days: Column) -> Column:
        return F.try_divide(F.sum(days * n), F.sum(n))

    # One row per close time and open status, then once per level: one scan, and everything else is on day counts.
    cells = claims.groupBy(F.col("days_to_close").alias("value"), open_status().alias("is_open")).agg(rows().alias("n"))
    joined = (
        cells.withColumn("pct", _levels(percents))
        .groupBy("pct")
        .agg(
            F.sum(n).alias("closed"),
            F.sum(F.when(F.col("is_open"), F.col("n")).otherwise(0)).cast("long").alias("open_backlog"),
            weighted(value.cast("double")).alias("mean0"),
            F.percentile(value, F.lit(0.5), n).alias("median0"),
            over(180, value).alias("over180"),
            over(365, value).alias("over365"),
            weighted(value * factor).alias("mean1"),
            F.percentile(value * factor, F.lit(0.5), n).alias("median1"),
            over(180, value * factor).alias("new_over180"),
            over(365, value * factor).alias("new_over365"),
        )
    )
    backlog = _whole(F.col("open_backlog") * factor)
    return joined.where(F.col("closed") > 0).select(
        F.col("pct").alias("reduction_pct"),
        F.round("mean0", 1).alias("mean_close_days"),
        F.round("median0", 1).alias("median_close_days"),
        F.col("over180").alias("claims_over_180_days"),
        F.col("over365").alias("claims_over_365_days"),
        "open_backlog",
        F.round("mean1", 1).alias("new_mean_close_days"),
        F.round("median1", 1).alias("new_median_close_days"),
        F.col("new_over180").alias("new_claims_over_180_days"),
        F.col("new_over365").alias("new_claims_over_365_days"),
        backlog.alias("estimated_backlog"),
        (F.round(F.col("mean1") - F.col("mean0"), 1) + F.lit(0.0)).alias("mean_close_days_change"),
        (F.col("new_over365") - F.col("over365")).alias("over_365_change"),
        (backlog - F.col("open_backlog")).alias("backlog_change"),
        _pct((F.col("new_over365") - F.col("over365")).cast("double"), F.col("over365")).alias("over_365_change_pct"),
        _pct((backlog - F.col("open_backlog")).cast("double"), F.col("open_backlog")).alias("backlog_change_pct"),
    )


def portfolio(claims: DataFrame) -> DataFrame:
    """The totals every cost scenario needs, from one scan: a single row."""
    incurred = F.col("incurred_amount")

    def part(prefix: str, condition: Column) -> list[Column]:
        amount = F.coalesce(exact_sum(F.when(condition, F.coalesce(incurred, F.lit(0.0)))).cast("double"), F.lit(0.0))
        n = F.count_if(condition)
        return [
            n.cast("long").alias(f"{prefix}_n"),
            amount.alias(f"{prefix}_sum"),
            F.coalesce(F.try_divide(amount, n), F.lit(0.0)).alias(f"{prefix}_avg"),
        ]

    litigated = F.coalesce("litigation_flag", F.lit(0))
    severity = F.col("severity_level")
    return claims.agg(
        rows().alias("total"),
        *part("all", F.lit(True)),
        *part("rated", severity.isNotNull()),
        *part("high", severity.isin(4, 5)),
        *part("mid", severity == 3),
        *part("lit", litigated == 1),
        *part("nolit", litigated == 0),
        count_where(open_status()).alias("open_n"),
    )


def severity_shift(claims: DataFrame, percents: tuple[int, ...] = (10, 20, 30)) -> DataFrame:
    """A percentage of severity 4-5 claims moves to the mean cost of severity 3."""
    moved = _whole(F.col("high_n") * F.col("pct") / 100)
    saving = moved * (F.col("high_avg") - F.col("mid_avg"))
    base = F.col("rated_sum")
    return (
        portfolio(claims)
        .withColumn("pct", _levels(percents))
        .where(F.col("rated_n") > 0)
        .select(
            F.col("pct").alias("shift_pct"),
            _amount(base).alias("baseline_total_incurred"),
            F.col("high_n").alias("high_severity_count"),
            _amount(F.col("high_sum")).alias("high_severity_incurred"),
            _amount(F.col("high_avg")).alias("avg_cost_severity_4_5"),
            _amount(F.col("mid_avg")).alias("avg_cost_severity_3"),
            moved.alias("claims_shifted"),
            (F.col("high_n") - moved).alias("remaining_high_severity"),
            _amount(base - saving).alias("new_total_incurred"),
            _amount(-saving).alias("absolute_change"),
            _pct(-saving, base).alias("pct_change"),
        )
    )


def litigation_cut(claims: DataFrame, percents: tuple[int, ...] = (25, 50)) -> DataFrame:
    """A percentage of litigated claims falls back to the mean cost of claims without litigation."""
    removed = _whole(F.col("lit_n") * F.col("pct") / 100)
    saving = removed * (F.col("lit_avg") - F.col("nolit_avg"))
    base = F.col("all_sum")
    return (
        portfolio(claims)
        .withColumn("pct", _levels(percents))
        .where(F.col("total") > 0)
        .select(
            F.col("pct").alias("reduction_pct"),
            F.col("total").alias("total_claims"),
            F.col("lit_n").alias("litigated_claims"),
            _pct(F.col("lit_n").cast("double"), F.col("total")).alias("litigation_rate_pct"),
            _amount(F.col("lit_avg")).alias("avg_cost_litigated"),
            _amount(F.col("nolit_avg")).alias("avg_cost_non_litigated"),
            _amount(F.col("lit_sum")).alias("total_litigation_cost"),
            F.lit(COST_MULTIPLIER).alias("cost_multiplier"),
            _amount(base).alias("baseline_total_incurred"),
            removed.alias("claims_no_longer_litigated"),
            (F.col("lit_n") - removed).alias("remaining_litigated"),
            _pct((F.col("lit_n") - removed).cast("double"), F.col("total")).alias("new_litigation_rate_pct"),
            _amount(base - saving).alias("new_total_incurred"),
            _amount(-saving).alias("absolute_change"),
            _pct(-saving, base).alias("pct_change"),
        )
    )


def combined(claims: DataFrame, severity_pct: int = 20, litigation_pct: int = 25, close_pct: int = 20) -> DataFrame:
    """Severity shift, litigation cut and the 5 % close-time rule together, with the reduced backlog."""
    base = F.col("all_sum")
    by_severity = _whole(F.col("high_n") * F.lit(severity_pct / 100)) * (F.col("high_avg") - F.col("mid_avg"))
    by_litigation = _whole(F.col("lit_n") * F.lit(litigation_pct / 100)) * (F.col("lit_avg") - F.col("nolit_avg"))
    by_closing = base * F.lit(close_pct / 100) * F.lit(0.05)
    saving = by_severity + by_litigation + by_closing
    fewer = _whole(F.col("open_n") * F.lit(1 - close_pct / 100))
    return portfolio(claims).select(
        _amount(base).alias("baseline_total_incurred"),
        _amount(base - saving).alias("new_total_incurred"),
        _amount(saving).alias("total_savings"),
        _amount(by_severity).alias("severity_shift_savings"),
        _amount(by_litigation).alias("litigation_reduction_savings"),
        _amount(by_closing).alias("close_time_reduction_savings"),
        _amount(-saving).alias("absolute_change"),
        _pct(-saving, base).alias("pct_change"),
        F.col("open_n").alias("baseline_open"),
        fewer.alias("estimated_new_open"),
        (F.col("open_n") - fewer).alias("backlog_reduction"),
        F.lit(severity_pct).alias("severity_shift_pct"),
        F.lit(litigation_pct).alias("litigation_reduction_pct"),
        F.lit(close_pct).alias("close_time_reduction_pct"),
        F.lit(0.05).alias("close_time_reserve_impact_factor"),
    )
