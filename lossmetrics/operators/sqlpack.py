"""The view and query pack: four views and seventeen queries over the claim summary.

Each is an aggregate of the claims first; windows then run over months, years or cells, never over claims. Fields that a
query takes from a dimension are already columns of the summary, so a query is one scan of a few columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.functions.columns import change, count_where, exact_sum, mean, mean_amount, mean_paid, rows, total
from lossmetrics.functions.distributions import value_counts

def percent(flag: str | Column, digits: int = 2) -> Column:
    part = F.sum(flag) if isinstance(flag, str) else F.count_if(flag)
    return F.round(F.lit(100.0) * part / rows(), digits)


def monthly_metrics(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy("incident_month")
        .agg(
            rows().alias("claim_count"),
            total("paid_amount").alias("total_paid"),
            total("incurred_amount").alias("total_incurred"),
            mean("severity_level").alias("avg_severity"),
            mean("days_to_close", 1).alias("avg_days_to_close"),
            F.sum("litigation_flag").alias("litigation_count"),
            count_where(F.col("status") == "reopened").alias("reopen_count"),
        )
        .orderBy("incident_month")
    )


def triangle_cells(claims: DataFrame) -> DataFrame:
    return claims.groupBy("accident_year", "development_year").agg(
        exact_sum("paid_amount").alias("paid"), rows().alias("claim_count")
    )


def loss_triangle(claims: DataFrame) -> DataFrame:
    """Incremental and cumulative paid per cell; the running sum is over unrounded cells."""
    so_far = Window.partitionBy("accident_year").orderBy("development_year").rowsBetween(Window.unboundedPreceding, 0)
    return (
        triangle_cells(claims)
        .select(
            "accident_year",
            "development_year",
            F.round("paid", 2).cast("double").alias("incremental_paid"),
            F.round(F.sum("paid").over(so_far), 2).cast("double").alias("cumulative_paid"),
            "claim_count",
        )
        .orderBy("accident_year", "development_year")
    )


PROVIDER = ["provider_id", "provider_name", "specialty", "department", "risk_tier"]


def provider_scorecard(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy(*PROVIDER)
        .agg(
            rows().alias("claim_count"),
            mean("severity_level").alias("avg_severity"),
            mean_paid("paid_amount").alias("avg_paid"),
            total("paid_amount").alias("total_paid"),
            F.round(F.sum("litigation_flag") / rows(), 4).alias("litigation_rate"),
            mean("days_to_close", 1).alias("avg_days_to_close"),
            mean("days_to_report", 1).alias("avg_days_to_report"),
            count_where(F.col("status") == "reopened").alias("reopen_count"),
            F.sum("repeat_event_flag").alias("repeat_event_count"),
        )
        .orderBy(F.desc("total_paid"), "provider_id")
    )


def running_frequency(claims: DataFrame) -> DataFrame:
    so_far = Window.orderBy("incident_month").rowsBetween(Window.unboundedPreceding, 0)  # one row per month
    months = claims.groupBy("incident_month").agg(rows().alias("claim_count"))
    return months.withColumn("running_total", F.sum("claim_count").over(so_far)).orderBy("incident_month")


def severity_by_specialty(claims: DataFrame) -> DataFrame:
    levels = [count_where(F.col("severity_level") == n).alias(f"sev_{n}") for n in range(1, 6)]
    return (
        claims.groupBy("specialty")
        .agg(rows().alias("total_claims"), *levels, mean("severity_level").alias("avg_severity"))
        .orderBy(F.desc("avg_severity"), "specialty")
    )


def top_claims(claims: DataFrame, k: int = 10) -> DataFrame:
    """The k largest claims: each task keeps k rows, so nothing is sorted as a whole."""
    return (
        claims.select(
            "claim_id",
            "incident_date",
            "paid_amount",
            "incurred_amount",
            "severity_level",
            "status",
            "provider_id",
            "specialty",
            "risk_tier",
            "diagnosis_category",
            "state_code",
            "region",
        )
        .orderBy(F.desc("paid_amount"), "claim_id")
        .limit(k)
    )


def yearly_change(claims: DataFrame) -> DataFrame:
    years = claims.groupBy("accident_year").agg(rows().alias("claim_count"), total("paid_amount").alias("total_paid"))
    order = Window.orderBy("accident_year")  # one row per year
    before = F.lag("claim_count").over(order)
    return years.select(
        "accident_year",
        "claim_count",
        "total_paid",
        before.alias("prev_year_count"),
        F.lag("total_paid").over(order).alias("prev_year_paid"),
        change(F.col("claim_count"), before).alias("pct_change"),
    ).orderBy("accident_year")


def moving_average(claims: DataFrame) -> DataFrame:
    """Three-row moving average of the rounded monthly paid amounts."""
    months = claims.groupBy("incident_month").agg(total("paid_amount").alias("total_paid"))
    last_three = Window.orderBy("incident_month").rowsBetween(-2, 0)  # one row per month
    return months.withColumn("moving_avg_3m", F.round(F.avg("total_paid").over(last_three), 2)).orderBy("incident_month")


def aging_by_status(claims: DataFrame) -> DataFrame:
    days = F.col("days_to_close")
    bucket = (
        F.when(days.isNull(), "Still Open")
        .when(days <= 30, "0-30 days")
        .when(days <= 90, "31-90 days")
        .when(days <= 180, "91-180 days")
        .when(days <= 365, "181-365 days")
        .otherwise("365+ days")
    )
    return (
        claims.groupBy("status", bucket.alias("aging_bucket"))
        .agg(
            rows().alias("claim_count"),
            total("paid_amount").alias("total_paid"),
            mean_paid("paid_amount").alias("avg_paid"),
            F.min(F.coalesce(days, F.lit(9999))).alias("_first"),
        )
        .orderBy("status", "_first")
        .drop("_first")
    )


def triangle_pivot(claims: DataFrame, devs: int = 5) -> DataFrame:
    """Incremental paid per development year as columns, null where a cell has no claims."""
    cells = [
        total(F.when(F.col("development_year") == d, F.col("paid_amount"))).alias(f"dev_{d}")
        for d in range(devs)
    ]
    return claims.groupBy("accident_year").agg(*cells, total("paid_amount").alias("total_paid")).orderBy("accident_year")


def provider_risk(claims: DataFrame, min_claims: int = 5) -> DataFrame:
    return (
        claims.groupBy("provider_id", "specialty", "risk_tier")
        .agg(
            rows().alias("claim_count"),
            mean("severity_level").alias("avg_severity"),
            mean_paid("paid_amount").alias("avg_paid"),
            total("paid_amount").alias("total_paid"),
            percent("litigation_flag").alias("litigation_pct"),
            mean("days_to_close", 1).alias("avg_days_to_close"),
            F.sum("repeat_event_flag").alias("repeat_events"),
            percent(F.col("status") == "reopened").alias("reopen_pct"),
        )
        .where(F.col("claim_count") >= min_claims)
        .orderBy(F.desc("total_paid"), "provider_id")
    )


def severe_regions(claims: DataFrame, threshold: float = 2.5) -> DataFrame:
    return (
        claims.groupBy("region", "urban_rural")
        .agg(
            rows().alias("claim_count"),
            F.avg("severity_level").alias("_severity"),
            total("paid_amount").alias("total_paid"),
            mean_paid("paid_amount").alias("avg_paid"),
            F.sum("litigation_flag").alias("litigation_count"),
        )
        .where(F.col("_severity") > threshold)
        .withColumn("avg_severity", F.round("_severity", 2))
        .drop("_severity")
        .orderBy(F.desc("avg_severity"), "region", "urban_rural")
    )


def diagnosis_pareto(claims: DataFrame) -> DataFrame:
    ranked = claims.groupBy("diagnosis_category").agg(rows().alias("claim_count"), total("paid_amount").alias("total_paid"))
    order = [F.desc("total_paid"), F.col("diagnosis_category")]
    so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)  # one row per category
    everything = Window.partitionBy()
    return ranked.withColumn(
        "cumulative_pct",
        F.round(
            F.try_divide(F.lit(100.0) * F.sum("total_paid").over(so_far), F.sum("total_paid").over(everything)), 2
        ),
    ).orderBy(*order)


def lag_by_specialty(claims: DataFrame) -> DataFrame:
    """Reporting lag with the upper median: the sorted value at 0-based position n / 2.

    The position is found in the day counts of each specialty, so a large specialty never has its claims sorted.
    """
    days = value_counts(claims, "days_to_report", ["specialty"])
    by_day = Window.partitionBy("specialty").orderBy("value")
    placed = days.select(
        "specialty",
        "value",
        "n",
        F.sum("n").over(by_day).alias("upto"),
        F.sum("n").over(Window.partitionBy("specialty")).alias("total"),
    )
    middle = F.floor(F.col("total") / 2)
    at_middle = (middle >= F.col("upto") - F.col("n")) & (middle < F.col("upto"))
    return (
        placed.groupBy("specialty")
        .agg(
            F.sum("n").alias("claim_count"),
            F.round(F.sum(F.col("value") * F.col("n")) / F.sum("n"), 1).alias("avg_report_lag"),
            F.min("value").alias("min_report_lag"),
            F.max("value").alias("max_report_lag"),
            F.max(F.when(at_middle, F.col("value"))).alias("median_report_lag"),
        )
        .orderBy(F.desc("avg_report_lag"), "specialty")
    )


def litigation_by_region(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy("region", "severity_level")
        .agg(
            rows().alias("claim_count"),
            F.sum("litigation_flag").alias("litigation_count"),
            percent("litigation_flag").alias("litigation_pct"),
        )
        .orderBy("region", "severity_level")
    )


def reopened_comparison(claims: DataFrame) -> DataFrame:
    group = F.when(F.col("status") == "reopened", "Reopened").otherwise("Not Reopened")
    grouped = claims.groupBy(group.alias("claim_group")).agg(
        rows().alias("claim_count"),
        mean_paid("paid_amount").alias("avg_paid"),
        total("paid_amount").alias("total_paid"),
        mean("severity_level").alias("avg_severity"),
        mean("days_to_close", 1).alias("avg_days_to_close"),
        percent("litigation_flag").alias("litigation_pct"),
    )
    overall = F.sum("claim_count").over(Window.partitionBy())  # two rows
    return grouped.withColumn("pct_of_total", F.round(F.lit(100.0) * F.col("claim_count") / overall, 2)).orderBy(
        "claim_group"
    )


def seasonality(claims: DataFrame) -> DataFrame:
    return (
        claims.groupBy(F.month("incident_date").alias("incident_month_num"))
        .agg(
            F.date_format(F.min("incident_date"), "MMMM").alias("month_name"),
            rows().alias("claim_count"),
            mean("severity_level").alias("avg_severity"),
            total("paid_amount").alias("total_paid"),
            mean_paid("paid_amount").alias("avg_paid"),
        )
        .orderBy("incident_month_num")
    )


def cohorts(claims: DataFrame) -> DataFrame:
    """Share of the accident year's total per development stage, and its running share."""
    year = Window.partitionBy("accident_year")
    so_far = year.orderBy("development_year").rowsBetween(Window.unboundedPreceding, 0)
    cells = triangle_cells(claims).select(
        "accident_year",
        "development_year",
        F.col("paid").cast("double").alias("paid"),
        F.sum("paid").over(year).cast("double").alias("ultimate"),
        F.sum("paid").over(so_far).cast("double").alias("upto"),
    )
    return cells.select(
        "accident_year",
        "development_year",
        F.round("paid", 2).alias("stage_paid"),
        F.round("ultimate", 2).alias("ultimate_paid"),
        F.round(F.try_divide(F.lit(100.0) * F.col("paid"), "ultimate"), 2).alias("pct_of_ultimate"),
        F.round(F.try_divide(F.lit(100.0) * F.col("upto"), "ultimate"), 2).alias("cumulative_pct"),
    ).orderBy("accident_year", "development_year")


def outliers(claims: DataFrame, deviations: float = 3.0) -> DataFrame:
    """Claims above mean + 3 population deviations. The limits are one row, broadcast to the scan."""
    paid = F.col("paid_amount")
    spread = F.avg(paid * paid) - mean_amount(paid) * mean_amount(paid)
    limits = claims.agg(mean_amount(paid).alias("_mean"), F.sqrt(F.greatest(spread, F.lit(0.0001))).alias("_dev"))
    upper = F.col("_mean") + F.lit(deviations) * F.col("_dev")
    return (
        claims.crossJoin(F.broadcast(limits))
        .where(paid > upper)
        .select(
            "claim_id",
            "paid_amount",
            "severity_level",
            "status",
            "specialty",
            "region",
            "diagnosis_category",
            F.round("_mean", 2).alias("population_mean"),
            F.round(upper, 2).alias("upper_threshold"),
            F.round((paid - F.col("_mean")) / F.col("_dev"), 2).alias("z_score"),
        )
        .orderBy(F.desc("paid_amount"), "claim_id")
    )
