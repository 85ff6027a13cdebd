"""Frequency and severity: counts per period, severity mixes, loss ratios and year-over-year changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.functions.columns import change, count_where, exact_sum, mean, month_of, quarter_of, rows, total
from lossmetrics.functions.distributions import counted_percentile, counted_rows, value_counts


def levels(column: str = "severity_level") -> list[Column]:
    return [count_where(F.col(column) == n).alias(f"sev_{n}") for n in range(1, 6)]


def monthly_by_type(claims: DataFrame) -> DataFrame:
    """Claims per month and claim type, for all types found, 0 where a month has none, with the month's total.

    Months and types meet on the counted cells; what is joined to every month is one row, the list of types.
    """
    known = claims.where(F.col("incident_date").isNotNull() & F.col("claim_type").isNotNull())
    cells = known.groupBy(month_of("incident_date").alias("incident_month"), "claim_type").agg(rows().alias("n"))
    months = cells.groupBy("incident_month").agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("claim_type", "n"))).alias("counts")
    )
    types = cells.agg(F.collect_set("claim_type").alias("types"))
    filled = months.join(F.broadcast(types)).withColumn("claim_type", F.explode("types"))  # one row
    count = F.coalesce(F.col("counts")[F.col("claim_type")], F.lit(0))
    return filled.select("incident_month", "claim_type", count.alias("claim_count"), "total")


def quarterly_counts(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull())
    return dated.groupBy(quarter_of("incident_date").alias("incident_quarter")).agg(rows().alias("claim_count"))


def yearly_counts(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull())
    years = dated.groupBy(F.year("incident_date").alias("incident_year")).agg(rows().alias("claim_count"))
    before = F.lag("claim_count").over(Window.orderBy("incident_year"))  # one row per year
    return years.withColumn("yoy_change_pct", change(F.col("claim_count"), before))


def severity_distribution(claims: DataFrame) -> DataFrame:
    """Count and share per severity, with the overall mean and median on every row."""
    counts = value_counts(claims, "severity_level")  # one row per severity
    overall = counts.agg(
        counted_rows().alias("_all"),
        F.round(F.sum(F.col("value") * F.col("n")) / F.sum("n"), 2).alias("mean_severity"),
        counted_percentile(0.5).alias("median_severity"),
    )
    return counts.crossJoin(F.broadcast(overall)).select(
        F.col("value").alias("severity_level"),
        F.col("n").alias("claim_count"),
        F.round(F.col("n") / F.col("_all") * 100, 2).alias("percentage"),
        "mean_severity",
        "median_severity",
    )


def severity_by(claims: DataFrame, key: str) -> DataFrame:
    """Claims per severity level as columns for each value of a key."""
    known = claims.where(F.col("severity_level").isNotNull() & F.col(key).isNotNull())
    return known.groupBy(key).agg(*levels())


def specialty_points(claims: DataFrame) -> DataFrame:
    known = claims.where(F.col("severity_level").isNotNull() & F.col("specialty").isNotNull())
    return known.groupBy("specialty").agg(
        F.count("claim_id").alias("claim_count"),
        mean("severity_level").alias("avg_severity"),
        total("paid_amount").alias("total_paid"),
    )


def loss_ratio(claims: DataFrame, key: str | None = "claim_type") -> DataFrame:
    """Paid over incurred per key (or overall), null where nothing is incurred."""
    keys = [key] if key else []
    known = claims.where(F.col(key).isNotNull()) if key else claims
    paid, incurred = exact_sum("paid_amount").cast("double"), exact_sum("incurred_amount").cast("double")
    return known.groupBy(*keys).agg(
        total("paid_amount").alias("total_paid"),
        total("incurred_amount").alias("total_incurred"),
        F.when(incurred > 0, F.round(F.try_divide(paid, incurred), 4)).alias("loss_ratio"),
    )


def yearly_metrics(claims: DataFrame) -> DataFrame:
    """Count, paid, incurred and mean severity per year with the change of the first three."""
    dated = claims.where(F.col("incident_date").isNotNull())
    years = dated.groupBy(F.year("incident_date").alias("incident_year")).agg(
        F.count("claim_id").alias("claim_count"),
        exact_sum("paid_amount").cast("double").alias("_paid"),
        exact_sum("incurred_amount").cast("double").alias("_incurred"),
        mean("severity_level").alias("avg_severity"),
    )
    order = Window.orderBy("incident_year")  # one row per year

    def against_last(c: str) -> Column:
        return change(F.col(c), F.lag(c).over(order))

    return years.select(
        "incident_year",
        "claim_count",
        F.round("_paid", 2).alias("total_paid"),
        F.round("_incurred", 2).alias("total_incurred"),
        "avg_severity",
        against_last("claim_count").alias("claim_count_yoy_pct"),
        against_last("_paid").alias("total_paid_yoy_pct"),
        against_last("_incurred").alias("total_incurred_yoy_pct"),
    )
