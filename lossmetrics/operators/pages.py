"""Interactive-page aggregates: a composable filter and the numbers behind every chart and KPI."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.functions.columns import (
    exact_sum,
    mean,
    mean_paid,
    month_of,
    open_status,
    quarter_of,
    rows,
    total,
)
from lossmetrics.functions.distributions import (
    counted_mean,
    counted_percentile,
    counted_rows,
    union_all,
    value_counts,
    with_total_row,
)
from lossmetrics.operators.closing import AGE_BUCKETS, open_ages, within
from lossmetrics.operators.frequency import levels, specialty_points
from lossmetrics.sources.lookups import HIGH_LITIGATION_STATES


def filtered(
    claims: DataFrame,
    years: list[int] | None = None,
    claim_types: list[str] | None = None,
    severities: list[int] | None = None,
    regions: list[str] | None = None,
    start: datetime.date | str | None = None,
    end: datetime.date | str | None = None,
    state: str | None = None,
) -> DataFrame:
    """Claims that pass every given filter; an empty filter keeps all. Years prune partitions, the rest is pushed down."""
    wanted = {"accident_year": years, "claim_type": claim_types, "severity_level": severities, "region": regions}
    for column, values in wanted.items():
        if values:
            claims = claims.where(F.col(column).isin(list(values)))
    if start:
        claims = claims.where(F.col("incident_date") >= F.lit(start).cast("date"))
    if end:
        claims = claims.where(F.col("incident_date") <= F.lit(end).cast("date"))
    if state:
        claims = claims.where(F.col("state_code") == state)
    return claims


def kpis(claims: DataFrame) -> DataFrame:
    """Six headline figures with their change from the prior to the latest accident year (null where not available).

    One scan gives one row per accident year with sums; totals and the two years are picked from those rows.
    """
    per_year = claims.groupBy("accident_year").agg(
        rows().alias("n"),
        exact_sum("paid_amount").alias("paid"),
        F.sum("severity_level").alias("sev"),
        F.count("severity_level").alias("sev_n"),
        F.sum("days_to_close").alias("days"),
        F.count("days_to_close").alias("days_n"),
        F.sum("litigation_flag").alias("lit"),
        F.count_if(open_status()).alias("open"),
    )
    newest = Window.partitionBy(F.col("accident_year").isNotNull()).orderBy(F.desc("accident_year"))  # one row per year
    ranked = per_year.withColumn("r", F.when(F.col("accident_year").isNotNull(), F.row_number().over(newest)))
    measures = {
        "total_claims": lambda at: at("n").cast("double"),
        "total_paid": lambda at: at("paid").cast("double"),
        "avg_severity": lambda at: F.try_divide(at("sev").cast("double"), at("sev_n")),
        "avg_days_to_close": lambda at: F.try_divide(at("days").cast("double"), at("days_n")),
        "litigation_rate_pct": lambda at: F.try_divide(at("lit").cast("double"), at("n")) * 100,
        "open_claims": lambda at: at("open").cast("double"),
    }

    def whole(c: str) -> Column:
        return F.sum(c)

    def year(rank: int):
        return lambda c: F.sum(F.when(F.col("r") == rank, F.col(c)))

    many = F.max("r") >= 2
    entries = []
    for i, (name, f) in enumerate(measures.items(), 1):
        now, before = f(year(1)), F.when(many, f(year(2)))
        growth = F.when(before != 0, F.round((now - before) / before * 100, 1))
        value = F.coalesce(F.round(f(whole), 4), F.lit(0.0))
        entries.append(
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("kpi"), value.alias("value"), growth.alias("yoy_pct"))
        )
    return ranked.agg(F.array(*entries).alias("k")).select(F.inline("k"))


def sparkline(claims: DataFrame, value: str | None = None) -> DataFrame:
    """Monthly count, or monthly sum of an amount."""
    dated = claims.where(F.col("incident_date").isNotNull())
    measure = total(value) if value else rows()
    return dated.groupBy(month_of("incident_date").alias("incident_month")).agg(measure.alias("value"))


def counts_by(claims: DataFrame, *keys: str | Column) -> DataFrame:
    """Claims per combination of keys, rows with a null key left out."""
    grouped = claims.groupBy(*keys).agg(rows().alias("claim_count"))
    return grouped.dropna(subset=[c for c in grouped.columns if c != "claim_count"])


def month_key() -> Column:
    return month_of("incident_date").alias("incident_month")


def year_key() -> Column:
    return F.year("incident_date").alias("incident_year")


def status_counts(claims: DataFrame) -> DataFrame:
    return counts_by(claims, "status")


def top_root_causes(claims: DataFrame, k: int = 10) -> DataFrame:
    return counts_by(claims, "root_cause_category").orderBy(F.desc("claim_count"), "root_cause_category").limit(k)


def paid_incurred(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull())
    return dated.groupBy(month_key()).agg(total("paid_amount").alias("paid"), total("incurred_amount").alias("incurred"))


def quarterly_loss_ratio(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull())
    paid, incurred = exact_sum("paid_amount").cast("double"), exact_sum("incurred_amount").cast("double")
    ratio = F.when(incurred > 0, F.round(F.try_divide(paid, incurred), 6)).otherwise(0.0)
    return dated.groupBy(quarter_of("incident_date").alias("quarter")).agg(
        total("paid_amount").alias("paid"), total("incurred_amount").alias("incurred"), ratio.alias("loss_ratio")
    )


def severity_mix(claims: DataFrame) -> DataFrame:
    """Share of each severity within its quarter."""
    counts = counts_by(claims, quarter_of("incident_date").alias("quarter"), "severity_level")
    in_quarter = F.sum("claim_count").over(Window.partitionBy("quarter"))
    return counts.withColumn("share_pct", F.round(F.col("claim_count") / in_quarter * 100, 4))


def claim_type_totals(claims: DataFrame) -> DataFrame:
    known = claims.where(F.col("claim_type").isNotNull())
    return known.groupBy("claim_type").agg(
        F.count("claim_id").alias("claim_count"), total("paid_amount").alias("total_paid")
    )


def state_map(claims: DataFrame) -> DataFrame:
    return (
        claims.where(F.col("state_code").isNotNull())
        .groupBy("state_code")
        .agg(
            total("paid_amount").alias("total_paid"),
            F.count("claim_id").alias("claim_count"),
            mean("severity_level").alias("avg_severity"),
        )
    )


def department_severity(claims: DataFrame) -> DataFrame:
    known = claims.where(F.col("department").isNotNull() & F.col("severity_level").isNotNull())
    return known.groupBy("department").agg(*levels())


def top_states(claims: DataFrame, k: int = 10) -> DataFrame:
    return state_map(claims).select("state_code", "claim_count", "total_paid").orderBy(
        F.desc("claim_count"), "state_code"
    ).limit(k)


def urban_rural(claims: DataFrame) -> DataFrame:
    known = claims.where(F.col("urban_rural").isNotNull())
    return known.groupBy("urban_rural").agg(
        mean("severity_level").alias("avg_severity"),
        mean_paid("paid_amount", 0).alias("avg_paid"),
        F.count("claim_id").alias("claim_count"),
    )


def ops_kpis(claims: DataFrame, thresholds: tuple[int, ...] = config.SLA_DAYS) -> DataFrame:
    days = value_counts(claims, "days_to_close")

    def inside(t: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("value") <= t, F.col("n")).otherwise(0)), F.lit(0)).cast("long")

    return days.agg(
        counted_rows().alias("closed_claims"),
        F.coalesce(F.round(counted_mean(), 2), F.lit(0.0)).alias("avg_days_to_close"),
        F.round(counted_percentile(0.5), 2).alias("median_days_to_close"),
        *[inside(t).alias(f"within_{t}") for t in thresholds],
        *[F.coalesce(F.round(within(t), 2), F.lit(0.0)).alias(f"sla_{t}_pct") for t in thresholds],
    )


def capped_day_histogram(claims: DataFrame, column: str, bins: int, key: str | None = None) -> DataFrame:
    """Equal-width histogram of a day count clipped at its 99th percentile, per value of a key."""
    keys = [key] if key else []
    days = value_counts(claims, column, keys)
    days = days.dropna(subset=keys) if key else days
    limits = days.agg(
        counted_percentile(0.99).alias("cap"),
        counted_percentile(0.5).alias("median"),
        counted_mean().alias("mean"),
        F.min("value").alias("low"),
    )
    clipped = days.crossJoin(F.broadcast(limits)).withColumn("v", F.least(F.col("value").cast("double"), F.col("cap")))
    slot = F.floor(F.try_divide(F.col("v") - F.col("low"), F.col("cap") - F.col("low")) * bins)
    placed = clipped.withColumn("bin", F.coalesce(F.least(slot, F.lit(bins - 1)), F.lit(0)).cast("int"))
    return placed.groupBy(*keys, "bin").agg(
        F.sum("n").alias("claim_count"),
        F.round(F.first("cap"), 2).alias("cap_days"),
        F.round(F.first("median"), 1).alias("median_days"),
        F.round(F.first("mean"), 1).alias("mean_days"),
    )


def open_aging(claims: DataFrame, as_of: datetime.date = config.AS_OF) -> DataFrame:
    """Open claims per non-empty age bucket."""
    age = F.col("age_days")
    bucket = F.when(age < 0, F.lit(None).cast("string"))
    for label, _, high in AGE_BUCKETS:
        bucket = bucket.when(age <= high, F.lit(label))
    ages = open_ages(claims, as_of).select(bucket.alias("bucket"))
    return counts_by(ages, "bucket").withColumnRenamed("claim_count", "open_claims")


def sla_table(claims: DataFrame, thresholds: tuple[int, ...] = config.SLA_DAYS) -> DataFrame:
    days = value_counts(claims, "days_to_close", ["claim_type"])
    return with_total_row(
        days,
        "claim_type",
        "OVERALL",
        counted_rows().alias("claims"),
        F.round(counted_mean(), 1).alias("avg_close_days"),
        F.round(counted_percentile(0.5), 1).alias("median_close_days"),
        *[F.round(within(t), 1).alias(f"sla_{t}d_pct") for t in thresholds],
    ).where(F.col("claims") > 0)


def risk_segments(claims: DataFrame, k: int = 10) -> DataFrame:
    """Specialty x region x claim type by total paid times rounded mean severity, ranked; the rank is over k rows."""
    keys = ["specialty", "region", "claim_type"]
    paid = exact_sum("paid_amount").cast("double")
    segments = (
        claims.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count("claim_id").alias("claim_count"),
            mean("severity_level").alias("avg_severity"),
            total("paid_amount").alias("total_paid"),
            F.round(F.avg("litigation_flag") * 100, 1).alias("litigation_rate_pct"),
            F.round(paid * mean("severity_level"), 0).alias("risk_score"),
        )
    )
    top = segments.orderBy(F.desc("risk_score"), *keys).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("risk_score"), *keys)))


def risk_matrix(claims: DataFrame) -> DataFrame:
    """Specialties above the median in frequency and severity (High), in one of them (Medium) or in none (Low)."""
    points = specialty_points(claims)  # one row per specialty
    middle = points.agg(F.median("claim_count").alias("mid_count"), F.median("avg_severity").alias("mid_severity"))
    often, severe = F.col("claim_count") > F.col("mid_count"), F.col("avg_severity") > F.col("mid_severity")
    level = F.when(often & severe, "High").when(often | severe, "Medium").otherwise("Low")
    return points.crossJoin(F.broadcast(middle)).select(
        "specialty", "claim_count", "avg_severity", "total_paid", level.alias("risk_level")
    )


def recommendation_metrics(claims: DataFrame, states: list[str] | None = None) -> DataFrame:
    """The figures behind the recommendations, as metric / number / text rows.

    ``states`` are the codes with high litigation; the surgical mean falls back to all claims when no type is surgical.
    """
    chosen = F.col("state_code").isin(states or HIGH_LITIGATION_STATES)
    surgical = F.coalesce(F.col("claim_type").rlike("(?i)surg"), F.lit(False))
    severity, lit = F.col("severity_level"), F.col("litigation_flag")
    low = severity <= 2
    facts = claims.agg(
        F.coalesce(
            F.round(F.coalesce(F.avg(F.when(surgical, severity)), F.avg(severity)), 2), F.lit(0.0)
        ).alias("avg_surgical_severity"),
        F.count_if(low).cast("double").alias("low_severity_claims"),
        F.coalesce(F.round(F.avg(F.when(low, F.col("days_to_close"))), 0), F.lit(0.0)).alias("low_severity_avg_close"),
        F.coalesce(F.round(F.avg(F.when(chosen, lit)) * 100, 1), F.lit(0.0)).alias("high_litigation_state_pct"),
        F.coalesce(F.round(F.avg(lit) * 100, 1), F.lit(0.0)).alias("overall_litigation_pct"),
        F.coalesce(F.sum("repeat_event_flag"), F.lit(0)).cast("double").alias("repeat_events"),
    )
    numbers = facts.unpivot([], facts.columns, "metric", "number").withColumn("text", F.lit(None).cast("string"))
    lags = claims.where(F.col("specialty").isNotNull()).groupBy("specialty").agg(F.avg("days_to_report").alias("lag"))
    slowest = (
        lags.where(F.col("lag").isNotNull())
        .orderBy(F.desc("lag"), "specialty")
        .limit(1)
        .select(F.lit("slowest_specialty").alias("metric"), F.round("lag", 1).alias("number"), F.col("specialty").alias("text"))
    )
    causes = counts_by(claims.where(F.col("repeat_event_flag") == 1), "root_cause_category")
    top = (
        causes.orderBy(F.desc("claim_count"), "root_cause_category")
        .limit(3)
        .select(
            F.lit("top_repeat_cause").alias("metric"),
            F.col("claim_count").cast("double").alias("number"),
            F.col("root_cause_category").alias("text"),
        )
    )
    return union_all([numbers, slowest, top])
