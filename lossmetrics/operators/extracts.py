"""Extract tables for BI tools: monthly, severity, provider and regional sheets and the page downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossmetrics.functions.columns import count_where, mean, mean_paid, month_of, rows, total
from lossmetrics.functions.distributions import union_all
from lossmetrics.operators import scenarios, sqlpack


def monthly_metrics(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull())
    return dated.groupBy(month_of("incident_date").alias("month")).agg(
        F.count("claim_id").alias("claim_count"),
        total("paid_amount").alias("total_paid"),
        total("incurred_amount").alias("total_incurred"),
        mean("severity_level").alias("avg_severity"),
        mean("days_to_close", 1).alias("avg_days_to_close"),
        F.coalesce(F.sum("litigation_flag"), F.lit(0)).alias("litigation_count"),
        count_where(F.col("status") == "reopened").alias("reopen_count"),
    )


def monthly_sheet(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull())
    return dated.groupBy(month_of("incident_date").alias("month")).agg(
        F.count("claim_id").alias("claim_count"),
        total("paid_amount").alias("total_paid"),
        total("incurred_amount").alias("total_incurred"),
        total("reserved_amount").alias("total_reserved"),
        mean("severity_level").alias("avg_severity"),
        mean("days_to_close", 1).alias("avg_days_to_close"),
        mean("days_to_report", 1).alias("avg_days_to_report"),
        F.coalesce(F.sum("litigation_flag"), F.lit(0)).alias("litigation_count"),
        F.coalesce(F.sum("is_high_severity"), F.lit(0)).alias("high_severity_count"),
    )


def provider_scorecard(claims: DataFrame) -> DataFrame:
    return sqlpack.provider_scorecard(claims.dropna(subset=sqlpack.PROVIDER))


def severity_sheet(claims: DataFrame) -> DataFrame:
    known = claims.dropna(subset=["claim_type", "severity_level"])
    return known.groupBy("claim_type", "severity_level").agg(
        F.count("claim_id").alias("claim_count"),
        total("paid_amount").alias("total_paid"),
        mean_paid("paid_amount").alias("avg_paid"),
    )


def state_summary(claims: DataFrame) -> DataFrame:
    keys = ["state_code", "state_name", "region", "urban_rural"]
    return (
        claims.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            F.count("claim_id").alias("claim_count"),
            total("paid_amount").alias("total_paid"),
            total("incurred_amount").alias("total_incurred"),
            mean("severity_level").alias("avg_severity"),
            mean("days_to_close", 1).alias("avg_days_to_close"),
            F.round(F.sum("litigation_flag") / rows(), 4).alias("litigation_rate"),
            F.round(F.sum("is_high_severity") / rows(), 4).alias("high_severity_pct"),
        )
        .orderBy(F.desc("total_paid"), "state_code")
    )


def sheets(claims: DataFrame) -> dict[str, DataFrame]:
    """The five sheets of the BI extract."""
    return {
        "claims_detail": claims,
        "monthly_summary": monthly_sheet(claims),
        "severity_analysis": severity_sheet(claims),
        "provider_scorecard": provider_scorecard(claims),
        "regional_summary": state_summary(claims),
    }


OPS_COLUMNS = [
    "claim_id",
    "incident_date",
    "report_date",
    "close_date",
    "claim_type",
    "severity_level",
    "status",
    "days_to_close",
    "days_to_report",
    "region",
    "state_name",
]
ANOMALY_COLUMNS = [
    "claim_id",
    "incident_date",
    "paid_amount",
    "severity_level",
    "days_to_close",
    "days_to_report",
    "specialty",
    "region",
    "claim_type",
    "litigation_flag",
    "anomaly_score",
]


def operations(claims: DataFrame) -> DataFrame:
    return claims.select(*OPS_COLUMNS)


def anomalies(scored: DataFrame) -> DataFrame:
    """Flagged claims, most anomalous first."""
    return scored.where("is_anomaly").select(*ANOMALY_COLUMNS).orderBy("anomaly_score", "claim_id")


def actual_and_forecast(actuals: DataFrame, forecast: DataFrame) -> DataFrame:
    """Monthly actuals followed by the forecast, one row per series and month end."""
    return union_all(
        [
            actuals.select("series_key", F.last_day("month").alias("date"), F.lit("actual").alias("type"), F.col("y").cast("double").alias("claim_count")),
            forecast.select("series_key", F.last_day("month").alias("date"), F.lit("forecast").alias("type"), F.round("forecast", 1).alias("claim_count")),
        ]
    )


def scenario_summary(claims: DataFrame, close_pct: int = 20, severity_pct: int = 20, litigation_pct: int = 25) -> DataFrame:
    """One row per scenario at the chosen levels: parameter, baseline and projected figure."""
    text = F.lit(None).cast("double")

    def row(df: DataFrame, name: str, parameter: str, days, incurred, figure: str, value) -> DataFrame:
        return df.select(
            F.lit(name).alias("scenario"),
            F.lit(parameter).alias("parameter"),
            days.alias("baseline_avg_close_days"),
            incurred.alias("baseline_total_incurred"),
            F.lit(figure).alias("note"),
            value.alias("note_value"),
        )

    return union_all(
        [
            row(
                scenarios.close_time(claims, (close_pct,)), "Close Time Reduction", f"{close_pct}%",
                F.col("mean_close_days"), text, "Days-based metric", text,
            ),
            row(
                scenarios.severity_shift(claims, (severity_pct,)), "Severity Shift", f"{severity_pct}%",
                text, F.col("baseline_total_incurred"), "Projected", F.col("new_total_incurred"),
            ),
            row(
                scenarios.litigation_cut(claims, (litigation_pct,)), "Litigation Reduction", f"{litigation_pct}%",
                text, F.col("baseline_total_incurred"), "Projected", F.col("new_total_incurred"),
            ),
            row(
                scenarios.combined(claims), "Combined (20% sev + 25% lit + 20% close)", "Combined",
                text, F.col("baseline_total_incurred"), "Total Savings", F.col("total_savings"),
            ),
        ]
    )
