"""Patient-safety indicators: rates per 1,000 overall, by department against the overall rate, and by quarter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.functions.columns import quarter_of, rows

INDICATORS = [
    "surgical_complication_rate",
    "fall_rate",
    "medication_error_rate",
    "diagnostic_error_rate",
    "hospital_acquired_infection_rate",
]


def _has(column: str, pattern: str) -> Column:
    return F.coalesce(F.col(column).rlike(f"(?i){pattern}"), F.lit(False))


def _any(columns: list[str], tests: dict[str, str]) -> Column:
    found = F.lit(False)
    for column, pattern in tests.items():
        if column in columns:
            found = found | _has(column, pattern)
    return found


def hits(columns: list[str]) -> dict[str, Column]:
    """Numerator condition of every indicator; a missing column contributes nothing.

    A fall is looked for in the root cause and only without that column in the diagnosis. With the usual root causes the
    fall rate is therefore 0; the rule is kept as published.
    """
    fall_column = "root_cause_category" if "root_cause_category" in columns else "diagnosis_category"
    # The published patterns.
    return {
        "surgical_complication_rate": _has("procedure_category", "Surg") & (F.col("severity_level") >= 4),
        "fall_rate": _any(columns, {fall_column: "Fall"}),
        "medication_error_rate": _any(columns, {"root_cause_category": "Medication", "diagnosis_category": "Medication"}),
        "diagnostic_error_rate": _any(columns, {"root_cause_category": "Diagnostic", "diagnosis_category": "Misdiagnos"}),
        "hospital_acquired_infection_rate": _any(columns, {"diagnosis_category": "Infection|Sepsis|Pneumonia|Catheter"}),
    }


def _counts(claims: DataFrame, keys: list[Column]) -> DataFrame:
    """Numerators and denominators of all indicators per key from one scan, as (keys, indicator, num, den) rows."""
    found = hits(claims.columns)
    grouped = claims.groupBy(*keys).agg(
        rows().alias("_rows"),
        F.count_if(_has("procedure_category", "Surg")).alias("_surgical"),
        *[F.count_if(c).alias(f"_{name}") for name, c in found.items()],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("indicator"),
                F.col(f"_{name}").alias("numerator"),
                F.col("_surgical" if name == "surgical_complication_rate" else "_rows").alias("denominator"),
            )
            for name in INDICATORS
        ]
    )
    kept = [c for c in grouped.columns if not c.startswith("_")]
    return grouped.select(*kept, F.col("_rows").alias("claim_count"), F.inline(entries))


def _rate(numerator: str = "numerator", denominator: str = "denominator") -> Column:
    per_thousand = F.round(F.try_divide(F.col(numerator), F.col(denominator)) * 1000, 2)
    return F.coalesce(per_thousand, F.lit(0.0))


def indicators(claims: DataFrame) -> DataFrame:
    return _counts(claims, []).select("indicator", "numerator", "denominator", _rate().alias("rate_per_1000"))


def departments(claims: DataFrame) -> DataFrame:
    """Department rate against the overall rate: variance in percent and above / below / at by a 10 % margin."""
    everywhere = Window.partitionBy("indicator")  # one row per department
    own = _counts(claims, [F.col("department")]).withColumns(
        {
            "dept_rate_per_1000": _rate("numerator", "denominator"),
            "all_numerator": F.sum("numerator").over(everywhere),
            "all_denominator": F.sum("denominator").over(everywhere),
        }
    )
    rated = own.withColumn("benchmark_rate_per_1000", _rate("all_numerator", "all_denominator"))
    mine, all_ = F.col("dept_rate_per_1000"), F.col("benchmark_rate_per_1000")
    return rated.where(F.col("department").isNotNull()).select(
        "department",
        "indicator",
        "claim_count",
        "dept_rate_per_1000",
        "benchmark_rate_per_1000",
        F.when(all_ > 0, F.round((mine - all_) / all_ * 100, 2)).otherwise(0.0).alias("variance_pct"),
        F.when(mine > all_ * 1.1, "above_benchmark")
        .when(mine < all_ * 0.9, "below_benchmark")
        .otherwise("at_benchmark")
        .alias("status"),
    )


def quarterly(claims: DataFrame) -> DataFrame:
    dated = claims.where(F.col("incident_date").isNotNull())
    return _counts(dated, [quarter_of("incident_date").alias("quarter")]).select(
        "quarter", "indicator", _rate().alias("rate_per_1000")
    )
