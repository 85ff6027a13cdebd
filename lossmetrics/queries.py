"""Registry: every operator as a query over the tables of one data folder.

"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmetrics.functions.columns import age_band, risk_segment, total
from lossmetrics.functions.distributions import union_all
from lossmetrics.ml import anomaly, evaluate, features, forecast, severity
from lossmetrics.operators import (
    benchmarks,
    closing,
    extracts,
    frequency,
    lag,
    pages,
    quality,
    repeat,
    resampling,
    reserving,
    scenarios,
    sqlpack,
    survival,
)
from lossmetrics.plans import cleaning, star
from lossmetrics.plans.warehouse import Warehouse, build_dims, open_warehouse, sources_from_tpch, write_star
from lossmetrics.session import shared_dir
from lossmetrics.sources import csv, sinks, tpch

Query = Callable[[SparkSession, str], DataFrame]


def on(part: str, f: Callable[[DataFrame], DataFrame]) -> Query:
    """Apply an operator to one table of the warehouse."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(getattr(open_warehouse(spark, sf_dir), part))

    return run


def with_warehouse(f: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(open_warehouse(spark, sf_dir))


def export_folder(spark: SparkSession, sf_dir: str) -> str:
    return f"{shared_dir(spark)}/lossmetrics/{spark.sparkContext.applicationId}/exports/{os.path.basename(sf_dir)}"


#: Claim-sized CSV exports of the queries are packed: as text they are several times the tables they come from.
PACKED = "gzip"


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw claims written as CSV, read back as text and cleaned."""
    folder = f"{export_folder(spark, sf_dir)}/raw"
    sinks.write_csv(open_warehouse(spark, sf_dir).raw, f"{folder}/claims.csv", compression=PACKED)
    return cleaning.clean_claims(csv.read_claims(spark, folder), measured=True)


def _dimension_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{export_folder(spark, sf_dir)}/raw_dims"
    sinks.write_csv(tpch.providers(spark, sf_dir), f"{folder}/providers.csv")
    return csv.read_dimension(spark, folder, "providers").drop("specialty_id")


def _cleaned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = open_warehouse(spark, sf_dir)
    path = sinks.write_cleaned({"claims": w.clean}, f"{export_folder(spark, sf_dir)}/cleaned", PACKED)[0]
    return sinks.read_back(spark, path, w.clean)


def _report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The before/after table of the written quality report."""
    w = open_warehouse(spark, sf_dir)
    path = f"{export_folder(spark, sf_dir)}/report"
    sinks.write_report(w.raw, sinks.quality_report(w.raw, w.clean, "at the end"), path)
    line = spark.read.text(path).where(F.col("value").rlike(r"^\| .*\| [*]*[0-9,]+[*]* \| [*]*[0-9,]+[*]* \|$"))
    number = lambda i: F.regexp_replace(F.regexp_extract("value", r"^\| (.*) \| (.*) \| (.*) \|$", i), "[*,]", "")
    return line.select(number(1).alias("category"), number(2).cast("long").alias("before"), number(3).cast("long").alias("after"))


def _sink(expected: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, str], str]) -> Query:
    """An extract written by its sink and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        claims = open_warehouse(spark, sf_dir).summary
        return sinks.read_back(spark, write(claims, export_folder(spark, sf_dir)), expected(claims))

    return run


def _sheet(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        claims = open_warehouse(spark, sf_dir).summary
        (path,) = sinks.bi_extract(claims, f"{export_folder(spark, sf_dir)}/bi_extract", [name], PACKED)
        return sinks.read_back(spark, path, extracts.sheets(claims)[name])

    return run


def _star(spark: SparkSession, sf_dir: str):
    """The full reload: dimensions, fact and summary as tables of their own."""
    w = open_warehouse(spark, sf_dir)
    return write_star(w.raw, w.sources, f"{export_folder(spark, sf_dir)}/star")


def _occurring(key: str, member: str, code: str) -> Query:
    """Dimension members that occur in the clean claims."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = open_warehouse(spark, sf_dir)
        return w.dims[key].join(w.clean.select(F.col(code).alias(member)).distinct(), member, "left_semi")

    return run


def _copies(raw: DataFrame) -> DataFrame:
    twice = raw.unionByName(raw)
    counted = twice.agg(F.count(F.lit(1)).alias("rows"))
    kept = cleaning.without_copies(twice).agg(F.count(F.lit(1)).alias("rows_kept"))
    duplicates = quality.duplicate_ids(twice).withColumnRenamed("issue_count", "duplicate_ids")
    return counted.crossJoin(F.broadcast(duplicates)).crossJoin(F.broadcast(kept))


def _claims_per(column: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.groupBy(column).agg(F.count(F.lit(1)).alias("claims"))


def _age_bands(raw: DataFrame) -> DataFrame:
    return raw.groupBy(age_band("patient_age").alias("patient_age_band")).agg(
        F.count(F.lit(1)).alias("claims"), F.min("patient_age").alias("youngest"), F.max("patient_age").alias("oldest")
    )


def _risk_segments(claims: DataFrame) -> DataFrame:
    return claims.groupBy(risk_segment("patient_age_band", "severity_weight").alias("segment")).agg(
        F.count(F.lit(1)).alias("claims"), total("paid_amount").alias("total_paid")
    )


def _dim(key: str) -> Query:
    return lambda spark, sf_dir: build_dims(sources_from_tpch(spark, sf_dir))[key]


def quality_queries() -> dict[str, Query]:
    out = {
        f"q{i}_{name}": on("raw", functools.partial(quality.check_count, name=name))
        for i, name in enumerate(list(quality.CHECKS)[:7], 1)
    }
    return out | {
        "q1_absolute_paid": on("raw", lambda r: cleaning.absolute_paid(r).select("claim_id", "paid_amount")),
        "q2_upper_state": on("raw", lambda r: _claims_per("state_code")(cleaning.upper_state(r))),
        "q3_numeric_severity": on("raw", lambda r: _claims_per("severity")(cleaning.numeric_severity(r))),
        "q4_ordered_dates": on("raw", lambda r: cleaning.ordered_dates(r).select("claim_id", "incident_date", "report_date")),
        "q5_known_diagnosis": on("raw", lambda r: _claims_per("diagnosis_id")(cleaning.known_diagnosis(r))),
        "q6_capped_paid": on("raw", lambda r: cleaning.capped_paid(r).select("claim_id", "paid_amount")),
        "q7_without_copies": on("raw", _copies),
        "q8_future_dates": on(
            "raw", lambda r: quality.issues(r).where(F.col("category") == "Future Dates").drop("position")
        ),
        "q9_typed": on(
            "raw",
            lambda r: cleaning.typed(r).select("claim_id", "patient_age", "paid_amount", "incident_date", "close_date"),
        ),
        "q10_null_counts": on("raw", quality.null_counts),
        "q10_numeric_ranges": on("raw", quality.numeric_ranges),
        "q11_issues": on("raw", quality.issues),
        "q11_comparison": with_warehouse(lambda w: quality.comparison(w.raw, w.clean)),
        "q12_clean_claims": on("raw", cleaning.clean_claims),
        "q12_clean_claims_measured": on("raw", functools.partial(cleaning.clean_claims, measured=True)),
        "q13_profile": on("summary", quality.profile),
        "q14_completeness": on("summary", quality.completeness),
        "q14_null_rates": on("summary", quality.null_rates),
        "q15_capped_histogram": on("summary", quality.capped_histogram),
        "q16_audit": with_warehouse(lambda w: quality.audit(w.fact, w.dims)),
    }


def warehouse_queries() -> dict[str, Query]:
    return {
        "s1_read_claims": _csv_round_trip,
        "s2_read_dimension": _dimension_round_trip,
        "s3_read_summary": on(
            "summary",
            lambda s: s.select(
                "claim_id", "specialty", "state_code", "diagnosis_category", "root_cause_category", "loss_ratio"
            ),
        ),
        "w1_dim_provider": _dim("provider_key"),
        "w2_dim_region": _dim("region_key"),
        "w3_dim_diagnosis": _occurring("diagnosis_key", "diagnosis_code", "diagnosis_id"),
        "w4_dim_root_cause": _occurring("root_cause_key", "root_cause_code", "root_cause_id"),
        "w5_fact_claim": with_warehouse(lambda w: star.fact_claim(w.clean, w.dims)),
        "w5_unmapped": with_warehouse(lambda w: star.unmapped_counts(w.clean, w.dims)),
        "w6_claims_summary": with_warehouse(lambda w: star.claims_summary(w.fact, w.dims)),
        "w7_constraints": with_warehouse(lambda w: quality.constraint_violations(w.fact, w.dims)),
        "w8_row_counts": with_warehouse(lambda w: star.row_counts(w.tables)),
        "w9_age_band": on("raw", _age_bands),
        "w10_risk_segment": on("summary", _risk_segments),
    }


def sqlpack_queries() -> dict[str, Query]:
    return {
        "v1_claims_summary": on("summary", lambda s: s),
        "v2_monthly_metrics": on("summary", sqlpack.monthly_metrics),
        "v3_loss_triangle": on("fact", sqlpack.loss_triangle),
        "v4_provider_scorecard": on("summary", sqlpack.provider_scorecard),
        "a1_running_frequency": on("summary", sqlpack.running_frequency),
        "a2_severity_by_specialty": on("summary", sqlpack.severity_by_specialty),
        "a3_top_claims": on("summary", sqlpack.top_claims),
        "a4_yearly_change": on("fact", sqlpack.yearly_change),
        "a5_moving_average": on("summary", sqlpack.moving_average),
        "a6_aging_by_status": on("fact", sqlpack.aging_by_status),
        "a7_triangle_pivot": on("fact", sqlpack.triangle_pivot),
        "a8_provider_risk": on("summary", sqlpack.provider_risk),
        "a9_severe_regions": on("summary", sqlpack.severe_regions),
        "a10_diagnosis_pareto": on("summary", sqlpack.diagnosis_pareto),
        "a11_lag_by_specialty": on("summary", sqlpack.lag_by_specialty),
        "a12_litigation_by_region": on("summary", sqlpack.litigation_by_region),
        "a13_reopened_comparison": on("fact", sqlpack.reopened_comparison),
        "a14_seasonality": on("fact", sqlpack.seasonality),
        "a15_quality_audit": with_warehouse(lambda w: quality.audit(w.fact, w.dims)),
        "a16_cohorts": on("fact", sqlpack.cohorts),
        "a17_outliers": on("summary", sqlpack.outliers),
    }


def analysis_queries() -> dict[str, Query]:
    return {
        "f1_monthly_by_type": on("summary", frequency.monthly_by_type),
        "f2_quarterly_counts": on("summary", frequency.quarterly_counts),
        "f3_yearly_counts": on("summary", frequency.yearly_counts),
        "f4_severity_distribution": on("summary", frequency.severity_distribution),
        "f5_severity_by_type": on("summary", lambda s: frequency.severity_by(s, "claim_type")),
        "f6_severity_by_specialty": on("summary", lambda s: frequency.severity_by(s, "specialty")),
        "f7_specialty_points": on("summary", frequency.specialty_points),
        "f8_loss_ratio": on("summary", frequency.loss_ratio),
        "f9_yearly_metrics": on("summary", frequency.yearly_metrics),
        "l1_close_histogram": on("summary", closing.close_histogram),
        "l2_close_percentiles": on("summary", closing.close_percentiles),
        "l3_close_by_group": on("summary", lambda s: closing.close_by(s, "severity_level", "specialty", "region")),
        "l4_sla_compliance": on("summary", closing.sla_compliance),
        "l5_backlog_aging": on("summary", closing.backlog_aging),
        "l6_monthly_close_trend": on("summary", closing.monthly_close_trend),
        "g1_lag_histogram": on("summary", lag.lag_histogram),
        "g1_lag_percentiles": on("summary", lag.lag_percentiles),
        "g2_lag_by_group": on("summary", lambda s: lag.lag_by(s, "specialty", "region", "severity_level")),
        "g3_slow_reporters": on("summary", lag.slow_reporters),
        "g3_above_median_reporters": on("summary", lambda s: lag.slow_reporters(s, factor=1.0)),
        "g4_monthly_lag_trend": on("summary", lag.monthly_lag_trend),
        "r1_reopen_rate": on("summary", repeat.reopen_rate),
        "r2_reopen_by_provider": on("summary", repeat.reopen_by_provider),
        "r3_reopen_by_root_cause": on("summary", lambda s: repeat.reopen_by(s, "root_cause_category")),
        "r3_reopen_by_specialty": on("summary", lambda s: repeat.reopen_by(s, "specialty")),
        "r4_litigation_link": on("summary", repeat.litigation_link),
        "r5_repeat_events": on("summary", repeat.repeat_events),
        "b1_indicators": on("summary", benchmarks.indicators),
        "b2_departments": on("summary", benchmarks.departments),
        "b3_quarterly": on("summary", benchmarks.quarterly),
        "x1_close_time": on("summary", scenarios.close_time),
        "x2_severity_shift": on("summary", scenarios.severity_shift),
        "x3_litigation_cut": on("summary", scenarios.litigation_cut),
        "x4_combined": on("summary", scenarios.combined),
    }


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def page_queries() -> dict[str, Query]:
    return {
        "p1_filtered": on(
            "summary",
            lambda s: pages.filtered(
                s,
                years=[1996, 1997],
                claim_types=["medical_malpractice", "workers_comp"],
                severities=[3, 4, 5],
                regions=["ASIA", "EUROPE"],
                start="1996-03-01",
                end="1997-10-31",
            ).select("claim_id", "accident_year", "claim_type", "severity_level", "region", "incident_date"),
        ),
        "p2_kpis": on("summary", pages.kpis),
        "p3_sparkline_count": on("summary", pages.sparkline),
        "p3_sparkline_paid": on("summary", lambda s: pages.sparkline(s, "paid_amount")),
        "p4_status_counts": on("summary", pages.status_counts),
        "p4_top_root_causes": on("summary", pages.top_root_causes),
        "p4_month_by_type": on("summary", lambda s: pages.counts_by(s, pages.month_key(), "claim_type")),
        "p4_year_by_severity": on("summary", lambda s: pages.counts_by(s, pages.year_key(), "severity_level")),
        "p5_month_by_severity": on("summary", lambda s: pages.counts_by(s, pages.month_key(), "severity_level")),
        "p5_paid_incurred": on("summary", pages.paid_incurred),
        "p5_quarterly_loss_ratio": on("summary", pages.quarterly_loss_ratio),
        "p5_severity_mix": on("summary", pages.severity_mix),
        "p5_claim_type_totals": on("summary", pages.claim_type_totals),
        "p6_state_map": on("summary", pages.state_map),
        "p6_department_severity": on("summary", pages.department_severity),
        "p6_region_by_type": on("summary", lambda s: pages.counts_by(s, "region", "claim_type")),
        "p6_top_states": on("summary", pages.top_states),
        "p6_urban_rural": on("summary", pages.urban_rural),
        "p6_urban_rural_state": on("summary", lambda s: pages.urban_rural(pages.filtered(s, state="NATION_7"))),
        "p7_ops_kpis": on("summary", pages.ops_kpis),
        "p7_close_histogram": on(
            "summary", lambda s: pages.capped_day_histogram(s, "days_to_close", 30, "severity_level")
        ),
        "p7_open_aging": on("summary", pages.open_aging),
        "p7_lag_histogram": on("summary", lambda s: pages.capped_day_histogram(s, "days_to_report", 40)),
        "p7_monthly_lag": on("summary", lag.monthly_lag_trend),
        "p7_sla_table": on("summary", pages.sla_table),
        "p8_risk_segments": on("summary", pages.risk_segments),
        "p9_risk_matrix": on("summary", pages.risk_matrix),
        "p10_recommendation_metrics": on(
            "summary", lambda s: pages.recommendation_metrics(s, [f"NATION_{i}" for i in range(4)])
        ),
        "e1_monthly_metrics": on("summary", extracts.monthly_metrics),
        "e1b_monthly_sheet": on("summary", extracts.monthly_sheet),
        "e2_provider_scorecard": on("summary", extracts.provider_scorecard),
        "e3_severity_sheet": on("summary", extracts.severity_sheet),
        "e4_state_summary": on("summary", extracts.state_summary),
        "k1_cleaned": _cleaned_round_trip,
        "k2_report": _report_round_trip,
        "k3_claims_detail": _sink(lambda s: s, functools.partial(sinks.claims_detail, compression=PACKED)),
        "k4_loss_triangle": _sink(lambda s: reserving.wide_triangle(s, sinks.development_years(s)).drop("segment"), sinks.loss_triangle),
        "k5_monthly_metrics": _sink(extracts.monthly_metrics, sinks.monthly_metrics),
        "k6_provider_scorecard": _sink(extracts.provider_scorecard, sinks.provider_scorecard),
        "k7_severity_sheet": _sheet("severity_analysis"),
        "k7_claims_sheet": _sheet("claims_detail"),
        "k7_monthly_sheet": _sheet("monthly_summary"),
        "k7_provider_sheet": _sheet("provider_scorecard"),
        "k7_regional_sheet": _sheet("regional_summary"),
        "k8_fact_table": lambda spark, sf_dir: _star(spark, sf_dir)[1],
        "k8_summary_table": lambda spark, sf_dir: _star(spark, sf_dir)[2],
        "k9_triangle_download": on(
            "summary",
            lambda s: reserving.wide_triangle(s, sinks.development_years(s), prefix="dev_year_", masked=True).drop("segment"),
        ),
        "k9_operations": on("summary", extracts.operations),
        "k9_scenario_summary": on("summary", extracts.scenario_summary),
    }


def advanced_queries() -> dict[str, Query]:
    return {
        "t1_triangle": on("summary", reserving.triangle),
        "t2_age_to_age": on("summary", reserving.age_to_age),
        "t3_cumulative_factors": on("summary", reserving.cumulative_factors),
        "t4_ultimates": on("summary", reserving.ultimates),
        "t5_ibnr": on("summary", reserving.ibnr),
        "t5_ibnr_by_segment": on("summary", lambda s: reserving.ibnr(s, "specialty")),
        "t6_standard_errors": on("summary", reserving.standard_errors),
        "t6_standard_errors_by_segment": on("summary", lambda s: reserving.standard_errors(s, "specialty", "region")),
        "x5_simulated_savings": on("summary", resampling.simulated_savings),
        "x5_simulated_savings_by_type": on("summary", lambda s: resampling.simulated_savings(s, "claim_type")),
        "x6_bootstrap_paid": on("summary", lambda s: resampling.bootstrap_interval(s, "paid_amount", "sum")),
        "x6_bootstrap_severity": on("summary", lambda s: resampling.bootstrap_interval(s, "severity_level", "mean")),
        "x5_savings_order": on("summary", _savings_order),
        "x6_bootstrap_median": on("summary", lambda s: resampling.bootstrap_percentile(s, "paid_amount", 0.5)),
        "x6_bootstrap_p95": on("summary", lambda s: resampling.bootstrap_percentile(s, "paid_amount", 0.95)),
        "x6_bootstrap_severity_spread": on("summary", lambda s: resampling.bootstrap_statistic(s, "severity_level", _spread)),
        "x6_bootstrap_bounds": on("summary", _bootstrap_bounds),
        "x7_litigation_interval": on(
            "summary",
            lambda s: _rounded(
                resampling.proportion_interval(s, "litigation_flag", "claim_type"),
                9,
                "estimate",
                "ci_lower",
                "ci_upper",
                "margin_of_error",
            ),
        ),
        "u1_durations": on(
            "summary",
            lambda s: survival.durations(s)
            .groupBy("claim_type", "event", "duration")
            .agg(F.count(F.lit(1)).alias("claims")),
        ),
        "u2_survival": on("summary", survival.kaplan_meier),
        "u3_survival_by_type": on("summary", lambda s: survival.kaplan_meier(s, "claim_type")),
        "u4_median_survival": on("summary", lambda s: survival.median_survival(s, "claim_type")),
        "u5_log_rank": on("summary", lambda s: _rounded(survival.log_rank(s), 8, "test_statistic")),
        "u5_log_rank_p": on("summary", lambda s: _rounded(_rounded(survival.log_rank_p(s), 8, "test_statistic"), 9, "p_value")),
    }


_fitted: dict[tuple, object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable):
    """A model fit shared by the queries that report on it."""
    handle = (spark.sparkContext.applicationId, sf_dir, name)
    if handle not in _fitted:
        _fitted[handle] = make(open_warehouse(spark, sf_dir).summary)
    return _fitted[handle]


def fitted(name: str, make: Callable, read: Callable) -> Query:
    """A query that reads the fit called ``name``, which it carries as ``fit``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read(once(spark, sf_dir, name, make))

    run.fit = name
    return run


def _scores(claims: DataFrame) -> DataFrame:
    return evaluate.cross_validate(severity.prepare(claims), severity.builders())


def _calibration(claims: DataFrame) -> DataFrame:
    return evaluate.calibrations(severity.prepare(claims), severity.builders())


def _anomalies(claims: DataFrame):
    return anomaly.detect(claims.select(*extracts.ANOMALY_COLUMNS[:-1]))


def _detected(read: Callable) -> Query:
    return fitted("anomalies", _anomalies, read)


def _fixed_prediction(claims: DataFrame) -> DataFrame:
    """A prediction that SQL can repeat: the reporting lag modulo five."""
    return features.labelled(claims.where(F.col("severity_level").isNotNull())).withColumn(
        "prediction", (F.col("days_to_report") % 5).cast("double")
    )


def _fixed_flags(claims: DataFrame) -> DataFrame:
    return claims.withColumn("is_anomaly", F.col("paid_amount") > 90000)


def _split_sizes(claims: DataFrame) -> DataFrame:
    rows = features.labelled(features.feature_table(features.valid_claims(claims)))
    parts = features.stratified_parts(rows, "severity_level", "claim_id", [0.2, 0.8])
    return parts.groupBy("severity_level", "part").agg(F.count(F.lit(1)).alias("claims"))


def _predicted(name: str) -> Query:
    def read(models: severity.SeverityModels) -> DataFrame:
        return models.predictions[name].select("claim_id", "severity_level", (F.col("prediction") + 1).cast("int").alias("predicted"))

    return fitted("severity", severity.train, read)


def _predicted_totals(models: severity.SeverityModels) -> DataFrame:
    """Predicted test rows per model and actual severity."""
    counts = [
        rows.groupBy("severity_level").agg(F.count("prediction").alias("claims")).select(F.lit(name).alias("model"), "severity_level", "claims")
        for name, rows in models.predictions.items()
    ]
    return union_all(counts)


def _spread(values: np.ndarray, weights: np.ndarray) -> float:
    """Population deviation of counted values."""
    rows = weights.sum()
    if not rows:
        return float("nan")
    mean = (values * weights).sum() / rows
    return float(np.sqrt((weights * (values - mean) ** 2).sum() / rows))


def _bootstrap_bounds(claims: DataFrame) -> DataFrame:
    """Bootstrap estimates, and whether their intervals hold them."""
    found = {
        "sum of paid_amount": resampling.bootstrap_interval(claims, "paid_amount", "sum"),
        "mean of severity_level": resampling.bootstrap_interval(claims, "severity_level", "mean"),
        "median of paid_amount": resampling.bootstrap_percentile(claims, "paid_amount", 0.5),
        "95th percentile of paid_amount": resampling.bootstrap_percentile(claims, "paid_amount", 0.95),
        "deviation of severity_level": resampling.bootstrap_statistic(claims, "severity_level", _spread),
    }
    inside = F.col("estimate").between(F.col("ci_lower"), F.col("ci_upper")).alias("inside")
    return union_all([df.select(F.lit(name).alias("statistic"), F.round("estimate", 2).alias("estimate"), inside) for name, df in found.items()])


def _savings_order(claims: DataFrame) -> DataFrame:
    """Whether the simulated savings of each claim type lie in order."""
    ordered = (F.col("p5") <= F.col("median_savings")) & (F.col("median_savings") <= F.col("p95"))
    inside = F.col("mean_savings").between(F.col("p5"), F.col("p95")) & F.col("prob_positive").between(0, 100)
    return resampling.simulated_savings(claims, "claim_type").select("claim_type", (ordered & inside).alias("ordered"))


def _naive(claims: DataFrame, *keys: str) -> DataFrame:
    """The forecast that SQL can repeat."""
    return forecast.seasonal_naive(forecast.monthly_series(claims, *keys))


def _actual_and_forecast(claims: DataFrame, *keys: str, model: Callable[[DataFrame], DataFrame] = forecast.fit_series) -> DataFrame:
    series = forecast.monthly_series(claims, *keys)
    return extracts.actual_and_forecast(series, model(series))


def _fit_invariants(claims: DataFrame) -> DataFrame:
    """What holds for every fitted series: method, horizon, a fit that beats the constant, forecasts inside their bands."""
    series = forecast.monthly_series(claims, "claim_type", "region")
    spread = series.groupBy("series_key").agg((F.var_pop("y") * F.count("y")).alias("around_mean"))
    inside = (F.col("lower_95") <= F.col("lower_80")) & (F.col("upper_80") <= F.col("upper_95")) & (F.col("forecast") <= F.col("upper_80"))
    return (
        forecast.with_bands(forecast.fit_series(series))
        .groupBy("series_key", "method")
        .agg(
            F.count(F.lit(1)).alias("horizons"),
            F.min("month").alias("first_month"),
            F.max("month").alias("last_month"),
            F.first("sse").alias("sse"),
            F.every(inside).alias("inside_bands"),
        )
        .join(spread, "series_key")
        .select(
            "series_key", "method", "horizons", "first_month", "last_month",
            (F.col("sse") <= F.col("around_mean")).alias("below_constant"), "inside_bands",
        )
    )


def model_queries() -> dict[str, Query]:
    return {
        "m1_valid_claims": on("summary", lambda s: features.valid_claims(s).select("claim_id", "severity_level")),
        "m2_feature_table": on(
            "summary",
            lambda s: _rounded(features.feature_table(features.valid_claims(s)), 9, "log_paid_amount"),
        ),
        "m3_split": on("summary", _split_sizes),
        "m4_forest": _predicted(severity.FOREST),
        "m5_logistic": _predicted(severity.LOGISTIC),
        "m6_boosted": _predicted(severity.BOOSTED),
        "m7_importances": fitted("severity", severity.train, lambda m: m.importances()),
        "m8_report": fitted("severity", severity.train, lambda m: m.report(severity.FOREST)),
        "m8_confusion": fitted("severity", severity.train, lambda m: m.confusion(severity.FOREST)),
        "m8_predicted_totals": fitted("severity", severity.train, _predicted_totals),
        "m8_report_logistic": fitted("severity", severity.train, lambda m: m.report(severity.LOGISTIC)),
        "m8_confusion_logistic": fitted("severity", severity.train, lambda m: m.confusion(severity.LOGISTIC)),
        "m8_report_fixed": on("summary", lambda s: evaluate.classification_report(_fixed_prediction(s))),
        "m8_confusion_fixed": on("summary", lambda s: evaluate.confusion(_fixed_prediction(s))),
        "m9_cross_validation": fitted("scores", _scores, lambda scores: scores),
        "m10_calibration": fitted("calibration", _calibration, lambda c: c),
        "m10_calibration_rows": fitted(
            "calibration", _calibration, lambda c: c.groupBy("model", "class").agg(F.sum("claim_count").alias("claims"))
        ),
        "m11_ranking": fitted("scores", _scores, evaluate.ranking),
        "m11_paired_test": fitted("scores", _scores, evaluate.paired_test),
        "m12_monthly_series": on("summary", forecast.monthly_series),
        "m12_monthly_series_by_type": on("summary", lambda s: forecast.monthly_series(s, "claim_type", "region")),
        "m13_forecast": on("summary", lambda s: forecast.fit_series(forecast.monthly_series(s))),
        "m13_forecast_by_type": on("summary", lambda s: forecast.fit_series(forecast.monthly_series(s, "claim_type", "region"))),
        "m13_fit_invariants": on("summary", _fit_invariants),
        "m13_seasonal_naive_by_type": on("summary", lambda s: _rounded(_naive(s, "claim_type", "region"), 6, "resid_std")),
        "m14_forecast_bands": on("summary", forecast.forecast),
        "m14_forecast_bands_by_type": on("summary", lambda s: forecast.forecast(s, "claim_type", "region")),
        "m14_bands_fixed": on(
            "summary",
            lambda s: _rounded(forecast.with_bands(_naive(s, "claim_type")), 6, "resid_std", "lower_80", "upper_80", "lower_95", "upper_95"),
        ),
        "m15_backtest_rows": on("summary", lambda s: forecast.backtest_rows(s, "claim_type")),
        "m15_backtest_rows_fixed": on("summary", lambda s: forecast.backtest_rows(s, "claim_type", model=forecast.seasonal_naive)),
        "m15_backtest_fixed": on(
            "summary",
            lambda s: _rounded(
                forecast.backtest_metrics(forecast.backtest_rows(s, "claim_type", model=forecast.seasonal_naive)), 6, "mape", "rmse", "mae"
            ),
        ),
        "m15_backtest": on(
            "summary", lambda s: forecast.backtest_metrics(forecast.backtest_rows(s, "claim_type"))
        ),
        "m16_anomaly_features": on(
            "summary", lambda s: _rounded(anomaly.standardised(anomaly.features(s)), 6, *anomaly.FEATURES)
        ),
        "m17_anomalies": _detected(lambda d: d[0].select("claim_id", "anomaly_score", "is_anomaly")),
        "m18_anomaly_summary": _detected(lambda d: anomaly.compare(d[0])),
        "m18_summary_fixed": on("summary", lambda s: anomaly.compare(_fixed_flags(s))),
        "m19_anomaly_months": _detected(lambda d: anomaly.monthly_rate(d[0])),
        "m19_months_fixed": on("summary", lambda s: anomaly.monthly_rate(_fixed_flags(s))),
        "m20_anomaly_reasons": _detected(lambda d: anomaly.explain(*d)),
        "k9_anomalies": _detected(lambda d: extracts.anomalies(d[0])),
        "k9_actual_and_forecast": on("summary", _actual_and_forecast),
        "k9_actual_and_forecast_by_type": on("summary", lambda s: _actual_and_forecast(s, "claim_type", "region")),
        "k9_forecast_fixed": on("summary", lambda s: _actual_and_forecast(s, "claim_type", "region", model=forecast.seasonal_naive)),
    }


def registry() -> dict[str, Query]:
    return (
        quality_queries()
        | warehouse_queries()
        | sqlpack_queries()
        | analysis_queries()
        | page_queries()
        | advanced_queries()
        | model_queries()
    )
