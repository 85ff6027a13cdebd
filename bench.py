"""Benchmark: build the warehouse from the source tables, then run the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the tables, ``BENCH_CPUS`` the local cores. Every query is run to
the end into a no-op sink. ``value`` is the build plus the sum over the queries of the median of ``BENCH_RUNS`` runs after
one warm-up run; models are timed once, fit included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lossmetrics.plans.warehouse import open_warehouse
from lossmetrics.queries import registry
from lossmetrics.session import local_session

HEADLINE = [
    "q11_issues",
    "q11_comparison",
    "q12_clean_claims",
    "q13_profile",
    "q15_capped_histogram",
    "q16_audit",
    "w5_fact_claim",
    "w6_claims_summary",
    "v2_monthly_metrics",
    "v3_loss_triangle",
    "v4_provider_scorecard",
    "a3_top_claims",
    "a6_aging_by_status",
    "a8_provider_risk",
    "a11_lag_by_specialty",
    "a16_cohorts",
    "a17_outliers",
    "f1_monthly_by_type",
    "f9_yearly_metrics",
    "l2_close_percentiles",
    "l3_close_by_group",
    "l4_sla_compliance",
    "g2_lag_by_group",
    "g3_slow_reporters",
    "r2_reopen_by_provider",
    "r5_repeat_events",
    "b2_departments",
    "x1_close_time",
    "x4_combined",
    "x5_simulated_savings",
    "x6_bootstrap_paid",
    "t5_ibnr",
    "t6_standard_errors",
    "u2_survival",
    "u5_log_rank",
    "m12_monthly_series",
    "m14_forecast_bands",
    "p2_kpis",
    "p8_risk_segments",
    "e4_state_summary",
]
# Fits are shared by the queries of an application, so these are timed at their first run, with the fit in it.
FITS = ["m4_forest", "m9_cross_validation", "m10_calibration", "m17_anomalies", "m20_anomaly_reasons"]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "lossmetrics-bench")
    build = timed(lambda: open_warehouse(spark, sf_dir, rebuild=True))  # never an earlier run's snapshot
    queries = registry()
    seconds: dict[str, float] = {"warehouse_build": build}
    for name in HEADLINE:
        def run() -> None:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        timed(run)
        seconds[name] = statistics.median(timed(run) for _ in range(runs))
    for name in FITS:
        seconds[name] = timed(lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    rows = open_warehouse(spark, sf_dir).raw.count()
    print(
        json.dumps(
            {
                "metric": "warehouse build and headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "claims": rows,
                "clean_rows_per_second": round(rows / seconds["q12_clean_claims"]),
                "cores": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
