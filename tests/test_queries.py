"""Registered queries against their SQL at the smallest scale, and the contract of the registry."""

import os

import pytest

import __spark_entry__ as entry
from lossmetrics.queries import registry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


#: Simulations, fits and their reports: no SQL repeats their random or iterative steps. Their parts have entries with SQL.
WITHOUT_SQL = {
    "x5_simulated_savings", "x5_simulated_savings_by_type", "x6_bootstrap_paid", "x6_bootstrap_severity", "x6_bootstrap_median", "x6_bootstrap_p95",
    "x6_bootstrap_severity_spread",
    "m4_forest", "m5_logistic", "m6_boosted", "m7_importances", "m8_report", "m8_confusion", "m8_report_logistic", "m8_confusion_logistic",
    "m9_cross_validation", "m10_calibration", "m11_ranking", "m11_paired_test", "m13_forecast", "m13_forecast_by_type",
    "m14_forecast_bands", "m14_forecast_bands_by_type", "m15_backtest", "m15_backtest_rows", "m17_anomalies", "m18_anomaly_summary", "m19_anomaly_months", "m20_anomaly_reasons",
    "k9_anomalies", "k9_actual_and_forecast", "k9_actual_and_forecast_by_type",
}


def test_every_other_query_has_sql():
    from oracles import all_sql

    assert set(registry()) - set(all_sql()) == WITHOUT_SQL - set(all_sql())
    assert set(all_sql()) <= set(registry())


def test_every_inventory_id_is_registered():
    ids = {name.split("_")[0] for name in registry()}
    wanted = {f"q{i}" for i in range(1, 17)} | {f"w{i}" for i in range(1, 11)} | {f"v{i}" for i in range(1, 5)}
    wanted |= {f"a{i}" for i in range(1, 18)} | {f"f{i}" for i in range(1, 10)} | {f"l{i}" for i in range(1, 7)}
    wanted |= {f"t{i}" for i in range(1, 7)} | {f"g{i}" for i in range(1, 5)} | {f"r{i}" for i in range(1, 6)}
    wanted |= {f"b{i}" for i in range(1, 4)} | {f"x{i}" for i in range(1, 8)} | {f"u{i}" for i in range(1, 6)}
    wanted |= {f"m{i}" for i in range(1, 21)} | {f"p{i}" for i in range(1, 11)} | {f"k{i}" for i in range(1, 10)} | {"e1", "e1b", "e2", "e3", "e4", "s1", "s2", "s3"}
    assert wanted <= ids


@needs_data
@pytest.mark.parametrize("name", sorted(n for n in ORACLE if n in registry()))
def test_matches_sql(spark, con, name):
    assert compare(con, entry.queries()[name](spark, SF), ORACLE[name]) == ""


@needs_data
def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "total_paid" in df.columns
