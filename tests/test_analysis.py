import datetime
import math

import pytest
from pyspark.sql import functions as F

from lossmetrics.operators import benchmarks, closing, extracts, frequency, lag, pages, repeat, scenarios, sqlpack, survival

D = datetime.date


def test_lag_edges(make_claims, as_dict):
    claims = make_claims([{"days_to_report": d, "days_to_close": d} for d in (0, 7, 8, 14, 365, 366, None)])
    buckets = {r["bucket"]: r["claim_count"] for r in lag.lag_histogram(claims).collect()}
    assert buckets == {"0-7": 1, "8-14": 2, "15-30": 0, "31-60": 0, "61-90": 0, "91-180": 0, "181-365": 1, "365+": 1}
    closed = {r["bucket"]: r["claim_count"] for r in closing.close_histogram(claims).collect()}
    assert closed["0-30"] == 3 and closed["271-365"] == 1 and closed["366-545"] == 1
    aged = as_dict(sqlpack.aging_by_status(claims), "aging_bucket")
    assert aged["0-30 days"]["claim_count"] == 4 and aged["Still Open"]["claim_count"] == 1  # 0 counts here


def test_sla_counts_zero_days_and_adds_overall(make_claims, as_dict):
    claims = make_claims(
        [{"days_to_close": d, "claim_type": t} for d, t in [(0, "a"), (90, "a"), (91, "a"), (400, "b"), (None, "c"), (10, None)]]
    )
    rows = as_dict(closing.sla_compliance(claims), "claim_type")
    assert set(rows) == {"a", "b", "overall"}
    assert rows["a"]["within_90_days_pct"] == 66.67 and rows["overall"]["claim_count"] == 5
    assert rows["b"]["within_365_days_pct"] == 0.0


def test_backlog_uses_report_then_incident_date(make_claims):
    claims = make_claims(
        [
            {"report_date": D(2023, 1, 1)},
            {"report_date": None, "incident_date": D(2023, 1, 11)},
            {"report_date": D(2024, 1, 1), "status": "reopened"},
            {"status": "closed"},
        ]
    )
    rows = closing.backlog_aging(claims, D(2023, 1, 31)).collect()
    assert {r["bucket"]: r["open_claims"] for r in rows} == {"0-30": 2, "31-90": 0, "91-180": 0, "181-365": 0, "365+": 0}
    assert rows[0]["total_open"] == 3 and rows[0]["median_age_days"] == 20.0  # -335, 20, 30


def test_close_by_drops_null_keys(make_claims):
    claims = make_claims([{"days_to_close": 10, "specialty": "A"}, {"days_to_close": 21, "specialty": "A"}, {"days_to_close": 5, "specialty": None}])
    rows = closing.close_by(claims, "specialty").collect()
    assert len(rows) == 1 and rows[0]["median"] == 15.5 and rows[0]["claim_count"] == 2


def test_upper_median_in_pack_and_interpolated_elsewhere(make_claims):
    claims = make_claims([{"days_to_report": d} for d in (1, 2, 10, 20)])
    assert sqlpack.lag_by_specialty(claims).first()["median_report_lag"] == 10
    assert lag.lag_percentiles(claims).first()["median"] == 6.0


def test_slow_reporters(make_claims):
    rows = [{"provider_id": "slow", "provider_name": "S", "days_to_report": 100}] * 5
    rows += [{"provider_id": "few", "days_to_report": 500}] * 4 + [{"provider_id": "fast", "days_to_report": 10}] * 20
    got = lag.slow_reporters(make_claims(rows)).collect()
    assert [(r["provider_id"], r["provider_name"], r["mean_lag"], r["threshold_days"]) for r in got] == [("slow", "S", 100.0, 20.0)]


def test_frequency(make_claims, as_dict):
    claims = make_claims(
        [
            {"incident_date": D(2022, 1, 5), "claim_type": "workers_comp", "severity_level": 1},
            {"incident_date": D(2023, 1, 5), "severity_level": 2},
            {"incident_date": D(2023, 2, 5), "severity_level": None},
            {"incident_date": None},
        ]
    )
    years = as_dict(frequency.yearly_counts(claims), "incident_year")
    assert years[2022]["yoy_change_pct"] is None and years[2023]["yoy_change_pct"] == 100.0
    months = {(r["incident_month"], r["claim_type"]): (r["claim_count"], r["total"]) for r in frequency.monthly_by_type(claims).collect()}
    assert months["2022-01", "workers_comp"] == (1, 1) and months["2022-01", "medical_malpractice"] == (0, 1)
    assert len(months) == 6
    other = make_claims([{"claim_type": "a sixth type"}, {"claim_type": "workers_comp"}])
    assert {r["claim_type"]: r["claim_count"] for r in frequency.monthly_by_type(other).collect()} == {"a sixth type": 1, "workers_comp": 1}
    mix = as_dict(frequency.severity_distribution(claims), "severity_level")
    assert mix[1]["percentage"] == 33.33 and mix[1]["median_severity"] == 2.0


def test_loss_ratio_null_without_incurred(make_claims, as_dict):
    claims = make_claims([{"incurred_amount": 0.0, "claim_type": "a"}, {"claim_type": "b"}, {"claim_type": "b", "paid_amount": None}])
    rows = as_dict(frequency.loss_ratio(claims), "claim_type")
    assert rows["a"]["loss_ratio"] is None and rows["b"]["loss_ratio"] == 0.25
    assert frequency.loss_ratio(claims, None).first()["loss_ratio"] == 0.5


def test_reopen_is_case_insensitive(make_claims):
    claims = make_claims([{"status": "Reopened", "repeat_event_flag": 1}, {"status": "open"}, {"status": None}])
    row = repeat.reopen_rate(claims).first()
    assert (row["reopened_claims"], row["reopen_rate_pct"]) == (1, 33.33)
    overall = repeat.repeat_events(claims).where("dimension = 'overall'").first()
    assert (overall["repeat_count"], overall["repeat_and_reopened"]) == (1, 1)


def test_litigation_link(make_claims):
    claims = make_claims([{"status": "reopened", "litigation_flag": 1}, {"litigation_flag": 1}, {}])
    rows = {(r["measure"][:10], r["status_group"]): r["rate_pct"] for r in repeat.litigation_link(claims).collect()}
    assert rows == {
        ("litigation", "reopened"): 100.0,
        ("litigation", "not_reopened"): 50.0,
        ("reopen_rat", "litigated"): 50.0,
        ("reopen_rat", "not_litigated"): 0.0,
    }


def test_fall_rate_ignores_diagnosis_when_root_cause_exists(make_claims, as_dict):
    claims = make_claims(
        [
            {"diagnosis_category": "Patient Fall"},
            {"procedure_category": "Surgical - Major", "severity_level": 5, "department": "OR"},
            {"procedure_category": "surgical", "severity_level": 1, "department": "OR"},
        ]
    )
    rows = as_dict(benchmarks.indicators(claims), "indicator")
    assert rows["fall_rate"]["numerator"] == 0
    assert rows["surgical_complication_rate"]["rate_per_1000"] == 500.0 and rows["surgical_complication_rate"]["denominator"] == 2
    alone = as_dict(benchmarks.indicators(claims.drop("root_cause_category")), "indicator")
    assert alone["fall_rate"]["numerator"] == 1
    dept = {(r["department"], r["indicator"]): r for r in benchmarks.departments(claims).collect()}
    assert dept["Pharmacy", "surgical_complication_rate"]["status"] == "below_benchmark"
    assert dept["OR", "fall_rate"]["status"] == "at_benchmark" and dept["OR", "fall_rate"]["variance_pct"] == 0.0


def test_scenarios_truncate(make_claims):
    rows = [{"severity_level": 5, "incurred_amount": 1000.0}] * 9 + [{"severity_level": 3, "incurred_amount": 100.0, "litigation_flag": 1}] * 3
    claims = make_claims(rows)
    shift = {r["shift_pct"]: r for r in scenarios.severity_shift(claims).collect()}
    assert shift[10]["claims_shifted"] == 0 and shift[10]["absolute_change"] == 0.0 and str(shift[10]["absolute_change"]) == "0.0"
    assert shift[30]["claims_shifted"] == 2 and shift[30]["new_total_incurred"] == 9300.0 - 1800.0
    both = scenarios.combined(claims).first()
    assert both["severity_shift_savings"] == 900.0 and both["close_time_reduction_savings"] == 93.0
    assert both["baseline_open"] == 12 and both["estimated_new_open"] == 9


def test_close_time_scenario(make_claims):
    claims = make_claims([{"days_to_close": 400, "status": "closed"}, {"days_to_close": 200, "status": "closed"}, {}, {}])
    row = scenarios.close_time(claims, (10,)).first()
    assert (row["new_mean_close_days"], row["new_claims_over_365_days"], row["estimated_backlog"]) == (270.0, 0, 1)
    assert row["backlog_change_pct"] == -50.0


def test_filters_compose(make_claims):
    claims = make_claims([{"accident_year": y, "region": r, "incident_date": D(y, 3, 1)} for y in (2021, 2022) for r in ("W", "E")])
    assert pages.filtered(claims).count() == 4
    assert pages.filtered(claims, years=[2021], regions=["W", "E"]).count() == 2
    assert pages.filtered(claims, start="2022-03-01", end=D(2022, 3, 1), regions=["W"]).count() == 1
    assert pages.filtered(claims, years=[], claim_types=None, severities=[3]).count() == 4


def test_kpis(make_claims, as_dict):
    claims = make_claims([{"accident_year": 2021}, {"accident_year": 2022}, {"accident_year": 2022, "litigation_flag": 1}, {"accident_year": None}])
    rows = as_dict(pages.kpis(claims), "kpi")
    assert rows["total_claims"]["value"] == 4.0 and rows["total_claims"]["yoy_pct"] == 100.0
    assert rows["litigation_rate_pct"]["yoy_pct"] is None and rows["litigation_rate_pct"]["value"] == 25.0
    one = as_dict(pages.kpis(claims.where("accident_year = 2021")), "kpi")
    assert one["total_paid"]["yoy_pct"] is None and one["avg_days_to_close"]["value"] == 0.0


def test_risk_segments_rank(make_claims):
    claims = make_claims([{"specialty": s, "paid_amount": p} for s, p in [("A", 10.0), ("B", 30.0), ("C", 20.0)]])
    rows = pages.risk_segments(claims, 2).orderBy("rank").collect()
    assert [(r["rank"], r["specialty"], r["risk_score"]) for r in rows] == [(1, "B", 90.0), (2, "C", 60.0)]


def test_recommendations_fall_back_to_all_claims(make_claims, as_dict):
    claims = make_claims([{"severity_level": 2, "repeat_event_flag": 1}, {"severity_level": 5, "state_code": "OH", "litigation_flag": 1}])
    rows = as_dict(pages.recommendation_metrics(claims), "metric")
    assert rows["avg_surgical_severity"]["number"] == 3.5 and rows["high_litigation_state_pct"]["number"] == 0.0
    assert rows["overall_litigation_pct"]["number"] == 50.0 and rows["top_repeat_cause"]["text"] == "Communication Failure"


def test_top_claims_break_ties_by_id(make_claims):
    claims = make_claims([{"paid_amount": 5.0}] * 12)
    assert [r["claim_id"] for r in sqlpack.top_claims(claims, 3).collect()] == ["C0", "C1", "C10"]


def test_scenario_summary_rows(make_claims):
    claims = make_claims([{"days_to_close": 10, "status": "closed"}, {}])
    rows = extracts.scenario_summary(claims).collect()
    assert len(rows) == 4 and rows[3]["parameter"] == "Combined"
    assert rows[0]["baseline_avg_close_days"] == pytest.approx(10.0) and rows[1]["note"] == "Projected"


def test_chi2_tail_is_erfc(spark):
    values = [0.0, 1e-12, 1e-3, 0.5, 1.0, 3.84, 5.999, 6.0, 6.001, 12.0, 40.0, 300.0, 2000.0, -1e-9]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").select("x", survival.chi2_tail(F.col("x")).alias("p")).collect()
    for r in rows:
        if r["x"] is None:
            assert r["p"] is None
        else:
            assert math.isclose(r["p"], math.erfc(math.sqrt(max(r["x"], 0.0) / 2)), rel_tol=1e-12, abs_tol=1e-300)
