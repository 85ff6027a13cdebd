import datetime
import math

import numpy as np
import pytest

from lossmetrics.operators import reserving, resampling, survival

D = datetime.date

TRIANGLE = {(2020, 0): 100.0, (2020, 1): 50.0, (2020, 2): 15.0, (2021, 0): 110.0, (2021, 1): 60.0, (2022, 0): 120.0}


def cells(values, **extra):
    return [{"accident_year": a, "development_year": d, "paid_amount": p, **extra} for (a, d), p in values.items()]


@pytest.fixture(scope="module")
def triangle(make_claims):
    return make_claims(cells(TRIANGLE) + [{"accident_year": None, "paid_amount": 9e9}, {"accident_year": 2022, "paid_amount": None}])


def test_triangle(triangle):
    rows = {(r["accident_year"], r["development_year"]): r["cumulative_paid"] for r in reserving.triangle(triangle).collect()}
    assert rows == {(2020, 0): 100.0, (2020, 1): 150.0, (2020, 2): 165.0, (2021, 0): 110.0, (2021, 1): 170.0, (2022, 0): 120.0}


def test_factors(triangle):
    links = {r["from_dev"]: r["factor"] for r in reserving.age_to_age(triangle).collect()}
    assert links == {0: round(320 / 210, 6), 1: 1.1}
    cdfs = {r["development_year"]: r["cdf"] for r in reserving.cumulative_factors(triangle).collect()}
    assert cdfs == {0: round(1.52381 * 1.1, 6), 1: 1.1, 2: 1.0}


def test_ultimates_and_ibnr(triangle, as_dict):
    ult = as_dict(reserving.ultimates(triangle), "accident_year")
    assert ult[2020]["ultimate"] == 165.0 and ult[2021]["ultimate"] == 187.0 and ult[2022]["ultimate"] == 201.14
    reserve = as_dict(reserving.ibnr(triangle), "accident_year")
    assert reserve["2021"]["ibnr"] == 17.0 and reserve["total"]["ibnr"] == 98.14 and reserve["total"]["current_paid"] == 455.0


def test_standard_errors_by_hand(triangle, as_dict):
    rows = as_dict(reserving.standard_errors(triangle), "accident_year")
    f0 = round(320 / 210, 6)
    s0 = (100 * (1.5 - f0) ** 2 + 110 * (170 / 110 - f0) ** 2) / 1
    variance = s0 / f0**2 * (1 / 120 + 1 / 330)  # the later step has one pair: sigma 0
    se = math.sqrt(variance) * 201.14
    assert rows[2020]["se"] == 0.0 and rows[2021]["se"] == 0.0
    assert rows[2022]["se"] == pytest.approx(se, abs=0.01)
    assert rows[2022]["ci_upper"] == pytest.approx(81.14 + 1.96 * se, abs=0.01)


def test_gap_carries_cumulative_and_breaks_the_pair(make_claims):
    gap = make_claims(cells({k: v for k, v in TRIANGLE.items() if k != (2020, 1)}))
    rows = {(r["accident_year"], r["development_year"]): r["cumulative_paid"] for r in reserving.triangle(gap).collect()}
    assert rows[2020, 2] == 115.0 and (2020, 1) not in rows
    links = {r["from_dev"]: r["factor"] for r in reserving.age_to_age(gap).collect()}
    assert links == {0: round(170 / 110, 6), 1: None}
    assert {r["development_year"]: r["cdf"] for r in reserving.cumulative_factors(gap).collect()}[1] == 1.0


def test_wide_triangles(triangle, as_dict):
    full = as_dict(reserving.wide_triangle(triangle, 3), "accident_year")
    assert (full[2022]["dev_0"], full[2022]["dev_1"], full[2022]["dev_2"]) == (120.0, 120.0, 120.0)
    masked = as_dict(reserving.wide_triangle(triangle, 3, masked=True), "accident_year")
    assert masked[2021]["dev_1"] == 170.0 and masked[2021]["dev_2"] is None


def test_segments_are_independent(make_claims):
    both = make_claims(cells(TRIANGLE, specialty="A") + cells({k: 2 * v for k, v in TRIANGLE.items()}, specialty="B"))
    totals = {r["segment"]: r["ibnr"] for r in reserving.ibnr(both, "specialty").where("accident_year = 'total'").collect()}
    assert totals["A"] == 98.14 and totals["B"] == pytest.approx(196.28, abs=0.02)
    assert reserving.standard_errors(make_claims(cells({(2020, 0): 1.0, (2020, 1): 1.0}))).count() == 0


KM = [("a", 1, 1), ("a", 2, 1), ("a", 2, 0), ("b", 3, 1), ("b", 3, 1), ("b", 5, 0)]


@pytest.fixture(scope="module")
def observed(make_claims):
    as_of = D(2023, 6, 30)
    return make_claims(
        [
            {
                "claim_type": g,
                "status": "closed" if e else "open",
                "days_to_close": t if e else None,
                "report_date": as_of - datetime.timedelta(days=t),
            }
            for g, t, e in KM
        ]
    ), as_of


def test_kaplan_meier_by_hand(observed, as_dict):
    claims, as_of = observed
    curve = as_dict(survival.kaplan_meier(claims, as_of=as_of), "t")
    assert sorted(curve) == [0, 1, 2, 3, 5] and curve[0]["survival"] == 1.0
    assert curve[1]["survival"] == pytest.approx(5 / 6) and curve[2]["survival"] == pytest.approx(2 / 3)
    assert curve[3]["survival"] == pytest.approx(2 / 9) and curve[5]["survival"] == pytest.approx(2 / 9)
    v = math.log(5 / 6)
    se = math.sqrt(1 / 30)
    assert curve[1]["ci_lower"] == pytest.approx(math.exp(-math.exp(math.log(-v) - 1.959964 * se / v)), abs=1e-6)
    assert 0 <= curve[3]["ci_lower"] < curve[3]["survival"] < curve[3]["ci_upper"] <= 1
    assert survival.median_survival(claims, as_of=as_of).first()["median_survival_time"] == 3


def test_curve_that_ends_at_zero(make_claims, as_dict):
    curve = as_dict(survival.kaplan_meier(make_claims([{"status": "closed", "days_to_close": d} for d in (4, 0, 9)])), "t")
    assert sorted(curve) == [0, 4, 9] and curve[9]["survival"] == 0.0 and curve[9]["ci_upper"] == 0.0


def test_small_groups_are_left_out(observed):
    claims, as_of = observed
    assert survival.kaplan_meier(claims, "claim_type", as_of).count() == 0


def test_log_rank_equals_direct_formula(make_claims):
    rng = np.random.default_rng(5)
    data = [(g, int(rng.integers(1, 30 if g == "a" else 60)), int(rng.random() < 0.7)) for g in "aab" for _ in range(20)]
    as_of = D(2023, 6, 30)
    claims = make_claims(
        [
            {"claim_type": g, "status": "closed" if e else "open", "days_to_close": t if e else None, "report_date": as_of - datetime.timedelta(days=t)}
            for g, t, e in data
        ]
    )
    gap = var = 0.0
    for t in sorted({t for _, t, e in data if e}):
        n = sum(x >= t for _, x, _ in data)
        na = sum(x >= t and g == "a" for g, x, _ in data)
        d = sum(x == t and e for _, x, e in data)
        da = sum(x == t and e and g == "a" for g, x, e in data)
        gap += da - d * na / n
        if n > 1:
            var += na * (n - na) * d * (n - d) / (n * n * (n - 1))
    row = survival.log_rank_p(claims, as_of=as_of).first()
    assert row["test_statistic"] == pytest.approx(gap**2 / var)
    assert row["p_value"] == pytest.approx(math.erfc(math.sqrt(gap**2 / var / 2))) and row["significant"] == (row["p_value"] < 0.05)


def portfolio(make_claims):
    rng = np.random.default_rng(6)
    return make_claims(
        [
            {"severity_level": int(rng.integers(1, 6)), "paid_amount": float(rng.lognormal(8, 1)), "litigation_flag": int(rng.random() < 0.3)}
            for _ in range(400)
        ]
    )


def test_simulated_savings(make_claims):
    claims = portfolio(make_claims)
    row = resampling.simulated_savings(claims, n_sim=500).first()
    assert row["p5"] <= row["median_savings"] <= row["p95"] and row["var_95"] == row["p5"] and 0 <= row["prob_positive"] <= 100
    again = resampling.simulated_savings(claims.repartition(7), n_sim=500).first()
    assert again["median_savings"] == pytest.approx(row["median_savings"], rel=1e-9)
    none = resampling.simulated_savings(claims, severity_pct=0, litigation_pct=0, close_pct=0, n_sim=50).first()
    assert none["mean_savings"] == 0.0 and none["prob_positive"] == 0.0


def test_bootstrap(make_claims):
    claims = portfolio(make_claims)
    values = np.array([r[0] for r in claims.select("paid_amount").collect()])
    row = resampling.bootstrap_interval(claims, "paid_amount", "mean", n_boot=600).first()
    assert row["ci_lower"] < row["estimate"] < row["ci_upper"] and row["estimate"] == pytest.approx(values.mean())
    assert row["margin_of_error"] == pytest.approx(1.96 * values.std() / math.sqrt(len(values)), rel=0.2)
    other = resampling.bootstrap_interval(claims.repartition(9), "paid_amount", "mean", n_boot=600).first()
    assert other["ci_lower"] == pytest.approx(row["ci_lower"], rel=1e-9)
    total = resampling.bootstrap_interval(claims, "paid_amount", "sum", n_boot=600).first()
    assert total["estimate"] == pytest.approx(values.sum()) and total["ci_lower"] == pytest.approx(row["ci_lower"] * 400, rel=1e-9)
    with pytest.raises(ValueError):
        resampling.bootstrap_interval(claims, "paid_amount", "median")


def test_bootstrap_of_nothing(make_claims):
    row = resampling.bootstrap_interval(make_claims([{"paid_amount": None}]), "paid_amount", n_boot=10).first()
    assert tuple(row) == (0.0, 0.0, 0.0, 0.0)
