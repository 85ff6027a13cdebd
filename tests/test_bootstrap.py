"""Bootstrap of any statistic against resampling row by row."""

import numpy as np
import pytest

from lossmetrics.operators import resampling


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_weighted_percentile_is_that_of_repeated_values(p):
    rng = np.random.default_rng(3)
    values = np.sort(rng.normal(size=40))
    weights = rng.poisson(1.3, 40)
    at = resampling.weighted_percentile(p)
    assert at(values, weights) == pytest.approx(np.percentile(np.repeat(values, weights), 100 * p), abs=1e-12)
    assert np.isnan(at(values, np.zeros(40, int))) and np.isnan(at(values[:0], weights[:0]))


def plain_interval(x, statistic, n_boot=600):
    rng = np.random.default_rng(9)
    found = [statistic(rng.choice(x, len(x))) for _ in range(n_boot)]
    return np.percentile(found, [2.5, 97.5])


@pytest.mark.parametrize("p", [0.5, 0.95])
@pytest.mark.parametrize("rows", [300, 40_000])
def test_percentile_interval(spark, p, rows):
    """The few rows take the plain way, the many the window of ranks."""
    x = np.random.default_rng(1).lognormal(6, 1, rows).round(2)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)] * 7, "paid double").repartition(5)
    got = resampling.bootstrap_percentile(df, "paid", p, n_boot=600).first()
    low, high = plain_interval(x, lambda s: np.percentile(s, 100 * p))
    assert got["estimate"] == pytest.approx(np.percentile(x, 100 * p), rel=1e-12)
    width = high - low
    assert abs(got["ci_lower"] - low) < 0.25 * width and abs(got["ci_upper"] - high) < 0.25 * width
    assert got["margin_of_error"] == pytest.approx((got["ci_upper"] - got["ci_lower"]) / 2)
    again = resampling.bootstrap_percentile(df.repartition(2), "paid", p, n_boot=600).first()
    assert got == again


def test_window_holds_few_values(spark, monkeypatch):
    x = np.random.default_rng(2).normal(size=40_000)
    df = spark.createDataFrame([(float(v),) for v in x], "paid double")
    monkeypatch.setattr(resampling, "MAX_VALUES", 2 * int(resampling.RANK_SPREAD * 100 + 2 * resampling.RANK_SPREAD**2) + 10)
    assert resampling.bootstrap_percentile(df, "paid", n_boot=20).first()["estimate"] == pytest.approx(np.median(x))
    with pytest.raises(ValueError):
        resampling.bootstrap_statistic(df, "paid", resampling.weighted_percentile(0.5), n_boot=20)


def test_any_statistic_of_counted_values(spark):
    x = np.random.default_rng(5).choice([1, 2, 3, 4, 5], 2000, p=[0.4, 0.3, 0.15, 0.1, 0.05])
    df = spark.createDataFrame([(int(v),) for v in x], "severity int")
    share = lambda values, weights: float(weights[values >= 4].sum() / weights.sum())
    got = resampling.bootstrap_statistic(df, "severity", share, n_boot=600).first()
    low, high = plain_interval(x, lambda s: (s >= 4).mean())
    assert got["estimate"] == pytest.approx((x >= 4).mean())
    assert abs(got["ci_lower"] - low) < 0.01 and abs(got["ci_upper"] - high) < 0.01


def test_ties_one_row_and_no_rows(spark):
    same = spark.createDataFrame([(3.0,)] * 50_000, "paid double")
    got = resampling.bootstrap_percentile(same, "paid", n_boot=20).first()
    assert (got["estimate"], got["ci_lower"], got["ci_upper"]) == (3.0, 3.0, 3.0)
    one = resampling.bootstrap_percentile(same.limit(1), "paid", n_boot=50).first()
    assert one["estimate"] == 3.0 and one["ci_lower"] == 3.0
    none = resampling.bootstrap_percentile(same.limit(0), "paid", n_boot=20).first()
    assert tuple(none) == (None, None, None, None)
    with pytest.raises(ValueError):
        resampling.bootstrap_percentile(same, "paid", 1.5)
