import numpy as np
import pytest
from pyspark.sql import functions as F

from lossmetrics.functions import columns
from lossmetrics.functions.distributions import counts_by_dimension, counted_percentile, counted_stddev, quantiles, stacked_counts, value_counts


@pytest.mark.parametrize(
    "values",
    [
        [5.0],
        [1.0, 2.0],
        list(np.random.default_rng(1).lognormal(9, 2, 5000)),
        [7.0] * 4000 + list(np.random.default_rng(2).normal(0, 1e6, 3000)),  # one hot value
        [-3.5, -3.5, 0.0, 0.0, 1e-9, 1e12],
        list(np.linspace(100, 100.001, 999)),  # all in one slice
    ],
)
def test_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(5)
    probs = {"p0": 0.0, "p05": 0.05, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    row = quantiles(df, "v", probs).first()
    for name, p in probs.items():
        assert row[name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-9)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert quantiles(df, "v", {"m": 0.5}).first()["m"] is None


def test_value_counts_statistics_equal_numpy(spark):
    values = list(map(int, np.random.default_rng(3).integers(0, 40, 1000)))
    df = spark.createDataFrame([(v,) for v in values], "v int")
    row = value_counts(df, "v").agg(counted_percentile(0.95).alias("p"), counted_stddev().alias("s")).first()
    assert row["p"] == pytest.approx(np.quantile(values, 0.95)) and row["s"] == pytest.approx(np.std(values, ddof=1))


def test_counts_by_dimension_drops_null_members(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", None, 3), (None, 1, 4)], "x string, y int, v int")
    rows = {(r["dimension"], r["member"], r["value"]): r["n"] for r in counts_by_dimension(df, "v", ["x", "y"]).collect()}
    assert rows == {("x", "a", 3): 2, ("y", "1", 3): 1, ("y", "1", 4): 1}


def test_stacked_counts(spark):
    df = spark.createDataFrame([(1, 5), (1, None)], "a int, b int")
    assert {(r["feature"], r["value"]): r["n"] for r in stacked_counts(df, ["a", "b"]).collect()} == {("a", 1): 2, ("b", 5): 1}


def test_exact_sum_does_not_depend_on_partitions(spark):
    values = [(float(v),) for v in np.random.default_rng(4).lognormal(10, 2, 4000).round(4)] + [(-0.25,), (None,)]
    sums = set()
    for parts in (1, 3, 17):
        df = spark.createDataFrame(values, "v double").repartition(parts)
        sums.add(df.agg(columns.exact_sum("v").alias("s")).first()["s"])
    assert len(sums) == 1
    assert float(sums.pop()) == pytest.approx(sum(v for (v,) in values if v is not None), rel=1e-12)


def test_wilson_hand_values(spark):
    parts = columns.wilson(F.lit(8), F.lit(10))
    row = spark.range(1).select(*[c.alias(n) for n, c in parts.items()]).first()
    assert row["estimate"] == 0.8
    assert row["ci_lower"] == pytest.approx(0.49016, abs=1e-4) and row["ci_upper"] == pytest.approx(0.94332, abs=1e-4)
    none = columns.wilson(F.lit(0), F.lit(0))
    assert set(spark.range(1).select(*[c.alias(n) for n, c in none.items()]).first()) == {0.0}


def test_right_closed_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 7, 8, 14, 365, 366, None)], "v int")
    labels = ["0-7", "8-14", "15-30", "31-60", "61-90", "91-180", "181-365", "365+"]
    got = [r[0] for r in df.select(columns.right_closed("v", [0, 7, 14, 30, 60, 90, 180, 365], labels)).collect()]
    assert got == [None, "0-7", "8-14", "8-14", "181-365", "365+", None]


def test_age_band_and_risk(spark):
    df = spark.createDataFrame([(17, 0.5), (18, 1.0), (64, 1.5), (65, 1.0), (80, 1.6)], "a int, w double")
    rows = df.select(columns.age_band("a").alias("b"), "w").select("b", columns.risk_segment("b", "w").alias("r")).collect()
    assert [(r["b"], r["r"]) for r in rows] == [("0-17", "low"), ("18-34", "medium"), ("50-64", "high"), ("65+", "high"), ("65+", "critical")]
