import datetime
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossmetrics.ml import anomaly, evaluate, features, forecast, severity

D = datetime.date


@pytest.fixture(scope="module")
def book(make_claims):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(600):
        level = int(rng.integers(1, 6))
        rows.append(
            {
                "severity_level": level,
                "status": "closed",
                "paid_amount": float(rng.lognormal(6 + level, 0.3)) if i % 100 else 4e6,
                "days_to_close": int(rng.integers(10, 400)) if i % 7 else None,
                "days_to_report": int(rng.integers(0, 60)),
                "specialty": f"S{int(rng.integers(0, 14)):02d}",
                "litigation_flag": int(rng.random() < 0.2),
                "incident_date": D(2021, 1, 1) + datetime.timedelta(days=int(rng.integers(0, 1000))),
            }
        )
    return make_claims(rows).repartition(4).cache()


def _small(*names):
    found = severity.builders(trees=10, depth=6, iterations=50, rounds=2)
    return {name: found[name] for name in names}


def test_valid_claims(make_claims):
    claims = make_claims([{"status": "Closed"}, {"status": "open"}, {"status": "closed", "severity_level": 6}, {"status": "closed", "severity_level": None}])
    assert [r["claim_id"] for r in features.valid_claims(claims).collect()] == ["C0"]


def test_too_few_claims(make_claims):
    with pytest.raises(ValueError):
        severity.prepare(make_claims([{"status": "closed"}] * 49))


def test_specialties_beyond_ten_are_other(book):
    table = features.feature_table(book)
    assert table.select("specialty_group").distinct().count() == 11
    assert table.where("specialty_group = 'other'").count() > 0 and table.count() == 600


def test_stratified_parts_are_exact_and_stable(book):
    rows = features.labelled(features.feature_table(book))
    parts = features.stratified_parts(rows, "label", "claim_id", [0.2, 0.8])
    total = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    test = {r["label"]: r["count"] for r in parts.where("part = 0").groupBy("label").count().collect()}
    assert test == {k: math.ceil(round(0.2 * n, 6)) for k, n in total.items()}
    same = features.stratified_parts(rows.repartition(9), "label", "claim_id", [0.2, 0.8])
    pick = lambda df: {r[0] for r in df.where("part = 0").select("claim_id").collect()}
    assert pick(parts) == pick(same)
    folds = features.stratified_parts(rows, "label", "claim_id", [0.2] * 5, column="fold")
    sizes = [r["count"] for r in folds.groupBy("label", "fold").count().collect()]
    assert folds.count() == 600 and len(sizes) == 25
    for label, n in total.items():
        own = [r["count"] for r in folds.where(F.col("label") == label).groupBy("fold").count().collect()]
        assert max(own) - min(own) <= 1 and sum(own) == n


def test_hash_slices_with_many_rows_per_slice(spark, monkeypatch):
    monkeypatch.setattr(features, "_SLICES", 3)
    df = spark.range(1000).selectExpr("id", "id % 2 AS label")
    parts = features.stratified_parts(df, "label", "id", [0.1, 0.3, 0.6])
    got = {(r["label"], r["part"]): r["count"] for r in parts.groupBy("label", "part").count().collect()}
    assert got == {(k, p): n for k in (0, 1) for p, n in enumerate((50, 150, 300))}


def test_training_learns_from_paid(book):
    models = severity.train(book, _small(severity.FOREST, severity.LOGISTIC))
    for name in (severity.FOREST, severity.LOGISTIC):
        accuracy = models.report(name).where("row = 'accuracy'").first()["precision"]
        assert accuracy > 0.6
        assert models.confusion(name).count() == 25
    importances = models.importances().collect()
    assert importances[0]["feature"] == "log_paid_amount" and sum(r["importance"] for r in importances) == pytest.approx(1.0)
    assert not any("unknown" in r["feature"] for r in importances)
    bins = evaluate.calibration(models.predictions[severity.FOREST]).collect()
    assert all(0 <= r["fraction_positive"] <= 1 and 0 <= r["mean_predicted"] <= 1 for r in bins)


def test_boosted_predicts_all_classes(book):
    models = severity.train(book, _small(severity.BOOSTED))
    assert models.report(severity.BOOSTED).where("row = 'accuracy'").first()["precision"] > 0.5


def test_cross_validation_and_ranking(book):
    rows = severity.prepare(book)
    scores = evaluate.cross_validate(
        rows, {"deep": lambda n: severity.forest(5, 6), "flat": lambda n: severity.forest(5, 1)}, folds=3
    )
    assert scores.count() == 6
    ranked = evaluate.ranking(scores).orderBy("rank").collect()
    assert [r["model"] for r in ranked] == ["deep", "flat"] and ranked[0]["f1_mean"] > ranked[1]["f1_mean"]
    test = evaluate.paired_test(scores).first()
    assert test["model_a"] == "deep" and test["t_statistic"] > 0 and 0 <= test["p_value"] <= 1


@pytest.fixture(scope="module")
def many_claims(spark):
    """9,000 valid claims, more than the 4,000 rows that models once were fitted on."""
    return spark.range(9000).selectExpr(
        "concat('C', id) AS claim_id", "CAST(id % 5 + 1 AS INT) AS severity_level", "'closed' AS status", "concat('T', id % 4) AS claim_type",
        "concat('S', id % 12) AS specialty", "concat('R', id % 3) AS region", "concat('A', id % 2) AS patient_age_band",
        "CAST(id * 7919 % 1000 AS DOUBLE) AS paid_amount", "CAST(id % 50 AS INT) AS days_to_report",
        "CAST(id % 7 = 0 AS INT) AS litigation_flag", "CAST(id % 11 = 0 AS INT) AS repeat_event_flag",
    )


def _seen():
    """Builders of a model that note the training rows, told and given."""
    told, given = [], []

    class Counted:
        def fit(self, df):
            given.append(df.select("claim_id").distinct().count())
            return severity.logistic(len(given), 1).fit(df)

    return {"counted": lambda rows: told.append(rows) or Counted()}, told, given


def test_training_uses_every_row_of_the_split(many_claims):
    models, told, given = _seen()
    severity.train(many_claims, models)
    assert told == given == [7200]


def test_folds_train_on_every_row_of_the_others(many_claims):
    models, told, given = _seen()
    evaluate.cross_validate(severity.prepare(many_claims), models, folds=3)
    assert told == given == [6000] * 3


def test_calibration_is_of_a_model_of_all_rows(many_claims):
    models, told, given = _seen()
    found = evaluate.calibrations(severity.prepare(many_claims), models)
    assert told == given == [9000]
    assert {r["n"] for r in found.groupBy("class").agg(F.sum("claim_count").alias("n")).collect()} == {9000}


def test_report_by_hand(spark):
    pairs = [(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 1.0)] * 2 + [(2.0, 0.0)] * 2
    rows = {r["row"]: r for r in evaluate.classification_report(spark.createDataFrame(pairs, "label double, prediction double")).collect()}
    assert rows["1"]["precision"] == 0.6 and rows["1"]["recall"] == 0.75 and rows["3"]["f1_score"] == 0.0
    assert rows["accuracy"]["recall"] == 0.625 and rows["macro avg"]["recall"] == pytest.approx((0.75 + 1 + 0) / 3, abs=1e-6)


@pytest.mark.parametrize("t, df, p", [(2.776445, 4, 0.05), (12.706205, 1, 0.05), (2.570582, 5, 0.05), (3.182446, 3, 0.05), (0.0, 4, 1.0)])
def test_student_tail(t, df, p):
    assert evaluate.t_two_sided(t, df) == pytest.approx(p, abs=1e-6)


def monthly(make_claims, months, skip=()):
    rows = []
    for m in range(months):
        if m not in skip:
            rows += [{"incident_date": D(2020 + m // 12, m % 12 + 1, 10)}] * (20 + 5 * (m % 12 == 0) + m // 6)
    return make_claims(rows)


def test_series_fills_gaps(make_claims):
    rows = forecast.monthly_series(monthly(make_claims, 30, skip=(5,))).orderBy("month").collect()
    assert len(rows) == 30 and rows[5]["y"] == 0 and rows[0]["y"] == 25


def test_forecast_follows_season_and_bands_widen(make_claims):
    rows = forecast.forecast(monthly(make_claims, 36)).orderBy("horizon").collect()
    assert len(rows) == 12 and rows[0]["method"] == "holt_winters" and rows[0]["month"] == D(2023, 1, 1)
    assert rows[0]["forecast"] > rows[1]["forecast"] + 2  # January peak
    assert all(r["lower_95"] <= r["lower_80"] <= r["forecast"] <= r["upper_80"] <= r["upper_95"] for r in rows)
    assert rows[-1]["upper_95"] - rows[-1]["forecast"] > rows[0]["upper_95"] - rows[0]["forecast"]
    assert rows[0]["beta"] <= rows[0]["alpha"] and rows[0]["gamma"] <= 1 - rows[0]["alpha"]


def plain_errors(y, season, alpha, beta, gamma, level, trend, cycle):
    cycle, out = list(cycle), []
    for t, value in enumerate(y):
        seasonal = cycle[t % season] if season else 0.0
        out.append(value - level - trend - seasonal)
        moved = alpha * (value - seasonal) + (1 - alpha) * (level + trend)
        if season:
            cycle[t % season] = gamma * (value - level - trend) + (1 - gamma) * seasonal
            trend = beta * (moved - level) + (1 - beta) * trend
        level = moved
    return np.array(out)


@pytest.mark.parametrize("months", [24, 25, 41, 90])
def test_estimated_start_states(months):
    rng = np.random.default_rng(months)
    y = rng.poisson(40 + 8 * np.sin(np.arange(months) / 2) + 0.3 * np.arange(months)).astype(float)
    result = forecast._smoother()(y, 12)
    first = y[:12].mean()
    for alpha in np.linspace(0.05, 0.95, 7):  # start states from the first two seasons are never better
        for beta in (0.05, alpha):
            for gamma in (0.05, 1 - alpha):
                plain = plain_errors(y, 12, alpha, beta, gamma, first, (y[12:24].mean() - first) / 12, y[:12] - first)
                assert result["sse"] <= (plain**2).sum() + 1e-9
    # A least-squares fit by numpy at the chosen parameters, state by state.
    chosen = (result["alpha"], result["beta"], result["gamma"])
    base = plain_errors(y, 12, *chosen, 0.0, 0.0, np.zeros(12))
    units = [plain_errors(np.zeros(months), 12, *chosen, *u[:2], u[2:]) for u in np.eye(14)]
    solved = np.linalg.lstsq(-np.array(units).T, base, rcond=None)[0]
    assert result["sse"] == pytest.approx(((base + np.array(units).T @ solved) ** 2).sum(), rel=1e-6)


def test_estimated_level_of_simple_smoothing():
    y = np.array([30.0, 12, 14, 13, 15, 12, 14])
    result = forecast._smoother()(y, 3)
    plain = min((plain_errors(y, 0, a, 0, 0, level, 0.0, ()) ** 2).sum() for a in np.linspace(0.01, 0.99, 50) for level in np.linspace(5, 35, 121))
    assert result["sse"] <= plain + 1e-9
    assert forecast._smoother()(np.array([4.0]), 2)["forecast"].tolist() == [4.0, 4.0]


def test_short_series_and_backtest(make_claims):
    short = monthly(make_claims, 10)
    rows = forecast.forecast(short).collect()
    assert {r["method"] for r in rows} == {"simple_exponential_smoothing"} and len({round(r["forecast"], 9) for r in rows}) == 1
    assert forecast.backtest_rows(short).count() == 0
    checked = forecast.backtest_rows(monthly(make_claims, 36))
    assert checked.count() == 6
    metrics = forecast.backtest_metrics(checked).first()
    assert 0 <= metrics["mae"] <= metrics["rmse"] and metrics["mape"] < 20


def test_many_series(make_claims):
    claims = monthly(make_claims, 26).withColumn("region", F.when(F.col("claim_id") < "C3", "x").otherwise("y"))
    assert forecast.forecast(claims, "region", periods=3).count() == 6


def test_features_impute_and_scale(book):
    x = anomaly.features(book)
    assert x.where("x_days_to_close IS NULL").count() == 0
    closes = np.array([r[0] for r in book.where("days_to_close IS NOT NULL").select("days_to_close").collect()])
    filled = x.where("days_to_close IS NULL").first()["x_days_to_close"]
    assert filled == np.median(closes)
    row = anomaly.standardised(x).agg(F.avg("log_paid_amount").alias("m"), F.stddev_pop("log_paid_amount").alias("s")).first()
    assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1)


@pytest.fixture(scope="module")
def detected(book):
    return anomaly.detect(book, trees=40)


def test_contamination_and_extremes(detected):
    flagged, forest = detected
    rate = flagged.where("is_anomaly").count() / 600
    assert abs(rate - 0.05) < 0.01 and len(forest) == 40
    big = flagged.where("paid_amount = 4000000").agg(F.avg("anomaly_score")).first()[0]
    assert big < flagged.agg(F.avg("anomaly_score")).first()[0]


def test_same_forest_for_any_layout(book, detected):
    _, forest = detected
    again = anomaly.fit_forest(anomaly.features(book.repartition(11)), 40)
    assert all(np.array_equal(a["threshold"], b["threshold"]) for a, b in zip(forest, again))


def test_shapley_values_equal_brute_force(detected):
    flagged, forest = detected
    rows = flagged.where("is_anomaly").orderBy("claim_id").limit(3)
    got = {}
    for r in anomaly.explain(rows, forest, top=5).collect():
        got.setdefault(r["claim_id"], {})[r["feature"]] = r["shap_value"]

    def value(tree, x, known, node=0):
        f = tree["feature"][node]
        if f < 0:
            return tree["value"][node]
        left, right = tree["left"][node], tree["right"][node]
        if f in known:
            return value(tree, x, known, left if x[f] <= tree["threshold"][node] else right)
        share = tree["size"][left] / tree["size"][node]
        return share * value(tree, x, known, left) + (1 - share) * value(tree, x, known, right)

    for r in rows.collect():
        x = [r[f"x_{c}"] for c in anomaly.FEATURES]
        for f, name in enumerate(anomaly.FEATURES):
            others = [k for k in range(5) if k != f]
            phi = 0.0
            for size in range(5):
                w = math.factorial(size) * math.factorial(4 - size) / 120
                for s in itertools.combinations(others, size):
                    phi += w * np.mean([value(t, x, {*s, f}) - value(t, x, set(s)) for t in forest])
            assert got[r["claim_id"]][name] == pytest.approx(phi, abs=1e-9)


def test_summary_and_months(detected):
    flagged, forest = detected
    rows = {r["feature"]: r for r in anomaly.compare(flagged).collect()}
    assert rows["paid_amount"]["anomaly_mean"] > rows["paid_amount"]["normal_mean"]
    normal = [r[0] for r in flagged.where("NOT is_anomaly AND days_to_close IS NOT NULL").select("days_to_close").collect()]
    assert rows["days_to_close"]["normal_median"] == pytest.approx(np.median(normal))
    assert anomaly.monthly_rate(flagged).agg(F.sum("anomaly_count")).first()[0] == flagged.where("is_anomaly").count()
    reasons = anomaly.explain(flagged, forest)
    topped = anomaly.with_top_reason(flagged, reasons)
    assert topped.count() == flagged.where("is_anomaly").count() and topped.where("top_reason = ''").count() == 0


def test_stratified_parts_add_no_task_per_shuffle_partition(spark):
    rows = spark.range(0, 3000, 1, 3).select(F.concat(F.lit("C"), "id").alias("claim_id"), (F.col("id") % 5).alias("label"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = features.stratified_parts(rows, "label", "claim_id", [0.2] * 5)
        assert parts.rdd.getNumPartitions() <= 3 + spark.sparkContext.defaultParallelism
        assert {r["count"] for r in parts.groupBy("label", "part").count().collect()} == {120}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_steps_lead_to_the_leaf_and_stay():
    tree = {c: np.array(v) for c, v in dict(feature=[1, -1, 0, -1, -1], threshold=[0.5, 0, 2.0, 0, 0], left=[1, -1, 3, -1, -1], right=[2, -1, 4, -1, -1]).items()}
    asked, threshold, child = anomaly._steps(tree)
    x = np.array([[1.0, 0.5], [2.0, 0.6], [2.5, 9.0], [np.nan, 1.0]])
    at = np.zeros(4, int)
    for _ in range(5):
        at = child[2 * at + ~(x[np.arange(4), asked[at]] <= threshold[at])]
    assert at.tolist() == [1, 3, 4, 4]
