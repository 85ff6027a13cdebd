"""Model evaluation: reports, confusion, stratified cross-validation, calibration, ranking and a paired t-test."""

from __future__ import annotations

import math
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.functions.distributions import union_all
from lossmetrics.ml import features
from lossmetrics.sources.lookups import values_frame

CLASSES = 5


def confusion(predictions: DataFrame, classes: int = CLASSES) -> DataFrame:
    """Counts per actual and predicted class, 0 where a pair does not occur."""
    codes = F.array(*[F.lit(float(c)) for c in range(classes)])
    counts = predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    grid = predictions.sparkSession.range(1).select(F.explode(codes).alias("label")).select(
        "label", F.explode(codes).alias("prediction")
    )
    return grid.join(counts, ["label", "prediction"], "left").select(
        (F.col("label") + 1).cast("int").alias("actual"),
        (F.col("prediction") + 1).cast("int").alias("predicted"),
        F.coalesce("n", F.lit(0)).alias("claim_count"),
    )


def _per_class(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Precision, recall, F1 and support per class from (keys, label, prediction, n) rows."""
    n = F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(0)
    actual = pairs.groupBy(*keys, F.col("label").alias("class")).agg(F.sum(n).alias("support"), F.sum(hit).alias("tp"))
    called = pairs.groupBy(*keys, F.col("prediction").alias("class")).agg(F.sum(n).alias("called"))
    joined = actual.join(called, [*keys, "class"], "full").na.fill(0, ["support", "tp", "called"])
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("called")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    scored = joined.withColumns({"precision": precision, "recall": recall})
    both = F.col("precision") + F.col("recall")
    return scored.withColumn(
        "f1_score", F.coalesce(F.try_divide(F.lit(2.0) * F.col("precision") * F.col("recall"), both), F.lit(0.0))
    )


def _pairs(predictions: DataFrame, *keys: str) -> DataFrame:
    return predictions.groupBy(*keys, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class with accuracy, macro and weighted averages."""
    per_class = _per_class(_pairs(predictions), [])
    measures = ["precision", "recall", "f1_score"]
    own = per_class.select((F.col("class") + 1).cast("int").cast("string").alias("row"), *measures, "support")
    support = F.sum("support").alias("support")
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], support).select(F.lit("macro avg").alias("row"), "*")
    weighted = per_class.agg(
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures], support
    ).select(F.lit("weighted avg").alias("row"), "*")
    right = F.try_divide(F.sum("tp"), F.sum("support"))
    accuracy = per_class.agg(*[right.alias(m) for m in measures], support).select(F.lit("accuracy").alias("row"), "*")
    rounded = union_all([own, accuracy, macro, weighted])
    return rounded.select("row", *[F.round(m, 6).alias(m) for m in measures], "support")


def macro_f1(predictions: DataFrame, *keys: str) -> DataFrame:
    return _per_class(_pairs(predictions, *keys), list(keys)).groupBy(*keys).agg(F.avg("f1_score").alias("macro_f1"))


def cross_validate(
    rows: DataFrame,
    models: dict[str, Callable[[int], Estimator]],
    folds: int = 5,
    fit_rows: int | None = None,
    seed: int = config.SEED,
) -> DataFrame:
    """Macro-F1 of every model on every stratified fold: (model, fold, macro_f1).

    ``rows`` are labelled feature rows; ``models`` build an estimator from the number of training rows. The assembly is
    fitted on the training folds only; every row of them is trained on (unless a caller bounds them by ``fit_rows``) and every row of
    a test fold is predicted. Folds run side by side.
    """
    parts = features.stratified_parts(rows, "label", "claim_id", [1 / folds] * folds, seed, "fold").persist()

    def scores_of(fold: int) -> list[tuple[str, int, float]]:
        train, test = parts.where(F.col("fold") != fold), parts.where(F.col("fold") == fold)
        train = features.bounded(train, fit_rows, seed)
        assembly = features.assembler().fit(train)
        train = features.with_class_weights(assembly.transform(train)).persist()
        try:
            size = train.count()
            test = assembly.transform(test)
            score = lambda build: float(macro_f1(build(size).fit(train).transform(test)).first()[0])
            with ThreadPool(len(models)) as pool:
                return [(name, fold, found) for name, found in zip(models, pool.map(score, models.values()))]
        finally:
            train.unpersist()

    try:
        with ThreadPool(folds) as pool:
            scores = [row for found in pool.map(scores_of, range(folds)) for row in found]
    finally:
        parts.unpersist()
    return values_frame(rows.sparkSession, scores, ["model", "fold", "macro_f1"])


def ranking(scores: DataFrame) -> DataFrame:
    """Models by mean macro-F1, with the population deviation over the folds."""
    means = scores.groupBy("model").agg(F.avg("macro_f1").alias("f1_mean"), F.stddev_pop("macro_f1").alias("f1_std"))
    place = F.row_number().over(Window.orderBy(F.desc("f1_mean"), "model"))  # one row per model
    return means.select(place.alias("rank"), "model", "f1_mean", "f1_std")


def paired_test(scores: DataFrame) -> DataFrame:
    """Paired t-test of the two best models over their folds; empty with fewer than two models or folds."""
    best = ranking(scores).where("rank <= 2")
    both = scores.join(best, "model").groupBy("fold").agg(
        F.max(F.when(F.col("rank") == 1, F.col("macro_f1"))).alias("a"),
        F.max(F.when(F.col("rank") == 2, F.col("macro_f1"))).alias("b"),
    )
    gap = F.col("a") - F.col("b")
    stats = both.where(gap.isNotNull()).agg(F.avg(gap).alias("m"), F.stddev_samp(gap).alias("s"), F.count(gap).alias("n"))
    names = best.agg(
        F.max(F.when(F.col("rank") == 1, F.col("model"))).alias("model_a"),
        F.max(F.when(F.col("rank") == 2, F.col("model"))).alias("model_b"),
    )
    row = names.crossJoin(F.broadcast(stats)).first()
    out = []
    if row["model_b"] is not None and row["n"] > 1 and row["s"]:
        t = row["m"] / (row["s"] / math.sqrt(row["n"]))
        p = t_two_sided(t, row["n"] - 1)
        out.append((row["model_a"], row["model_b"], float(t), p, int(p < 0.05)))
    columns = ["model_a", "model_b", "t_statistic", "p_value", "significant"]
    spark = scores.sparkSession
    return values_frame(spark, out or [("", "", 0.0, 0.0, 0)], columns).where(F.lit(bool(out)))


def t_two_sided(t: float, df: int) -> float:
    """Two-sided tail of Student's t for whole degrees of freedom, by the finite trigonometric series."""
    angle = math.atan(abs(t) / math.sqrt(df))
    c, s = math.cos(angle), math.sin(angle)
    if df % 2:
        term, total = c, c if df > 1 else 0.0
        for k in range(3, df - 1, 2):
            term *= (k - 1) / k * c * c
            total += term
        inside = 2 / math.pi * (angle + s * total)
    else:
        term, total = 1.0, 1.0
        for k in range(2, df, 2):
            term *= (k - 1) / k * c * c
            total += term
        inside = s * total
    return max(0.0, 1.0 - inside)


def calibration(predictions: DataFrame, bins: int = 10) -> DataFrame:
    """Mean predicted probability and observed share per class and uniform probability bin; empty bins do not appear."""
    exploded = predictions.select("label", F.posexplode(vector_to_array("probability")).alias("class", "p"))
    slot: Column = F.least(F.floor(F.col("p") * bins), F.lit(bins - 1)).cast("int")
    return exploded.groupBy((F.col("class") + 1).alias("class"), slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("claim_count"),
        F.avg("p").alias("mean_predicted"),
        F.avg((F.col("label") == F.col("class")).cast("double")).alias("fraction_positive"),
    )


def fit_all(rows: DataFrame, models: dict[str, Callable[[int], Estimator]], fit_rows: int | None = None) -> tuple[dict[str, Model], DataFrame]:
    """All models, fitted side by side on all rows (on one draw of them if ``fit_rows`` is given), and all rows ready to be predicted."""
    chosen = features.bounded(rows, fit_rows)
    assembly = features.assembler().fit(chosen)
    chosen = features.with_class_weights(assembly.transform(chosen)).persist()
    try:
        size = chosen.count()
        with ThreadPool(len(models)) as pool:
            fitted = dict(zip(models, pool.map(lambda build: build(size).fit(chosen), models.values())))
    finally:
        chosen.unpersist()
    return fitted, assembly.transform(rows)


def calibrations(rows: DataFrame, models: dict[str, Callable[[int], Estimator]], bins: int = 10, fit_rows: int | None = None) -> DataFrame:
    """The calibration of every model, with its name."""
    fitted, ready = fit_all(rows, models, fit_rows)
    return union_all([calibration(model.transform(ready), bins).select(F.lit(name).alias("model"), "*") for name, model in fitted.items()])
