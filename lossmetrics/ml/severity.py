"""Severity classifiers: random forest, multinomial logistic regression (Spark ML) and boosted trees."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, SparkSession

from lossmetrics import config
from lossmetrics.ml import evaluate, features
from lossmetrics.ml.boosting import Boosted
from lossmetrics.ml.forest import Forest
from lossmetrics.sources.lookups import values_frame

MIN_CLAIMS = 50
FOREST, LOGISTIC, BOOSTED = "Random Forest", "Logistic Regression", "Gradient Boosting"


def forest(trees: int = 200, depth: int = 15, seed: int = config.SEED) -> Forest:
    return Forest(trees, depth, seed)


def logistic(rows: int, iterations: int = 1000) -> Estimator:
    """Ridge-penalised multinomial regression; the penalty is spread over the training rows."""
    return LogisticRegression(
        family="multinomial", maxIter=iterations, regParam=1.0 / max(rows, 1), weightCol="weight", standardization=False
    )


def boosted(rounds: int = 150, depth: int = 5, rate: float = 0.1) -> Boosted:
    return Boosted(rounds, depth, rate)


@dataclasses.dataclass
class SeverityModels:
    models: dict[str, Model]
    predictions: dict[str, DataFrame]
    feature_names: list[str]
    test_rows: DataFrame

    def report(self, name: str) -> DataFrame:
        return evaluate.classification_report(self.predictions[name])

    def confusion(self, name: str) -> DataFrame:
        return evaluate.confusion(self.predictions[name])

    def importances(self) -> DataFrame:
        return importances(self.test_rows.sparkSession, self.models[FOREST], self.feature_names)


def feature_names(assembled: DataFrame) -> list[str]:
    attributes = assembled.schema["raw_features"].metadata["ml_attr"]["attrs"]
    found = [a for kind in attributes.values() for a in kind]
    return [a["name"] for a in sorted(found, key=lambda a: a["idx"])]


def importances(spark: SparkSession, model: Model, names: list[str]) -> DataFrame:
    """Features by descending importance; one row per feature."""
    values = [(name, float(v)) for name, v in zip(names, model.importances())]
    return values_frame(spark, values, ["feature", "importance"]).orderBy("importance", ascending=False)


def prepare(claims: DataFrame) -> DataFrame:
    """Assembled, labelled rows of the valid claims; an error if there are too few to train on."""
    valid = features.valid_claims(claims)
    found = valid.limit(MIN_CLAIMS).count()
    if found < MIN_CLAIMS:
        raise ValueError(f"Only {found} valid closed claims with severity 1-5; at least {MIN_CLAIMS} are needed")
    return features.labelled(features.feature_table(valid))


def builders(
    trees: int = 200, depth: int = 15, iterations: int = 1000, rounds: int = 150, boosted_depth: int = 5, seed: int = config.SEED
) -> dict[str, Callable[[int], Estimator]]:
    """The three models, each built from the number of its training rows."""
    return {
        FOREST: lambda rows: forest(trees, depth, seed),
        LOGISTIC: lambda rows: logistic(rows, iterations),
        BOOSTED: lambda rows: boosted(rounds, boosted_depth),
    }


def train(
    claims: DataFrame,
    models: dict[str, Callable[[int], Estimator]] | None = None,
    test_size: float = 0.2,
    fit_rows: int | None = None,
    seed: int = config.SEED,
) -> SeverityModels:
    """Fit the models on all rows of a stratified train split and predict the whole test split.

    Only a caller's ``fit_rows`` bounds the labelled rows of a fit, by a stratified draw by a hash of the claim id. Rounds, trees
    and depths are never reduced, and every test row is predicted.
    """
    train_rows, test_rows = features.split(prepare(claims), test_size, seed)
    train_rows = features.bounded(train_rows, fit_rows, seed)
    assembly = features.assembler().fit(train_rows)
    train_rows = features.with_class_weights(assembly.transform(train_rows)).persist()
    test_rows = assembly.transform(test_rows)
    try:
        size = train_rows.count()
        wanted = models or builders(seed=seed)
        with ThreadPool(len(wanted)) as pool:  # the fits are many small jobs, so they run side by side
            fitted = dict(zip(wanted, pool.map(lambda build: build(size).fit(train_rows), wanted.values())))
        names = feature_names(train_rows)
    finally:
        train_rows.unpersist()
    predictions = {name: model.transform(test_rows) for name, model in fitted.items()}
    return SeverityModels(fitted, predictions, names, test_rows)
