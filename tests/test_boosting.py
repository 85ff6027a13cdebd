"""Boosted trees against a fit in plain numpy, and the bounded draw of training rows."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lossmetrics.ml import boosting, features


def rows_of(n, seed=4):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 2, n), rng.normal(size=n), rng.integers(0, 6, n), np.ones(n)]).astype(float)
    y = np.clip((x[:, 0] * 2 + x[:, 1] + x[:, 2] / 3 + rng.normal(size=n) / 2).astype(int), 0, 2)
    return x, y


def frame(spark, x, y, parts):
    rows = [(float(b), [float(v) for v in a]) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "label double, x array<double>").repartition(parts)
    return df.withColumn("features", array_to_vector("x"))


def plain_edges(x):
    out = np.full((x.shape[1], boosting.BINS - 1), np.inf)
    for k in range(x.shape[1]):
        grid = np.quantile(x[:, k], np.linspace(0, 1, boosting.BINS + 1), method="inverted_cdf")
        cuts = np.unique([x[:, k].min(), *grid, x[:, k].max()])
        if len(cuts) > boosting.BINS:
            cuts = cuts[np.unique(np.linspace(0, len(cuts) - 1, boosting.BINS).astype(int))]
        out[k, : len(cuts) - 1] = (cuts[1:] + cuts[:-1]) / 2
    return out


def plain_tree(codes, g, h, depth, least, enough, rate):
    """Leaf value of every row, nodes split one by one by trying every feature and bin."""
    value = np.zeros(len(codes))

    def grow(own, level):
        value[own] = -rate * (g[own].sum() / boosting.UNIT) / (h[own].sum() / boosting.UNIT + 1e-9)
        if level == depth or len(own) < enough:
            return
        best = (1e-9, None)
        score = lambda r: (g[r].sum() / boosting.UNIT) ** 2 / (h[r].sum() / boosting.UNIT + 1e-9)
        for f in range(codes.shape[1]):
            for b in range(boosting.BINS):
                left, right = own[codes[own, f] <= b], own[codes[own, f] > b]
                if len(left) >= least and len(right) >= least:
                    gain = score(left) + score(right) - score(own)
                    if gain > best[0] + 1e-12:
                        best = (gain, (left, right))
        if best[1] is not None:
            grow(best[1][0], level + 1)
            grow(best[1][1], level + 1)

    grow(np.arange(len(codes)), 0)
    return value


@pytest.mark.parametrize("parts", [1, 7])
def test_boosting_equals_numpy(spark, monkeypatch, parts):
    monkeypatch.setattr(boosting, "ROUNDS_KEPT", 2)
    x, y = rows_of(500)
    model = boosting.Boosted(rounds=5, depth=3, rate=0.3, least=3, enough=8, classes=3).fit(frame(spark, x, y, parts))
    edges = plain_edges(x)
    assert np.array_equal(model.edges, edges)
    codes = np.stack([np.searchsorted(edges[k], x[:, k]) for k in range(x.shape[1])], axis=1)
    raw = np.tile(np.log(np.bincount(y, minlength=3) / len(y)), (len(y), 1))
    for _ in range(5):
        p = np.exp(raw - raw.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        unit = lambda v: np.rint(v * boosting.UNIT)
        raw += np.column_stack([plain_tree(codes, unit(p[:, k] - (y == k)), unit(p[:, k] * (1 - p[:, k])), 3, 3, 8, 0.3) for k in range(3)])
    chance = np.exp(raw - raw.max(axis=1, keepdims=True))
    assert np.allclose(model.probabilities(x), chance / chance.sum(axis=1, keepdims=True), atol=1e-9)
    assert (model.probabilities(x).argmax(axis=1) == y).mean() > 0.8


def test_model_does_not_depend_on_the_deal(spark, monkeypatch):
    x, y = rows_of(3000)
    one = boosting.Boosted(rounds=4, depth=4, classes=3).fit(frame(spark, x, y, 1))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "BLOCKS", 3)  # sums are added up in the tasks
    many = boosting.Boosted(rounds=4, depth=4, classes=3).fit(frame(spark, x, y, 9))
    for a, b in zip(one.trees, many.trees):
        assert a[0] == b[0] and all(np.array_equal(u, v) for u, v in zip(a[1:], b[1:]))


def test_constant_features_missing_classes_and_no_rows(spark):
    x = np.ones((60, 2))
    y = np.array([0, 1] * 30)
    model = boosting.Boosted(rounds=2, depth=2, classes=4).fit(frame(spark, x, y, 2))
    assert all((tree[1] < 0).all() for tree in model.trees)
    assert np.allclose(model.probabilities(x)[:, :2], 0.5, atol=1e-4)
    out = model.transform(frame(spark, x, y, 2)).select("prediction").distinct().collect()
    assert {r[0] for r in out} <= {0.0, 1.0}
    with pytest.raises(ValueError):
        boosting.Boosted(classes=2).fit(frame(spark, x, y, 2).limit(0))


def test_bounded_draw_keeps_shares_and_every_class(spark):
    df = spark.range(50_000).select(F.concat(F.lit("C"), "id").alias("claim_id"), F.when(F.col("id") % 1000 == 0, 5).otherwise(F.col("id") % 3).cast("int").alias("severity_level"))
    drawn = features.bounded(df, 3000)
    counts = {r["severity_level"]: r["count"] for r in drawn.groupBy("severity_level").count().collect()}
    assert set(counts) == {0, 1, 2, 5}
    assert all(abs(counts[k] - 1000) < 30 for k in (0, 1, 2)) and 3 <= counts[5] <= 6
    again = features.bounded(df.repartition(5), 3000)
    assert {r[0] for r in drawn.select("claim_id").collect()} == {r[0] for r in again.select("claim_id").collect()}
    assert drawn.rdd.getNumPartitions() == 3
    assert features.bounded(df, None) is df
    assert features.bounded(df, 10**6).count() == 50_000
    assert features.bounded(df.limit(0), 100).count() == 0


def test_rows_of_one_block_are_boosted_in_one_job(spark, monkeypatch):
    x, y = rows_of(800)
    df = frame(spark, x, y, 4).persist()
    df.count()
    spark.sparkContext.setJobGroup("one-block", "boosting")
    one = boosting.Boosted(rounds=12, depth=3, classes=3).fit(df)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-block"))
    spark.sparkContext.setJobGroup("many-blocks", "boosting")
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    many = boosting.Boosted(rounds=12, depth=3, classes=3).fit(df)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    df.unpersist()
    assert jobs < 12  # borders, label counts and the fit, whatever the rounds
    for a, b in zip(one.trees, many.trees, strict=True):
        assert a[0] == b[0] and all(np.array_equal(u, v) for u, v in zip(a[1:], b[1:]))


def test_walk_ends_in_the_leaf_of_every_row():
    x, y = rows_of(300)
    codes = boosting._codes(x, plain_edges(x))
    rng = np.random.default_rng(1)
    feature = np.r_[-1, 0, 1, 2, -1, 1, 2, np.full(9, -1)]
    tree = (1, feature, rng.integers(0, 5, 16), rng.normal(size=16))

    def leaf(row, node=1):
        return node if feature[node] < 0 else leaf(row, 2 * node + int(row[feature[node]] > tree[2][node]))

    assert boosting._walk(codes, tree).tolist() == [leaf(row) for row in codes]
