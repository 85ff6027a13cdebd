"""Forests: every split against all splits tried one by one, draws and layout of the rows, and columns of several features."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from lossmetrics.ml import boosting, bundles, forest

BINS = np.array([2, 2, 2, 6, 5, 1])


def rows_of(n, seed=4):
    rng = np.random.default_rng(seed)
    group, free = rng.integers(0, 3, n), rng.integers(0, 2, n)
    codes = np.column_stack([group == 1, group == 2, free, rng.integers(0, 6, n), rng.integers(0, 5, n), np.zeros(n)]).astype(np.uint8)
    y = np.clip(group + codes[:, 3] // 2 + rng.integers(-1, 2, n), 0, 2).astype(np.uint8)
    return codes, y


def frame(spark, codes, y, parts):
    rows = [(f"C{n}", float(b), [float(v) for v in a], 2.0 if b == 1 else 0.5) for n, (a, b) in enumerate(zip(codes, y))]
    df = spark.createDataFrame(rows, "claim_id string, label double, x array<double>, weight double").repartition(parts)
    return df.withColumn("features", array_to_vector("x"))


def packed(codes):
    return bundles.found(bundles.together(codes, BINS), BINS)


def grown(codes, y, times, own, balance, depth=4, held=None, tried=6):
    growing = forest._Growing(own, BINS, balance, tried, 3, 8, forest._key(42, 1, 2))
    return forest.grow(own.pack(codes), y, times, np.zeros(len(y), np.int32) if held is None else held, growing, depth)


def test_columns_hold_features_that_never_meet():
    codes, _ = rows_of(500)
    own = packed(codes)
    assert own.column[0] == own.column[1] and len(own.widths) < len(BINS) and own.widths.max() <= bundles.CODES
    out = own.pack(codes)
    for feature, k in enumerate(own.column):
        assert np.array_equal(own.bins[feature][out[:, k]], codes[:, feature])
    sums = np.concatenate([np.bincount(out[:, k], minlength=width) for k, width in enumerate(own.widths)])
    direct = np.concatenate([np.bincount(codes[:, f], minlength=BINS[f]) for f in range(len(BINS))])
    assert np.array_equal(own.by_feature(sums, BINS), direct)
    codes[7, :2] = 1  # one row that has both
    met = packed(codes)
    for feature, k in enumerate(met.column):
        assert np.array_equal(met.bins[feature][met.pack(codes)[:, k]], codes[:, feature])


def test_every_split_is_the_best_one():
    codes, y = rows_of(400)
    times, balance = np.random.default_rng(1).integers(0, 4, 400).astype(np.uint8), np.array([1.0, 2.0, 0.5])
    tree = grown(codes, y, times, packed(codes), balance)
    counts = lambda rows: np.bincount(y[rows], times[rows], 3)
    score = lambda rows: ((counts(rows) * balance) ** 2).sum() / max((counts(rows) * balance).sum(), 1e-300)

    def gains(rows):
        for f in range(len(BINS)):
            for cut in range(BINS[f]):
                left, right = rows[codes[rows, f] <= cut], rows[codes[rows, f] > cut]
                if min(times[left].sum(), times[right].sum()) >= 3:
                    yield score(left) + score(right) - score(rows)

    def check(node, rows, level):
        best = max(gains(rows), default=0.0)
        f = tree.feature[node]
        if f < 0:
            assert level == 4 or times[rows].sum() < 8 or (counts(rows) > 0).sum() == 1 or best < 1e-6
            assert np.allclose(tree.shares[tree.leaf[node]], counts(rows) * balance / (counts(rows) * balance).sum(), atol=1e-6)
            return 0.0
        left, right = rows[codes[rows, f] <= tree.cut[node]], rows[codes[rows, f] > tree.cut[node]]
        gain = score(left) + score(right) - score(rows)
        assert gain == pytest.approx(best) and gain > 0
        return gain + check(tree.left[node], left, level + 1) + check(tree.left[node] + 1, right, level + 1)

    assert check(0, np.flatnonzero(times), 0) == pytest.approx(tree.gains.sum()) and len(tree.feature) > 9


def test_chunks_and_files_do_not_change_a_tree(monkeypatch):
    codes, y = rows_of(900)
    times, balance, own = np.random.default_rng(2).integers(0, 3, 900).astype(np.uint8), np.ones(3), packed(codes)
    whole = grown(codes, y, times, own, balance, tried=3)
    for name, value in (("HELD_ROWS", 10), ("CHUNK_ROWS", 64), ("CELLS", 7)):
        monkeypatch.setattr(forest, name, value)
    held = forest._Held(900)
    for start in (0, 300, 600):
        held.add(codes[start : start + 300], y[start : start + 300], times[start : start + 300])
    from_files = [np.asarray(c) for c in held.columns()]
    assert held.many and all(np.array_equal(a, b) for a, b in zip(from_files, (codes, y, times)))
    small = grown(*from_files, own, balance, tried=3)
    assert all(np.array_equal(getattr(whole, k), getattr(small, k)) for k in ("feature", "cut", "left", "leaf", "shares"))


def test_draws_are_those_of_a_resample():
    times = forest.draws(np.arange(100_000), forest._key(42, 3, 1))
    shares = np.bincount(times, minlength=4)[:4] / len(times)
    assert np.allclose(shares, [0.3679, 0.3679, 0.1839, 0.0613], atol=0.006) and abs(times.mean() - 1) < 0.01
    assert not np.array_equal(times, forest.draws(np.arange(100_000), forest._key(42, 4, 1)))


def test_forest_does_not_depend_on_the_deal(spark, monkeypatch):
    codes, y = rows_of(3000)
    one = forest.Forest(trees=3, depth=6, classes=3).fit(frame(spark, codes, y, 1))
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    many = forest.Forest(trees=3, depth=6, classes=3).fit(frame(spark, codes, y, 9))
    for a, b in zip(one.trees, many.trees, strict=True):
        assert all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("feature", "cut", "left", "leaf", "shares"))
    out = one.transform(frame(spark, codes, y, 2)).select("label", "prediction", "probability").collect()
    hits = lambda k: np.mean([r["prediction"] == k for r in out if r["label"] == k])
    assert hits(1) > 0.7 and hits(0) + hits(1) + hits(2) > 1.5  # the second class weighs four times as much
    assert all(sum(r["probability"]) == pytest.approx(1, abs=1e-5) for r in out)
    assert one.importances().sum() == pytest.approx(1) and one.importances()[5] == 0
    with pytest.raises(ValueError):
        forest.Forest(trees=2, classes=3).fit(frame(spark, codes, y, 2).limit(0))
