"""Simulated savings, bootstrap intervals and Wilson intervals.

Random numbers depend on the seed and the draw or row id, never on the partition, so results do not change with the
cluster layout.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.functions.columns import exact_sum, mean_amount, rows, wilson
from lossmetrics.functions.distributions import quantiles


def proportion_interval(claims: DataFrame, flag: str | Column, *keys: str, level: float = 0.95) -> DataFrame:
    """Wilson interval of a 0/1 flag, overall or per key."""
    counted = claims.groupBy(*keys).agg(F.coalesce(F.sum(flag), F.lit(0)).alias("successes"), rows().alias("trials"))
    parts = wilson(F.col("successes"), F.col("trials"), level)
    return counted.select(*keys, "successes", "trials", *[c.alias(name) for name, c in parts.items()])


def savings_baseline(claims: DataFrame, *keys: str) -> DataFrame:
    """The totals that a savings draw scales, per segment: one row each."""
    paid = F.coalesce("paid_amount", F.lit(0.0))
    litigated = F.coalesce("litigation_flag", F.lit(0))
    severity = F.col("severity_level")
    high = F.coalesce(mean_amount(F.when(severity >= 4, paid)), F.lit(0.0))
    medium = F.coalesce(mean_amount(F.when(severity.between(2, 3), paid)), F.lit(0.0))
    premium = mean_amount(F.when(litigated == 1, paid)) - mean_amount(F.when(litigated == 0, paid))
    return claims.groupBy(*keys).agg(
        F.greatest(
            F.coalesce(exact_sum("incurred_amount").cast("double"), F.lit(0.0)),
            F.coalesce(exact_sum("paid_amount").cast("double"), F.lit(0.0)),
            F.lit(1.0),
        ).alias("baseline"),
        F.count_if(severity >= 4).alias("n_high"),
        F.greatest(F.when(high == 0, 1.0).otherwise(high) - medium, F.lit(0.0)).alias("saving_per_high"),
        F.coalesce(F.sum(litigated), F.lit(0)).alias("n_litigated"),
        F.greatest(F.coalesce(premium, F.lit(0.0)), F.lit(0.0)).alias("litigation_premium"),
    )


def reduction_draws(
    claims: DataFrame, severity_pct: float, litigation_pct: float, close_pct: float, n_sim: int, seed: int
) -> DataFrame:
    """``n_sim`` rows of Beta-distributed reductions; draw i always gives the same numbers for a seed."""
    levers = [p / 100 for p in (severity_pct, litigation_pct, close_pct)]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = np.zeros((len(batch), 3))
            for row, draw_id in enumerate(batch["id"].to_numpy()):
                rng = np.random.default_rng([seed, int(draw_id)])
                for lever, p in enumerate(levers):
                    if p > 0:
                        out[row, lever] = rng.beta(max(10 * p, 1), max(10 * (1 - p), 1))
            yield pd.DataFrame({"draw": batch["id"], "r_sev": out[:, 0], "r_lit": out[:, 1], "r_close": out[:, 2]})

    return claims.sparkSession.range(n_sim).mapInPandas(draw, "draw long, r_sev double, r_lit double, r_close double")


def savings_draws(
    claims: DataFrame,
    *keys: str,
    severity_pct: float = 20,
    litigation_pct: float = 25,
    close_pct: float = 20,
    n_sim: int = 5000,
    seed: int = config.SEED,
) -> DataFrame:
    """Simulated saving per draw and segment: the draws (n_sim rows) are broadcast to the segment totals."""
    draws = reduction_draws(claims, severity_pct, litigation_pct, close_pct, n_sim, seed)
    saving = (
        F.floor(F.col("n_high") * F.col("r_sev")) * F.col("saving_per_high")
        + F.col("n_litigated") * F.col("r_lit") * F.col("litigation_premium")
        + F.col("baseline") * F.col("r_close") * 0.05
    )
    return savings_baseline(claims, *keys).crossJoin(F.broadcast(draws)).select(*keys, "draw", saving.alias("saving"))


def simulated_savings(claims: DataFrame, *keys: str, **options) -> DataFrame:
    """Mean, median, 5th / 95th percentile, chance of a saving and value at risk of the simulated savings."""
    q = F.percentile(F.col("saving"), F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    return (
        savings_draws(claims, *keys, **options)
        .groupBy(*keys)
        .agg(
            F.avg("saving").alias("mean_savings"),
            q.alias("q"),
            (F.avg((F.col("saving") > 0).cast("double")) * 100).alias("prob_positive"),
        )
        .select(
            *keys,
            "mean_savings",
            F.col("q")[1].alias("median_savings"),
            F.col("q")[0].alias("p5"),
            F.col("q")[2].alias("p95"),
            "prob_positive",
            F.col("q")[0].alias("var_95"),
        )
    )


# Poisson(1) by inverse transform of 16 random bits.
_POISSON_CDF = np.cumsum(np.exp(-1.0) / np.array([1, 1, 2, 6, 24, 120, 720, 5040, 40320], dtype=float))


def bootstrap_interval(
    claims: DataFrame, value: str, statistic: str = "mean", row_id: str = "claim_id", n_boot: int = 1000,
    level: float = 0.95, seed: int = config.SEED,
) -> DataFrame:
    """Percentile bootstrap interval of a sum or mean.

    Resampling rows would shuffle the table once per replicate. Each row instead gets a Poisson(1) weight per replicate,
    hashed from its id, and a task emits only the weighted count and sum of each replicate: one scan, no row shuffled.
    """
    if statistic not in ("sum", "mean"):
        raise ValueError("statistic is 'sum' or 'mean'")
    words = -(-n_boot // 4)
    table = np.searchsorted(_POISSON_CDF, (np.arange(65536) + 0.5) / 65536).astype(np.float32)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total, rows, plain = np.zeros(words * 4), np.zeros(words * 4), 0, 0.0
        salt = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            ids = batch["h"].to_numpy().view(np.uint64)
            x = batch["v"].to_numpy(dtype=float)
            rows, plain = rows + len(x), plain + float(x.sum())
            for at in range(0, len(ids), 1024):
                z = ids[at : at + 1024, None] + salt[None, :]
                z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                z = z ^ (z >> np.uint64(31))
                w = table[np.ascontiguousarray(z).view(np.uint16)].astype(float)
                count += w.sum(axis=0)
                total += x[at : at + 1024] @ w
        # Replicate -1 carries the plain count and sum, so the table is read once.
        yield pd.DataFrame(
            {
                "replicate": np.arange(-1, n_boot),
                "w": np.concatenate([[rows], count[:n_boot]]),
                "wx": np.concatenate([[plain], total[:n_boot]]),
            }
        )

    known = claims.select(F.xxhash64(F.lit(seed), row_id).alias("h"), F.col(value).cast("double").alias("v")).where(
        F.col("v").isNotNull()
    )
    replicates = (
        known.mapInPandas(weigh, "replicate int, w double, wx double")
        .groupBy("replicate")
        .agg(F.sum("w").alias("w"), F.sum("wx").alias("wx"))
    )
    one = F.try_divide(F.col("wx"), F.col("w"))
    plain = F.col("replicate") == -1
    edge = (1 - level) / 2
    # A replicate's weights sum to about the row count; its mean scaled to the row count is the resampled sum.
    scale = F.lit(1.0) if statistic == "mean" else F.col("rows")
    return (
        replicates.groupBy()
        .agg(
            F.percentile(F.when(~plain, one), F.array(F.lit(edge), F.lit(1 - edge))).alias("q"),
            F.max(F.when(plain, F.col("w"))).alias("rows"),
            F.max(F.when(plain, one)).alias("mean"),
        )
        .select(
            F.coalesce(F.col("mean") * scale, F.lit(0.0)).alias("estimate"),
            F.coalesce(F.col("q")[0] * scale, F.lit(0.0)).alias("ci_lower"),
            F.coalesce(F.col("q")[1] * scale, F.lit(0.0)).alias("ci_upper"),
            F.coalesce((F.col("q")[1] - F.col("q")[0]) / 2 * scale, F.lit(0.0)).alias("margin_of_error"),
        )
    )


#: Distinct values whose counts every task of a bootstrap may hold.
MAX_VALUES = 1 << 21
#: Standard deviations of a resampled rank that a percentile's window spans to either side.
RANK_SPREAD = 9.0

#: A statistic of ascending values and of how often each occurs.
Statistic = Callable[[np.ndarray, np.ndarray], float]


def weighted_percentile(p: float) -> Statistic:
    """The interpolated percentile of values that occur ``weights`` times each; nan without any."""

    def at(values: np.ndarray, weights: np.ndarray) -> float:
        upto = np.cumsum(weights)
        if not len(upto) or upto[-1] == 0:
            return float("nan")
        place = p * (upto[-1] - 1)
        low, high = (values[np.searchsorted(upto, k, side="right")] for k in (math.floor(place), math.ceil(place)))
        return float(low if low == high else low + (high - low) * (place - math.floor(place)))

    return at


def _replicated(spark: SparkSession, values: np.ndarray, counts: np.ndarray, statistic: Statistic, n_boot: int, seed: int) -> DataFrame:
    """(replicate, statistic): a value that occurs n times gets a Poisson(n) weight in every replicate, as n rows with weights of Poisson(1) would."""
    sent = spark.sparkContext.broadcast((values, counts))  # at most MAX_VALUES

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        values, counts = sent.value
        for batch in batches:
            found = [statistic(values, np.random.Generator(np.random.Philox(key=[seed, int(k)])).poisson(counts)) for k in batch["id"]]
            yield pd.DataFrame({"replicate": batch["id"], "statistic": np.array(found, float)})

    tasks = max(1, min(n_boot, spark.sparkContext.defaultParallelism))
    return spark.range(0, n_boot, 1, tasks).mapInPandas(draw, "replicate long, statistic double")


def _interval(replicates: DataFrame, estimate: float, level: float) -> DataFrame:
    edge = (1 - level) / 2
    known = F.when(~F.isnan("statistic"), F.col("statistic"))
    q = replicates.agg(F.percentile(known, F.array(F.lit(edge), F.lit(1 - edge))).alias("q"))
    whole = None if math.isnan(estimate) else estimate
    return q.select(
        F.lit(whole).cast("double").alias("estimate"), F.col("q")[0].alias("ci_lower"), F.col("q")[1].alias("ci_upper"),
        ((F.col("q")[1] - F.col("q")[0]) / 2).alias("margin_of_error"),
    )


def _counted(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ascending values and their counts; an error beyond ``MAX_VALUES``."""
    found = rows.groupBy("v").agg(F.count(F.lit(1)).alias("n")).limit(MAX_VALUES + 1).toPandas().sort_values("v")
    if len(found) > MAX_VALUES:
        raise ValueError(f"more than {MAX_VALUES} distinct values: use a percentile, a sum or a mean, or round the values")
    return found["v"].to_numpy(float), found["n"].to_numpy(np.int64)


def bootstrap_statistic(
    claims: DataFrame, value: str, statistic: Statistic, n_boot: int = 1000, level: float = 0.95, seed: int = config.SEED
) -> DataFrame:
    """Percentile bootstrap interval of any statistic of a column, given as a function of ascending values and counts.

    Rows are counted by value, so the table is read once and a value that many rows share costs as much as any other. Null
    values are left out; without values all results are null.
    """
    rows = claims.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    values, counts = _counted(rows)
    estimate = statistic(values, counts) if len(values) else float("nan")
    if not len(values):
        n_boot = 0
    return _interval(_replicated(claims.sparkSession, values, counts, statistic, n_boot, seed), estimate, level)


def bootstrap_percentile(
    claims: DataFrame, value: str, p: float = 0.5, n_boot: int = 1000, level: float = 0.95, seed: int = config.SEED
) -> DataFrame:
    """Percentile bootstrap interval of a percentile, at any number of distinct values.

    In a resample of N rows the wanted rank moves by about sqrt(N p (1 - p)). Values farther away than ``RANK_SPREAD`` times that
    only matter by how many they are: those below and those above are one value each, and what lies between, about
    the square root of the rows, is counted by value. The window's edges are exact quantiles.
    """
    if not 0 <= p <= 1:
        raise ValueError("p lies between 0 and 1")
    rows = claims.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    total = rows.count()
    spread = (RANK_SPREAD * math.sqrt(total * p * (1 - p)) + RANK_SPREAD**2) / max(total, 1)
    statistic = weighted_percentile(p)
    if spread > 0.25:
        return bootstrap_statistic(claims, value, statistic, n_boot, level, seed)
    edges = quantiles(rows, "v", {"low": max(0.0, p - spread), "high": min(1.0, p + spread)}).first()
    outside = F.when(F.col("v") < edges["low"], float("-inf")).when(F.col("v") > edges["high"], float("inf"))
    values, counts = _counted(rows.select(F.coalesce(outside, F.col("v")).alias("v")))
    return _interval(_replicated(claims.sparkSession, values, counts, statistic, n_boot, seed), statistic(values, counts), level)
