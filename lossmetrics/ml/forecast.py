"""Monthly series and their exponential-smoothing forecasts, for one series or many.

Claims become one row per (series, month) in a single aggregate. A series is as long as the calendar, so fitting one is a
small task whatever the number of claims, and Spark spreads the series.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics import config

SEASON = 12
MIN_SEASONAL = 24
# The published normal quantiles of the 80 % and 95 % bands.
BANDS = {"80": 1.2816, "95": 1.96}


def monthly_series(claims: DataFrame, *keys: str) -> DataFrame:
    """Claims per month and series, with 0 for the months without claims between a series' first and last."""
    key = F.concat_ws("|", *keys) if keys else F.lit("all")
    dated = claims.where(F.col("incident_date").isNotNull())
    counts = dated.groupBy(key.alias("series_key"), F.trunc("incident_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spans = counts.groupBy("series_key").agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    grid = spans.select("series_key", F.explode(F.expr("sequence(lo, hi, interval 1 month)")).alias("month"))
    return grid.join(counts, ["series_key", "month"], "left").select(
        "series_key", "month", F.coalesce("n", F.lit(0)).alias("y")
    )


FIT_SCHEMA = (
    "series_key string, month date, horizon int, forecast double, resid_std double, sse double, method string, "
    "alpha double, beta double, gamma double, aic double"
)


def _smoother():
    """Fit functions, closed over as one object so that tasks need nothing but numpy."""

    def starts(y, season):
        """Start level, trend and cycle taken from the first two seasons (the first value without a season)."""
        if not season:
            return np.array([y[0], 0.0])
        first = y[:season].mean()
        return np.concatenate([[first, (y[season : 2 * season].mean() - first) / season], y[:season] - first])

    def run(y, season, params, states):
        """One-step errors and end states of the additive recursion, for every parameter set and every column of start states.

        ``y`` has one column per column of ``states`` (level, trend, cycle); errors are (parameter set, month, column).
        """
        alpha, beta, gamma = (p[:, None] for p in params.T)
        level, trend = (np.tile(states[k], (len(params), 1)) for k in (0, 1))
        cycle = [np.tile(states[2 + k], (len(params), 1)) for k in range(season)]
        errors = np.empty((len(params), *y.shape))
        for t, value in enumerate(y):
            seasonal = cycle[t % season] if season else 0.0
            drifted = level + trend
            errors[:, t] = value - drifted - seasonal
            moved = alpha * (value - seasonal) + (1 - alpha) * drifted
            if season:
                cycle[t % season] = gamma * (value - drifted) + (1 - gamma) * seasonal
                trend = beta * (moved - level) + (1 - beta) * trend
            level = moved
        return errors, level, trend, cycle

    def estimated(y, season, params):
        """Least-squares start states of every parameter set with their errors.

        The recursion is linear, so the errors of start states s + d are those of s plus the effect of d on a series of
        zeros; the smallest d that minimises the squares is taken. Where rounding leaves more than d = 0, d = 0 stays.
        """
        base = starts(y, season)
        free = len(base) if season else 1  # simple smoothing has no trend
        units = np.zeros((len(base), 1 + free))
        units[:, 0] = base
        units[:free, 1:] = np.eye(free)
        columns = np.zeros((len(y), 1 + free))
        columns[:, 0] = y
        effects = run(columns, season, params, units)[0]
        errors, slopes = effects[:, :, 0], effects[:, :, 1:]
        moves = -(np.linalg.pinv(slopes, rcond=1e-10) @ errors[:, :, None])[:, :, 0]
        solved = errors + (slopes @ moves[:, :, None])[:, :, 0]
        better = (solved**2).sum(axis=1) <= (errors**2).sum(axis=1)
        states = np.tile(base, (len(params), 1))
        states[:, :free] += np.where(better[:, None], moves, 0.0)
        return np.where(better[:, None], solved, errors), states

    def search(y, season):
        """Coarse grid, then a shrinking neighbourhood around the best point; beta <= alpha and gamma <= 1 - alpha."""
        coarse = np.linspace(0.05, 0.95, 7)
        axes = [coarse, coarse if season else np.zeros(1), coarse if season else np.zeros(1)]
        width, best, least = 0.15, None, np.inf
        for _ in range(6):
            grid = np.stack([g.ravel() for g in np.meshgrid(*axes, indexing="ij")], axis=1)
            if season:
                grid = grid[(grid[:, 1] <= grid[:, 0]) & (grid[:, 2] <= 1 - grid[:, 0])]
            errors, states = estimated(y, season, grid)
            sse = (errors**2).sum(axis=1)
            k = int(np.argmin(sse))
            if sse[k] < least:
                best, least = (grid[k], states[k]), sse[k]
            near = np.linspace(-width, width, 5)
            axes = [np.clip(best[0][i] + near, 1e-4, 0.9999) if season or i == 0 else np.zeros(1) for i in range(3)]
            width /= 2.5
        return best

    def fit(y, periods):
        season = SEASON if len(y) >= MIN_SEASONAL else 0
        best, states = search(y, season)
        errors, level, trend, cycle = run(y[:, None], season, best[None, :], states[:, None])
        steps = np.arange(1, periods + 1)
        ahead = level[0, 0] + steps * trend[0, 0]
        if season:
            ahead = ahead + np.array([c[0, 0] for c in cycle])[(len(y) + steps - 1) % season]
        resid = errors[0, :, 0]
        sse = max(float((resid**2).sum()), 1e-12)
        free = 2 + 2 + 1 + season if season else 2
        aic = len(y) * np.log(sse / len(y)) + 2 * free
        return {
            "forecast": ahead,
            "resid_std": float(resid.std(ddof=1)) if len(resid) > 1 else 0.0,
            "sse": float((resid**2).sum()),
            "method": "holt_winters" if season else "simple_exponential_smoothing",
            "alpha": float(best[0]),
            "beta": float(best[1]) if season else None,
            "gamma": float(best[2]) if season else None,
            "aic": float(aic),
        }

    return fit


def fit_series(series: DataFrame, periods: int = config.FORECAST_PERIODS) -> DataFrame:
    """Additive Holt-Winters (period 12) from 24 months on, simple smoothing below, ``periods`` months ahead.

    Start states are estimated together with the smoothing parameters. Series are fitted side by side, one group per series.
    """
    fit = _smoother()

    def forecast(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("month")
        result = fit(frame["y"].to_numpy(dtype=float), periods)
        start = pd.Timestamp(frame["month"].iloc[-1])
        months = [(start + pd.DateOffset(months=h)).date() for h in range(1, periods + 1)]
        return pd.DataFrame(
            {
                "series_key": frame["series_key"].iloc[0],
                "month": months,
                "horizon": range(1, periods + 1),
                **result,
            }
        )

    return series.groupBy("series_key").applyInPandas(forecast, FIT_SCHEMA)


def with_bands(fitted: DataFrame) -> DataFrame:
    """80 % and 95 % bands that widen with the square root of the horizon; the lower edge is at least 0."""

    def margin(z: float) -> Column:
        return F.lit(z) * F.col("resid_std") * F.sqrt("horizon")

    out = fitted
    for name, z in BANDS.items():
        out = out.withColumns(
            {
                f"lower_{name}": F.greatest(F.col("forecast") - margin(z), F.lit(0.0)),
                f"upper_{name}": F.col("forecast") + margin(z),
            }
        )
    return out


def forecast(claims: DataFrame, *keys: str, periods: int = config.FORECAST_PERIODS) -> DataFrame:
    return with_bands(fit_series(monthly_series(claims, *keys), periods))


def seasonal_naive(series: DataFrame, periods: int = SEASON) -> DataFrame:
    """The reference forecast: every coming month repeats the same month one year earlier; up to 12 months ahead.

    ``resid_std`` is the deviation of the year-on-year changes, null for series with fewer than two of them.
    """
    own = Window.partitionBy("series_key").orderBy("month")  # one row per month
    to_end = Window.partitionBy("series_key")
    change = F.col("y") - F.lag("y", SEASON).over(own)
    placed = series.withColumns({"change": change.cast("double"), "last": F.max("month").over(to_end)})
    spread = placed.withColumn("resid_std", F.stddev_samp("change").over(to_end))
    ahead = F.months_between(F.add_months("month", SEASON), F.col("last")).cast("int")
    return spread.select(
        "series_key", F.add_months("month", SEASON).alias("month"), ahead.alias("horizon"), F.col("y").cast("double").alias("forecast"), "resid_std"
    ).where(F.col("horizon").between(1, min(periods, SEASON)))


def backtest_rows(claims: DataFrame, *keys: str, holdout: int = 6, model: Callable[[DataFrame, int], DataFrame] = fit_series) -> DataFrame:
    """Actual and forecast of the last months, from a fit on the months before; series under 12 months are left out."""
    series = monthly_series(claims, *keys)
    own = Window.partitionBy("series_key")  # one row per month
    placed = series.withColumn("left", F.row_number().over(own.orderBy(F.desc("month")))).withColumn(
        "size", F.count(F.lit(1)).over(own)
    )
    usable = placed.where(F.col("size") >= holdout + 6)
    fitted = model(usable.where(F.col("left") > holdout).select("series_key", "month", "y"), holdout)
    actual = usable.where(F.col("left") <= holdout).select("series_key", "month", F.col("y").cast("double").alias("actual"))
    return fitted.select("series_key", "month", "forecast").join(actual, ["series_key", "month"])


def backtest_metrics(rows: DataFrame) -> DataFrame:
    """MAPE over non-zero actuals, RMSE and MAE per series."""
    gap = F.col("actual") - F.col("forecast")
    return rows.groupBy("series_key").agg(
        (F.avg(F.when(F.col("actual") != 0, F.abs(gap / F.col("actual")))) * 100).alias("mape"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
    )
