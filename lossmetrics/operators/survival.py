"""Survival of open claims: Kaplan-Meier curves with intervals, median survival and log-rank tests.

Durations are counted per day and group first. A curve then runs over at most one row per distinct day.
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.functions.columns import normal_quantile


def durations(claims: DataFrame, as_of: datetime.date = config.AS_OF) -> DataFrame:
    """Claims with ``duration`` and ``event``: closed claims end, all others are censored at ``as_of``."""
    closed = F.coalesce(F.lower(F.col("status")) == "closed", F.lit(False))
    age = F.datediff(F.lit(as_of), F.col("report_date"))
    out = claims.withColumns(
        {"event": closed.cast("int"), "duration": F.when(closed, F.col("days_to_close")).otherwise(age)}
    )
    return out.where(F.col("duration") > 0)


def risk_table(observed: DataFrame, group: str | None = None, min_rows: int = 5) -> DataFrame:
    """Per group and day: events, all leavers and the number at risk just before the day."""
    label = F.col(group) if group else F.lit("all")
    counts = (
        observed.select(label.alias("survival_group"), F.col("duration").alias("t"), "event")
        .where(F.col("survival_group").isNotNull())
        .groupBy("survival_group", "t")
        .agg(F.sum("event").alias("d"), F.count(F.lit(1)).alias("m"))
    )
    to_end = Window.partitionBy("survival_group").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("survival_group")
    table = counts.withColumn("n", F.sum("m").over(to_end)).withColumn("size", F.sum("m").over(whole))
    return table.where(F.col("size") >= min_rows).drop("size") if group else table.drop("size")


def _curve(table: DataFrame, level: float = 0.95) -> DataFrame:
    z = normal_quantile(1 - (1 - level) / 2)
    so_far = Window.partitionBy("survival_group").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("n") - F.col("d")
    ended = F.max((left == 0).cast("int")).over(so_far) == 1
    log_s = F.sum(F.when(left > 0, F.log(left / F.col("n"))).otherwise(0.0)).over(so_far)
    greenwood = F.sum(F.when(left > 0, F.col("d") / (F.col("n") * left)).otherwise(0.0)).over(so_far)
    steps = table.select(
        "survival_group",
        "t",
        "n",
        "d",
        F.when(ended, 0.0).otherwise(F.exp(log_s)).alias("s"),
        F.when(~ended, log_s).alias("v"),
        greenwood.alias("gw"),
    )

    def bound(sign: int) -> Column:
        inner = F.log(-F.col("v")) - F.lit(sign * z) * F.sqrt("gw") / F.col("v")
        return (
            F.when(F.col("v") < 0, F.exp(-F.exp(inner)))
            .when(F.col("v").isNotNull(), F.lit(1.0))
            .otherwise(F.lit(0.0))
        )

    return steps.select(
        "survival_group", "t", "n", "d", "s", bound(1).alias("ci_lower"), bound(-1).alias("ci_upper")
    )


def kaplan_meier(
    claims: DataFrame, group: str | None = None, as_of: datetime.date = config.AS_OF, level: float = 0.95
) -> DataFrame:
    """Survival curve with the log-log interval, starting at t = 0; the timeline holds censoring times too.

    The interval is 1 while nothing has closed and 0 once nobody is left.
    """
    curve = _curve(risk_table(durations(claims, as_of), group), level)
    first = F.lag("t").over(Window.partitionBy("survival_group").orderBy("t")).isNull()
    names = ["t", "at_risk", "events", "survival", "ci_lower", "ci_upper"]

    def entry(*columns: Column) -> Column:
        return F.struct(*[c.alias(name) for name, c in zip(names, columns)])

    one = F.lit(1.0)
    start = entry(F.lit(0), F.col("n"), F.lit(0).cast("long"), one, one, one)
    step = entry(F.col("t"), F.col("n"), F.col("d"), *[F.round(c, 8) for c in ("s", "ci_lower", "ci_upper")])
    opened = F.when(F.col("_first"), F.array(start, step)).otherwise(F.array(step))
    return curve.withColumn("_first", first).select("survival_group", F.inline(opened))


def median_survival(claims: DataFrame, group: str | None = None, as_of: datetime.date = config.AS_OF) -> DataFrame:
    """First time at which survival is at most one half, null if it never is."""
    curve = _curve(risk_table(durations(claims, as_of), group))
    return curve.groupBy("survival_group").agg(
        F.min(F.when(F.round("s", 12) <= 0.5, F.col("t"))).alias("median_survival_time")
    )


def log_rank(claims: DataFrame, group: str = "claim_type", as_of: datetime.date = config.AS_OF) -> DataFrame:
    """Log-rank statistic of every pair of groups.

    Each day row of a group goes to the pairs that contain it, and both sides' numbers at risk are running sums within
    the pair, so no two groups are ever crossed row by row. The rows are day counts, not claims.
    """
    table = risk_table(durations(claims, as_of), group).select("survival_group", "t", "d", "m")
    groups = table.agg(F.sort_array(F.collect_set("survival_group")).alias("groups"))  # one row, a name per group
    mine = F.col("survival_group")
    sided = (
        table.crossJoin(F.broadcast(groups))
        .withColumn("other", F.explode(F.array_except("groups", F.array(mine))))
        .select(
            F.least(mine, "other").alias("group_a"),
            F.greatest(mine, "other").alias("group_b"),
            "t",
            F.when(mine < F.col("other"), F.col("d")).otherwise(0).alias("da"),
            F.when(mine < F.col("other"), F.col("m")).otherwise(0).alias("ma"),
            "d",
            "m",
        )
    )
    pair = ["group_a", "group_b"]
    days = sided.groupBy(*pair, "t").agg(*[F.sum(c).alias(c) for c in ("da", "ma", "d", "m")])
    to_end = Window.partitionBy(*pair).orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, 0)
    risk = days.withColumn("na", F.sum("ma").over(to_end).cast("double")).withColumn(
        "n", F.sum("m").over(to_end).cast("double")
    )
    expected = F.col("d") * F.col("na") / F.col("n")
    spread = F.when(
        F.col("n") > 1,
        F.col("na") * (F.col("n") - F.col("na")) * F.col("d") * (F.col("n") - F.col("d"))
        / (F.col("n") * F.col("n") * (F.col("n") - 1)),
    ).otherwise(0.0)
    return (
        risk.groupBy(*pair)
        .agg((F.sum("da") - F.sum(expected)).alias("gap"), F.sum(spread).alias("var"))
        .select(*pair, F.try_divide(F.col("gap") * F.col("gap"), F.col("var")).alias("test_statistic"))
    )


def log_rank_p(claims: DataFrame, group: str = "claim_type", as_of: datetime.date = config.AS_OF) -> DataFrame:
    """Log-rank statistic with the chi-square (1) p-value of every pair."""
    return log_rank(claims, group, as_of).withColumn("p_value", chi2_tail(F.col("test_statistic"))).withColumn(
        "significant", F.col("p_value") < 0.05
    )


def chi2_tail(statistic: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom: erfc(z) at z = sqrt(x / 2), null for null.

    Below z * z = 3 from the series of erf with positive terms only, beyond it from the continued fraction of erfc; both
    are carried far enough that their rest is under the precision of a double.
    """
    square = F.greatest(statistic, F.lit(0.0)) / 2
    z = F.sqrt(square)
    weight = F.exp(-square) / F.lit(math.sqrt(math.pi))
    down = lambda n: F.sequence(F.lit(n), F.lit(1), F.lit(-1))
    series = F.aggregate(down(60), F.lit(1.0), lambda rest, k: F.lit(1.0) + rest * square * 2 / (k * 2 + 1))
    fraction = F.aggregate(down(80), z, lambda rest, k: z + k / 2 / rest)
    return F.when(statistic.isNotNull(), F.when(square < 3, 1 - weight * 2 * z * series).otherwise(weight / fraction))
