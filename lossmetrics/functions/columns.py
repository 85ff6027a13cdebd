"""Column expressions used across the operators. All stay inside whole-stage codegen."""

from __future__ import annotations

from decimal import Decimal
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("long")


def exact_sum(c: str | Column) -> Column:
    """Sum of an amount to six decimals as a decimal, the same under any partitioning.

    A sum of doubles changes with the order of the shuffle, which shows as soon as it is rounded. Whole units and
    millionths are summed as two long integers, which stay in generated code, and joined once per group.
    """
    c = col(c)
    whole = F.sum(F.floor(c).try_cast("bigint"))
    millionths = F.sum(F.round((c - F.floor(c)) * 1e6).try_cast("bigint"))
    return whole.cast("decimal(30,6)") + millionths.cast("decimal(22,0)") * F.lit(Decimal("0.000001"))


def total(c: str | Column, digits: int = 2) -> Column:
    """Rounded exact sum of an amount; null amounts add nothing."""
    return F.round(exact_sum(c), digits).cast("double")


def mean_amount(c: str | Column) -> Column:
    return F.try_divide(exact_sum(c).cast("double"), F.count(col(c)))


def mean_paid(c: str | Column, digits: int = 2) -> Column:
    """Rounded mean of an amount, from its exact sum."""
    return F.round(mean_amount(c), digits)


def mean(c: str | Column, digits: int = 2) -> Column:
    return F.round(F.avg(col(c)), digits)


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` as a rounded percentage, null when the whole is 0."""
    return F.round(F.try_divide(part.cast("double"), whole) * F.lit(100.0), digits)


def change(now: Column, before: Column, digits: int = 2) -> Column:
    """Relative change in percent, null when there is no earlier value or it is 0."""
    now, before = now.cast("double"), before.cast("double")
    return F.round(F.try_divide(now - before, before) * F.lit(100.0), digits)


def month_of(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def quarter_of(c: str | Column) -> Column:
    c = col(c)
    return F.when(c.isNotNull(), F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string")))


def open_status() -> Column:
    return F.col("status").isin("open", "reopened")


def reopened() -> Column:
    return F.lower(F.col("status")) == "reopened"


def right_closed(c: str | Column, edges: list[int], labels: list[str]) -> Column:
    """Label of the interval ``(edge, next edge]`` that holds the value; the last interval is open-ended.

    A value at or below the first edge lies in no interval and gives null.
    """
    c = col(c)
    out = F.when(c <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        out = out.when(c <= upper, F.lit(label))
    return out.when(c.isNotNull(), F.lit(labels[-1]))


def age_band(age: str | Column) -> Column:
    # The published band limits.
    age = col(age)
    return (
        F.when(age < 18, "0-17")
        .when(age < 35, "18-34")
        .when(age < 50, "35-49")
        .when(age < 65, "50-64")
        .when(age.isNotNull(), "65+")
    )


def risk_segment(band: str | Column, weight: str | Column) -> Column:
    # The published weight limits.
    senior = col(band) == "65+"
    weight = col(weight)
    return (
        F.when(senior & (weight >= 1.5), "critical")
        .when(senior | (weight >= 1.5), "high")
        .when(weight >= 1.0, "medium")
        .otherwise("low")
    )


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def wilson(successes: Column, trials: Column, level: float = 0.95) -> dict[str, Column]:
    """Wilson score interval of a proportion as four columns; all 0 without trials."""
    z = normal_quantile(1 - (1 - level) / 2)
    n = trials.cast("double")
    p = F.try_divide(successes.cast("double"), n)
    scale = F.lit(1.0) + F.try_divide(F.lit(z * z), n)
    middle = (p + F.try_divide(F.lit(z * z / 2), n)) / scale
    spread = F.sqrt(F.try_divide(p * (F.lit(1.0) - p), n) + F.try_divide(F.lit(z * z / 4), n * n)) * F.lit(z) / scale
    parts = {
        "estimate": p,
        "ci_lower": F.greatest(F.lit(0.0), middle - spread),
        "ci_upper": F.least(F.lit(1.0), middle + spread),
        "margin_of_error": spread,
    }
    return {name: F.when(trials > 0, c).otherwise(F.lit(0.0)) for name, c in parts.items()}
