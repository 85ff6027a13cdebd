"""Loss development: triangles, chain-ladder factors, ultimates, IBNR and standard errors, for one or many segments.

Claims are reduced to (segment, accident year, development year) cells in one shuffle; everything after that runs on the
cells. Without segment columns the whole book is one segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.functions.columns import exact_sum

SEG = "segment"
KEY = [SEG, "accident_year"]


def _segment(columns: tuple[str, ...]) -> Column:
    return F.concat_ws("|", *columns) if columns else F.lit("all")


def cells(claims: DataFrame, *segments: str) -> DataFrame:
    """Incremental and cumulative paid of the observed cells; the running sum passes over interior gaps.

    ``step`` numbers the development years that occur anywhere in the segment, oldest first.
    """
    known = claims.where(F.col("accident_year").isNotNull() & F.col("development_year").isNotNull())
    paid = known.groupBy(_segment(segments).alias(SEG), "accident_year", "development_year").agg(
        F.coalesce(exact_sum("paid_amount"), F.lit(0)).alias("paid")
    )
    so_far = Window.partitionBy(*KEY).orderBy("development_year").rowsBetween(Window.unboundedPreceding, 0)
    in_segment = Window.partitionBy(SEG).orderBy("development_year")
    return paid.select(
        *KEY,
        "development_year",
        F.col("paid").cast("double").alias("incremental_paid"),
        F.sum("paid").over(so_far).cast("double").alias("cumulative_paid"),
        F.dense_rank().over(in_segment).alias("step"),
    )


def triangle(claims: DataFrame, *segments: str) -> DataFrame:
    return cells(claims, *segments).select(
        *KEY,
        "development_year",
        F.round("incremental_paid", 2).alias("incremental_paid"),
        F.round("cumulative_paid", 2).alias("cumulative_paid"),
    )


def wide_triangle(claims: DataFrame, devs: int, *segments: str, prefix: str = "dev_", masked: bool = False) -> DataFrame:
    """Cumulative triangle with one column per development year 0 .. devs - 1.

    Unmasked, an unobserved cell repeats the cumulative value before it (0 at the start); masked, it is null.
    """
    grid = cells(claims, *segments).groupBy(*KEY)
    seen = [F.max(F.when(F.col("development_year") == d, F.col("cumulative_paid"))) for d in range(devs)]
    if masked:
        columns = [F.round(c, 2).alias(f"{prefix}{d}") for d, c in enumerate(seen)]
    else:
        before = [F.max(F.when(F.col("development_year") <= d, F.struct("development_year", "cumulative_paid"))) for d in range(devs)]
        columns = [
            F.coalesce(F.round(c["cumulative_paid"], 2), F.lit(0.0)).alias(f"{prefix}{d}") for d, c in enumerate(before)
        ]
    return grid.agg(*columns) if columns else cells(claims, *segments).select(*KEY).distinct()  # no claims, no development year


def _links(grid: DataFrame) -> DataFrame:
    """One row per segment and step: the factor to the next step, its variance and the column total.

    A factor uses the accident years that have both steps; it is null when there is none or their total is 0.
    """
    year = Window.partitionBy(*KEY).orderBy("step")
    column = Window.partitionBy(SEG, "step")
    now = F.col("cumulative_paid")
    adjacent = F.lead("step").over(year) == F.col("step") + 1
    pairs = grid.withColumn("next", F.when(adjacent, F.lead("cumulative_paid").over(year)))
    both = F.col("next").isNotNull()
    ratio = F.try_divide(F.sum("next").over(column), F.sum(F.when(both, now)).over(column))
    off = F.try_divide(F.col("next"), now) - F.col("factor")
    factors = (
        pairs.withColumn("factor", F.round(ratio, 6))
        .groupBy(SEG, "step")
        .agg(
            F.min("development_year").alias("development_year"),
            F.max("factor").alias("factor"),
            F.sum("cumulative_paid").alias("column_total"),
            F.count(off).alias("_pairs"),
            F.sum(now * off * off).alias("_sum"),
        )
    )
    order = Window.partitionBy(SEG).orderBy("step")
    out = factors.withColumn(
        "sigma_sq",
        F.when(F.col("factor").isNotNull(), F.when(F.col("_pairs") > 1, F.col("_sum") / (F.col("_pairs") - 1)).otherwise(0.0)),
    )
    out = out.withColumn("next_dev", F.lead("development_year").over(order)).withColumn(
        "steps", F.count(F.lit(1)).over(Window.partitionBy(SEG))
    )
    last = (F.col("step") == F.col("steps") - 1) & (F.col("steps") >= 3)
    carried = F.coalesce(F.lag("sigma_sq").over(order), F.lit(0.0))
    return out.withColumn("sigma_sq", F.when(last & F.col("sigma_sq").isNull(), carried).otherwise(F.col("sigma_sq")))


def age_to_age(claims: DataFrame, *segments: str) -> DataFrame:
    return (
        _links(cells(claims, *segments))
        .where(F.col("next_dev").isNotNull())
        .select(SEG, F.col("development_year").alias("from_dev"), F.col("next_dev").alias("to_dev"), "factor")
    )


def _cdfs(links: DataFrame) -> DataFrame:
    """Product of the rounded factors from a step to the end, a missing factor counting as 1."""
    to_end = Window.partitionBy(SEG).orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    factor = F.when(F.col("next_dev").isNotNull(), F.coalesce("factor", F.lit(1.0))).otherwise(1.0)
    product = F.aggregate(F.collect_list(factor).over(to_end), F.lit(1.0), lambda a, f: a * f)
    return links.withColumn("cdf", F.round(product, 6))


def cumulative_factors(claims: DataFrame, *segments: str) -> DataFrame:
    return _cdfs(_links(cells(claims, *segments))).select(SEG, "development_year", "cdf")


def ultimates(claims: DataFrame, *segments: str) -> DataFrame:
    """Latest cumulative paid of each accident year times the factor to ultimate."""
    grid = cells(claims, *segments)
    return _ultimates(grid, _cdfs(_links(grid))).drop("step")


def _ultimates(grid: DataFrame, factors: DataFrame) -> DataFrame:
    latest = grid.groupBy(*KEY).agg(
        F.max("step").alias("step"),
        F.max_by("development_year", "step").alias("latest_dev_year"),
        F.max_by("cumulative_paid", "step").alias("paid"),
    )
    joined = latest.join(factors.select(SEG, "step", "cdf"), [SEG, "step"])
    return joined.select(
        *KEY,
        F.round("paid", 2).alias("current_paid"),
        "latest_dev_year",
        F.col("cdf").alias("cdf_applied"),
        F.round(F.col("paid") * F.col("cdf"), 2).alias("ultimate"),
        "step",
    )


def ibnr(claims: DataFrame, *segments: str) -> DataFrame:
    """Reserve per accident year and a total row per segment (accident year null)."""
    return (
        ultimates(claims, *segments)
        .groupingSets([[F.col(SEG), F.col("accident_year")], [F.col(SEG)]], SEG, "accident_year")
        .agg(F.sum("current_paid").alias("c"), F.sum("ultimate").alias("u"))
        .select(
            SEG,
            F.coalesce(F.col("accident_year").cast("string"), F.lit("total")).alias("accident_year"),
            F.round("c", 2).alias("current_paid"),
            F.round("u", 2).alias("ultimate"),
            F.round(F.col("u") - F.col("c"), 2).alias("ibnr"),
        )
    )


def standard_errors(claims: DataFrame, *segments: str) -> DataFrame:
    """Standard error and 95 % interval of each accident year's reserve (Mack 1993, with column totals over all
    observed accident years). Nothing is returned for a segment with fewer than two accident or development years.

    The remaining steps of a year are folded over the segment's factors, an array of a few entries per segment.
    """
    grid = cells(claims, *segments)
    links = _cdfs(_links(grid))
    steps = links.where(F.col("next_dev").isNotNull()).groupBy(SEG).agg(
        F.array_sort(F.collect_list(F.struct("step", "factor", "sigma_sq", "column_total"))).alias("chain")
    )
    size = grid.groupBy(SEG).agg(F.countDistinct("accident_year").alias("years"))
    state = F.struct(F.col("current_paid").alias("c"), F.lit(0.0).alias("v"))

    def advance(acc: Column, link: Column) -> Column:
        f, s2, total = link["factor"], link["sigma_sq"], link["column_total"]
        usable = f.isNotNull() & (f != 0) & s2.isNotNull() & (total != 0)
        own = F.when(acc["c"] > 0, F.try_divide(F.lit(1.0), acc["c"])).otherwise(0.0)
        term = F.try_divide(s2, f * f) * (own + F.try_divide(F.lit(1.0), total))
        return F.when(usable, F.struct((acc["c"] * f).alias("c"), (acc["v"] + term).alias("v"))).otherwise(acc)

    ahead = F.filter("chain", lambda link: link["step"] >= F.col("step"))
    folded = F.aggregate(ahead, state, advance)["v"]
    reserve = F.col("ultimate") - F.col("current_paid")
    se = F.when(F.col("variance") > 0, F.sqrt("variance") * F.col("ultimate")).otherwise(0.0)
    return (
        _ultimates(grid, links)
        .join(steps, SEG)
        .join(size.where(F.col("years") >= 2), SEG)
        .withColumn("variance", folded)
        .select(
            *KEY,
            F.round(reserve, 2).alias("ibnr"),
            F.round(se, 2).alias("se"),
            F.round(F.greatest(F.lit(0.0), reserve - F.lit(1.96) * se), 2).alias("ci_lower"),
            F.round(reserve + F.lit(1.96) * se, 2).alias("ci_upper"),
        )
    )
