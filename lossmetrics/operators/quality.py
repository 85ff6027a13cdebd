"""Data quality: issue counts, null counts, ranges, profiles and before/after comparison.

All row-level checks of a table share one scan. Only the duplicate-id count shuffles, and it moves ids, not rows.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.functions.columns import count_where
from lossmetrics.functions.distributions import quantiles, union_all
from lossmetrics.plans.cleaning import as_date, is_number, number
from lossmetrics.sources.lookups import STATUSES, values_frame

# Category and description of every check, in report order.
CHECKS = {
    "negative_paid": ("Negative Paid Amounts", "records with negative paid_amount values"),
    "mixed_case_state": ("Mixed-Case State Codes", "state codes not in uppercase format"),
    "text_severity": ("Text Severity Values", "severity values stored as text instead of numeric"),
    "swapped_dates": ("Swapped Dates", "report_date earlier than incident_date"),
    "null_diagnosis": ("Null Diagnosis Codes", "missing diagnosis_id values"),
    "outlier": ("Extreme Outliers", "paid_amount exceeding $5,000,000"),
    "duplicate_ids": ("Duplicate Claim IDs", "duplicate claim_id entries"),
    "future_incident": ("Future Dates", "incident_date values set in the future"),
    "future_report": ("Future Dates", "report_date values set in the future"),
    "future_close": ("Future Dates", "close_date values set in the future"),
}

# What cleaning does about a category.
ACTIONS = {
    "Negative Paid Amounts": "Converted to absolute values",
    "Mixed-Case State Codes": "Converted to uppercase",
    "Text Severity Values": "Mapped text labels to integers 1-5",
    "Swapped Dates": "Swapped incident_date and report_date back to correct order",
    "Null Diagnosis Codes": "Filled with 'UNKNOWN'",
    "Extreme Outliers": "Capped at $5,000,000",
    "Duplicate Claim IDs": "Removed duplicate rows",
}


def conditions(as_of: datetime.date = config.AS_OF, cap: float = config.PAID_CAP) -> dict[str, Column]:
    """Row-level condition of every check; a null operand never counts."""
    paid = F.col("paid_amount").try_cast("double")
    severity = F.col("severity")
    today = F.lit(as_of)
    return {
        "negative_paid": paid < 0,
        "mixed_case_state": F.col("state_code") != F.upper("state_code"),
        "text_severity": severity.isNotNull() & ~is_number(severity),
        "swapped_dates": as_date("report_date") < as_date("incident_date"),
        "null_diagnosis": F.col("diagnosis_id").isNull(),
        "outlier": F.abs(paid) > cap,
        "future_incident": as_date("incident_date") > today,
        "future_report": as_date("report_date") > today,
        "future_close": as_date("close_date") > today,
    }


def check_count(claims: DataFrame, name: str, **limits) -> DataFrame:
    """One check on its own: category and affected rows."""
    category = F.lit(CHECKS[name][0]).alias("category")
    if name == "duplicate_ids":
        return duplicate_ids(claims).select(category, "issue_count")
    counted = claims.agg(count_where(conditions(**limits)[name]).alias("issue_count"))
    return counted.select(category, "issue_count")


def duplicate_ids(claims: DataFrame) -> DataFrame:
    """Rows beyond the first of each claim id."""
    per_id = claims.groupBy("claim_id").agg(F.count(F.lit(1)).alias("copies"))
    return per_id.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("issue_count"))


def issues(
    claims: DataFrame, as_of: datetime.date = config.AS_OF, cap: float = config.PAID_CAP, one_pass: bool = False
) -> DataFrame:
    """Issues found, one row per check with at least one affected row.

    A stored table is scanned twice, so that the duplicate count shuffles ids only. ``one_pass`` is for a table that is
    itself a costly plan: all counts travel with the ids and the table is computed once.
    """
    tests = conditions(as_of, cap)
    if one_pass:
        per_id = claims.groupBy("claim_id").agg(
            F.count(F.lit(1)).alias("copies"), *[F.count_if(c).alias(n) for n, c in tests.items()]
        )
        sums = {n: F.sum(n) for n in tests} | {"duplicate_ids": F.sum(F.col("copies") - 1)}
        both = per_id.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in sums.items()])
    else:
        rowwise = claims.agg(*[count_where(c).alias(n) for n, c in tests.items()])
        both = rowwise.crossJoin(F.broadcast(duplicate_ids(claims).withColumnRenamed("issue_count", "duplicate_ids")))
    entries = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(category).alias("category"),
                F.lit(text).alias("description"),
                F.col(name).alias("issue_count"),
            )
            for position, (name, (category, text)) in enumerate(CHECKS.items(), 1)
        ]
    )
    return both.select(F.inline(entries)).where(F.col("issue_count") > 0)


def comparison(before: DataFrame, after: DataFrame, as_of: datetime.date = config.AS_OF) -> DataFrame:
    """Affected rows per category before and after cleaning, with a total row."""

    def by_category(claims: DataFrame, name: str, one_pass: bool) -> DataFrame:
        return issues(claims, as_of, one_pass=one_pass).groupBy("category").agg(F.sum("issue_count").alias(name))

    joined = by_category(before, "before", False).join(by_category(after, "after", True), "category", "full")
    filled = joined.na.fill(0, ["before", "after"])
    return (
        filled.rollup("category")
        .agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
        .select(
            F.coalesce("category", F.lit("Total")).alias("category"),
            F.coalesce("before", F.lit(0)).cast("long").alias("before"),
            F.coalesce("after", F.lit(0)).cast("long").alias("after"),
            F.coalesce(F.col("before") - F.col("after"), F.lit(0)).cast("long").alias("resolved"),
        )
    )


def _per_column(df: DataFrame, columns: list[str], measure, name: str) -> DataFrame:
    """One aggregate per column from a single scan, turned into rows."""
    return df.agg(*[measure(F.col(c)).alias(c) for c in columns]).unpivot([], columns, "column_name", name)


def null_counts(df: DataFrame) -> DataFrame:
    return _per_column(df, df.columns, lambda c: count_where(c.isNull()), "null_count")


def numeric_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind in ("tinyint", "smallint", "int", "bigint", "float", "double")]


def numeric_ranges(df: DataFrame) -> DataFrame:
    """Smallest and largest non-null value of every numeric column that has one."""
    columns = numeric_columns(df)
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_lo").alias("min_value"), F.col(f"{c}_hi").alias("max_value"))
            for c in columns
        ]
    )
    lows = [F.min(F.col(c).cast("double")).alias(f"{c}_lo") for c in columns]
    highs = [F.max(F.col(c).cast("double")).alias(f"{c}_hi") for c in columns]
    return df.agg(*lows, *highs).select(F.inline(entries)).where(F.col("min_value").isNotNull())


WHOLE, REAL, DAY, TEXT = "bigint", "double", "date", "string"


def _by_kind(df: DataFrame) -> dict[str, list[str]]:
    """Columns by the type in which their values are compared."""
    groups: dict[str, list[str]] = {}
    for name, kind in df.dtypes:
        if kind in ("tinyint", "smallint", "int", "bigint"):
            kind = WHOLE
        elif kind in ("float", "double"):
            kind = REAL
        elif kind != DAY:
            kind = TEXT
        groups.setdefault(kind, []).append(name)
    return groups


def _numeric(value: Column, kind: str) -> Column:
    if kind == DAY:
        return F.lit(None).cast("double")
    return number(value) if kind == TEXT else value.cast("double")


def _value_profile(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """Nulls, distinct values and numeric range per column from its counted values.

    Repeats of a (column, value) pair collapse before the shuffle, and a text is parsed once per distinct value.
    """
    values = df.select([F.col(c).cast(kind).alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    counted = values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    parsed = counted.withColumn("x", _numeric(F.col("value"), kind))
    return parsed.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("x").isNotNull(), F.col("n"))), F.lit(0)).alias("numbers"),
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
    )


def _sketched_profile(df: DataFrame) -> DataFrame:
    """The same measures in one scan with a distinct-count sketch per column."""
    kinds = {c: kind for kind, columns in _by_kind(df).items() for c in columns}
    measures = []
    for c, kind in kinds.items():
        x = _numeric(F.col(c).cast(kind), kind)
        parts = [F.count_if(F.col(c).isNull()), F.approx_count_distinct(c), F.count(x), F.min(x), F.max(x)]
        names = ["null_count", "distinct_count", "numbers", "lo", "hi"]
        measures.append(F.struct(F.lit(c).alias("column_name"), *[p.alias(n) for p, n in zip(parts, names)]))
    one = df.agg(F.count(F.lit(1)).alias("rows"), F.array(*measures).alias("m"))
    return one.select("rows", F.inline("m"))


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, nulls, distinct values and, where more than half of the rows are numeric, the range of every column."""
    if exact:
        measured = union_all([_value_profile(df, columns, kind) for kind, columns in _by_kind(df).items()])
    else:
        measured = _sketched_profile(df)
    shown = values_frame(df.sparkSession, [tuple(pair) for pair in df.dtypes], ["column_name", "data_type"])
    numeric = (F.col("numbers") > 0) & (F.col("numbers") > F.col("rows") * 0.5)
    return shown.join(measured, "column_name", "left").select(
        "column_name",
        "data_type",
        F.coalesce("null_count", F.lit(0)).alias("null_count"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
        F.when(numeric, F.round("lo", 2)).alias("min_value"),
        F.when(numeric, F.round("hi", 2)).alias("max_value"),
    )


def completeness(df: DataFrame) -> DataFrame:
    """Rows, columns, share of non-null cells and the latest incident (else report) date."""
    filled = sum((F.count(F.col(c)) for c in df.columns), F.lit(0))
    cells = F.count(F.lit(1)) * len(df.columns)
    latest = F.coalesce(*[F.max(c) for c in ("incident_date", "report_date") if c in df.columns])
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.lit(len(df.columns)).alias("column_count"),
        F.coalesce(F.round(F.try_divide(filled, cells) * 100, 1), F.lit(100.0)).alias("completeness_pct"),
        latest.alias("latest_date"),
    )


def null_rates(df: DataFrame) -> DataFrame:
    """Null percentage of the columns that have nulls."""
    rates = _per_column(
        df, df.columns, lambda c: F.round(F.try_divide(F.count_if(c.isNull()), F.count(F.lit(1))) * 100, 2), "null_pct"
    )
    return rates.where(F.col("null_pct") > 0)


def capped_histogram(df: DataFrame, value: str = "paid_amount", bins: int = 50, cap_at: float = 0.99) -> DataFrame:
    """Equal-width histogram of a column clipped at a quantile, with its median."""
    stats = quantiles(df, value, {"cap": cap_at, "median": 0.5, "low": 0.0})
    clipped = df.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    placed = clipped.crossJoin(F.broadcast(stats)).withColumn("v", F.least("v", "cap"))
    width = F.col("cap") - F.col("low")
    slot = F.least(F.floor(F.try_divide(F.col("v") - F.col("low"), width) * bins), F.lit(bins - 1))
    return (
        placed.select(F.coalesce(slot, F.lit(0)).cast("int").alias("bin"), "cap", "low", "median")
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("claim_count"),
            F.first("cap").alias("cap"),
            F.first("low").alias("low"),
            F.first("median").alias("median"),
        )
        .select(
            "bin",
            F.round(F.col("low") + (F.col("cap") - F.col("low")) * F.col("bin") / bins, 2).alias("bin_start"),
            "claim_count",
            F.round("median", 2).alias("median_value"),
        )
    )


def audit(fact: DataFrame, dims: dict[str, DataFrame], as_of: datetime.date = config.AS_OF) -> DataFrame:
    """Eighteen warehouse checks: 16 from one scan of the fact, two by anti join of its keys."""
    # Check names.
    checks = {
        "Total rows": F.lit(True),
        "NULL incident_date": F.col("incident_date").isNull(),
        "NULL report_date": F.col("report_date").isNull(),
        "NULL close_date": F.col("close_date").isNull(),
        "NULL provider_key": F.col("provider_key").isNull(),
        "NULL region_key": F.col("region_key").isNull(),
        "NULL diagnosis_key": F.col("diagnosis_key").isNull(),
        "Severity out of range": ~F.col("severity_level").between(1, 5),
        "Negative paid_amount": F.col("paid_amount") < 0,
        "Negative incurred_amount": F.col("incurred_amount") < 0,
        "Paid > Incurred": F.col("paid_amount") > F.col("incurred_amount"),
        "Report before incident": F.col("report_date") < F.col("incident_date"),
        "Negative days_to_report": F.col("days_to_report") < 0,
        "Negative days_to_close": F.col("days_to_close") < 0,
        "Future incident_date": F.col("incident_date") > F.lit(as_of),
        "Unknown status values": ~F.col("status").isin(STATUSES),
    }
    slots = {f"c{i}": name for i, name in enumerate(checks)}
    counted = fact.agg(*[count_where(checks[name]).alias(slot) for slot, name in slots.items()])
    entries = F.array(
        *[F.struct(F.lit(name).alias("check_name"), F.col(slot).alias("result")) for slot, name in slots.items()]
    )
    out = counted.select(F.inline(entries))
    for label in ("provider", "region"):
        out = out.unionByName(orphans(fact, dims[f"{label}_key"], f"{label}_key", f"Orphan {label} keys"))
    return out


def orphans(fact: DataFrame, dim: DataFrame, key: str, label: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension. Keys are counted first, so the join moves keys, not claims."""
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lost = per_key.join(dim.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("result")).select(
        F.lit(label).alias("check_name"), "result"
    )


def constraint_violations(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Violations per declared constraint of the fact: primary key, four foreign keys and three value checks."""
    per_id = fact.groupBy("claim_id").agg(F.count(F.lit(1)).alias("n"))
    unique = per_id.where((F.col("n") > 1) | F.col("claim_id").isNull())
    parts = [
        unique.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("result")).select(
            F.lit("pk_claim_id").alias("check_name"), "result"
        )
    ]
    parts += [orphans(fact, dim, key, f"fk_{key}") for key, dim in dims.items()]
    values = fact.agg(
        count_where(~F.col("severity_level").between(1, 5)).alias("ck_severity_range"),
        count_where(F.col("paid_amount") < 0).alias("ck_paid_non_negative"),
        count_where(F.col("incurred_amount") < 0).alias("ck_incurred_non_negative"),
    )
    parts.append(values.unpivot([], values.columns, "check_name", "result"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("check_name").alias("constraint_name"), F.col("result").alias("violations"))
