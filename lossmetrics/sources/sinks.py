"""Sinks: partitioned writers for tables and extracts, and the quality report.

Writers run in parallel and name a folder of parts. Only the report is a single text; its rows are one per check and
column, so collecting them is bounded by the schema.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.operators import extracts, quality, reserving

BOM = "﻿"


def write_csv(df: DataFrame, path: str, bom: bool = False, compression: str = "none") -> str:
    """CSV parts with a header, written in parallel; null is an empty field. ``bom`` marks the header as UTF-8.

    ``compression`` (such as ``gzip``) packs every part; the readers unpack it by its name.
    """
    if bom:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    options = {"header": True, "nullValue": "", "emptyValue": '""', "quote": '"', "escape": '"'}
    df.write.mode("overwrite").options(**options, compression=compression).csv(path)
    return path


def read_back(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A written CSV folder with the columns and types of ``like``; columns are taken in order, as the header may hold a mark."""
    options = {"header": True, "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"', "multiLine": True}
    return spark.read.schema(like.schema).options(**options).csv(path)


def write_cleaned(tables: dict[str, DataFrame], folder: str, compression: str = "none") -> list[str]:
    """Every cleaned table as CSV."""
    return [write_csv(df, f"{folder}/{name}.csv", compression=compression) for name, df in tables.items()]


def claims_detail(claims: DataFrame, folder: str, compression: str = "none") -> str:
    return write_csv(claims, f"{folder}/claims_detail.csv", bom=True, compression=compression)


def development_years(claims: DataFrame) -> int:
    """Development years to show: a single number."""
    latest = claims.agg(F.max("development_year")).first()[0]
    return 0 if latest is None else latest + 1


def loss_triangle(claims: DataFrame, folder: str) -> str:
    """Wide cumulative triangle; an unobserved cell repeats the value before it."""
    wide = reserving.wide_triangle(claims, development_years(claims)).drop("segment").orderBy("accident_year")
    return write_csv(wide, f"{folder}/loss_triangle.csv", bom=True)


def monthly_metrics(claims: DataFrame, folder: str) -> str:
    return write_csv(extracts.monthly_metrics(claims).orderBy("month"), f"{folder}/monthly_metrics.csv", bom=True)


def provider_scorecard(claims: DataFrame, folder: str) -> str:
    return write_csv(extracts.provider_scorecard(claims), f"{folder}/provider_scorecard.csv", bom=True)


def bi_extract(claims: DataFrame, folder: str, names: Iterable[str] | None = None, compression: str = "none") -> list[str]:
    """The five sheets, or those named, one folder each."""
    return [write_csv(df, f"{folder}/{name}", bom=True, compression=compression) for name, df in extracts.sheets(claims).items() if names is None or name in set(names)]


def export_all(claims: DataFrame, folder: str) -> list[str]:
    return [
        claims_detail(claims, folder),
        loss_triangle(claims, folder),
        monthly_metrics(claims, folder),
        provider_scorecard(claims, folder),
        *bi_extract(claims, f"{folder}/bi_extract"),
    ]


# Texts of the report.
TITLE, SUMMARY, DETAIL = "# Data Quality Report", "## Summary", "## Issues Detail"
COMPARISON = "## Before/After Comparison"
NULLS = "## Column Null Counts (After Cleaning)"
RANGES = "## Numeric Column Ranges (After Cleaning)"
SUMMARY_LINES = (
    "- Total records examined: {records:,}",
    "- Issues found: {before:,}",
    "- Issues resolved: {resolved:,}",
    "- Issues remaining: {after:,}",
    "- Cleaning time: {seconds:.2f}s",
)


def _table(title: str, header: list[str], rows: list[list[str]]) -> list[str]:
    """A section with a table; nothing without rows."""
    if not rows:
        return []
    line = lambda cells: "| " + " | ".join(cells) + " |"
    rule = "|" + "|".join("-" * (len(cell) + 2) for cell in header) + "|"
    return [title, line(header), rule, *map(line, rows), ""]


def quality_report(
    raw: DataFrame, clean: DataFrame, generated: str, seconds: float = 0.0, as_of: datetime.date = config.AS_OF
) -> str:
    """Markdown report of a cleaning run: summary, issues, before/after, nulls and ranges."""
    compared = {r["category"]: r for r in quality.comparison(raw, clean, as_of).collect()}
    overall = compared.pop("Total", None) or dict.fromkeys(("before", "resolved", "after"), 0)  # no rows, no comparison
    facts = {"records": raw.count(), "seconds": seconds} | {c: overall[c] for c in ("before", "resolved", "after")}

    def issue(row) -> list[str]:
        action = quality.ACTIONS.get(row["category"])
        left = compared[row["category"]]["after"] if row["category"] in compared else 0
        lines = [f"### {row['category']}", f"- Found: {row['issue_count']:,} records — {row['description']}"]
        return [*lines, *([f"- Action: {action}"] if action else []), f"- Remaining: {left:,}", ""]

    issues = [line for row in quality.issues(raw, as_of).orderBy("position").collect() for line in issue(row)]
    both = [[c, f"{r['before']:,}", f"{r['after']:,}"] for c, r in sorted(compared.items())]
    total = [["**Total**", f"**{overall['before']:,}**", f"**{overall['after']:,}**"]] if both else []
    nulls = quality.null_counts(clean).where("null_count > 0").orderBy(F.desc("null_count"), "column_name").collect()
    ranges = quality.numeric_ranges(clean).orderBy("column_name").collect()
    sections = [
        [TITLE, f"Generated: {generated}", ""],
        [SUMMARY, *(line.format(**facts) for line in SUMMARY_LINES), ""],
        [DETAIL, *issues] if issues else [],
        _table(COMPARISON, ["Metric", "Before", "After"], both + total),
        _table(NULLS, ["Column", "Null Count"], [[r["column_name"], f"{r['null_count']:,}"] for r in nulls]),
        _table(RANGES, ["Column", "Min", "Max"], [[r["column_name"], f"{r['min_value']:,.2f}", f"{r['max_value']:,.2f}"] for r in ranges]),
    ]
    return "\n".join(line for section in sections for line in section)


def write_report(df: DataFrame, text: str, path: str) -> str:
    """Write a bounded text as one file through the session's file system."""
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path
