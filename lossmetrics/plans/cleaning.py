"""Claim cleaning: one projection per step, all fused into a single stage, and one shuffle to drop copies."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.functions.joins import lookup
from lossmetrics.session import shared_dir
from lossmetrics.sources import lookups, schemas


def as_date(c: str) -> Column:
    return F.col(c).try_cast("date")


# A cast that fails raises inside the cast for every bad value; testing the text first is far cheaper.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_number(c: Column) -> Column:
    """True when a text holds a number."""
    return F.coalesce(c.cast("string").rlike(NUMBER), F.lit(False))


def number(c: Column) -> Column:
    """A text as a double, null when it holds no number."""
    return F.when(is_number(c), c.try_cast("double"))


def severity_number(c: str | Column) -> Column:
    """Severity as a whole number from digits or from a spelled-out word; a fraction and anything else is null."""
    c = F.col(c) if isinstance(c, str) else c
    word = F.lower(F.trim(c.cast("string")))
    value = c.try_cast("double")
    out = F.when(is_number(c) & (value == F.floor(value)), value.try_cast("int"))
    for value, text in enumerate(lookups.SEVERITY_WORDS, 1):
        out = out.when(word == text, F.lit(value))
    return out


def absolute_paid(claims: DataFrame) -> DataFrame:
    return claims.withColumn("paid_amount", F.abs(F.col("paid_amount").try_cast("double")))


def upper_state(claims: DataFrame) -> DataFrame:
    return claims.withColumn("state_code", F.upper("state_code"))


def numeric_severity(claims: DataFrame) -> DataFrame:
    return claims.withColumn("severity", severity_number("severity"))


def ordered_dates(claims: DataFrame) -> DataFrame:
    """Swap the two dates where the report precedes the incident. A missing date is never swapped."""
    incident, report = as_date("incident_date"), as_date("report_date")
    swapped = report < incident
    return claims.withColumns(
        {
            "incident_date": F.when(swapped, report).otherwise(incident),
            "report_date": F.when(swapped, incident).otherwise(report),
        }
    )


def known_diagnosis(claims: DataFrame) -> DataFrame:
    return claims.withColumn("diagnosis_id", F.coalesce("diagnosis_id", F.lit("UNKNOWN")))


def capped_paid(claims: DataFrame, cap: float = config.PAID_CAP) -> DataFrame:
    paid = F.col("paid_amount").try_cast("double")
    return claims.withColumn(
        "paid_amount", F.when(F.abs(paid) > cap, F.signum(paid) * F.lit(float(cap))).otherwise(paid)
    )


def without_copies(claims: DataFrame) -> DataFrame:
    """Drop full-row copies. Copies collapse map-side before the shuffle, so a hot group costs one row per task."""
    return claims.dropDuplicates()


def without_copies_measured(claims: DataFrame) -> DataFrame:
    """Drop full-row copies where only rows of repeated claim ids are shuffled as a whole.

    Copies share their id, and so its digest. The repeated digests are counted map-side, eight bytes a row, and written to
    the shared folder, where they are counted: they are broadcast up to a bound and otherwise joined by digest, splitting hot
    ones. Two ids of one digest only mean that their rows are compared as a whole too. Writing is one job.
    """
    digest = F.xxhash64("claim_id")
    per_id = claims.groupBy(digest.alias("_id")).agg(F.count(F.lit(1)).alias("n"))
    repeated = per_id.where(F.col("n") > 1).select("_id")
    path = f"{shared_dir(claims.sparkSession)}/lossmetrics/repeated-{uuid.uuid4().hex}"
    repeated.write.parquet(path)
    ids = lookup(claims.sparkSession.read.schema(repeated.schema).parquet(path))
    same = digest == F.col("_id")
    single = claims.join(ids, same, "left_anti")
    return single.unionByName(without_copies(claims.join(ids, same, "left_semi")))


def typed(claims: DataFrame) -> DataFrame:
    """Dates, amounts and integers in their types; a value that does not parse becomes null."""
    casts = {c: as_date(c) for c in schemas.DATE_COLUMNS}
    casts |= {c: F.col(c).try_cast("double") for c in schemas.AMOUNT_COLUMNS}
    casts |= {c: F.col(c).try_cast("double").try_cast("int") for c in schemas.INTEGER_COLUMNS}
    return claims.withColumns({c: e for c, e in casts.items() if c in claims.columns})


def repaired(raw: DataFrame, cap: float = config.PAID_CAP) -> DataFrame:
    """The row-level cleaning steps in their fixed order: one projection, no shuffle."""
    return (
        raw.transform(absolute_paid)
        .transform(upper_state)
        .transform(numeric_severity)
        .transform(ordered_dates)
        .transform(known_diagnosis)
        .transform(capped_paid, cap)
        .transform(typed)
    )


def clean_claims(raw: DataFrame, cap: float = config.PAID_CAP, measured: bool = False) -> DataFrame:
    """Raw claims to clean claims. ``measured`` looks for repeated ids first and shuffles only their rows."""
    drop = without_copies_measured if measured else without_copies
    return repaired(raw, cap).transform(drop)
