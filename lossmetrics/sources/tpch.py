"""Adapter: TPC-H-like tables to raw (dirty) claims and their four dimension sources.

One line item becomes one claim. Line items and orders are cut down to what a claim takes from them before they are
shuffled. Parts and suppliers are broadcast up to a counted bound and joined by shuffle beyond it; adaptive execution splits
a hot order, part or supplier key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmetrics.functions.columns import age_band, risk_segment
from lossmetrics.functions.joins import lookup
from lossmetrics.sources import lookups


def pick(values: list, index: Column) -> Column:
    """``values[index % len(values)]`` as a constant-array lookup."""
    return F.array(*[F.lit(v) for v in values])[(index % len(values)).cast("int")]


def numbered(prefix: str, count: int, index: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad((index % count + 1).cast("string"), 2, "0"))


def provider_id(key: Column) -> Column:
    return F.concat(F.lit("PRV"), key.cast("string"))

#: The tables that claims, providers and regions are derived from.
TABLES = ("lineitem", "nation", "orders", "part", "region", "supplier")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    lines = t("lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        F.col("l_shipdate").cast("date").alias("shipped"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("loss"),
    )
    orders = t("orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("incident_date"),
        (F.col("o_custkey") % 96).cast("int").alias("age"),
    )
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(lookup(t("part").select("p_partkey", "p_size")), F.col("l_partkey") == F.col("p_partkey"))
        .join(lookup(t("supplier").select("s_suppkey", "s_nationkey")), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    line = F.col("l_linenumber")
    gap = F.datediff("shipped", "incident_date") % 400
    base = joined.select("*", (F.col("p_size") % 5 + 1).alias("level")).withColumn("report_date", F.date_add("incident_date", gap))
    first = F.least("incident_date", "report_date")
    last = F.greatest("incident_date", "report_date")
    age = F.col("age")
    weight = pick([w for _, _, w in lookups.DIAGNOSES], F.col("l_partkey"))
    signed = (
        F.when((F.col("l_returnflag") == "A") & (line == 2), -F.col("loss"))
        .when(F.col("l_quantity") == 50, F.col("loss") * 1000)
        .otherwise(F.col("loss"))
    )
    reserve = F.col("loss") * (1 + F.col("l_tax"))
    closed = F.col("o_orderstatus") == "F"
    return base.select(
        F.concat_ws("-", "l_orderkey", line, "l_partkey", "l_suppkey", "shipped").alias("claim_id"),
        "incident_date",
        "report_date",
        F.when(closed, F.date_add(last, (F.col("l_quantity") * 8).cast("int"))).alias("close_date"),
        F.year(first).alias("accident_year"),
        F.year(last).alias("report_year"),
        (F.year(last) - F.year(first)).alias("development_year"),
        provider_id(F.col("l_suppkey")).alias("provider_id"),
        F.when(line == 3, F.lower("n_name")).otherwise(F.col("n_name")).alias("state_code"),
        F.col("r_name").alias("region"),
        F.when(line != 5, numbered("DX", len(lookups.DIAGNOSES), F.col("l_partkey"))).alias("diagnosis_id"),
        numbered("RC", len(lookups.ROOT_CAUSES), F.col("l_orderkey")).alias("root_cause_id"),
        pick(lookups.CLAIM_TYPES, F.col("l_orderkey")).alias("claim_type"),
        pick(lookups.PROCEDURES, F.col("l_orderkey") + line).alias("procedure_category"),
        F.when(line == 4, pick(lookups.SEVERITY_WORDS, F.col("p_size")))
        .otherwise(F.col("level").cast("string"))
        .alias("severity"),
        F.when(closed, "closed").when(F.col("o_orderstatus") == "O", "open").otherwise("reopened").alias("status"),
        signed.alias("paid_amount"),
        reserve.alias("reserve_amount"),
        (F.col("loss") + reserve).alias("incurred_amount"),
        age.alias("patient_age"),
        age_band(age).alias("patient_age_band"),
        risk_segment(age_band(age), weight).alias("patient_risk_segment"),
        (F.col("l_returnflag") == "R").cast("int").alias("litigation_flag"),
        ((F.col("l_linestatus") == "O") & (line == 1)).cast("int").alias("repeat_event_flag"),
        F.datediff(last, first).alias("report_lag_days"),
    )


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    count = len(lookups.SPECIALTIES)
    return table(spark, sf_dir, "supplier").select(
        provider_id(key).alias("provider_id"),
        numbered("SP", count, key).alias("specialty_id"),
        pick([name for name, _ in lookups.SPECIALTIES], key).alias("specialty_name"),
        pick(lookups.DEPARTMENTS, key).alias("department"),
        pick([tier for _, tier in lookups.SPECIALTIES], key).alias("risk_tier"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("state_code"),
            F.col("n_name").alias("state_name"),
            F.col("r_name").alias("region"),
            pick(lookups.URBAN_RURAL, F.col("n_nationkey")).alias("urban_rural"),
            F.lit(1.0).alias("volume_multiplier"),
            F.lit(1.0).alias("severity_multiplier"),
        )
    )
