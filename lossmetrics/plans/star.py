"""Star schema: four dimensions with surrogate keys, the fact table and the joined claim summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.functions.distributions import union_all
from lossmetrics.functions.joins import lookup
from lossmetrics.sources import schemas
from lossmetrics.sources.lookups import values_frame

KEYS = {
    "provider_key": ("provider_id", "provider_id"),
    "region_key": ("state_code", "state_code"),
    "diagnosis_key": ("diagnosis_id", "diagnosis_code"),
    "root_cause_key": ("root_cause_id", "root_cause_code"),
}


def with_surrogate_key(dim: DataFrame, natural: str, key: str, code_list: bool = False) -> DataFrame:
    """Dense keys 1..n in the order of the natural key's digest, the same on every run and cluster.

    A row number over a whole dimension sorts it in one task, which only a published code list (states, diagnoses, root
    causes: ``code_list``) allows. Any other dimension is numbered inside 4,096 digest slices of even size, and each
    slice starts after the rows of the slices before it. Both ways give the same keys.
    """
    digest = F.md5(F.col(natural))
    if code_list:
        position = F.row_number().over(Window.orderBy(digest, natural))
        return dim.select(position.cast("long").alias(key), *dim.columns)
    sliced = dim.withColumn("_digest", digest).withColumn("_slice", F.substring("_digest", 1, 3))
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select(
        "_slice", (F.sum("_rows").over(Window.orderBy("_slice")) - F.col("_rows")).alias("_start")
    )  # at most 4,096 rows
    position = F.row_number().over(Window.partitionBy("_slice").orderBy("_digest", natural))
    return sliced.join(F.broadcast(starts), "_slice").select(
        (F.col("_start") + position).cast("long").alias(key), *dim.columns
    )


def dim_provider(providers: DataFrame) -> DataFrame:
    shaped = providers.select(
        "provider_id",
        F.concat(F.lit("Provider "), F.col("provider_id")).alias("provider_name"),
        F.col("specialty_name").alias("specialty"),
        "department",
        "risk_tier",
    )
    return with_surrogate_key(shaped, "provider_id", "provider_key")


def dim_region(regions: DataFrame) -> DataFrame:
    return with_surrogate_key(regions.select(*schemas.REGION_COLUMNS), "state_code", "region_key", code_list=True)


def dim_diagnosis(diagnoses: DataFrame) -> DataFrame:
    """Diagnoses plus the UNKNOWN member that cleaning fills in, unless the source already has one."""
    shaped = diagnoses.select(
        F.col("diagnosis_id").alias("diagnosis_code"),
        F.col("category").alias("diagnosis_category"),
        F.col("severity_weight").cast("double").alias("severity_weight"),
    )
    unknown = values_frame(diagnoses.sparkSession, [("UNKNOWN", "Unknown", 1.0)], schemas.DIAGNOSIS_COLUMNS)
    missing = unknown.join(shaped, "diagnosis_code", "left_anti")
    return with_surrogate_key(shaped.unionByName(missing), "diagnosis_code", "diagnosis_key", code_list=True)


def dim_root_cause(root_causes: DataFrame) -> DataFrame:
    shaped = root_causes.select(
        F.col("root_cause_id").alias("root_cause_code"),
        F.col("category").alias("root_cause_category"),
        "preventability",
    )
    return with_surrogate_key(shaped, "root_cause_code", "root_cause_key", code_list=True)


def keyed_claims(clean: DataFrame, dims: dict[str, DataFrame], attributes: bool = False) -> DataFrame:
    """Clean claims with the four surrogate keys looked up (null without a match), and the dimension attributes if asked.

    A dimension is broadcast up to a counted bound, so that wide claims are not shuffled for it; beyond the bound a hot
    provider is split.
    """
    out = clean
    for key, (claim_column, dim_column) in KEYS.items():
        dim = dims[key]
        if attributes:
            shared = [c for c in dim.columns if c in out.columns and c != dim_column]
            side = lookup(dim.withColumn("_natural", F.col(dim_column)))
            out = out.drop(*shared).withColumnRenamed(claim_column, "_claim").join(side, F.col("_claim") == F.col("_natural"), "left")
            out = out.drop("_claim", "_natural")
        else:
            out = out.join(lookup(dim.select(F.col(dim_column).alias(claim_column), key)), claim_column, "left")
    return out


def unmapped_counts(clean: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Claims without a match per dimension, and claims dropped because any key is missing."""
    keyed = keyed_claims(clean, dims)
    names = [key.removesuffix("_key") for key in KEYS]
    counts = [F.count_if(F.col(key).isNull()).alias(name) for key, name in zip(KEYS, names)]
    dropped = F.count_if(F.greatest(*[F.col(k).isNull().cast("int") for k in KEYS]) == 1).alias("dropped_rows")
    return (
        keyed.agg(*counts, dropped)
        .unpivot([], [*names, "dropped_rows"], "dimension", "unmapped")
        .select("dimension", F.col("unmapped").cast("long").alias("unmapped"))
    )


def measures(keyed: DataFrame, lag: Column) -> DataFrame:
    """Rename and derive the fact measures on keyed claims."""
    return keyed.withColumns(
        {
            "severity_level": F.col("severity").try_cast("int"),
            "reserved_amount": F.col("reserve_amount"),
            "days_to_report": lag.try_cast("int"),
            "days_to_close": F.datediff("close_date", "incident_date"),
            "repeat_event_flag": F.coalesce(F.col("repeat_event_flag"), F.lit(0)).try_cast("int"),
            "litigation_flag": F.coalesce(F.col("litigation_flag"), F.lit(0)).try_cast("int"),
        }
    )


def _fact_rows(clean: DataFrame, dims: dict[str, DataFrame], recompute: bool, attributes: bool) -> DataFrame:
    lag = F.datediff("report_date", "incident_date")
    if "report_lag_days" in clean.columns and not recompute:
        lag = F.coalesce(F.col("report_lag_days"), F.lit(0))
    keyed = keyed_claims(clean, dims, attributes).dropna(subset=list(KEYS))
    if recompute:
        keyed = keyed.withColumns(
            {
                "accident_year": F.year("incident_date"),
                "development_year": F.year("report_date") - F.year("incident_date"),
            }
        )
    return measures(keyed, lag)


def fact_claim(clean: DataFrame, dims: dict[str, DataFrame], recompute: bool = False) -> DataFrame:
    """One row per claim whose four keys resolve.

    Years and the report lag come from the raw file and are not derived again after a date swap, unless ``recompute``
    is set; the lag falls back to the date difference where the file has no lag column.
    """
    return _fact_rows(clean, dims, recompute, attributes=False).select(*schemas.FACT_COLUMNS)


ATTRIBUTES = schemas.PROVIDER_COLUMNS + schemas.REGION_COLUMNS + schemas.DIAGNOSIS_COLUMNS + schemas.ROOT_CAUSE_COLUMNS


def derived() -> list[Column]:
    """The derived fields of the summary."""
    return [
        F.round(F.try_divide("paid_amount", "incurred_amount"), 4).alias("loss_ratio"),
        F.round(F.col("reserved_amount") - F.col("paid_amount"), 2).alias("reserve_adequacy"),
        F.date_format("incident_date", "yyyy-MM").alias("incident_month"),
        F.coalesce((F.col("severity_level") >= 4).cast("int"), F.lit(0)).alias("is_high_severity"),
        F.coalesce((F.col("days_to_close") > 365).cast("int"), F.lit(0)).alias("is_long_tail"),
    ]


def claims_summary(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact joined with all dimension attributes and the derived fields."""
    joined = fact
    for key in KEYS:
        joined = joined.join(lookup(dims[key]), key)
    kept = [c for c in schemas.FACT_COLUMNS if c not in KEYS]
    return joined.select(*kept, *ATTRIBUTES, *derived())


def wide_claims(clean: DataFrame, dims: dict[str, DataFrame], recompute: bool = False) -> DataFrame:
    """Fact and summary columns together from one round of lookups: both tables are column subsets of it."""
    rows = _fact_rows(clean, dims, recompute, attributes=True)
    return rows.select(*schemas.FACT_COLUMNS, *ATTRIBUTES, *derived())


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    )
