"""Severity model inputs: valid claims, feature table, vector assembly, exact stratified parts and class weights."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics import config

CATEGORIES = ["claim_type", "specialty_group", "region", "patient_age_band"]
NUMBERS = ["log_paid_amount", "days_to_report", "litigation_flag", "repeat_event_flag"]
TOP_SPECIALTIES = 10


def valid_claims(claims: DataFrame) -> DataFrame:
    """Closed claims with a severity from 1 to 5."""
    return claims.where((F.lower("status") == "closed") & F.col("severity_level").between(1, 5))


def top_specialties(claims: DataFrame, k: int = TOP_SPECIALTIES) -> DataFrame:
    counts = claims.where(F.col("specialty").isNotNull()).groupBy("specialty").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "specialty").limit(k).select("specialty")


def feature_table(valid: DataFrame) -> DataFrame:
    """One row per claim: label, four categories (specialties beyond the top ten are "other") and four numbers."""
    top = top_specialties(valid).withColumn("specialty_group", F.col("specialty"))
    joined = valid.join(F.broadcast(top), "specialty", "left")  # at most ten rows
    paid = F.greatest(F.coalesce("paid_amount", F.lit(0.0)), F.lit(0.0))
    return joined.select(
        "claim_id",
        "severity_level",
        "claim_type",
        F.coalesce("specialty_group", F.lit("other")).alias("specialty_group"),
        "region",
        "patient_age_band",
        F.log1p(paid).alias("log_paid_amount"),
        F.coalesce("days_to_report", F.lit(0)).cast("double").alias("days_to_report"),
        F.coalesce("litigation_flag", F.lit(0)).cast("double").alias("litigation_flag"),
        F.coalesce("repeat_event_flag", F.lit(0)).cast("double").alias("repeat_event_flag"),
    )


def assembler() -> Pipeline:
    """One-hot categories and numbers, scaled into ``features``; they are not centred, so one-hot vectors stay sparse.

    The indexer keeps an extra last level for null and unseen values and the encoder drops that one only, so every real
    level has a column and an unknown value is all zeros.
    """
    indexed = [f"{c}_index" for c in CATEGORIES]
    encoded = [f"{c}_" for c in CATEGORIES]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=CATEGORIES, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
            VectorAssembler(inputCols=[*encoded, *NUMBERS], outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=False, withStd=True),
        ]
    )


def labelled(features: DataFrame) -> DataFrame:
    """Labels 0..4 for severities 1..5."""
    return features.withColumn("label", (F.col("severity_level") - 1).cast("double"))


_SLICES = 4096


def stratified_parts(
    df: DataFrame, label: str, row_id: str, fractions: list[float], seed: int = config.SEED, column: str = "part"
) -> DataFrame:
    """Assign each row to a part so that every class is divided in the given fractions, to the row.

    Rows are ordered by a hash of their id. Ranking a class as a whole would sort a third of the table in one task:
    counts per hash slice give the slice in which each cut falls, and only the rows of those slices are ranked.
    """
    digest = F.xxhash64(F.lit(seed), row_id)
    hashed = df.withColumn("_hash", digest).withColumn("_slice", F.pmod("_hash", F.lit(_SLICES)))
    counts = hashed.groupBy(label, "_slice").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(label).orderBy("_slice")  # at most 4,096 rows per class
    placed = counts.select(
        label,
        "_slice",
        F.sum("n").over(order).alias("upto"),
        "n",
        F.sum("n").over(Window.partitionBy(label)).alias("total"),
    )
    edges, share = [], 0.0
    for fraction in fractions[:-1]:
        share += fraction
        edges.append(F.lit(round(share, 12)))
    cuts = (
        placed.withColumn("cut", F.explode(F.array(*[F.ceil(F.round(F.col("total") * e, 6)) for e in edges])))
        .where((F.col("cut") > F.col("upto") - F.col("n")) & (F.col("cut") <= F.col("upto")))
        .groupBy(label)
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("cut", F.col("_slice").alias("slice"), (F.col("upto") - F.col("n")).alias("before"))
                )
            ).alias("_cuts")
        )
    )
    joined = hashed.join(F.broadcast(cuts), label, "left")  # one row per class
    here = F.filter("_cuts", lambda c: c["slice"] == F.col("_slice"))
    on_edge = F.coalesce(F.size(here) > 0, F.lit(False))
    passed = F.size(F.filter("_cuts", lambda c: c["slice"] < F.col("_slice")))
    sure = joined.where(~on_edge).withColumn(column, F.coalesce(passed, F.lit(0)).cast("int"))
    rank = F.row_number().over(Window.partitionBy(label, "_slice").orderBy("_hash", row_id)) + here[0]["before"]
    edge = joined.where(on_edge).withColumn("_rank", rank)
    edge = edge.withColumn(column, F.size(F.filter("_cuts", lambda c: c["cut"] < F.col("_rank"))).cast("int"))
    kept = [*df.columns, column]
    # The ranked rows are a few slices: as many tasks as cores hold them, not one per shuffle partition.
    return sure.select(*kept).unionByName(edge.select(*kept).coalesce(max(1, df.sparkSession.sparkContext.defaultParallelism)))


def split(features: DataFrame, test_size: float = 0.2, seed: int = config.SEED) -> tuple[DataFrame, DataFrame]:
    """Stratified train and test rows."""
    parts = stratified_parts(features, "severity_level", "claim_id", [test_size, 1 - test_size], seed)
    return parts.where("part = 1").drop("part"), parts.where("part = 0").drop("part")


#: Rows of a class and hash slice are counted in this many slices of the hash.
_CUT_SLICES = 1 << 16


def bounded(rows: DataFrame, fit_rows: int | None, seed: int = config.SEED, label: str = "severity_level", row_id: str = "claim_id") -> DataFrame:
    """At most about ``fit_rows`` rows, every class in its share, chosen by a hash of the claim id; all rows for None.

    Threshold sampling: rows are counted by class and slice of the hash, which gives each class the slice up to which its
    share reaches; every task then keeps the rows below that cut, and only these are shuffled. The last slice is kept whole, so
    a class may have a few rows more than its share and has at least one.
    """
    if fit_rows is None:
        return rows
    cut = F.pmod(F.xxhash64(F.lit(seed + 1), F.lit("cut"), row_id), F.lit(_CUT_SLICES)).cast("int")
    counts = rows.groupBy(label, cut.alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(label).orderBy("slice"))  # at most 65,536 rows per class
    placed = counts.select(label, "slice", "n", upto.alias("upto"), F.sum("n").over(Window.partitionBy(label)).alias("class_rows"))
    whole = counts.agg(F.sum("n").alias("rows"))  # one row
    wanted = F.ceil(F.least(F.lit(1.0), F.lit(float(fit_rows)) / F.col("rows")) * F.col("class_rows"))
    cuts = placed.join(F.broadcast(whole)).where(F.col("upto") - F.col("n") < wanted).groupBy(label).agg(F.max("slice").alias("_last"))
    parts = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, fit_rows // 1000))
    kept = rows.join(F.broadcast(cuts), label).where(cut <= F.col("_last"))  # one row per class
    return kept.select(*rows.columns).repartition(parts, row_id)


def with_class_weights(rows: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: rows / (classes x rows of the class)."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # one row per class
    weights = counts.select(
        label, (F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))).alias("weight")
    )
    return rows.join(F.broadcast(weights), label)
