"""The written warehouse: raw claims, dimensions and one wide claim table in the shared folder.

Fact and summary are column subsets of the wide table, which parquet reads as cheaply as tables of their own, so the
claims go through the dimension lookups once. Every query reads the tables back, so none replays the source joins and a
lost executor costs re-reading a file, not a lineage.

Tables are kept as snapshots. A snapshot is named by its version, a digest of the source files (path, size, time) and of the
code that derives the tables; it goes into a folder of its own, and the index that names its tables is written last. So an
application that finds the version reads it without writing anything, a reload never touches tables that are being read, and
one that fails half-way leaves no snapshot.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import inspect
import json
import sys
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lossmetrics import config
from lossmetrics.functions import columns, distributions, joins
from lossmetrics.plans import cleaning, star
from lossmetrics.plans.cleaning import clean_claims
from lossmetrics.session import shared_dir
from lossmetrics.sources import lookups, schemas, tpch


@dataclasses.dataclass
class Warehouse:
    raw: DataFrame
    sources: dict[str, DataFrame]
    dims: dict[str, DataFrame]
    fact: DataFrame
    summary: DataFrame

    @functools.cached_property
    def clean(self) -> DataFrame:
        return clean_claims(self.raw, measured=True)

    @property
    def tables(self) -> dict[str, DataFrame]:
        named = {key.removesuffix("_key"): df for key, df in self.dims.items()}
        return {**{f"dim_{n}": df for n, df in named.items()}, "fact_claim": self.fact}


_open: dict[tuple[str, str], Warehouse] = {}
#: The index of a snapshot: its tables, where they are and their schemas.
INDEX = "name string, path string, fields string"


def sources_from_tpch(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "providers": tpch.providers(spark, sf_dir),
        "regions": tpch.regions(spark, sf_dir),
        "diagnoses": lookups.diagnoses(spark),
        "root_causes": lookups.root_causes(spark),
    }


def build_dims(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "provider_key": star.dim_provider(sources["providers"]),
        "region_key": star.dim_region(sources["regions"]),
        "diagnosis_key": star.dim_diagnosis(sources["diagnoses"]),
        "root_cause_key": star.dim_root_cause(sources["root_causes"]),
    }


def write_table(df: DataFrame, path: str, partition: str | None = None) -> DataFrame:
    """Full reload of one table, written where its rows lie: a task sorts its own rows by partition and no row is shuffled.

    Claim numbers and amounts fill most of a table, and zstd packs them closer than the default.
    """
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    fields = sorted(df.schema.fields, key=lambda f: f.name == partition)  # a table without rows has no file to take them from
    return df.sparkSession.read.schema(StructType(fields)).parquet(path)


def write_dims(sources: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    return {key: write_table(df, f"{folder}/dim_{key.removesuffix('_key')}") for key, df in build_dims(sources).items()}


def _year_last(claims: DataFrame) -> DataFrame:
    """The columns as a table partitioned by accident year would give them.

    The widest tables are not partitioned: that takes a shuffle or a sort of rows of several hundred bytes, while the year's
    bounds in the parquet footers and the column itself serve the few filters by year.
    """
    return claims.select(*[c for c in claims.columns if c != "accident_year"], "accident_year")


def write_star(
    raw: DataFrame, sources: dict[str, DataFrame], folder: str
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Clean the raw claims and write dimensions, fact and summary as tables of their own, replacing what is there."""
    dims = write_dims(sources, folder)
    fact = write_table(star.fact_claim(clean_claims(raw, measured=True), dims), f"{folder}/fact_claim", "accident_year")
    summary = write_table(_year_last(star.claims_summary(fact, dims)), f"{folder}/claims_summary")
    return dims, fact, summary


def source_version(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = tpch.TABLES) -> str:
    """Digest of the source files' paths, sizes and times, and of the code between them and the tables.

    Only the file list is read; it is summed up in Spark, whatever the number of files.
    """
    listed = [spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir}/{name}.parquet") for name in names]
    files = functools.reduce(DataFrame.union, [df.select("path", "length", "modificationTime") for df in listed])
    mark = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    found = files.agg(F.count(F.lit(1)), F.sum(mark), F.sum("length")).first()
    code = "".join(inspect.getsource(m) for m in (columns, distributions, joins, cleaning, star, lookups, schemas, tpch, config, sys.modules[__name__]))
    return hashlib.sha256(f"{spark.version}{tuple(map(str, found))}{code}".encode()).hexdigest()[:24]


def _snapshot(spark: SparkSession, index: str) -> dict[str, DataFrame]:
    """The tables of an index; none if there is no complete one."""
    try:
        rows = spark.read.schema(INDEX).parquet(index).collect()  # a row per table
    except AnalysisException:
        return {}
    return {r["name"]: spark.read.schema(StructType.fromJson(json.loads(r["fields"]))).parquet(r["path"]) for r in rows}


def _build(spark: SparkSession, sf_dir: str, sources: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    raw = write_table(tpch.raw_claims(spark, sf_dir), f"{folder}/raw_claims")
    dims = write_dims(sources, folder)
    wide = write_table(_year_last(star.wide_claims(clean_claims(raw, measured=True), dims)), f"{folder}/claims_wide")
    return {"raw_claims": raw, "claims_wide": wide, **{f"dim_{key.removesuffix('_key')}": df for key, df in dims.items()}}


def open_warehouse(spark: SparkSession, sf_dir: str, refresh: bool = False, rebuild: bool = False) -> Warehouse:
    """The warehouse over the tables of ``sf_dir``: the snapshot of their present version, written if there is none.

    An application looks at the source files once, and again with ``refresh``; ``rebuild`` writes a new snapshot
    even if there is one. Earlier snapshots stay until they are removed.
    """
    handle = (spark.sparkContext.applicationId, sf_dir)
    if handle not in _open or refresh or rebuild:
        folder = f"{shared_dir(spark)}/lossmetrics/{hashlib.sha1(sf_dir.encode()).hexdigest()[:12]}"
        version = source_version(spark, sf_dir)
        index = f"{folder}/{version}.index"
        sources = sources_from_tpch(spark, sf_dir)
        tables = {} if rebuild else _snapshot(spark, index)
        if not tables:
            own = f"{folder}/{version}-{uuid.uuid4().hex}"
            tables = _build(spark, sf_dir, sources, own)
            rows = [(name, f"{own}/{name}", df.schema.json()) for name, df in tables.items()]
            spark.createDataFrame(rows, INDEX).coalesce(1).write.mode("overwrite").parquet(index)
        dims = {key: tables[f"dim_{key.removesuffix('_key')}"] for key in build_dims(sources)}
        wide = tables["claims_wide"]
        _open[handle] = Warehouse(tables["raw_claims"], sources, dims, wide.select(*schemas.FACT_COLUMNS), wide.drop(*star.KEYS))
    return _open[handle]
