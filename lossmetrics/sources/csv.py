"""CSV readers: raw claim folders and cleaned dimension files."""

from __future__ import annotations

import csv as _csv
from collections import defaultdict
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lossmetrics.functions.distributions import union_all
from lossmetrics.sources import schemas


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


#: Options of every read: quotes are doubled inside quotes, and only an empty field is null.
OPTIONS = {"header": True, "mode": "PERMISSIVE", "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"'}
#: Column that holds a row with more or fewer fields than its file's header, whole.
MALFORMED = "_corrupt_record"


def part_headers(spark: SparkSession, path: str) -> dict[str, tuple[str, ...]]:
    """The header of every part of a CSV file or folder; parts without a line are left out.

    The driver reads one line per part, many parts at a time.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(conf)
    hidden = lambda name: name.startswith(("_", "."))
    files = [f.getPath() for f in system.listStatus(root) if f.isFile() and f.getLen() and (f.getPath().equals(root) or not hidden(f.getPath().getName()))]
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(file) -> tuple[str, ...]:
        stream, codec = system.open(file), codecs.getCodec(file)
        try:
            text = codec.createInputStream(stream) if codec is not None else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
        finally:
            stream.close()
        return tuple(next(_csv.reader([line.lstrip("\ufeff")]), ())) if line else ()

    with ThreadPool(16) as pool:
        found = zip((f.toString() for f in files), pool.map(header, files))
        return {name: columns for name, columns in found if columns}


def read_parts(spark: SparkSession, path: str, schema, multiline: bool = False, keep_malformed: bool = False) -> DataFrame:
    """The columns of ``schema`` as text, from a CSV file or a folder of parts.

    Columns are matched by the header of their own part: the order may differ from part to part, unknown columns are left
    out, missing ones are null; of two columns of one name the first counts. Parts with the same header are read
    together. A file is read by as many tasks as it has splits; fields with line breaks need ``multiline``, which costs one
    task per file. ``keep_malformed`` adds a column with the whole row where a row's fields do not fit its header.
    """
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for name, header in part_headers(spark, path).items():
        groups[header].append(name)
    frames = []
    for header, files in groups.items():
        fields = [StructField(f"c{k}", StringType()) for k in range(len(header))]
        if keep_malformed:
            fields.append(StructField(MALFORMED, StringType()))
        reader = spark.read.schema(StructType(fields)).options(**OPTIONS, multiLine=multiline, columnNameOfCorruptRecord=MALFORMED, columnPruning=not keep_malformed)
        found = reader.csv(files)
        place = {c: k for k, c in reversed(list(enumerate(header)))}
        columns = [F.col(f"c{place[c]}").alias(c) if c in place else F.lit(None).cast("string").alias(c) for c in schema.names]
        frames.append(found.select(*columns, *([MALFORMED] if keep_malformed else [])))
    if not frames:
        names = [*schema.names, *([MALFORMED] if keep_malformed else [])]
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in names]))
    return union_all(frames)


def malformed(spark: SparkSession, path: str, schema, multiline: bool = False) -> DataFrame:
    """The rows of a file or folder whose fields do not fit the header of their part, with the whole row as ``_corrupt_record``."""
    return read_parts(spark, path, schema, multiline, keep_malformed=True).where(F.col(MALFORMED).isNotNull())


def read_claims(spark: SparkSession, folder: str, multiline: bool = False) -> DataFrame:
    """``claims.csv`` (a file or a folder of parts) of a raw folder, every column as text."""
    path = f"{folder.rstrip('/')}/claims.csv"
    if not _exists(spark, path):
        raise FileNotFoundError(f"claims.csv not found in {folder}")
    return read_parts(spark, path, schemas.raw_claims_schema(), multiline)


def read_dimension(spark: SparkSession, folder: str, name: str, multiline: bool = False) -> DataFrame:
    """One of providers, regions, diagnoses, root_causes as text; only an empty field is null."""
    path = f"{folder.rstrip('/')}/{name}.csv"
    if not _exists(spark, path):
        raise FileNotFoundError(f"{name}.csv not found in {folder}")
    return read_parts(spark, path, schemas.raw_dimension_schema(name), multiline)


def read_folder(spark: SparkSession, folder: str, multiline: bool = False) -> dict[str, DataFrame]:
    """All raw tables of a folder: the mandatory claims and the dimensions that are present."""
    frames = {"claims": read_claims(spark, folder, multiline)}
    for name in schemas.RAW_DIMENSIONS:
        if _exists(spark, f"{folder.rstrip('/')}/{name}.csv"):
            frames[name] = read_dimension(spark, folder, name, multiline)
    return frames
