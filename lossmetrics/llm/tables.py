"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from lossmetrics.session import shared_dir


def folder(df: DataFrame, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table read back: lineage ends here, and Spark knows the table's size when it plans a join."""
    path = folder(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
