"""Session helpers: a local session for tests and benchmarks, and the shared folder for written tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "lossmetrics", **conf) -> SparkSession:
    """A local session with the settings the operators expect (UTC, AQE, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # Written tables are rebalanced to this size; the cluster default (64 MB) would leave most local cores idle.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        # Small row groups, so that a small file is still read by all cores.
        .config("spark.hadoop.parquet.block.size", str(4 << 20))
        .config("spark.driver.memory", os.environ.get("LOSSMETRICS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session, where driver and executors share one
    machine, falls back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = sc.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="lossmetrics-")
        sc.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]
