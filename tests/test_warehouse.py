"""Snapshots of the warehouse: reuse by a later application, reload beside readers, incomplete ones."""

import hashlib
import os
import shutil

import pytest

from lossmetrics.plans import warehouse
from lossmetrics.session import shared_dir
from lossmetrics.sources import tpch

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def folders(spark, sf_dir):
    """Snapshots and indexes of one source folder."""
    base = f"{shared_dir(spark)}/lossmetrics/{hashlib.sha1(sf_dir.encode()).hexdigest()[:12]}"
    return set(os.listdir(base)) if os.path.isdir(base) else set()


@pytest.fixture
def sf_dir(tmp_path):
    for name in tpch.TABLES:
        shutil.copyfile(f"{SF}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_snapshot_is_reused_and_reloaded(spark, sf_dir):
    before = folders(spark, sf_dir)
    first = warehouse.open_warehouse(spark, sf_dir)
    made = folders(spark, sf_dir) - before
    assert len(made) == 2  # tables and index
    rows = sorted(first.summary.collect())

    # Another application finds the snapshot and writes nothing.
    del warehouse._open[spark.sparkContext.applicationId, sf_dir]
    again = warehouse.open_warehouse(spark, sf_dir)
    assert again is not first and folders(spark, sf_dir) - before == made
    assert sorted(again.summary.collect()) == rows and again.summary.schema == first.summary.schema
    assert again.raw.count() == first.raw.count() and again.fact.columns == first.fact.columns

    # New source rows: an open reader keeps its rows, a refresh sees the new ones.
    half = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey % 2 = 0")
    os.remove(f"{sf_dir}/lineitem.parquet")
    half.write.parquet(f"{sf_dir}/lineitem.parquet")
    assert warehouse.open_warehouse(spark, sf_dir) is again
    newer = warehouse.open_warehouse(spark, sf_dir, refresh=True)
    assert 0 < newer.raw.count() < first.raw.count()
    assert sorted(first.summary.collect()) == rows and len(folders(spark, sf_dir) - before) == 4


def test_incomplete_snapshot_is_built_again(spark, sf_dir, monkeypatch):
    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "write_dims", broken)
        with pytest.raises(OSError):
            warehouse.open_warehouse(spark, sf_dir)
    assert (spark.sparkContext.applicationId, sf_dir) not in warehouse._open
    assert warehouse.open_warehouse(spark, sf_dir).summary.count() > 0


def test_wide_claims_are_written_without_a_shuffle_of_their_rows(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).selectExpr("id", "cast(id % 3 + 2000 as int) as accident_year")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("partitioned-write", "write")
    back = warehouse.write_table(df, f"{tmp_path}/t", "accident_year")
    jobs = tracker.getJobIdsForGroup("partitioned-write")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [len(tracker.getJobInfo(job).stageIds) for job in jobs] == [1]
    assert back.columns == ["id", "accident_year"] and back.count() == 4000
    assert warehouse._year_last(back.select("accident_year", "id")).columns == ["id", "accident_year"]
