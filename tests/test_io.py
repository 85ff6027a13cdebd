import glob
import gzip
from pathlib import Path

import pytest

from lossmetrics.operators import extracts
from lossmetrics.plans import cleaning
from lossmetrics.sources import csv, schemas, sinks


def read(spark, path):
    return spark.read.option("header", True).csv(path)


def test_claims_are_mandatory(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv.read_claims(spark, str(tmp_path))


def test_raw_folder(spark, tmp_path):
    (tmp_path / "claims.csv").write_text("paid_amount,claim_id,severity,state_code\n-5,A,three,ny\n,B,,\n", encoding="utf-8")
    (tmp_path / "providers.csv").write_text("provider_id,specialty_id,specialty_name,department,risk_tier\n007,SP1,NA,,low\n", encoding="utf-8")
    frames = csv.read_folder(spark, str(tmp_path))
    assert set(frames) == {"claims", "providers"}
    rows = frames["claims"].orderBy("claim_id").collect()
    assert rows[0]["claim_id"] == "A" and rows[0]["paid_amount"] == "-5" and rows[1]["paid_amount"] is None
    provider = frames["providers"].first()
    assert (provider["provider_id"], provider["specialty_name"], provider["department"]) == ("007", "NA", None)


def test_columns_are_bound_by_name(spark, tmp_path):
    """An unknown column is left out, a missing one is null, order does not matter, and quotes are doubled."""
    (tmp_path / "claims.csv").write_text(
        'severity,notes,paid_amount,claim_id,claim_type\n2.7,hello,5,A,"a ""b"", c\nd"\n1e12,"x,y",6,B,\n', encoding="utf-8"
    )
    rows = csv.read_claims(spark, str(tmp_path), multiline=True).orderBy("claim_id").collect()
    assert [(r["claim_id"], r["paid_amount"], r["severity"], r["claim_type"]) for r in rows] == [("A", "5", "2.7", 'a "b", c\nd'), ("B", "6", "1e12", None)]
    assert rows[0]["incident_date"] is None and "notes" not in rows[0].asDict()
    clean = {r["claim_id"]: r for r in cleaning.clean_claims(csv.read_claims(spark, str(tmp_path), multiline=True)).collect()}
    assert clean["A"]["severity"] is None and clean["B"]["severity"] is None


def test_parts_have_headers_of_their_own(spark, tmp_path):
    """Reordered, missing, unknown and repeated columns, a mark, an empty part and a compressed one."""
    folder = tmp_path / "claims.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("claim_id,severity,paid_amount\nA,4,20.5\n", encoding="utf-8")
    (folder / "b.csv").write_text("\ufeffclaim_id,paid_amount,severity\nB,20.5,4\n", encoding="utf-8")
    (folder / "c.csv").write_text('state_code,"claim_id",other,state_code\nNY,C,x,TX\n', encoding="utf-8")
    (folder / "d.csv").write_text("", encoding="utf-8")
    (folder / "_SUCCESS").write_text("", encoding="utf-8")
    (folder / ".hidden.csv").write_text("claim_id\nno\n", encoding="utf-8")
    with gzip.open(folder / "e.csv.gz", "wt", encoding="utf-8") as f:
        f.write("severity,claim_id\n2,E\n")
    rows = csv.read_claims(spark, str(tmp_path)).orderBy("claim_id").collect()
    found = [(r["claim_id"], r["severity"], r["paid_amount"], r["state_code"]) for r in rows]
    assert found == [("A", "4", "20.5", None), ("B", "4", "20.5", None), ("C", None, None, "NY"), ("E", "2", None, None)]


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    with open(tmp_path / "claims.csv", "w", encoding="utf-8") as f:
        f.write("claim_id,severity\n")
        f.writelines(f"C{k},{k % 5}\n" for k in range(200_000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        claims = csv.read_claims(spark, str(tmp_path))
        assert claims.rdd.getNumPartitions() > 4
        assert claims.count() == 200_000 and claims.where("claim_id is null or claim_id = 'claim_id'").count() == 0
        assert csv.read_claims(spark, str(tmp_path), multiline=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_malformed_rows_are_named(spark, tmp_path):
    path = tmp_path / "claims.csv"
    path.write_text("claim_id,severity\nA,1\nB\nC,1,2,3\nD,2\n", encoding="utf-8")
    found = {r["_corrupt_record"] for r in csv.malformed(spark, str(path), schemas.raw_claims_schema()).collect()}
    assert found == {"B", "C,1,2,3"}
    assert csv.read_claims(spark, str(tmp_path)).count() == 4


def test_empty_folder_of_claims(spark, tmp_path):
    (tmp_path / "claims.csv").mkdir()
    claims = csv.read_claims(spark, str(tmp_path))
    assert claims.count() == 0 and claims.columns == schemas.raw_claims_schema().names


def test_quotes_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "no", then\nleave'), ("2", "back\\slash"), ("3", None)], "claim_id string, claim_type string")
    sinks.write_csv(df, f"{tmp_path}/claims.csv")
    back = {r["claim_id"]: r["claim_type"] for r in csv.read_claims(spark, str(tmp_path), multiline=True).collect()}
    assert back == {"1": 'say "no", then\nleave', "2": "back\\slash", "3": None}


def test_round_trip_cleans_to_the_same_rows(spark, dirty_28, tmp_path):
    sinks.write_csv(dirty_28, f"{tmp_path}/claims.csv")
    back = csv.read_claims(spark, str(tmp_path))
    assert sorted(map(str, cleaning.clean_claims(back).collect())) == sorted(map(str, cleaning.clean_claims(dirty_28).collect()))


def test_exports(spark, make_claims, tmp_path):
    claims = make_claims([{"severity_level": s, "development_year": d} for s, d in [(1, 0), (2, 1), (2, 1)]])
    paths = sinks.export_all(claims, str(tmp_path))
    assert len(paths) == 9
    detail = read(spark, f"{tmp_path}/claims_detail.csv")
    assert detail.count() == 3 and detail.columns[0].lstrip("﻿") == "claim_id"
    with open(glob.glob(f"{tmp_path}/claims_detail.csv/part-*.csv")[0], "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    assert "_month" not in detail.columns
    triangle = read(spark, f"{tmp_path}/loss_triangle.csv").first()
    assert triangle["dev_0"] == "100.0" and triangle["dev_1"] == "300.0"
    assert read(spark, f"{tmp_path}/monthly_metrics.csv").first()["claim_count"] == "3"
    assert set(extracts.sheets(claims)) == {"claims_detail", "monthly_summary", "severity_analysis", "provider_scorecard", "regional_summary"}


def test_report(spark, dirty_28, tmp_path):
    text = sinks.quality_report(dirty_28, cleaning.clean_claims(dirty_28), "2024-01-01 00:00:00", 1.5)
    assert "- Total records examined: 31" in text and "### Swapped Dates" in text
    assert "- Action: Mapped text labels to integers 1-5" in text and "| **Total** | **" in text
    assert "## Numeric Column Ranges (After Cleaning)" in text and "## Before/After Comparison" in text
    assert "## Column Null Counts (After Cleaning)" in text and "| paid_amount | 1.00 | 5,000,000.00 |" in text
    sinks.write_report(dirty_28, text, f"{tmp_path}/report.md")
    assert "\n".join(r[0] for r in spark.read.text(f"{tmp_path}/report.md").collect()) == text


def test_anomaly_and_operation_columns(make_claims):
    from pyspark.sql import functions as F

    scored = make_claims([{}, {}]).withColumns({"anomaly_score": F.lit(-0.1), "is_anomaly": F.col("claim_id") == "C1"})
    assert [r["claim_id"] for r in extracts.anomalies(scored).collect()] == ["C1"]
    assert extracts.anomalies(scored).columns == extracts.ANOMALY_COLUMNS
    assert extracts.operations(scored).columns == extracts.OPS_COLUMNS
    assert set(extracts.OPS_COLUMNS) <= set(schemas.summary_schema().names)


def test_packed_csv_reads_back_whole(spark, tmp_path):
    df = spark.range(0, 2000, 1, 3).selectExpr("concat('C', id) as claim_id", "if(id % 7 = 0, null, 'a, \"b\"') as status")
    plain = sinks.write_csv(df, f"{tmp_path}/plain", bom=True)
    packed = sinks.write_csv(df, f"{tmp_path}/packed", bom=True, compression="gzip")
    size = lambda path: sum(f.stat().st_size for f in Path(path).glob("part-*"))
    assert len(list(Path(packed).glob("part-*.csv.gz"))) == 3 and size(packed) * 3 < size(plain)
    assert sorted(map(str, sinks.read_back(spark, packed, df).collect())) == sorted(map(str, df.collect()))
