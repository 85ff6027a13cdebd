import datetime

import pytest

from lossmetrics.operators import quality
from lossmetrics.plans import cleaning, star, warehouse
from lossmetrics.sources import schemas

D = datetime.date


@pytest.fixture(scope="module")
def built(make_raw, star_sources):
    raw = make_raw(
        [
            {},
            {"status": "open", "close_date": None, "litigation_flag": None, "report_lag_days": None},
            {"provider_id": "PRV9"},
            {"state_code": "zz", "diagnosis_id": None},
            {"diagnosis_id": None, "close_date": "2025-01-01"},
            {"incident_date": "2023-07-20", "report_date": "2023-06-15", "report_lag_days": "99", "incurred_amount": "0"},
        ]
    )
    clean = cleaning.clean_claims(raw)
    dims = warehouse.build_dims(star_sources)
    return clean, dims


def test_dimensions(built):
    _, dims = built
    assert dims["diagnosis_key"].count() == 21
    unknown = dims["diagnosis_key"].where("diagnosis_code = 'UNKNOWN'").first()
    assert unknown["diagnosis_category"] == "Unknown" and unknown["severity_weight"] == 1.0
    assert {r["provider_name"] for r in dims["provider_key"].collect()} == {"Provider PRV1", "Provider PRV2"}
    assert "volume_multiplier" not in dims["region_key"].columns


def test_unknown_is_not_added_twice(spark, star_sources):
    have = star_sources["diagnoses"].unionByName(
        spark.sql("SELECT 'UNKNOWN' diagnosis_id, 'x' code, 'Mine' category, 2.0D severity_weight")
    )
    rows = star.dim_diagnosis(have).where("diagnosis_code = 'UNKNOWN'").collect()
    assert [r["diagnosis_category"] for r in rows] == ["Mine"]


def test_sliced_keys_equal_plain_keys(spark):
    dim = spark.range(3000).selectExpr("concat('P', id) AS provider_id")
    sliced = {r[1]: r[0] for r in star.with_surrogate_key(dim, "provider_id", "k").collect()}
    plain = {r[1]: r[0] for r in star.with_surrogate_key(dim, "provider_id", "k", code_list=True).collect()}
    assert sliced == plain and sorted(sliced.values()) == list(range(1, 3001))


def test_fact_drops_unmapped_and_counts_them(built, as_dict):
    clean, dims = built
    fact = star.fact_claim(clean, dims)
    assert fact.columns == schemas.FACT_COLUMNS and fact.count() == 4
    lost = {k: v["unmapped"] for k, v in as_dict(star.unmapped_counts(clean, dims), "dimension").items()}
    assert lost == {"provider": 1, "region": 1, "diagnosis": 0, "root_cause": 0, "dropped_rows": 2}


def test_fact_measures(built, as_dict):
    clean, dims = built
    rows = as_dict(star.fact_claim(clean, dims), "claim_id")
    assert rows["CLM0"]["days_to_close"] == 92 and rows["CLM0"]["days_to_report"] == 5
    assert rows["CLM1"]["days_to_close"] is None and rows["CLM1"]["days_to_report"] == 0 and rows["CLM1"]["litigation_flag"] == 0
    assert rows["CLM5"]["days_to_report"] == 99  # not derived again after the swap
    again = as_dict(star.fact_claim(clean, dims, recompute=True), "claim_id")
    assert again["CLM5"]["days_to_report"] == 35


def test_summary(built, as_dict):
    clean, dims = built
    summary = star.claims_summary(star.fact_claim(clean, dims), dims)
    assert set(summary.columns) == set(schemas.summary_schema().names)
    rows = as_dict(summary, "claim_id")
    assert rows["CLM0"]["loss_ratio"] == 0.8333 and rows["CLM0"]["incident_month"] == "2023-06"
    assert rows["CLM5"]["loss_ratio"] is None
    assert rows["CLM4"]["is_long_tail"] == 1 and rows["CLM1"]["is_long_tail"] == 0
    assert rows["CLM4"]["diagnosis_code"] == "UNKNOWN"


def test_constraints_and_audit(built, as_dict):
    clean, dims = built
    fact = star.fact_claim(clean, dims)
    broken = fact.unionByName(fact.where("claim_id = 'CLM0'").selectExpr(
        "* except (provider_key, paid_amount)", "cast(99 as bigint) AS provider_key", "-1.0D AS paid_amount"))
    checks = {k: v["violations"] for k, v in as_dict(quality.constraint_violations(broken, dims), "constraint_name").items()}
    assert checks["pk_claim_id"] == 2 and checks["fk_provider_key"] == 1 and checks["ck_paid_non_negative"] == 1
    audit = {k: v["result"] for k, v in as_dict(quality.audit(broken, dims, D(2030, 1, 1)), "check_name").items()}
    assert len(audit) == 18 and audit["Total rows"] == 5 and audit["Orphan provider keys"] == 1
    assert audit["Paid > Incurred"] == 1 and audit["NULL close_date"] == 1


def test_written_star_reloads(spark, make_raw, star_sources, tmp_path):
    raw = make_raw([{}, {"accident_year": "2022"}])
    for _ in range(2):  # a reload replaces what is there
        dims, fact, summary = warehouse.write_star(raw, star_sources, str(tmp_path))
    assert fact.count() == 2 and summary.count() == 2
    assert {p.name for p in (tmp_path / "fact_claim").glob("accident_year=*")} == {"accident_year=2022", "accident_year=2023"}
    counts = {r[0]: r[1] for r in star.row_counts({"fact_claim": fact, "dim_region": dims["region_key"]}).collect()}
    assert counts == {"fact_claim": 2, "dim_region": 1}


def test_wide_table_holds_fact_and_summary(built):
    clean, dims = built
    wide = star.wide_claims(clean, dims)
    fact = star.fact_claim(clean, dims)
    assert sorted(map(str, wide.select(*schemas.FACT_COLUMNS).collect())) == sorted(map(str, fact.collect()))
    summary = star.claims_summary(fact, dims)
    assert sorted(map(str, wide.select(*summary.columns).collect())) == sorted(map(str, summary.collect()))


def test_claims_are_shuffled_for_orders_alone(spark, star_sources, make_raw, tmp_path, capsys):
    """A lookup side beyond Spark's own limit moves no claims, up to a counted bound."""
    from lossmetrics.functions.joins import lookup
    from lossmetrics.sources import tpch

    day = "TIMESTAMP'2023-01-05'"
    rows = {
        "lineitem": f"1L l_orderkey, 2L l_partkey, 3L l_suppkey, 1 l_linenumber, 50D l_quantity, 10D l_extendedprice, 0.5D l_discount, 0.1D l_tax, 'R' l_returnflag, 'O' l_linestatus, {day} l_shipdate",
        "orders": f"1L o_orderkey, 97L o_custkey, 'F' o_orderstatus, {day} o_orderdate",
        "part": "2L p_partkey, 7 p_size",
        "supplier": "3L s_suppkey, 0 s_nationkey",
        "nation": "0 n_nationkey, 'N' n_name, 0 n_regionkey",
        "region": "0 r_regionkey, 'R' r_name",
    }
    for name, columns in rows.items():
        spark.sql(f"SELECT {columns}").write.parquet(f"{tmp_path}/{name}.parquet")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        raw = tpch.raw_claims(spark, str(tmp_path)).select("claim_id", "paid_amount", "severity", "patient_age")
        assert [tuple(r) for r in raw.collect()] == [("1-1-2-3-2023-01-05", 5000.0, "3", 1)]
        raw.explain()
        plan = capsys.readouterr().out
        assert "BroadcastHashJoin [l_partkey" in plan and "BroadcastHashJoin [l_suppkey" in plan and "SortMergeJoin [l_orderkey" in plan
        star.keyed_claims(cleaning.clean_claims(make_raw([{}])), warehouse.build_dims(star_sources)).explain()
        plan = capsys.readouterr().out
        assert "BroadcastHashJoin [provider_id" in plan and "SortMergeJoin [provider_id" not in plan
        side = spark.range(3)
        spark.range(9).join(lookup(side, cells=2), "id").explain()
        assert "SortMergeJoin" in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
