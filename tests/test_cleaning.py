import datetime

import pytest

from lossmetrics.operators import quality
from lossmetrics.plans import cleaning

D = datetime.date


def counts(df):
    return {r["category"]: r["issue_count"] for r in df.groupBy("category").agg({"issue_count": "sum"}).withColumnRenamed("sum(issue_count)", "issue_count").collect()}


def test_issue_counts(dirty_28):
    found = counts(quality.issues(dirty_28, D(2023, 6, 30)))
    assert found == {
        "Negative Paid Amounts": 6,
        "Mixed-Case State Codes": 6,
        "Text Severity Values": 5,
        "Swapped Dates": 5,
        "Null Diagnosis Codes": 6,
        "Extreme Outliers": 3,
        "Duplicate Claim IDs": 2,
        "Future Dates": 30,  # close dates of all rows but the one without
    }


def test_single_checks_agree_with_table(dirty_28):
    for name in list(quality.CHECKS)[:7]:
        category, n = quality.check_count(dirty_28, name).first()
        assert counts(quality.issues(dirty_28)).get(category, 0) == n


def test_severity_words_and_unknown(dirty_28):
    rows = cleaning.numeric_severity(dirty_28).orderBy("claim_id").collect()
    by_id = {r["claim_id"]: r["severity"] for r in rows}
    assert [by_id[f"CLM{i}"] for i in range(10, 15)] == [1, 2, 3, 4, None]


def test_swap_moves_only_reversed_dates(make_raw):
    raw = make_raw([{"incident_date": "2023-02-02", "report_date": "2023-01-01"}, {"report_date": None}, {"report_date": "bad"}])
    rows = cleaning.ordered_dates(raw).orderBy("claim_id").collect()
    assert (rows[0]["incident_date"], rows[0]["report_date"]) == (D(2023, 1, 1), D(2023, 2, 2))
    assert rows[1]["incident_date"] == D(2023, 6, 15) and rows[1]["report_date"] is None
    assert rows[2]["report_date"] is None


def test_cap_keeps_sign(make_raw):
    raw = make_raw([{"paid_amount": "-9000000"}, {"paid_amount": "5000000"}, {"paid_amount": "x"}])
    assert [r["paid_amount"] for r in cleaning.capped_paid(raw).orderBy("claim_id").collect()] == [-5e6, 5e6, None]


def test_types_coerce(make_raw):
    raw = make_raw([{"patient_age": "40.0", "incident_date": "never", "incurred_amount": "abc", "litigation_flag": ""}])
    row = cleaning.typed(raw).first()
    assert row["patient_age"] == 40 and row["incident_date"] is None and row["incurred_amount"] is None
    assert row["litigation_flag"] is None


@pytest.mark.parametrize("measured", [False, True])
def test_clean_claims(dirty_28, measured):
    clean = cleaning.clean_claims(dirty_28, measured=measured)
    rows = clean.collect()
    assert len(rows) == 30  # only the full copy is gone
    assert sum(r["claim_id"] == "CLM0" for r in rows) == 1 and sum(r["claim_id"] == "CLM5" for r in rows) == 2
    after = counts(quality.issues(clean, D(2030, 1, 1)))
    assert after == {"Duplicate Claim IDs": 1}
    assert max(r["paid_amount"] or 0 for r in rows) == 5e6


def test_measured_removal_without_broadcast(spark, dirty_28):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = cleaning.without_copies_measured(dirty_28)
        assert sorted(map(str, found.collect())) == sorted(map(str, cleaning.without_copies(dirty_28).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_severity_of_fractions_and_large_numbers(spark):
    df = spark.createDataFrame([("3",), ("2.7",), ("1e12",), ("4.0",), ("five",), ("x",)], "severity string")
    assert [r[0] for r in df.select(cleaning.severity_number("severity")).collect()] == [3, None, None, 4, 5, None]


def test_measured_removal_with_null_ids_and_hot_copies(make_raw):
    raw = make_raw([{"claim_id": None}] * 4 + [{"claim_id": "hot"}] * 40 + [{"claim_id": "one"}])
    assert cleaning.without_copies_measured(raw).count() == 3


def test_cleaning_clean_data_changes_nothing(dirty_28):
    once = cleaning.clean_claims(dirty_28)
    assert sorted(map(str, cleaning.clean_claims(once).collect())) == sorted(map(str, once.collect()))


def test_comparison_totals(dirty_28, as_dict):
    table = as_dict(quality.comparison(dirty_28, cleaning.clean_claims(dirty_28), D(2030, 1, 1)), "category")
    once = counts(quality.issues(dirty_28, one_pass=True))
    assert once == counts(quality.issues(dirty_28))
    assert table["Total"]["before"] == 33 and table["Total"]["after"] == 1 and table["Total"]["resolved"] == 32
    assert table["Duplicate Claim IDs"]["resolved"] == 1


def test_null_counts_and_ranges(dirty_28, as_dict):
    clean = cleaning.clean_claims(dirty_28)
    nulls = as_dict(quality.null_counts(clean), "column_name")
    assert nulls["close_date"]["null_count"] == 1 and nulls["diagnosis_id"]["null_count"] == 0
    ranges = as_dict(quality.numeric_ranges(clean), "column_name")
    assert ranges["paid_amount"]["max_value"] == 5e6 and "state_code" not in ranges


def test_profile_exact_and_sketched(make_claims, as_dict):
    claims = make_claims([{"severity_level": s, "state_code": st} for s, st in [(1, "NY"), (2, "NY"), (2, None), (None, "CA")]])
    exact = as_dict(quality.profile(claims), "column_name")
    assert exact["severity_level"] | {} == {
        "column_name": "severity_level", "data_type": "int", "null_count": 1, "min_value": 1.0, "max_value": 2.0, "distinct_count": 2,
    }
    assert exact["state_code"]["distinct_count"] == 2 and exact["state_code"]["min_value"] is None
    assert exact["close_date"]["distinct_count"] == 0
    nothing = as_dict(quality.profile(claims.where("false")), "column_name")
    assert len(nothing) == 39 and nothing["region"]["null_count"] == 0 and nothing["region"]["min_value"] is None
    rough = as_dict(quality.profile(claims, exact=False), "column_name")
    assert rough["severity_level"]["distinct_count"] == 2


def test_capped_histogram_counts_everything(make_claims):
    claims = make_claims([{"paid_amount": float(i)} for i in range(200)] + [{"paid_amount": 1e6}, {"paid_amount": None}])
    rows = quality.capped_histogram(claims).collect()
    assert sum(r["claim_count"] for r in rows) == 201
    assert max(r["bin"] for r in rows) == 49 and rows[0]["median_value"] == 100.0
