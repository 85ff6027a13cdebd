"""Oracle SQL of the quality, warehouse and source queries."""

from lossmetrics.operators import quality as q
from lossmetrics.sources import lookups, schemas
from oracles.base import AS_OF, age_band, with_clean, with_dims, with_fact, with_raw, with_summary

NUMERIC = "TRY_CAST(severity AS DOUBLE)"
COND = {
    "negative_paid": "paid_amount < 0",
    "mixed_case_state": "state_code <> upper(state_code)",
    "text_severity": f"severity IS NOT NULL AND {NUMERIC} IS NULL",
    "swapped_dates": "report_date < incident_date",
    "null_diagnosis": "diagnosis_id IS NULL",
    "outlier": "abs(paid_amount) > 5000000",
    "future_incident": f"incident_date > {AS_OF}",
    "future_report": f"report_date > {AS_OF}",
    "future_close": f"close_date > {AS_OF}",
}


def quoted(x: str) -> str:
    return lookups.sql_text(x)


def count(table: str, name: str) -> str:
    if name == "duplicate_ids":
        return f"(SELECT count(*) - count(DISTINCT claim_id) FROM {table})"
    return f"(SELECT count(*) FROM {table} WHERE {COND[name]})"


def issue_rows(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS position, {quoted(c)} AS category, {quoted(d)} AS description, {count(table, n)} AS issue_count"
        for i, (n, (c, d)) in enumerate(q.CHECKS.items(), 1)
    )


def one_check(name: str) -> str:
    return with_raw(f"SELECT {quoted(q.CHECKS[name][0])} AS category, {count('raw', name)} AS issue_count")


RAW_COLUMNS = [c.name for c in schemas.raw_claims_schema()]
RAW_NUMERIC = schemas.INTEGER_COLUMNS + schemas.AMOUNT_COLUMNS
SUMMARY = [(f.name, f.dataType.simpleString()) for f in schemas.summary_schema()]


def null_rows(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {table}" for c in columns
    )


def profile_rows() -> str:
    out = []
    for name, kind in SUMMARY:
        number = f"TRY_CAST(CAST({name} AS VARCHAR) AS DOUBLE)"
        half = f"count({number}) > 0 AND count({number}) > 0.5 * count(*)"
        out.append(
            f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) - count({name}) AS null_count, "
            f"count(DISTINCT {name}) AS distinct_count, CASE WHEN {half} THEN round(min({number}), 2) END AS min_value, "
            f"CASE WHEN {half} THEN round(max({number}), 2) END AS max_value FROM s"
        )
    return " UNION ALL ".join(out)


_checks = [
    ("Total rows", "true"),
    ("NULL incident_date", "incident_date IS NULL"),
    ("NULL report_date", "report_date IS NULL"),
    ("NULL close_date", "close_date IS NULL"),
    ("NULL provider_key", "provider_key IS NULL"),
    ("NULL region_key", "region_key IS NULL"),
    ("NULL diagnosis_key", "diagnosis_key IS NULL"),
    ("Severity out of range", "severity_level NOT BETWEEN 1 AND 5"),
    ("Negative paid_amount", "paid_amount < 0"),
    ("Negative incurred_amount", "incurred_amount < 0"),
    ("Paid > Incurred", "paid_amount > incurred_amount"),
    ("Report before incident", "report_date < incident_date"),
    ("Negative days_to_report", "days_to_report < 0"),
    ("Negative days_to_close", "days_to_close < 0"),
    ("Future incident_date", f"incident_date > {AS_OF}"),
    ("Unknown status values", "status NOT IN ('open', 'closed', 'reopened')"),
]
AUDIT = with_fact(
    ", base AS (SELECT * FROM fact) "
    + " UNION ALL ".join(f"SELECT '{n}' AS check_name, count(*) AS result FROM base WHERE {c}" for n, c in _checks)
    + "".join(
        f" UNION ALL SELECT 'Orphan {d} keys', count(*) FROM base LEFT JOIN dim_{d} x USING ({d}_key) WHERE x.{d}_key IS NULL"
        for d in ("provider", "region")
    )
)

FKS = ["provider_key", "region_key", "diagnosis_key", "root_cause_key"]
CONSTRAINTS = with_fact(
    "SELECT 'pk_claim_id' AS constraint_name, CAST(coalesce((SELECT sum(n) FROM (SELECT claim_id, count(*) AS n FROM fact"
    " GROUP BY 1) WHERE n > 1 OR claim_id IS NULL), 0) AS BIGINT) AS violations"
    + "".join(
        f" UNION ALL SELECT 'fk_{k}', count(*) FROM fact f LEFT JOIN dim_{k[:-4]} x USING ({k}) WHERE x.{k} IS NULL" for k in FKS
    )
    + " UNION ALL SELECT 'ck_severity_range', count(*) FROM fact WHERE severity_level NOT BETWEEN 1 AND 5"
    " UNION ALL SELECT 'ck_paid_non_negative', count(*) FROM fact WHERE paid_amount < 0"
    " UNION ALL SELECT 'ck_incurred_non_negative', count(*) FROM fact WHERE incurred_amount < 0"
)

_cleaned = ", ".join(c for c in RAW_COLUMNS)

SQL = {
    **{f"q{i}_{n}": one_check(n) for i, n in enumerate(list(q.CHECKS)[:7], 1)},
    "q1_absolute_paid": with_raw("SELECT claim_id, abs(paid_amount) AS paid_amount FROM raw"),
    "q2_upper_state": with_raw("SELECT upper(state_code) AS state_code, count(*) AS claims FROM raw GROUP BY 1"),
    "q3_numeric_severity": with_clean("SELECT severity, count(*) AS claims FROM clean GROUP BY 1"),
    "q4_ordered_dates": with_clean("SELECT claim_id, incident_date, report_date FROM clean"),
    "q5_known_diagnosis": with_raw("SELECT coalesce(diagnosis_id, 'UNKNOWN') AS diagnosis_id, count(*) AS claims FROM raw GROUP BY 1"),
    "q6_capped_paid": with_raw(
        "SELECT claim_id, CASE WHEN abs(paid_amount) > 5000000 THEN sign(paid_amount) * 5000000.0::DOUBLE ELSE paid_amount END"
        " AS paid_amount FROM raw"
    ),
    "q7_without_copies": with_raw(
        ", twice AS (SELECT * FROM raw UNION ALL SELECT * FROM raw) SELECT count(*) AS rows, count(*) - count(DISTINCT claim_id)"
        " AS duplicate_ids, (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS rows_kept FROM twice"
    ),
    "q8_future_dates": with_raw(f"SELECT category, description, issue_count FROM ({issue_rows('raw')}) WHERE category = 'Future Dates' AND issue_count > 0"),
    "q9_typed": with_raw(
        "SELECT claim_id, TRY_CAST(patient_age AS INTEGER) AS patient_age, TRY_CAST(paid_amount AS DOUBLE) AS paid_amount,"
        " TRY_CAST(incident_date AS DATE) AS incident_date, TRY_CAST(close_date AS DATE) AS close_date FROM raw"
    ),
    "q10_null_counts": with_raw(null_rows("raw", RAW_COLUMNS)),
    "q10_numeric_ranges": with_raw(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM raw"
            for c in RAW_NUMERIC
        )
    ),
    "q11_issues": with_raw(f"SELECT * FROM ({issue_rows('raw')}) WHERE issue_count > 0"),
    "q11_comparison": with_clean(
        f""", b AS (SELECT category, sum(issue_count) AS n FROM ({issue_rows('raw')}) GROUP BY 1 HAVING sum(issue_count) > 0),
        a AS (SELECT category, sum(issue_count) AS n FROM ({issue_rows('clean')}) GROUP BY 1 HAVING sum(issue_count) > 0),
        j AS (SELECT coalesce(b.category, a.category) AS category, coalesce(b.n, 0) AS bn, coalesce(a.n, 0) AS an FROM b FULL JOIN a USING (category))
        SELECT coalesce(category, 'Total') AS category, CAST(sum(bn) AS BIGINT) AS "before", CAST(sum(an) AS BIGINT) AS "after",
        CAST(sum(bn - an) AS BIGINT) AS resolved FROM j GROUP BY ROLLUP(category)"""
    ),
    "q12_clean_claims": with_clean(f"SELECT {_cleaned} FROM clean"),
    "q12_clean_claims_measured": with_clean(f"SELECT {_cleaned} FROM clean"),
    "q13_profile": with_summary(profile_rows()),
    "q14_completeness": with_summary(
        f"SELECT count(*) AS total_records, {len(SUMMARY)} AS column_count, round((({' + '.join(f'count({c})' for c, _ in SUMMARY)})"
        f" / (count(*) * {len(SUMMARY)})) * 100, 1) AS completeness_pct, max(incident_date) AS latest_date FROM s"
    ),
    "q14_null_rates": with_summary(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, round((count(*) - count({c})) / count(*) * 100, 2) AS null_pct FROM s" for c, _ in SUMMARY
        )
        + ") WHERE null_pct > 0"
    ),
    "q15_capped_histogram": with_summary(
        """, st AS (SELECT quantile_cont(paid_amount, 0.99) AS cap, quantile_cont(paid_amount, 0.5) AS med, min(paid_amount) AS lo FROM s),
        b AS (SELECT least(floor((least(paid_amount, cap) - lo) / (cap - lo) * 50), 49) AS bin, cap, med, lo FROM s, st)
        SELECT CAST(bin AS INTEGER) AS bin, round(any_value(lo) + (any_value(cap) - any_value(lo)) * bin / 50, 2) AS bin_start,
        count(*) AS claim_count, round(any_value(med), 2) AS median_value FROM b GROUP BY bin"""
    ),
    "q16_audit": AUDIT,
    "w1_dim_provider": with_dims("SELECT * FROM dim_provider"),
    "w2_dim_region": with_dims("SELECT * FROM dim_region"),
    "w3_dim_diagnosis": with_fact("SELECT * FROM dim_diagnosis WHERE diagnosis_code IN (SELECT diagnosis_id FROM clean)"),
    "w4_dim_root_cause": with_fact("SELECT * FROM dim_root_cause WHERE root_cause_code IN (SELECT root_cause_id FROM clean)"),
    "w5_fact_claim": with_fact("SELECT * FROM fact"),
    "k8_fact_table": with_fact("SELECT * FROM fact"),
    "k8_summary_table": with_summary("SELECT * FROM s"),
    "k1_cleaned": with_clean(f"SELECT {_cleaned} FROM clean"),
    "w5_unmapped": with_clean(
        """, d AS (SELECT count(*) AS n FROM clean) SELECT * FROM (VALUES ('provider', 0::BIGINT), ('region', 0::BIGINT),
        ('diagnosis', 0::BIGINT), ('root_cause', 0::BIGINT), ('dropped_rows', 0::BIGINT)) AS t(dimension, unmapped)"""
    ),
    "w6_claims_summary": with_summary("SELECT * FROM s"),
    "w7_constraints": CONSTRAINTS,
    "w8_row_counts": with_fact(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t if t != 'fact_claim' else 'fact'}"
            for t in ("dim_provider", "dim_region", "dim_diagnosis", "dim_root_cause", "fact_claim")
        )
    ),
    "w9_age_band": with_raw(f"SELECT {age_band('patient_age')} AS patient_age_band, count(*) AS claims, min(patient_age) AS youngest, max(patient_age) AS oldest FROM raw GROUP BY 1"),
    "w10_risk_segment": with_summary(
        """SELECT CASE WHEN patient_age_band = '65+' AND severity_weight >= 1.5 THEN 'critical'
        WHEN patient_age_band = '65+' OR severity_weight >= 1.5 THEN 'high' WHEN severity_weight >= 1.0 THEN 'medium' ELSE 'low' END
        AS segment, count(*) AS claims, round(sum(paid_amount), 2) AS total_paid FROM s GROUP BY 1"""
    ),
    "s1_read_claims": with_clean(f"SELECT {_cleaned} FROM clean"),
    "s2_read_dimension": with_dims("SELECT provider_id, specialty_name, department, risk_tier FROM providers"),
    "s3_read_summary": with_summary("SELECT claim_id, specialty, state_code, diagnosis_category, root_cause_category, loss_ratio FROM s"),
}
SQL["k2_report"] = f"""SELECT category, "before", "after" FROM ({SQL["q11_comparison"]})"""
