"""Oracle SQL of the page aggregates and extracts."""

from lossmetrics.operators.closing import AGE_BUCKETS
from lossmetrics.operators.extracts import OPS_COLUMNS
from oracles.advanced import TRI
from oracles.analysis import PORTFOLIO, SEVS, _cs, within
from oracles.base import AS_OF, month, quarter, with_summary
from oracles.sqlpack import MONTHLY, SCORECARD

S = with_summary
M, Q = month("incident_date"), quarter("incident_date")
OPEN = "status IN ('open', 'reopened')"

_measures = [
    ("total_claims", "count(*)::DOUBLE"),
    ("total_paid", "sum(paid_amount)"),
    ("avg_severity", "avg(severity_level)"),
    ("avg_days_to_close", "avg(days_to_close)"),
    ("litigation_rate_pct", "sum(litigation_flag)::DOUBLE / count(*) * 100"),
    ("open_claims", f"count(*) FILTER (WHERE {OPEN})::DOUBLE"),
]
_yr = "(SELECT max(accident_year) FROM s)"
KPIS = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{n}' AS kpi, round((SELECT {e} FROM s), 4) AS value,
    round(((SELECT {e} FROM s WHERE accident_year = {_yr}) - (SELECT {e} FROM s WHERE accident_year = y.p)) /
    (SELECT {e} FROM s WHERE accident_year = y.p) * 100, 1) AS yoy_pct FROM y"""
    for i, (n, e) in enumerate(_measures, 1)
)


def capped(column: str, bins: int, key: str | None) -> str:
    k = f"{key}, " if key else ""
    known = f"{column} IS NOT NULL" + (f" AND {key} IS NOT NULL" if key else "")
    return S(
        f""", x AS (SELECT {k}{column} AS d FROM s WHERE {known}),
        l AS (SELECT quantile_cont(d, 0.99) AS cap, median(d) AS med, avg(d) AS mn, min(d) AS low FROM x),
        b AS (SELECT {k}CAST(least(floor((least(d::DOUBLE, cap) - low) / (cap - low) * {bins}), {bins - 1}) AS INTEGER) AS bin, cap, med, mn FROM x, l)
        SELECT {k}bin, count(*) AS claim_count, round(any_value(cap), 2) AS cap_days, round(any_value(med), 1) AS median_days,
        round(any_value(mn), 1) AS mean_days FROM b GROUP BY {k}bin"""
    )


def sla_row(label: str) -> str:
    parts = ", ".join(f"round(count(*) FILTER (WHERE days_to_close <= {t}) / count(*) * 100, 1) AS sla_{t}d_pct" for t in (90, 180, 365))
    return f"SELECT {label} AS claim_type, count(*) AS claims, round(avg(days_to_close), 1) AS avg_close_days, round(median(days_to_close), 1) AS median_close_days, {parts} FROM s WHERE days_to_close IS NOT NULL"


def counts(keys: str, extra: str = "") -> str:
    return S(f"SELECT {keys}, count(*) AS claim_count FROM s {extra} GROUP BY ALL")


def scenario(name: str, parameter: str, days: str, incurred: str, note: str, value: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS scenario, '{parameter}' AS parameter, {days} AS baseline_avg_close_days,"
        f" {incurred} AS baseline_total_incurred, '{note}' AS note, {value} AS note_value FROM {source}"
    )


_nul = "CAST(NULL AS DOUBLE)"
_one = "CAST(floor(high_n * 20 / 100) AS BIGINT) * (high_avg - mid_avg)"
_two = "CAST(floor(lit_n * 25 / 100) AS BIGINT) * (lit_avg - nolit_avg)"

SQL = {
    "p1_filtered": S(
        """SELECT claim_id, accident_year, claim_type, severity_level, region, incident_date FROM s
        WHERE accident_year IN (1996, 1997) AND claim_type IN ('medical_malpractice', 'workers_comp') AND severity_level IN (3, 4, 5)
        AND region IN ('ASIA', 'EUROPE') AND incident_date >= DATE '1996-03-01' AND incident_date <= DATE '1997-10-31'"""
    ),
    "p2_kpis": S(f", y AS (SELECT max(accident_year) AS p FROM s WHERE accident_year < {_yr}) {KPIS}"),
    "p3_sparkline_count": S(f"SELECT {M} AS incident_month, count(*) AS value FROM s GROUP BY 1"),
    "p3_sparkline_paid": S(f"SELECT {M} AS incident_month, round(sum(paid_amount), 2) AS value FROM s GROUP BY 1"),
    "p4_status_counts": counts("status"),
    "p4_top_root_causes": S(
        "SELECT root_cause_category, count(*) AS claim_count FROM s GROUP BY 1 ORDER BY claim_count DESC, root_cause_category LIMIT 10"
    ),
    "p4_month_by_type": counts(f"{M} AS incident_month, claim_type"),
    "p4_year_by_severity": counts("CAST(year(incident_date) AS INTEGER) AS incident_year, severity_level", "WHERE severity_level IS NOT NULL"),
    "p5_month_by_severity": counts(f"{M} AS incident_month, severity_level", "WHERE severity_level IS NOT NULL"),
    "p5_paid_incurred": S(
        f"SELECT {M} AS incident_month, round(sum(paid_amount), 2) AS paid, round(sum(incurred_amount), 2) AS incurred FROM s GROUP BY 1"
    ),
    "p5_quarterly_loss_ratio": S(
        f"""SELECT {Q} AS quarter, round(sum(paid_amount), 2) AS paid, round(sum(incurred_amount), 2) AS incurred,
        CASE WHEN sum(incurred_amount) > 0 THEN round(sum(paid_amount) / sum(incurred_amount), 6) ELSE 0.0::DOUBLE END AS loss_ratio
        FROM s GROUP BY 1"""
    ),
    "p5_severity_mix": S(
        f""", c AS (SELECT {Q} AS quarter, severity_level, count(*) AS claim_count FROM s WHERE severity_level IS NOT NULL GROUP BY 1, 2)
        SELECT *, round(claim_count / sum(claim_count) OVER (PARTITION BY quarter) * 100, 4) AS share_pct FROM c"""
    ),
    "p5_claim_type_totals": S(
        "SELECT claim_type, count(claim_id) AS claim_count, round(sum(paid_amount), 2) AS total_paid FROM s GROUP BY 1"
    ),
    "p6_state_map": S(
        """SELECT state_code, round(sum(paid_amount), 2) AS total_paid, count(claim_id) AS claim_count,
        round(avg(severity_level), 2) AS avg_severity FROM s GROUP BY 1"""
    ),
    "p6_department_severity": S(f"SELECT department, {SEVS} FROM s WHERE severity_level IS NOT NULL GROUP BY 1"),
    "p6_region_by_type": counts("region, claim_type"),
    "p6_top_states": S(
        """SELECT state_code, count(claim_id) AS claim_count, round(sum(paid_amount), 2) AS total_paid FROM s GROUP BY 1
        ORDER BY claim_count DESC, state_code LIMIT 10"""
    ),
    "p6_urban_rural": S(
        """SELECT urban_rural, round(avg(severity_level), 2) AS avg_severity, round(avg(paid_amount), 0) AS avg_paid,
        count(claim_id) AS claim_count FROM s GROUP BY 1"""
    ),
    "p6_urban_rural_state": S(
        """SELECT urban_rural, round(avg(severity_level), 2) AS avg_severity, round(avg(paid_amount), 0) AS avg_paid,
        count(claim_id) AS claim_count FROM s WHERE state_code = 'NATION_7' GROUP BY 1"""
    ),
    "p7_ops_kpis": S(
        "SELECT count(days_to_close) AS closed_claims, round(avg(days_to_close), 2) AS avg_days_to_close,"
        " round(median(days_to_close), 2) AS median_days_to_close, "
        + ", ".join(
            f"count(*) FILTER (WHERE days_to_close <= {t}) AS within_{t}, round(count(*) FILTER (WHERE days_to_close <= {t})"
            f" / count(days_to_close) * 100, 2) AS sla_{t}_pct"
            for t in (90, 180, 365)
        )
        + " FROM s"
    ),
    "p7_close_histogram": capped("days_to_close", 30, "severity_level"),
    "p7_open_aging": S(
        f""", o AS (SELECT date_diff('day', coalesce(report_date, incident_date), {AS_OF}) AS age FROM s WHERE {OPEN})
        SELECT bucket, count(*) AS open_claims FROM o JOIN (VALUES {", ".join(f"('{l}', {lo}, {hi})" for l, lo, hi in AGE_BUCKETS)})
        AS t(bucket, lo, hi) ON age BETWEEN lo AND hi GROUP BY 1"""
    ),
    "p7_lag_histogram": capped("days_to_report", 40, None),
    "p7_monthly_lag": S(
        f"""SELECT {M} AS incident_month, round(median(days_to_report), 1) AS median, round(avg(days_to_report), 1) AS mean,
        count(*) AS claim_count FROM s WHERE days_to_report IS NOT NULL GROUP BY 1"""
    ),
    "p7_sla_table": S(sla_row("claim_type") + " GROUP BY claim_type UNION ALL " + sla_row("'OVERALL'")),
    "p8_risk_segments": S(
        """, g AS (SELECT specialty, region, claim_type, count(claim_id) AS claim_count, round(avg(severity_level), 2) AS avg_severity,
        sum(paid_amount) AS p, round(avg(litigation_flag) * 100, 1) AS litigation_rate_pct FROM s GROUP BY 1, 2, 3),
        r AS (SELECT * EXCLUDE (p), round(p, 2) AS total_paid, round(p * avg_severity, 0) AS risk_score FROM g)
        SELECT *, CAST(row_number() OVER (ORDER BY risk_score DESC, specialty, region, claim_type) AS INTEGER) AS rank FROM r
        ORDER BY risk_score DESC, specialty, region, claim_type LIMIT 10"""
    ),
    "p9_risk_matrix": S(
        """, g AS (SELECT specialty, count(claim_id) AS claim_count, round(avg(severity_level), 2) AS avg_severity,
        round(sum(paid_amount), 2) AS total_paid FROM s WHERE severity_level IS NOT NULL GROUP BY 1),
        m AS (SELECT median(claim_count) AS mc, median(avg_severity) AS ms FROM g)
        SELECT specialty, claim_count, avg_severity, total_paid, CASE WHEN claim_count > mc AND avg_severity > ms THEN 'High'
        WHEN claim_count > mc OR avg_severity > ms THEN 'Medium' ELSE 'Low' END AS risk_level FROM g, m"""
    ),
    "p10_recommendation_metrics": S(
        """SELECT 'avg_surgical_severity' AS metric, round(avg(severity_level), 2) AS number, CAST(NULL AS VARCHAR) AS text FROM s
        UNION ALL SELECT 'low_severity_claims', count(*) FILTER (WHERE severity_level <= 2), NULL FROM s
        UNION ALL SELECT 'low_severity_avg_close', round(avg(CASE WHEN severity_level <= 2 THEN days_to_close END), 0), NULL FROM s
        UNION ALL SELECT 'high_litigation_state_pct', round(avg(litigation_flag) * 100, 1), NULL FROM s
          WHERE state_code IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3')
        UNION ALL SELECT 'overall_litigation_pct', round(avg(litigation_flag) * 100, 1), NULL FROM s
        UNION ALL SELECT 'repeat_events', sum(repeat_event_flag), NULL FROM s
        UNION ALL SELECT * FROM (SELECT 'slowest_specialty', round(avg(days_to_report), 1), specialty FROM s GROUP BY specialty
          ORDER BY avg(days_to_report) DESC, specialty LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'top_repeat_cause', count(*)::DOUBLE, root_cause_category FROM s WHERE repeat_event_flag = 1
          GROUP BY root_cause_category ORDER BY count(*) DESC, root_cause_category LIMIT 3)"""
    ),
    "e1_monthly_metrics": S(MONTHLY.replace("incident_month,", "incident_month AS month,")),
    "e1b_monthly_sheet": S(
        """SELECT incident_month AS month, count(*) AS claim_count, round(sum(paid_amount), 2) AS total_paid,
        round(sum(incurred_amount), 2) AS total_incurred, round(sum(reserved_amount), 2) AS total_reserved,
        round(avg(severity_level), 2) AS avg_severity, round(avg(days_to_close), 1) AS avg_days_to_close,
        round(avg(days_to_report), 1) AS avg_days_to_report, CAST(sum(litigation_flag) AS BIGINT) AS litigation_count,
        CAST(sum(is_high_severity) AS BIGINT) AS high_severity_count FROM s GROUP BY 1"""
    ),
    "e2_provider_scorecard": S(SCORECARD),
    "e3_severity_sheet": S(
        """SELECT claim_type, severity_level, count(*) AS claim_count, round(sum(paid_amount), 2) AS total_paid,
        round(avg(paid_amount), 2) AS avg_paid FROM s WHERE severity_level IS NOT NULL GROUP BY 1, 2"""
    ),
    "e4_state_summary": S(
        """SELECT state_code, state_name, region, urban_rural, count(*) AS claim_count, round(sum(paid_amount), 2) AS total_paid,
        round(sum(incurred_amount), 2) AS total_incurred, round(avg(severity_level), 2) AS avg_severity,
        round(avg(days_to_close), 1) AS avg_days_to_close, round(sum(litigation_flag) / count(*), 4) AS litigation_rate,
        round(sum(is_high_severity) / count(*), 4) AS high_severity_pct FROM s GROUP BY 1, 2, 3, 4"""
    ),
    "k3_claims_detail": S("SELECT * FROM s"),
    "k4_loss_triangle": S(
        f"{TRI} SELECT accident_year, "
        + ", ".join(
            f"round(coalesce(sum(inc) FILTER (WHERE development_year <= {d}), 0)::DOUBLE, 2) AS dev_{d}" for d in range(3)
        )
        + " FROM cell GROUP BY 1"
    ),
    "k9_triangle_download": S(
        f"{TRI} SELECT accident_year, "
        + ", ".join(
            f"CASE WHEN count(*) FILTER (WHERE development_year = {d}) > 0 THEN"
            f" round(coalesce(sum(inc) FILTER (WHERE development_year <= {d}), 0)::DOUBLE, 2) END AS dev_year_{d}"
            for d in range(3)
        )
        + " FROM cell GROUP BY 1"
    ),
    "k9_operations": S(f"SELECT {', '.join(OPS_COLUMNS)} FROM s"),
    "k9_scenario_summary": S(
        PORTFOLIO
        + " "
        + " UNION ALL ".join(
            [
                scenario("Close Time Reduction", "20%", "round(avg(days_to_close), 1)", _nul, "Days-based metric", _nul, "s"),
                scenario("Severity Shift", "20%", _nul, "round(rated_sum, 2)", "Projected", f"round(rated_sum - {_one}, 2)", "p"),
                scenario("Litigation Reduction", "25%", _nul, "round(all_sum, 2)", "Projected", f"round(all_sum - {_two}, 2)", "p"),
                scenario("Combined (20% sev + 25% lit + 20% close)", "Combined", _nul, "round(all_sum, 2)", "Total Savings", f"round({_cs}, 2)", "p"),
            ]
        )
    ),
}
SQL["k5_monthly_metrics"] = SQL["e1_monthly_metrics"]
SQL["k6_provider_scorecard"] = SQL["e2_provider_scorecard"]
SQL["k7_severity_sheet"] = SQL["e3_severity_sheet"]
SQL["k7_claims_sheet"] = SQL["k3_claims_detail"]
SQL["k7_monthly_sheet"] = SQL["e1b_monthly_sheet"]
SQL["k7_provider_sheet"] = SQL["e2_provider_scorecard"]
SQL["k7_regional_sheet"] = SQL["e4_state_summary"]
