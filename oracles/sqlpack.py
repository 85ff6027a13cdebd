"""Oracle SQL of the view and query pack."""

from oracles.base import month, with_fact, with_summary
from oracles.quality import AUDIT

R = "round(100.0::DOUBLE * sum({0}) / count(*), 2)"
MONTHLY = """SELECT incident_month, count(*) AS claim_count, round(sum(paid_amount), 2) AS total_paid,
  round(sum(incurred_amount), 2) AS total_incurred, round(avg(severity_level), 2) AS avg_severity,
  round(avg(days_to_close), 1) AS avg_days_to_close, CAST(sum(litigation_flag) AS BIGINT) AS litigation_count,
  count(*) FILTER (WHERE status = 'reopened') AS reopen_count FROM s GROUP BY 1"""
SCORECARD = """SELECT provider_id, provider_name, specialty, department, risk_tier, count(*) AS claim_count,
  round(avg(severity_level), 2) AS avg_severity, round(avg(paid_amount), 2) AS avg_paid,
  round(sum(paid_amount), 2) AS total_paid, round(sum(litigation_flag) / count(*), 4) AS litigation_rate,
  round(avg(days_to_close), 1) AS avg_days_to_close, round(avg(days_to_report), 1) AS avg_days_to_report,
  count(*) FILTER (WHERE status = 'reopened') AS reopen_count, CAST(sum(repeat_event_flag) AS BIGINT) AS repeat_event_count
  FROM s GROUP BY ALL"""
_names = "January February March April May June July August September October November December".split()

SQL = {
    "v1_claims_summary": with_summary("SELECT * FROM s"),
    "v2_monthly_metrics": with_summary(MONTHLY),
    "v3_loss_triangle": with_fact(
        """SELECT accident_year, development_year, round(sum(paid_amount), 2) AS incremental_paid, count(*) AS claim_count,
        round(sum(sum(paid_amount)) OVER (PARTITION BY accident_year ORDER BY development_year), 2) AS cumulative_paid
        FROM fact GROUP BY accident_year, development_year"""
    ),
    "v4_provider_scorecard": with_summary(SCORECARD),
    "a1_running_frequency": with_summary(
        f", m AS ({MONTHLY}) SELECT incident_month, claim_count, CAST(sum(claim_count) OVER (ORDER BY incident_month) AS BIGINT) AS running_total FROM m"
    ),
    "a2_severity_by_specialty": with_summary(
        "SELECT specialty, count(*) AS total_claims, "
        + ", ".join(f"count(*) FILTER (WHERE severity_level = {n}) AS sev_{n}" for n in range(1, 6))
        + ", round(avg(severity_level), 2) AS avg_severity FROM s GROUP BY 1"
    ),
    "a3_top_claims": with_summary(
        "SELECT claim_id, incident_date, paid_amount, incurred_amount, severity_level, status, provider_id, specialty,"
        " risk_tier, diagnosis_category, state_code, region FROM s ORDER BY paid_amount DESC, claim_id LIMIT 10"
    ),
    "a4_yearly_change": with_fact(
        """, y AS (SELECT accident_year, count(*) AS claim_count, round(sum(paid_amount), 2) AS total_paid FROM fact GROUP BY 1)
        SELECT *, lag(claim_count) OVER w AS prev_year_count, lag(total_paid) OVER w AS prev_year_paid,
        round((claim_count::DOUBLE - lag(claim_count) OVER w) / nullif(lag(claim_count) OVER w, 0) * 100, 2) AS pct_change
        FROM y WINDOW w AS (ORDER BY accident_year)"""
    ),
    "a5_moving_average": with_summary(
        f", m AS ({MONTHLY}) SELECT incident_month, total_paid, round(avg(total_paid) OVER (ORDER BY incident_month"
        " ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS moving_avg_3m FROM m"
    ),
    "a6_aging_by_status": with_fact(
        """SELECT status, CASE WHEN days_to_close IS NULL THEN 'Still Open' WHEN days_to_close <= 30 THEN '0-30 days'
        WHEN days_to_close <= 90 THEN '31-90 days' WHEN days_to_close <= 180 THEN '91-180 days'
        WHEN days_to_close <= 365 THEN '181-365 days' ELSE '365+ days' END AS aging_bucket, count(*) AS claim_count,
        round(sum(paid_amount), 2) AS total_paid, round(avg(paid_amount), 2) AS avg_paid FROM fact GROUP BY 1, 2"""
    ),
    "a7_triangle_pivot": with_fact(
        "SELECT accident_year, "
        + ", ".join(f"round(sum(CASE WHEN development_year = {d} THEN paid_amount END), 2) AS dev_{d}" for d in range(5))
        + ", round(sum(paid_amount), 2) AS total_paid FROM fact GROUP BY 1"
    ),
    "a8_provider_risk": with_summary(
        f"""SELECT provider_id, specialty, risk_tier, count(*) AS claim_count, round(avg(severity_level), 2) AS avg_severity,
        round(avg(paid_amount), 2) AS avg_paid, round(sum(paid_amount), 2) AS total_paid, {R.format('litigation_flag')} AS litigation_pct,
        round(avg(days_to_close), 1) AS avg_days_to_close, CAST(sum(repeat_event_flag) AS BIGINT) AS repeat_events,
        {R.format("CAST(status = 'reopened' AS INTEGER)")} AS reopen_pct FROM s GROUP BY 1, 2, 3 HAVING count(*) >= 5"""
    ),
    "a9_severe_regions": with_summary(
        """SELECT region, urban_rural, count(*) AS claim_count, round(avg(severity_level), 2) AS avg_severity,
        round(sum(paid_amount), 2) AS total_paid, round(avg(paid_amount), 2) AS avg_paid,
        CAST(sum(litigation_flag) AS BIGINT) AS litigation_count FROM s GROUP BY 1, 2 HAVING avg(severity_level) > 2.5"""
    ),
    "a10_diagnosis_pareto": with_summary(
        """SELECT diagnosis_category, count(*) AS claim_count, round(sum(paid_amount), 2) AS total_paid,
        round(sum(round(sum(paid_amount), 2)) OVER (ORDER BY round(sum(paid_amount), 2) DESC, diagnosis_category ROWS UNBOUNDED PRECEDING)
        * 100.0::DOUBLE / sum(round(sum(paid_amount), 2)) OVER (), 2) AS cumulative_pct FROM s GROUP BY diagnosis_category"""
    ),
    "a11_lag_by_specialty": with_summary(
        """, r AS (SELECT specialty, days_to_report, row_number() OVER (PARTITION BY specialty ORDER BY days_to_report) AS rn,
        count(*) OVER (PARTITION BY specialty) AS n FROM s)
        SELECT specialty, count(*) AS claim_count, round(avg(days_to_report), 1) AS avg_report_lag,
        min(days_to_report) AS min_report_lag, max(days_to_report) AS max_report_lag,
        max(days_to_report) FILTER (WHERE rn = n // 2 + 1) AS median_report_lag FROM r GROUP BY 1"""
    ),
    "a12_litigation_by_region": with_summary(
        f"SELECT region, severity_level, count(*) AS claim_count, CAST(sum(litigation_flag) AS BIGINT) AS litigation_count,"
        f" {R.format('litigation_flag')} AS litigation_pct FROM s GROUP BY 1, 2"
    ),
    "a13_reopened_comparison": with_fact(
        f"""SELECT CASE WHEN status = 'reopened' THEN 'Reopened' ELSE 'Not Reopened' END AS claim_group, count(*) AS claim_count,
        round(avg(paid_amount), 2) AS avg_paid, round(sum(paid_amount), 2) AS total_paid, round(avg(severity_level), 2) AS avg_severity,
        round(avg(days_to_close), 1) AS avg_days_to_close, {R.format('litigation_flag')} AS litigation_pct,
        round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM fact), 2) AS pct_of_total FROM fact GROUP BY 1"""
    ),
    "a14_seasonality": with_fact(
        "SELECT CAST(month(incident_date) AS INTEGER) AS incident_month_num, CASE month(incident_date) "
        + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_names, 1))
        + " END AS month_name, count(*) AS claim_count, round(avg(severity_level), 2) AS avg_severity,"
        " round(sum(paid_amount), 2) AS total_paid, round(avg(paid_amount), 2) AS avg_paid FROM fact GROUP BY 1, 2"
    ),
    "a15_quality_audit": AUDIT,
    "a16_cohorts": with_fact(
        """SELECT accident_year, development_year, round(paid, 2) AS stage_paid, round(whole, 2) AS ultimate_paid,
        round(paid / nullif(whole, 0) * 100.0::DOUBLE, 2) AS pct_of_ultimate, round(upto / nullif(whole, 0) * 100.0::DOUBLE, 2) AS cumulative_pct
        FROM (SELECT accident_year, development_year, sum(paid_amount) AS paid,
          sum(sum(paid_amount)) OVER (PARTITION BY accident_year) AS whole,
          sum(sum(paid_amount)) OVER (PARTITION BY accident_year ORDER BY development_year) AS upto
          FROM fact GROUP BY accident_year, development_year)"""
    ),
    "a17_outliers": with_summary(
        """SELECT claim_id, paid_amount, severity_level, status, specialty, region, diagnosis_category, round(middle, 2) AS population_mean,
        round(middle + 3 * spread, 2) AS upper_threshold, round((paid_amount - middle) / spread, 2) AS z_score
        FROM s CROSS JOIN (SELECT avg(paid_amount) AS middle, greatest(stddev_pop(paid_amount), 0.01) AS spread FROM s)
        WHERE paid_amount - middle > 3 * spread"""
    ),
}
