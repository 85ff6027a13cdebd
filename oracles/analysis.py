"""Oracle SQL of the frequency, closing, lag, repeat, benchmark and scenario queries."""

from lossmetrics.operators.closing import AGE_BUCKETS, CLOSE_EDGES, CLOSE_LABELS
from lossmetrics.operators.lag import LAG_EDGES, LAG_LABELS
from lossmetrics.sources.lookups import CLAIM_TYPES
from oracles.base import AS_OF, bucket, month, quarter, with_summary

S = with_summary
M, Q = month("incident_date"), quarter("incident_date")
SEVS = ", ".join(f"count(*) FILTER (WHERE severity_level = {n}) AS sev_{n}" for n in range(1, 6))


def yoy(x: str) -> str:
    return f"round(({x} - lag({x}) OVER w)::DOUBLE / nullif(lag({x}) OVER w, 0) * 100, 2)"


def histogram(column: str, edges, labels) -> str:
    shown = ", ".join(f"({i}, '{l}')" for i, l in enumerate(labels, 1))
    return S(
        f""", b AS (SELECT {bucket(column, edges, labels)} AS bucket FROM s)
        SELECT position, bucket, (SELECT count(*) FROM b WHERE b.bucket = t.bucket) AS claim_count
        FROM (VALUES {shown}) AS t(position, bucket)"""
    )


def stats_by(column: str, keys, std: bool) -> str:
    parts = []
    for k in keys:
        extra = f", round(stddev_samp({column}), 1) AS std" if std else ""
        parts.append(
            f"SELECT '{k}' AS dimension, CAST({k} AS VARCHAR) AS member, round(median({column}), 1) AS median,"
            f" round(avg({column}), 1) AS mean, count(*) AS claim_count{extra} FROM s"
            f" WHERE {column} IS NOT NULL AND {k} IS NOT NULL GROUP BY {k}"
        )
    return S(" UNION ALL ".join(parts))


def within(t: int) -> str:
    return f"round(count(*) FILTER (WHERE days_to_close <= {t}) / count(*) * 100, 2) AS within_{t}_days_pct"


def rate(part: str, whole: str = "count(*)") -> str:
    return f"round({part} / {whole} * 100, 2)"


RE = "count(*) FILTER (WHERE lower(status) = 'reopened')"

IND = [
    ("surgical_complication_rate", "regexp_matches(procedure_category, '(?i)surg') AND severity_level >= 4"),
    ("fall_rate", "regexp_matches(root_cause_category, '(?i)fall')"),
    ("medication_error_rate", "regexp_matches(root_cause_category, '(?i)medication') OR regexp_matches(diagnosis_category, '(?i)medication')"),
    ("diagnostic_error_rate", "regexp_matches(root_cause_category, '(?i)diagnostic') OR regexp_matches(diagnosis_category, '(?i)misdiagnos')"),
    ("hospital_acquired_infection_rate", "regexp_matches(diagnosis_category, '(?i)infection|sepsis|pneumonia|catheter')"),
]


def indicator_rows(keys: str, group: str) -> str:
    out = []
    for name, cond in IND:
        den = "count(*) FILTER (WHERE regexp_matches(procedure_category, '(?i)surg'))" if name.startswith("surg") else "count(*)"
        num = f"count(*) FILTER (WHERE {cond})"
        out.append(
            f"SELECT {keys} '{name}' AS indicator, count(*) AS claim_count, {num} AS numerator, {den} AS denominator,"
            f" CASE WHEN {den} > 0 THEN round({num} / {den} * 1000, 2) ELSE 0.0::DOUBLE END AS rate_per_1000 FROM s {group}"
        )
    return " UNION ALL ".join(out)


def pct(part: str, base: str) -> str:
    return f"CASE WHEN {base} > 0 THEN round(({part}) / {base} * 100, 2) + 0.0::DOUBLE ELSE 0.0::DOUBLE END"


def avg_where(cond: str) -> str:
    return (
        f"coalesce(CAST(sum(CAST(CASE WHEN {cond} THEN incurred_amount END AS DECIMAL(18, 6))) AS DOUBLE)"
        f" / nullif(count(*) FILTER (WHERE {cond}), 0), 0)"
    )


def sum_where(cond: str) -> str:
    return f"coalesce(CAST(sum(CAST(CASE WHEN {cond} THEN incurred_amount END AS DECIMAL(18, 6))) AS DOUBLE), 0)"


PORTFOLIO = f""", p AS (SELECT count(*) AS total, {sum_where('true')} AS all_sum,
  {sum_where('severity_level IS NOT NULL')} AS rated_sum,
  count(*) FILTER (WHERE severity_level IN (4, 5)) AS high_n, {sum_where('severity_level IN (4, 5)')} AS high_sum,
  {avg_where('severity_level IN (4, 5)')} AS high_avg, {avg_where('severity_level = 3')} AS mid_avg,
  count(*) FILTER (WHERE litigation_flag = 1) AS lit_n, {sum_where('litigation_flag = 1')} AS lit_sum,
  {avg_where('litigation_flag = 1')} AS lit_avg, {avg_where('litigation_flag = 0')} AS nolit_avg,
  count(*) FILTER (WHERE status IN ('open', 'reopened')) AS open_n FROM s)"""

_moved = "CAST(floor(high_n * pct / 100) AS BIGINT)"
_save1 = f"({_moved} * (high_avg - mid_avg))"
_removed = "CAST(floor(lit_n * pct / 100) AS BIGINT)"
_save2 = f"({_removed} * (lit_avg - nolit_avg))"
_c1 = "(CAST(floor(high_n * 0.2::DOUBLE) AS BIGINT) * (high_avg - mid_avg))"
_c2 = "(CAST(floor(lit_n * 0.25::DOUBLE) AS BIGINT) * (lit_avg - nolit_avg))"
_c3 = "(all_sum * 0.2::DOUBLE * 0.05::DOUBLE)"
_cs = f"({_c1} + {_c2} + {_c3})"
_fewer = "CAST(floor(open_n * 0.8::DOUBLE) AS BIGINT)"
_fac = "(1 - pct::DOUBLE / 100)"

def slow(factor: int) -> str:
    return S(
        f""", m AS (SELECT median(days_to_report) AS med FROM s),
        p AS (SELECT provider_id, min(provider_name) AS provider_name, count(*) AS claim_count, avg(days_to_report) AS mean_lag,
        median(days_to_report) AS med_lag FROM s WHERE days_to_report IS NOT NULL GROUP BY 1)
        SELECT provider_id, provider_name, claim_count, round(mean_lag, 1) AS mean_lag, round(med_lag, 1) AS median_lag,
        round(med * {factor}, 1) AS threshold_days, round(med, 1) AS overall_median FROM p, m
        WHERE claim_count >= 5 AND mean_lag > med * {factor} ORDER BY p.mean_lag DESC, provider_id LIMIT 50"""
    )


SQL = {
    "f1_monthly_by_type": S(
        f"""SELECT m.incident_month, t.claim_type, count(s.claim_id) AS claim_count, any_value(m.total) AS total
        FROM (SELECT {M} AS incident_month, count(*) AS total FROM s GROUP BY 1) m CROSS JOIN (SELECT DISTINCT claim_type FROM s) t
        LEFT JOIN s ON {M} = m.incident_month AND s.claim_type = t.claim_type GROUP BY 1, 2"""
    ),
    "f2_quarterly_counts": S(f"SELECT {Q} AS incident_quarter, count(*) AS claim_count FROM s GROUP BY 1"),
    "f3_yearly_counts": S(
        f""", y AS (SELECT CAST(year(incident_date) AS INTEGER) AS incident_year, count(*) AS claim_count FROM s GROUP BY 1)
        SELECT *, {yoy('claim_count')} AS yoy_change_pct FROM y WINDOW w AS (ORDER BY incident_year)"""
    ),
    "f4_severity_distribution": S(
        """SELECT severity_level, count(*) AS claim_count, round(count(*) / (SELECT count(severity_level) FROM s) * 100, 2) AS percentage,
        (SELECT round(avg(severity_level), 2) FROM s) AS mean_severity, (SELECT median(severity_level) FROM s) AS median_severity
        FROM s WHERE severity_level IS NOT NULL GROUP BY 1"""
    ),
    "f5_severity_by_type": S(f"SELECT claim_type, {SEVS} FROM s WHERE severity_level IS NOT NULL GROUP BY 1"),
    "f6_severity_by_specialty": S(f"SELECT specialty, {SEVS} FROM s WHERE severity_level IS NOT NULL GROUP BY 1"),
    "f7_specialty_points": S(
        """SELECT specialty, count(claim_id) AS claim_count, round(avg(severity_level), 2) AS avg_severity,
        round(sum(paid_amount), 2) AS total_paid FROM s WHERE severity_level IS NOT NULL GROUP BY 1"""
    ),
    "f8_loss_ratio": S(
        """SELECT claim_type, round(sum(paid_amount), 2) AS total_paid, round(sum(incurred_amount), 2) AS total_incurred,
        CASE WHEN sum(incurred_amount) > 0 THEN round(sum(paid_amount) / sum(incurred_amount), 4) END AS loss_ratio FROM s GROUP BY 1"""
    ),
    "f9_yearly_metrics": S(
        f""", y AS (SELECT CAST(year(incident_date) AS INTEGER) AS incident_year, count(claim_id) AS c, sum(paid_amount) AS p,
        sum(incurred_amount) AS i, round(avg(severity_level), 2) AS avg_severity FROM s GROUP BY 1)
        SELECT incident_year, c AS claim_count, round(p, 2) AS total_paid, round(i, 2) AS total_incurred, avg_severity,
        {yoy('c')} AS claim_count_yoy_pct, {yoy('p')} AS total_paid_yoy_pct, {yoy('i')} AS total_incurred_yoy_pct
        FROM y WINDOW w AS (ORDER BY incident_year)"""
    ),
    "l1_close_histogram": histogram("days_to_close", CLOSE_EDGES, CLOSE_LABELS),
    "l2_close_percentiles": S(
        """SELECT count(days_to_close) AS claim_count, round(median(days_to_close), 1) AS median_overall,
        round(avg(days_to_close), 1) AS mean_overall, round(quantile_cont(days_to_close, 0.95), 1) AS p95 FROM s"""
    ),
    "l3_close_by_group": stats_by("days_to_close", ["severity_level", "specialty", "region"], False),
    "l4_sla_compliance": S(
        f"""SELECT claim_type, count(*) AS claim_count, {within(90)}, {within(180)}, {within(365)} FROM s
        WHERE days_to_close IS NOT NULL GROUP BY 1 UNION ALL SELECT 'overall', count(*), {within(90)}, {within(180)}, {within(365)}
        FROM s WHERE days_to_close IS NOT NULL"""
    ),
    "l5_backlog_aging": S(
        f""", o AS (SELECT date_diff('day', coalesce(report_date, incident_date), {AS_OF}) AS age FROM s WHERE status IN ('open', 'reopened'))
        SELECT position, bucket, (SELECT count(*) FROM o WHERE age BETWEEN lo AND hi) AS open_claims, (SELECT count(*) FROM o) AS total_open,
        (SELECT round(median(age), 1) FROM o) AS median_age_days, (SELECT round(avg(age), 1) FROM o) AS mean_age_days
        FROM (VALUES {", ".join(f"({i}, '{l}', {lo}, {hi})" for i, (l, lo, hi) in enumerate(AGE_BUCKETS, 1))}) AS t(position, bucket, lo, hi)"""
    ),
    "l6_monthly_close_trend": S(
        f"SELECT {M} AS incident_month, round(median(days_to_close), 1) AS median_days_to_close FROM s WHERE days_to_close IS NOT NULL GROUP BY 1"
    ),
    "g1_lag_histogram": histogram("days_to_report", LAG_EDGES, LAG_LABELS),
    "g1_lag_percentiles": S(
        """SELECT round(median(days_to_report), 1) AS median, round(avg(days_to_report), 1) AS mean,
        round(quantile_cont(days_to_report, 0.9), 1) AS p90, round(quantile_cont(days_to_report, 0.95), 1) AS p95 FROM s"""
    ),
    "g2_lag_by_group": stats_by("days_to_report", ["specialty", "region", "severity_level"], True),
    "g3_slow_reporters": slow(2),
    "g3_above_median_reporters": slow(1),
    "g4_monthly_lag_trend": S(
        f"""SELECT {M} AS incident_month, round(median(days_to_report), 1) AS median, round(avg(days_to_report), 1) AS mean,
        count(*) AS claim_count FROM s WHERE days_to_report IS NOT NULL GROUP BY 1"""
    ),
    "r1_reopen_rate": S(f"SELECT count(*) AS total_claims, {RE} AS reopened_claims, {rate(RE)} AS reopen_rate_pct FROM s"),
    "r2_reopen_by_provider": S(
        f"""SELECT provider_id, count(claim_id) AS claim_count, {RE} AS reopened, min(provider_name) AS provider_name,
        min(specialty) AS specialty, {rate(RE)} AS reopen_rate_pct FROM s GROUP BY 1 HAVING count(claim_id) >= 5
        ORDER BY reopen_rate_pct DESC, provider_id LIMIT 50"""
    ),
    "r3_reopen_by_root_cause": S(
        f"SELECT root_cause_category, count(*) AS claim_count, {RE} AS reopened, {rate(RE)} AS reopen_rate_pct FROM s GROUP BY 1"
    ),
    "r3_reopen_by_specialty": S(
        f"SELECT specialty, count(*) AS claim_count, {RE} AS reopened, {rate(RE)} AS reopen_rate_pct FROM s GROUP BY 1"
    ),
    "r4_litigation_link": S(
        f"""SELECT 'litigation_rate_by_reopen_status' AS measure, CASE WHEN status = 'reopened' THEN 'reopened' ELSE 'not_reopened' END
        AS status_group, count(*) AS claim_count, {rate('sum(litigation_flag)')} AS rate_pct FROM s GROUP BY 2
        UNION ALL SELECT 'reopen_rate_by_litigation_status', CASE WHEN litigation_flag = 1 THEN 'litigated' ELSE 'not_litigated' END,
        count(*), {rate(RE)} FROM s GROUP BY 2"""
    ),
    "r5_repeat_events": S(
        " UNION ALL ".join(
            f"SELECT '{d}' AS dimension, {m} AS member, count(*) AS claim_count, CAST(sum(repeat_event_flag) AS BIGINT) AS repeat_count,"
            f" {rate('sum(repeat_event_flag)')} AS repeat_rate_pct,"
            f" count(*) FILTER (WHERE repeat_event_flag = 1 AND status = 'reopened') AS repeat_and_reopened FROM s {g}"
            for d, m, g in [
                ("overall", "'all'", ""),
                ("severity_level", "CAST(severity_level AS VARCHAR)", "WHERE severity_level IS NOT NULL GROUP BY severity_level"),
                ("claim_type", "claim_type", "GROUP BY claim_type"),
            ]
        )
    ),
    "b1_indicators": S(f"SELECT indicator, numerator, denominator, rate_per_1000 FROM ({indicator_rows('', '')})"),
    "b2_departments": S(
        f""", a AS ({indicator_rows('', '')}), d AS ({indicator_rows('department,', 'GROUP BY department')})
        SELECT department, d.indicator, d.claim_count, d.rate_per_1000 AS dept_rate_per_1000, a.rate_per_1000 AS benchmark_rate_per_1000,
        CASE WHEN a.rate_per_1000 > 0 THEN round((d.rate_per_1000 - a.rate_per_1000) / a.rate_per_1000 * 100, 2) ELSE 0.0::DOUBLE END AS variance_pct,
        CASE WHEN d.rate_per_1000 > a.rate_per_1000 * 1.1::DOUBLE THEN 'above_benchmark'
        WHEN d.rate_per_1000 < a.rate_per_1000 * 0.9::DOUBLE THEN 'below_benchmark' ELSE 'at_benchmark' END AS status
        FROM d JOIN a ON d.indicator = a.indicator"""
    ),
    "b3_quarterly": S(
        f"SELECT quarter, indicator, rate_per_1000 FROM ({indicator_rows(Q + ' AS quarter,', 'GROUP BY ' + Q)})"
    ),
    "x1_close_time": S(
        f""", c AS (SELECT days_to_close AS d FROM s WHERE days_to_close IS NOT NULL), f AS (SELECT unnest([10, 20, 30]) AS pct),
        b AS (SELECT avg(d) AS mean0, median(d) AS med0, count(*) FILTER (WHERE d > 180) AS o180, count(*) FILTER (WHERE d > 365) AS o365,
          (SELECT count(*) FROM s WHERE status IN ('open', 'reopened')) AS ob FROM c),
        n AS (SELECT pct, avg(d * {_fac}) AS mean1, median(d * {_fac}) AS med1, count(*) FILTER (WHERE d * {_fac} > 180) AS n180,
          count(*) FILTER (WHERE d * {_fac} > 365) AS n365 FROM c, f GROUP BY pct),
        j AS (SELECT *, CAST(floor(ob * {_fac}) AS BIGINT) AS eb FROM n, b)
        SELECT pct AS reduction_pct, round(mean0, 1) AS mean_close_days, round(med0, 1) AS median_close_days,
        o180 AS claims_over_180_days, o365 AS claims_over_365_days, ob AS open_backlog, round(mean1, 1) AS new_mean_close_days,
        round(med1, 1) AS new_median_close_days, n180 AS new_claims_over_180_days, n365 AS new_claims_over_365_days,
        eb AS estimated_backlog, round(mean1 - mean0, 1) AS mean_close_days_change, n365 - o365 AS over_365_change,
        eb - ob AS backlog_change, {pct('n365 - o365', 'o365')} AS over_365_change_pct, {pct('eb - ob', 'ob')} AS backlog_change_pct FROM j"""
    ),
    "x2_severity_shift": S(
        f"""{PORTFOLIO} SELECT pct AS shift_pct, round(rated_sum, 2) AS baseline_total_incurred, high_n AS high_severity_count,
        round(high_sum, 2) AS high_severity_incurred, round(high_avg, 2) AS avg_cost_severity_4_5, round(mid_avg, 2) AS avg_cost_severity_3,
        {_moved} AS claims_shifted, high_n - {_moved} AS remaining_high_severity, round(rated_sum - {_save1}, 2) AS new_total_incurred,
        round(-{_save1}, 2) AS absolute_change, {pct('-' + _save1, 'rated_sum')} AS pct_change FROM p, (SELECT unnest([10, 20, 30]) AS pct)"""
    ),
    "x3_litigation_cut": S(
        f"""{PORTFOLIO} SELECT pct AS reduction_pct, total AS total_claims, lit_n AS litigated_claims, {pct('lit_n', 'total')} AS litigation_rate_pct,
        round(lit_avg, 2) AS avg_cost_litigated, round(nolit_avg, 2) AS avg_cost_non_litigated, round(lit_sum, 2) AS total_litigation_cost,
        3.0::DOUBLE AS cost_multiplier, round(all_sum, 2) AS baseline_total_incurred, {_removed} AS claims_no_longer_litigated,
        lit_n - {_removed} AS remaining_litigated, {pct(f'lit_n - {_removed}', 'total')} AS new_litigation_rate_pct,
        round(all_sum - {_save2}, 2) AS new_total_incurred, round(-{_save2}, 2) AS absolute_change, {pct('-' + _save2, 'all_sum')} AS pct_change
        FROM p, (SELECT unnest([25, 50]) AS pct)"""
    ),
    "x4_combined": S(
        f"""{PORTFOLIO} SELECT round(all_sum, 2) AS baseline_total_incurred, round(all_sum - {_cs}, 2) AS new_total_incurred,
        round({_cs}, 2) AS total_savings, round({_c1}, 2) AS severity_shift_savings, round({_c2}, 2) AS litigation_reduction_savings,
        round({_c3}, 2) AS close_time_reduction_savings, round(-{_cs}, 2) AS absolute_change, {pct('-' + _cs, 'all_sum')} AS pct_change,
        open_n AS baseline_open, {_fewer} AS estimated_new_open, open_n - {_fewer} AS backlog_reduction, 20 AS severity_shift_pct,
        25 AS litigation_reduction_pct, 20 AS close_time_reduction_pct, 0.05::DOUBLE AS close_time_reserve_impact_factor FROM p"""
    ),
}
