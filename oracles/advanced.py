"""Oracle SQL of the reserving, survival, interval and model-input queries."""

from statistics import NormalDist

from oracles.base import AS_OF, with_summary

S = with_summary
Z = repr(NormalDist().inv_cdf(0.975))


def tri(segment: str) -> str:
    """Cells of the triangle (``inc`` is an exact decimal) per segment."""
    return f""", cell AS (SELECT {segment} AS segment, accident_year, development_year,
      sum(CAST(paid_amount AS DECIMAL(18, 6))) AS inc FROM s GROUP BY 1, 2, 3),
    grid AS (SELECT segment, accident_year, development_year, inc::DOUBLE AS inc,
      (sum(inc) OVER (PARTITION BY segment, accident_year ORDER BY development_year))::DOUBLE AS cum,
      dense_rank() OVER (PARTITION BY segment ORDER BY development_year) AS step FROM cell),
    pairs AS (SELECT g.*, h.cum AS nxt FROM grid g LEFT JOIN grid h
      ON g.segment = h.segment AND g.accident_year = h.accident_year AND h.step = g.step + 1),
    fac AS (SELECT segment, step, min(development_year) AS dev, sum(cum) AS col_total,
      round(sum(nxt) / nullif(sum(cum) FILTER (WHERE nxt IS NOT NULL), 0), 6) AS factor FROM pairs GROUP BY 1, 2),
    lnk AS (SELECT *, lead(dev) OVER (PARTITION BY segment ORDER BY step) AS next_dev FROM fac),
    cdf AS (SELECT a.segment, a.step, a.dev, round(coalesce((SELECT product(coalesce(b.factor, 1)) FROM lnk b
      WHERE b.segment = a.segment AND b.step >= a.step AND b.next_dev IS NOT NULL), 1), 6) AS cdf FROM lnk a),
    last AS (SELECT segment, accident_year, max(step) AS step, arg_max(development_year, step) AS latest, arg_max(cum, step) AS cum
      FROM grid GROUP BY 1, 2),
    ult AS (SELECT l.segment, l.accident_year, round(l.cum, 2) AS current_paid, latest AS latest_dev_year, cdf AS cdf_applied,
      round(l.cum * cdf, 2) AS ultimate, l.step FROM last l JOIN cdf c ON l.segment = c.segment AND l.step = c.step)"""


TRI = tri("'all'")
IBNR = """SELECT segment, coalesce(CAST(accident_year AS VARCHAR), 'total') AS accident_year, round(sum(current_paid), 2) AS current_paid,
  round(sum(ultimate), 2) AS ultimate, round(sum(ultimate) - sum(current_paid), 2) AS ibnr FROM ult
  GROUP BY GROUPING SETS ((segment, accident_year), (segment))"""
MACK = """, sig AS (SELECT f.segment, f.step, f.factor, f.col_total, CASE WHEN f.factor IS NULL THEN NULL WHEN count(p.nxt) <= 1 THEN 0
    ELSE sum(p.cum * (p.nxt / p.cum - f.factor) * (p.nxt / p.cum - f.factor)) / (count(p.nxt) - 1) END AS s2
    FROM lnk f LEFT JOIN pairs p ON f.segment = p.segment AND f.step = p.step AND p.nxt IS NOT NULL AND p.cum <> 0
    WHERE f.next_dev IS NOT NULL GROUP BY 1, 2, 3, 4),
  roll AS (SELECT u.segment, u.accident_year, s.step, s.factor, s.s2, s.col_total, u.current_paid * coalesce((SELECT product(q.factor)
    FROM sig q WHERE q.segment = u.segment AND q.step >= u.step AND q.step < s.step), 1) AS c
    FROM ult u JOIN sig s ON s.segment = u.segment AND s.step >= u.step),
  var AS (SELECT segment, accident_year, sum(s2 / (factor * factor) * (1 / c + 1 / col_total)) AS v FROM roll GROUP BY 1, 2),
  se AS (SELECT u.*, coalesce(sqrt(v), 0) * ultimate AS se FROM ult u LEFT JOIN var USING (segment, accident_year))
  SELECT segment, accident_year, round(ultimate - current_paid, 2) AS ibnr, round(se, 2) AS se,
  round(greatest(0, ultimate - current_paid - 1.96::DOUBLE * se), 2) AS ci_lower, round(ultimate - current_paid + 1.96::DOUBLE * se, 2) AS ci_upper FROM se"""

DUR = f""", dur AS (SELECT claim_type, CAST(status = 'closed' AS INTEGER) AS event,
    CASE WHEN status = 'closed' THEN days_to_close ELSE date_diff('day', report_date, {AS_OF}) END AS t FROM s)"""


def km(group: str) -> str:
    return f"""{DUR}, cnt AS (SELECT {group} AS g, CAST(t AS INTEGER) AS t, sum(event) AS d, count(*) AS m FROM dur WHERE t > 0 GROUP BY 1, 2),
    risk AS (SELECT g, t, d, sum(m) OVER (PARTITION BY g ORDER BY t DESC) AS n FROM cnt),
    acc AS (SELECT *, max(CAST(n = d AS INTEGER)) OVER w AS ended,
      sum(CASE WHEN n > d THEN ln((n - d) / n) ELSE 0 END) OVER w AS v0,
      sum(CASE WHEN n > d THEN d / (n * (n - d)) ELSE 0 END) OVER w AS gw FROM risk WINDOW w AS (PARTITION BY g ORDER BY t)),
    km AS (SELECT g, t, n, d, CASE WHEN ended = 1 THEN 0 ELSE exp(v0) END AS s, CASE WHEN ended = 0 THEN v0 END AS v, gw FROM acc)"""


def bound(sign: str) -> str:
    return f"CASE WHEN v < 0 THEN exp(-exp(ln(-v) {sign} {Z}::DOUBLE * sqrt(gw) / v)) WHEN v IS NOT NULL THEN 1 ELSE 0 END"


CURVE = f"""SELECT g AS survival_group, t, CAST(n AS BIGINT) AS at_risk, CAST(d AS BIGINT) AS events, round(s::DOUBLE, 8) AS survival,
  round({bound('-')}, 8) AS ci_lower, round({bound('+')}, 8) AS ci_upper FROM km
  UNION ALL SELECT g, 0, CAST(max(n) AS BIGINT), 0, 1.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE FROM km GROUP BY g"""
MEDIAN = "SELECT g AS survival_group, min(t) FILTER (WHERE round(s::DOUBLE, 12) <= 0.5) AS median_survival_time FROM km GROUP BY 1"

LOGRANK = f"""{DUR}, g AS (SELECT DISTINCT claim_type AS g FROM dur),
  pr AS (SELECT a.g AS group_a, b.g AS group_b FROM g a JOIN g b ON a.g < b.g),
  cnt AS (SELECT claim_type AS g, t, sum(event) AS d, count(*) AS m FROM dur WHERE t > 0 GROUP BY 1, 2),
  dd AS (SELECT group_a, group_b, t, sum(d) FILTER (WHERE g = group_a) AS da, sum(m) FILTER (WHERE g = group_a) AS ma, sum(d) AS d, sum(m) AS m
    FROM cnt JOIN pr ON g IN (group_a, group_b) GROUP BY 1, 2, 3),
  rk AS (SELECT *, (sum(coalesce(ma, 0)) OVER w)::DOUBLE AS na, (sum(m) OVER w)::DOUBLE AS n FROM dd WINDOW w AS (PARTITION BY group_a, group_b ORDER BY t DESC)),
  st AS (SELECT group_a, group_b, sum(coalesce(da, 0)) - sum(d * na / n) AS gap,
    sum(CASE WHEN n > 1 THEN na * (n - na) * d * (n - d) / (n * n * (n - 1)) ELSE 0 END) AS v FROM rk GROUP BY 1, 2)
"""


def erfc(z: str) -> str:
    """Complementary error function of a non-negative expression: Taylor series of erf below 1.5, asymptotic fraction beyond."""
    terms, whole = "1", "1"
    for k in range(60, 0, -1):
        terms = f"(1 + {terms} * 2 * {z} * {z} / {2 * k + 1})"
    for k in range(90, 0, -1):
        whole = f"(1 + {k} / (2 * {z} * {z}) / {whole})"
    return f"CASE WHEN {z} < 1.5 THEN 1 - 2 / sqrt(pi()) * exp(-{z} * {z}) * {z} * {terms} ELSE exp(-{z} * {z}) / ({z} * sqrt(pi())) / {whole} END"

_p = "(successes / trials::DOUBLE)"
_zz = f"({Z}::DOUBLE * {Z}::DOUBLE)"
_mid = f"(({_p} + {_zz} / 2 / trials) / (1 + {_zz} / trials))"
_spr = f"(sqrt({_p} * (1 - {_p}) / trials + {_zz} / 4 / (trials::DOUBLE * trials)) * {Z}::DOUBLE / (1 + {_zz} / trials))"

VALID = "s WHERE lower(status) = 'closed' AND severity_level BETWEEN 1 AND 5"
FEATURES = ["log_paid_amount", "days_to_close", "days_to_report", "severity_level", "litigation_flag"]
MEASURES = ["paid_amount", "days_to_close", "days_to_report", "severity_level", "litigation_flag"]


def macro(x: str) -> str:
    return f"round({x}, 6)"


REPORT = """, p AS (SELECT severity_level AS a, days_to_report % 5 + 1 AS b FROM s WHERE severity_level IS NOT NULL),
  c AS (SELECT k, (SELECT count(*) FROM p WHERE a = k) AS support, (SELECT count(*) FROM p WHERE b = k) AS called,
    (SELECT count(*) FROM p WHERE a = k AND b = k) AS tp FROM (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
  m AS (SELECT *, coalesce(tp / nullif(called, 0), 0) AS pr, coalesce(tp / nullif(support, 0), 0) AS re FROM c),
  f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM m)
  SELECT CAST(k AS VARCHAR) AS row, round(pr, 6) AS "precision", round(re, 6) AS recall, round(f1, 6) AS f1_score, support FROM f
  UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
  UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
  UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 6), round(sum(re * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f"""


def months(key: str) -> str:
    """``y``: claims per series and month, with the empty months."""
    return f""", c AS (SELECT {key} AS series_key, CAST(date_trunc('month', incident_date) AS DATE) AS month, count(*) AS n FROM s GROUP BY 1, 2),
        g AS (SELECT series_key, CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month FROM c GROUP BY 1),
        y AS (SELECT series_key, month, coalesce(n, 0) AS y FROM g LEFT JOIN c USING (series_key, month))"""


def series(key: str) -> str:
    return S(f"{months(key)} SELECT series_key, month, y FROM y")


def naive(key: str) -> str:
    """``nv``: every month of the coming year as the same month of the last one."""
    return f"""{months(key)}, ch AS (SELECT a.series_key, a.month, a.y, a.y - b.y AS change FROM y a
        LEFT JOIN y b ON b.series_key = a.series_key AND b.month = CAST(a.month - INTERVAL 12 MONTH AS DATE)),
        ends AS (SELECT series_key, max(month) AS last, stddev_samp(change) AS resid_std FROM ch GROUP BY 1),
        nv AS (SELECT series_key, CAST(month + INTERVAL 12 MONTH AS DATE) AS month, CAST(date_diff('month', last, CAST(month + INTERVAL 12 MONTH AS DATE)) AS INTEGER) AS horizon,
          y::DOUBLE AS forecast, resid_std FROM ch JOIN ends USING (series_key) WHERE month > CAST(last - INTERVAL 12 MONTH AS DATE))"""


TYPE_REGION = "concat_ws('|', claim_type, region)"
LATE = f"""{months("concat_ws('|', claim_type)")}, r AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY month DESC) AS back, count(*) OVER (PARTITION BY series_key) AS size FROM y),
        bt AS (SELECT a.series_key, a.month, a.y::DOUBLE AS actual, b.y::DOUBLE AS forecast FROM r a JOIN r b ON a.series_key = b.series_key AND b.back = a.back + 12 WHERE a.back <= 6 AND a.size >= 12)"""


def scaled() -> str:
    logs = "CASE WHEN paid_amount IS NOT NULL THEN ln(1 + greatest(paid_amount, 0)) END"
    values = {"log_paid_amount": logs} | {c: f"{c}::DOUBLE" for c in FEATURES[1:]}
    base = ", ".join(f"coalesce({v}, (SELECT median({v}) FROM s)) AS {c}" for c, v in values.items())
    cols = ", ".join(f"round(({c} - (SELECT avg({c}) FROM x)) / (SELECT stddev_pop({c}) FROM x), 6) AS {c}" for c in FEATURES)
    return S(f", x AS (SELECT claim_id, {base} FROM s) SELECT claim_id, {cols} FROM x")


def compared() -> str:
    n, a = "paid_amount <= 90000", "paid_amount > 90000"
    return S(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE {n}), 2) AS normal_mean, round(avg({c}) FILTER (WHERE {a}), 2) AS anomaly_mean,"
            f" round(median({c}) FILTER (WHERE {n}), 2) AS normal_median, round(median({c}) FILTER (WHERE {a}), 2) AS anomaly_median,"
            f" round((avg({c}) FILTER (WHERE {a}) - avg({c}) FILTER (WHERE {n})) / avg({c}) FILTER (WHERE {n}) * 100, 2) AS pct_diff_mean FROM s"
            for c in MEASURES
        )
    )


SQL = {
    "m1_valid_claims": S(f"SELECT claim_id, severity_level FROM {VALID}"),
    "m2_feature_table": S(
        f""", v AS (SELECT * FROM {VALID}), top AS (SELECT specialty FROM v GROUP BY 1 ORDER BY count(*) DESC, specialty LIMIT 10)
        SELECT claim_id, severity_level, claim_type, CASE WHEN specialty IN (SELECT specialty FROM top) THEN specialty ELSE 'other' END AS specialty_group,
        region, patient_age_band, round(ln(1 + greatest(paid_amount, 0)), 9) AS log_paid_amount, days_to_report::DOUBLE AS days_to_report,
        litigation_flag::DOUBLE AS litigation_flag, repeat_event_flag::DOUBLE AS repeat_event_flag FROM v"""
    ),
    "m3_split": S(
        f""", c AS (SELECT severity_level, count(*) AS n FROM {VALID} GROUP BY 1)
        SELECT severity_level, 0 AS part, CAST(ceil(round(n * 0.2::DOUBLE, 6)) AS BIGINT) AS claims FROM c
        UNION ALL SELECT severity_level, 1, n - CAST(ceil(round(n * 0.2::DOUBLE, 6)) AS BIGINT) FROM c"""
    ),
    "m8_predicted_totals": S(
        f"""SELECT model, severity_level, CAST(ceil(round(count(*) * 0.2::DOUBLE, 6)) AS BIGINT) AS claims FROM (SELECT * FROM {VALID}) v
        CROSS JOIN (VALUES ('Random Forest'), ('Logistic Regression'), ('Gradient Boosting')) m(model) GROUP BY 1, 2"""
    ),
    "m10_calibration_rows": S(
        f"""SELECT model, CAST(class AS INTEGER) AS class, count(*) AS claims FROM (SELECT * FROM {VALID}) v
        CROSS JOIN (VALUES ('Random Forest'), ('Logistic Regression'), ('Gradient Boosting')) m(model)
        CROSS JOIN range(1, 6) k(class) GROUP BY 1, 2"""
    ),
    "x5_savings_order": S("SELECT claim_type, true AS ordered FROM s GROUP BY 1"),
    "x6_bootstrap_bounds": S(
        """SELECT 'sum of paid_amount' AS statistic, round(sum(paid_amount), 2) AS estimate, true AS inside FROM s
        UNION ALL SELECT 'mean of severity_level', round(avg(severity_level), 2), true FROM s
        UNION ALL SELECT 'median of paid_amount', round(quantile_cont(paid_amount::DOUBLE, 0.5), 2), true FROM s
        UNION ALL SELECT '95th percentile of paid_amount', round(quantile_cont(paid_amount::DOUBLE, 0.95), 2), true FROM s
        UNION ALL SELECT 'deviation of severity_level', round(stddev_pop(severity_level), 2), true FROM s"""
    ),
    "m8_report_fixed": S(REPORT),
    "m8_confusion_fixed": S(
        """, p AS (SELECT severity_level AS a, days_to_report % 5 + 1 AS b FROM s WHERE severity_level IS NOT NULL)
        SELECT actual, predicted, (SELECT count(*) FROM p WHERE a = actual AND b = predicted) AS claim_count
        FROM (SELECT unnest([1, 2, 3, 4, 5]) AS actual), (SELECT unnest([1, 2, 3, 4, 5]) AS predicted)"""
    ),
    "m12_monthly_series": series("'all'"),
    "m12_monthly_series_by_type": series("concat_ws('|', claim_type, region)"),
    "m13_seasonal_naive_by_type": S(f"{naive(TYPE_REGION)} SELECT series_key, month, horizon, forecast, round(resid_std, 6) AS resid_std FROM nv"),
    "m13_fit_invariants": S(
        f"""{months(TYPE_REGION)} SELECT series_key, CASE WHEN count(*) >= 24 THEN 'holt_winters' ELSE 'simple_exponential_smoothing' END AS method,
        CAST(12 AS BIGINT) AS horizons, CAST(max(month) + INTERVAL 1 MONTH AS DATE) AS first_month, CAST(max(month) + INTERVAL 12 MONTH AS DATE) AS last_month,
        true AS below_constant, true AS inside_bands FROM y GROUP BY 1"""
    ),
    "m14_bands_fixed": S(
        f"""{naive("concat_ws('|', claim_type)")} SELECT series_key, month, horizon, forecast, round(resid_std, 6) AS resid_std,
        round(greatest(forecast - 1.2816 * resid_std * sqrt(horizon), 0), 6) AS lower_80, round(forecast + 1.2816 * resid_std * sqrt(horizon), 6) AS upper_80,
        round(greatest(forecast - 1.96 * resid_std * sqrt(horizon), 0), 6) AS lower_95, round(forecast + 1.96 * resid_std * sqrt(horizon), 6) AS upper_95 FROM nv"""
    ),
    "m15_backtest_rows_fixed": S(f"{LATE} SELECT series_key, month, forecast, actual FROM bt"),
    "m15_backtest_fixed": S(
        f"""{LATE} SELECT series_key, round(avg(abs((actual - forecast) / actual)) FILTER (WHERE actual <> 0) * 100, 6) AS mape,
        round(sqrt(avg((actual - forecast) * (actual - forecast))), 6) AS rmse, round(avg(abs(actual - forecast)), 6) AS mae FROM bt GROUP BY 1"""
    ),
    "k9_forecast_fixed": S(
        f"""{naive(TYPE_REGION)} SELECT series_key, last_day(month) AS date, 'actual' AS type, y::DOUBLE AS claim_count FROM y
        UNION ALL SELECT series_key, last_day(month), 'forecast', forecast FROM nv"""
    ),
    "m16_anomaly_features": scaled(),
    "m18_summary_fixed": compared(),
    "m19_months_fixed": S(
        """SELECT strftime(incident_date, '%Y-%m') AS incident_month, count(*) AS total_claims, count(*) FILTER (WHERE paid_amount > 90000) AS anomaly_count,
        round(count(*) FILTER (WHERE paid_amount > 90000) / count(*) * 100, 2) AS anomaly_rate FROM s GROUP BY 1"""
    ),
    "t1_triangle": S(
        f"{TRI} SELECT segment, accident_year, development_year, round(inc, 2) AS incremental_paid, round(cum, 2) AS cumulative_paid FROM grid"
    ),
    "t2_age_to_age": S(f"{TRI} SELECT segment, dev AS from_dev, next_dev AS to_dev, factor FROM lnk WHERE next_dev IS NOT NULL"),
    "t3_cumulative_factors": S(f"{TRI} SELECT segment, dev AS development_year, cdf FROM cdf"),
    "t4_ultimates": S(f"{TRI} SELECT segment, accident_year, current_paid, latest_dev_year, cdf_applied, ultimate FROM ult"),
    "t5_ibnr": S(f"{TRI} {IBNR}"),
    "t6_standard_errors": S(TRI + MACK),
    "t6_standard_errors_by_segment": S(tri("concat_ws('|', specialty, region)") + MACK),
    "t5_ibnr_by_segment": S(f"{tri(chr(39) + chr(39) + ' || specialty')} {IBNR}"),
    "x7_litigation_interval": S(
        f""", c AS (SELECT claim_type, CAST(sum(litigation_flag) AS BIGINT) AS successes, count(*) AS trials FROM s GROUP BY 1)
        SELECT claim_type, successes, trials, round({_p}, 9) AS estimate, round({_mid} - {_spr}, 9) AS ci_lower,
        round({_mid} + {_spr}, 9) AS ci_upper, round({_spr}, 9) AS margin_of_error FROM c"""
    ),
    "u1_durations": S(f"{DUR} SELECT claim_type, event, CAST(t AS INTEGER) AS duration, count(*) AS claims FROM dur WHERE t > 0 GROUP BY 1, 2, 3"),
    "u2_survival": S(f"{km(chr(39) + 'all' + chr(39))} {CURVE}"),
    "u3_survival_by_type": S(f"{km('claim_type')} {CURVE}"),
    "u4_median_survival": S(f"{km('claim_type')} {MEDIAN}"),
    "u5_log_rank": S(f"{LOGRANK} SELECT group_a, group_b, round(gap * gap / v, 8) AS test_statistic FROM st"),
    "u5_log_rank_p": S(
        f"""{LOGRANK}, zz AS (SELECT *, gap * gap / v AS x, sqrt(gap * gap / v / 2) AS z FROM st), pp AS (SELECT *, {erfc("z")} AS p FROM zz)
        SELECT group_a, group_b, round(x, 8) AS test_statistic, round(p, 9) AS p_value, p < 0.05 AS significant FROM pp"""
    ),
}
