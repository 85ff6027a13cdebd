"""Shared DuckDB text: the adapter, cleaning, star schema and summary as common table expressions."""

import re

from lossmetrics import config
from lossmetrics.sources import lookups

AS_OF = f"DATE '{config.AS_OF}'"


def text_list(values) -> str:
    return "[" + ", ".join(lookups.sql_text(v).rstrip("D") if isinstance(v, float) else lookups.sql_text(v) for v in values) + "]"


def pick(values, index: str, cast: str = "VARCHAR") -> str:
    return f"CAST(list_extract({text_list(values)}, CAST({index} % {len(values)} AS INTEGER) + 1) AS {cast})"


def numbered(prefix: str, count: int, index: str) -> str:
    return f"'{prefix}' || lpad(CAST({index} % {count} + 1 AS VARCHAR), 2, '0')"


def values_cte(rows, columns) -> str:
    body = ", ".join("(" + ", ".join(f"CAST({v} AS DOUBLE)" if isinstance(v, float) else lookups.sql_text(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"


def age_band(x: str) -> str:
    return (
        f"CASE WHEN {x} < 18 THEN '0-17' WHEN {x} < 35 THEN '18-34' WHEN {x} < 50 THEN '35-49' "
        f"WHEN {x} < 65 THEN '50-64' WHEN {x} IS NOT NULL THEN '65+' END"
    )


def exact_round(x: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal form, as Spark rounds; binary rounding differs on row-level ties."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 15)), {digits}) AS DOUBLE)"


def surrogate(columns: str, natural: str, key: str, source: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY md5({natural}), {natural}) AS {key}, {columns} FROM ({source})"


_weights = [w for _, _, w in lookups.DIAGNOSES]

RAW = f"""
joined AS (
  SELECT *, CAST(o_orderdate AS DATE) AS od, CAST(l_shipdate AS DATE) AS sd,
         l_extendedprice * (1 - l_discount) AS loss
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
dated AS (
  SELECT *, CAST(od + to_days(CAST(date_diff('day', od, sd) % 400 AS INTEGER)) AS DATE) AS rd FROM joined),
raw AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, sd) AS claim_id,
    od AS incident_date, rd AS report_date,
    CASE WHEN o_orderstatus = 'F'
         THEN CAST(greatest(od, rd) + to_days(CAST(l_quantity * 8 AS INTEGER)) AS DATE) END AS close_date,
    CAST(year(least(od, rd)) AS INTEGER) AS accident_year, CAST(year(greatest(od, rd)) AS INTEGER) AS report_year,
    CAST(year(greatest(od, rd)) - year(least(od, rd)) AS INTEGER) AS development_year,
    'PRV' || l_suppkey AS provider_id,
    CASE WHEN l_linenumber = 3 THEN lower(n_name) ELSE n_name END AS state_code, r_name AS region,
    CASE WHEN l_linenumber <> 5 THEN {numbered('DX', 20, 'l_partkey')} END AS diagnosis_id,
    {numbered('RC', 12, 'l_orderkey')} AS root_cause_id,
    {pick(lookups.CLAIM_TYPES, 'l_orderkey')} AS claim_type,
    {pick(lookups.PROCEDURES, '(l_orderkey + l_linenumber)')} AS procedure_category,
    CASE WHEN l_linenumber = 4 THEN {pick(lookups.SEVERITY_WORDS, 'p_size')}
         ELSE CAST(1 + p_size % 5 AS VARCHAR) END AS severity,
    CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'reopened' END AS status,
    CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN -loss WHEN l_quantity = 50 THEN loss * 1000
         ELSE loss END AS paid_amount,
    loss * (1 + l_tax) AS reserve_amount, loss + loss * (1 + l_tax) AS incurred_amount,
    CAST(o_custkey % 96 AS INTEGER) AS patient_age, {age_band('(o_custkey % 96)')} AS patient_age_band,
    CASE WHEN o_custkey % 96 >= 65 AND {pick(_weights, 'l_partkey', 'DOUBLE')} >= 1.5 THEN 'critical'
         WHEN o_custkey % 96 >= 65 OR {pick(_weights, 'l_partkey', 'DOUBLE')} >= 1.5 THEN 'high'
         WHEN {pick(_weights, 'l_partkey', 'DOUBLE')} >= 1.0 THEN 'medium' ELSE 'low' END AS patient_risk_segment,
    CAST(l_returnflag = 'R' AS INTEGER) AS litigation_flag,
    CAST(l_linestatus = 'O' AND l_linenumber = 1 AS INTEGER) AS repeat_event_flag,
    CAST(date_diff('day', least(od, rd), greatest(od, rd)) AS INTEGER) AS report_lag_days
  FROM dated)"""

CLEAN = """
clean AS (
  SELECT DISTINCT * REPLACE (
    CASE WHEN abs(paid_amount) > 5000000 THEN 5000000.0::DOUBLE ELSE abs(paid_amount) END AS paid_amount,
    upper(state_code) AS state_code,
    CASE lower(trim(severity)) WHEN 'one' THEN 1 WHEN 'two' THEN 2 WHEN 'three' THEN 3 WHEN 'four' THEN 4
      WHEN 'five' THEN 5 ELSE TRY_CAST(severity AS INTEGER) END AS severity,
    CASE WHEN report_date < incident_date THEN report_date ELSE incident_date END AS incident_date,
    CASE WHEN report_date < incident_date THEN incident_date ELSE report_date END AS report_date,
    coalesce(diagnosis_id, 'UNKNOWN') AS diagnosis_id)
  FROM raw)"""

_specialties = [n for n, _ in lookups.SPECIALTIES]
_tiers = [t for _, t in lookups.SPECIALTIES]
PROVIDERS = f"""SELECT 'PRV' || s_suppkey AS provider_id, {pick(_specialties, 's_suppkey')} AS specialty_name,
  {pick(lookups.DEPARTMENTS, 's_suppkey')} AS department, {pick(_tiers, 's_suppkey')} AS risk_tier FROM supplier"""
_diag_rows = [(f"DX{i:02d}", n, w) for i, (_, n, w) in enumerate(lookups.DIAGNOSES, 1)] + [("UNKNOWN", "Unknown", 1.0)]
_cause_rows = [(f"RC{i:02d}", n, p) for i, (n, p) in enumerate(lookups.ROOT_CAUSES, 1)]

DIMS = f"""
providers AS ({PROVIDERS}),
dim_provider AS ({surrogate("provider_id, 'Provider ' || provider_id AS provider_name, specialty_name AS specialty, department, risk_tier", "provider_id", "provider_key", "SELECT * FROM providers")}),
dim_region AS ({surrogate("*", "state_code", "region_key", f"SELECT n_name AS state_code, n_name AS state_name, r_name AS region, {pick(lookups.URBAN_RURAL, 'n_nationkey')} AS urban_rural FROM nation JOIN region ON n_regionkey = r_regionkey")}),
dim_diagnosis AS ({surrogate("*", "diagnosis_code", "diagnosis_key", values_cte(_diag_rows, ["diagnosis_code", "diagnosis_category", "severity_weight"]))}),
dim_root_cause AS ({surrogate("*", "root_cause_code", "root_cause_key", values_cte(_cause_rows, ["root_cause_code", "root_cause_category", "preventability"]))})"""

FACT = """
fact AS (
  SELECT claim_id, incident_date, report_date, close_date, provider_key, region_key, diagnosis_key, root_cause_key,
    claim_type, procedure_category, severity AS severity_level, status, paid_amount, incurred_amount,
    reserve_amount AS reserved_amount, CAST(date_diff('day', incident_date, close_date) AS INTEGER) AS days_to_close,
    coalesce(report_lag_days, 0) AS days_to_report, patient_age_band, patient_risk_segment, repeat_event_flag,
    litigation_flag, accident_year, development_year
  FROM clean c JOIN dim_provider USING (provider_id)
  JOIN (SELECT region_key, state_code FROM dim_region) r ON c.state_code = r.state_code
  JOIN dim_diagnosis ON diagnosis_id = diagnosis_code JOIN dim_root_cause ON root_cause_id = root_cause_code)"""

SUMMARY = f"""
s AS (
  SELECT f.* EXCLUDE (provider_key, region_key, diagnosis_key, root_cause_key),
    p.* EXCLUDE (provider_key), r.* EXCLUDE (region_key), d.* EXCLUDE (diagnosis_key), rc.* EXCLUDE (root_cause_key),
    {exact_round('f.paid_amount / nullif(f.incurred_amount, 0)', 4)} AS loss_ratio,
    {exact_round('(f.reserved_amount - f.paid_amount)', 2)} AS reserve_adequacy,
    strftime(f.incident_date, '%Y-%m') AS incident_month,
    CASE WHEN f.severity_level >= 4 THEN 1 ELSE 0 END AS is_high_severity,
    CASE WHEN f.days_to_close > 365 THEN 1 ELSE 0 END AS is_long_tail
  FROM fact f JOIN dim_provider p USING (provider_key) JOIN dim_region r USING (region_key)
  JOIN dim_diagnosis d USING (diagnosis_key) JOIN dim_root_cause rc USING (root_cause_key))"""


def with_raw(sql: str) -> str:
    return f"WITH {RAW} {_tail(sql)}"


def with_clean(sql: str) -> str:
    return f"WITH {RAW}, {CLEAN} {_tail(sql)}"


def with_dims(sql: str) -> str:
    return f"WITH {DIMS} {_tail(sql)}"


def with_fact(sql: str) -> str:
    return f"WITH {RAW}, {CLEAN}, {DIMS}, {FACT} {_tail(sql)}"


def with_summary(sql: str) -> str:
    """``s`` is the claim summary; the query may start with further expressions as ``, name AS (...)``."""
    return f"WITH {RAW}, {CLEAN}, {DIMS}, {FACT}, {SUMMARY} {_tail(sql)}"


AMOUNT = r"(?:\w+\.)?(?:paid|incurred|reserved|reserve)_amount"


def _tail(sql: str) -> str:
    return _exact(sql.strip())


def _close(text: str, start: int) -> int:
    """Index of the parenthesis that closes the one before ``start``."""
    depth = 1
    for i in range(start, len(text)):
        depth += (text[i] == "(") - (text[i] == ")")
        if depth == 0:
            return i
    raise ValueError(text[start:])


def _exact(sql: str) -> str:
    """Write amounts as exact decimal sums and every rounding as half-up on the decimal form."""
    out, at = "", 0
    for m in re.finditer(r"(?<![\w.])round\(", sql):
        if m.start() < at:
            continue
        end = _close(sql, m.end())
        body = sql[m.end() : end]
        comma = body.rfind(",")
        value, digits = body[:comma].strip(), body[comma + 1 :].strip()
        out += _sums(sql[at : m.start()])
        single = re.match(r"sum\(", value)
        if single and _close(value, 4) == len(value) - 1 and re.search(AMOUNT, value):
            out += f"CAST(round(sum(CAST({value[4:-1]} AS DECIMAL(18, 6))), {digits}) AS DOUBLE)"
        else:
            out += exact_round("(" + _exact(value) + ")", int(digits))
        at = end + 1
    return out + _sums(sql[at:])


def _sums(sql: str) -> str:
    later = r"(?! FILTER| OVER)"
    sql = re.sub(rf"\bsum\(({AMOUNT})\){later}", r"CAST(sum(CAST(\1 AS DECIMAL(18, 6))) AS DOUBLE)", sql)
    return re.sub(rf"\bavg\(({AMOUNT})\){later}", r"(CAST(sum(CAST(\1 AS DECIMAL(18, 6))) AS DOUBLE) / count(\1))", sql)


def quarter(x: str) -> str:
    return f"year({x}) || 'Q' || quarter({x})"


def month(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def bucket(x: str, edges: list[int], labels: list[str]) -> str:
    whens = " ".join(f"WHEN {x} <= {u} THEN '{l}'" for u, l in zip(edges[1:], labels))
    return f"CASE WHEN {x} IS NULL OR {x} <= {edges[0]} THEN NULL {whens} ELSE '{labels[-1]}' END"
