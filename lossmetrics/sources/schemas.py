"""Explicit schemas of the raw files and of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "date": T.DateType(), "int": T.IntegerType(), "double": T.DoubleType()}


def _schema(text: str) -> T.StructType:
    """``name type, ...`` as a schema, without needing a session."""
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw claims arrive as text: dates may not parse and severity mixes digits and words.
RAW_CLAIMS = """
claim_id string, incident_date string, report_date string, close_date string, accident_year string,
report_year string, development_year string, provider_id string, state_code string, region string,
diagnosis_id string, root_cause_id string, claim_type string, procedure_category string, severity string,
status string, paid_amount string, reserve_amount string, incurred_amount string, patient_age string,
patient_age_band string, patient_risk_segment string, litigation_flag string, repeat_event_flag string,
report_lag_days string
"""

# Raw dimensions are read as text; only an empty field is null.
RAW_DIMENSIONS = {
    "providers": "provider_id string, specialty_id string, specialty_name string, department string, risk_tier string",
    "regions": "state_code string, state_name string, region string, urban_rural string, "
    "volume_multiplier string, severity_multiplier string",
    "diagnoses": "diagnosis_id string, code string, category string, severity_weight string",
    "root_causes": "root_cause_id string, category string, preventability string",
}

DATE_COLUMNS = ["incident_date", "report_date", "close_date"]
AMOUNT_COLUMNS = ["paid_amount", "reserve_amount", "incurred_amount"]
INTEGER_COLUMNS = [
    "patient_age",
    "litigation_flag",
    "repeat_event_flag",
    "report_lag_days",
    "accident_year",
    "report_year",
    "development_year",
]

FACT_COLUMNS = [
    "claim_id",
    "incident_date",
    "report_date",
    "close_date",
    "provider_key",
    "region_key",
    "diagnosis_key",
    "root_cause_key",
    "claim_type",
    "procedure_category",
    "severity_level",
    "status",
    "paid_amount",
    "incurred_amount",
    "reserved_amount",
    "days_to_close",
    "days_to_report",
    "patient_age_band",
    "patient_risk_segment",
    "repeat_event_flag",
    "litigation_flag",
    "accident_year",
    "development_year",
]

PROVIDER_COLUMNS = ["provider_id", "provider_name", "specialty", "department", "risk_tier"]
REGION_COLUMNS = ["state_code", "state_name", "region", "urban_rural"]
DIAGNOSIS_COLUMNS = ["diagnosis_code", "diagnosis_category", "severity_weight"]
ROOT_CAUSE_COLUMNS = ["root_cause_code", "root_cause_category", "preventability"]

SUMMARY = """
claim_id string, incident_date date, report_date date, close_date date, claim_type string, procedure_category string,
severity_level int, status string, paid_amount double, incurred_amount double, reserved_amount double,
days_to_close int, days_to_report int, patient_age_band string, patient_risk_segment string, repeat_event_flag int,
litigation_flag int, accident_year int, development_year int, provider_id string, provider_name string,
specialty string, department string, risk_tier string, state_code string, state_name string, region string,
urban_rural string, diagnosis_code string, diagnosis_category string, severity_weight double, root_cause_code string,
root_cause_category string, preventability string, loss_ratio double, reserve_adequacy double, incident_month string,
is_high_severity int, is_long_tail int
"""


def raw_claims_schema() -> T.StructType:
    return _schema(RAW_CLAIMS)


def raw_dimension_schema(name: str) -> T.StructType:
    return _schema(RAW_DIMENSIONS[name])


def summary_schema() -> T.StructType:
    return _schema(SUMMARY)
