import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lossmetrics.session import local_session
from lossmetrics.sources import lookups, schemas

D = datetime.date


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "lossmetrics-tests")
    yield session
    session.stop()


DEFAULTS = dict(
    claim_id="C1",
    incident_date=D(2023, 6, 15),
    report_date=D(2023, 6, 20),
    close_date=None,
    claim_type="medical_malpractice",
    procedure_category="Diagnostic Imaging",
    severity_level=3,
    status="open",
    paid_amount=100.0,
    incurred_amount=200.0,
    reserved_amount=100.0,
    days_to_close=None,
    days_to_report=5,
    patient_age_band="35-49",
    patient_risk_segment="low",
    repeat_event_flag=0,
    litigation_flag=0,
    accident_year=2023,
    development_year=0,
    provider_id="P1",
    provider_name="Provider P1",
    specialty="Cardiology",
    department="Pharmacy",
    risk_tier="medium",
    state_code="NY",
    state_name="New York",
    region="Northeast",
    urban_rural="urban",
    diagnosis_code="DX01",
    diagnosis_category="Surgical Site Infection",
    severity_weight=1.0,
    root_cause_code="RC01",
    root_cause_category="Communication Failure",
    preventability="preventable",
    loss_ratio=0.5,
    reserve_adequacy=0.0,
    incident_month="2023-06",
    is_high_severity=0,
    is_long_tail=0,
)


@pytest.fixture(scope="session")
def make_claims(spark):
    """Summary-shaped claims from partial rows."""

    def make(rows):
        full = [{**DEFAULTS, "claim_id": f"C{i}", **r} for i, r in enumerate(rows)]
        schema = schemas.summary_schema()
        return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in full], schema)

    return make


RAW_DEFAULTS = dict(
    claim_id="CLM0",
    incident_date="2023-06-15",
    report_date="2023-06-20",
    close_date="2023-09-15",
    accident_year="2023",
    report_year="2023",
    development_year="0",
    provider_id="PRV1",
    state_code="NY",
    region="Northeast",
    diagnosis_id="DX01",
    root_cause_id="RC01",
    claim_type="workers_comp",
    procedure_category="Anesthesia",
    severity="3",
    status="closed",
    paid_amount="50000.0",
    reserve_amount="1000.0",
    incurred_amount="60000.0",
    patient_age="40",
    patient_age_band="35-49",
    patient_risk_segment="medium",
    litigation_flag="0",
    repeat_event_flag="0",
    report_lag_days="5",
)


@pytest.fixture(scope="session")
def make_raw(spark):
    def make(rows):
        schema = schemas.raw_claims_schema()
        full = [{**RAW_DEFAULTS, "claim_id": f"CLM{i}", **r} for i, r in enumerate(rows)]
        return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in full], schema)

    return make


@pytest.fixture(scope="session")
def dirty_28(make_raw):
    """28 rows with one issue block each, a full copy, a same-id different row and a row of nulls."""
    rows = [{"paid_amount": "-100.5"} for _ in range(5)]
    rows += [{"state_code": "Ny"} for _ in range(5)]
    rows += [{"severity": w} for w in ("one", " TWO ", "Three", "four", "banana")]
    rows += [{"incident_date": "2023-06-20", "report_date": "2023-06-15"} for _ in range(5)]
    rows += [{"diagnosis_id": None} for _ in range(5)]
    rows += [{"paid_amount": "12000000"} for _ in range(3)]
    rows += [{"claim_id": "CLM0", "paid_amount": "-100.5"}, {"claim_id": "CLM5", "state_code": "Ny", "paid_amount": "1.0"}]
    nullable = ["close_date", "incident_date", "report_date", "diagnosis_id", "severity", "paid_amount", "patient_age"]
    rows += [{c: None for c in nullable}]
    return make_raw(rows)


@pytest.fixture(scope="session")
def star_sources(spark):
    return {
        "providers": lookups.values_frame(
            spark,
            [("PRV1", "SP07", "Cardiology", "Pharmacy", "medium"), ("PRV2", "SP08", "Radiology", "Radiology", "medium")],
            ["provider_id", "specialty_id", "specialty_name", "department", "risk_tier"],
        ),
        "regions": lookups.values_frame(
            spark, [("NY", "New York", "Northeast", "urban", 1.15, 1.1)],
            ["state_code", "state_name", "region", "urban_rural", "volume_multiplier", "severity_multiplier"],
        ),
        "diagnoses": lookups.diagnoses(spark),
        "root_causes": lookups.root_causes(spark),
    }


@pytest.fixture(scope="session")
def as_dict():
    def convert(df, key):
        return {r[key]: r.asDict() for r in df.collect()}

    return convert
