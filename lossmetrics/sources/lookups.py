"""Domain lists. They must equal the published lookup tables, in their natural order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Specialty name, risk tier.
SPECIALTIES = [
    ("General Surgery", "high"),
    ("Orthopedic Surgery", "high"),
    ("Neurosurgery", "high"),
    ("Obstetrics/Gynecology", "high"),
    ("Anesthesiology", "high"),
    ("Emergency Medicine", "medium"),
    ("Cardiology", "medium"),
    ("Radiology", "medium"),
    ("Gastroenterology", "medium"),
    ("Oncology", "medium"),
    ("Internal Medicine", "low"),
    ("Family Medicine", "low"),
    ("Pediatrics", "low"),
    ("Psychiatry", "low"),
    ("Dermatology", "low"),
]

# ICD-style code, category, severity weight.
DIAGNOSES = [
    ("T81.4", "Surgical Site Infection", 1.0),
    ("O75.4", "Birth Injury", 1.8),
    ("T80.1", "Medication Error", 1.2),
    ("Y65.5", "Misdiagnosis", 1.5),
    ("T81.0", "Post-Operative Hemorrhage", 1.6),
    ("T84.0", "Implant/Device Failure", 1.4),
    ("G97.1", "Anesthesia Complication", 1.7),
    ("T85.6", "Catheter-Related Infection", 0.8),
    ("T81.1", "Surgical Shock", 2.0),
    ("Y83.1", "Wrong-Site Surgery", 1.9),
    ("T88.7", "Adverse Drug Reaction", 1.1),
    ("W19", "Patient Fall", 0.7),
    ("L89.3", "Pressure Ulcer", 0.6),
    ("T80.2", "Transfusion Reaction", 1.3),
    ("J95.0", "Ventilator-Associated Pneumonia", 1.2),
    ("A41.9", "Sepsis", 1.8),
    ("I26.9", "Pulmonary Embolism", 1.6),
    ("R57.0", "Cardiac Arrest - Iatrogenic", 2.0),
    ("T86.1", "Organ Rejection", 1.5),
    ("Y69", "Delayed Treatment", 0.9),
]

# Category, preventability.
ROOT_CAUSES = [
    ("Communication Failure", "preventable"),
    ("Documentation Error", "preventable"),
    ("Inadequate Training", "preventable"),
    ("Protocol Non-Compliance", "preventable"),
    ("Equipment Malfunction", "partially"),
    ("Staffing Shortage", "partially"),
    ("Patient Non-Compliance", "partially"),
    ("Diagnostic Error", "partially"),
    ("System/IT Failure", "partially"),
    ("Unforeseen Complication", "non-preventable"),
    ("Patient Anatomy Variation", "non-preventable"),
    ("Disease Progression", "non-preventable"),
]

# Fixed values.
DEPARTMENTS = [
    "Emergency Department",
    "Operating Room",
    "Intensive Care Unit",
    "Labor & Delivery",
    "Medical/Surgical Floor",
    "Outpatient Clinic",
    "Radiology",
    "Pharmacy",
]

# Fixed values.
CLAIM_TYPES = [
    "medical_malpractice",
    "general_liability",
    "workers_comp",
    "product_liability",
    "professional_liability",
]

# Fixed values (the first two hold an en dash).
PROCEDURES = [
    "Surgical – Major",
    "Surgical – Minor",
    "Diagnostic Imaging",
    "Laboratory/Pathology",
    "Medication Administration",
    "Therapeutic Procedure",
    "Obstetric Delivery",
    "Anesthesia",
    "Emergency Intervention",
    "Rehabilitation/Physical Therapy",
]

# Fixed values.
URBAN_RURAL = ["urban", "suburban", "rural"]
STATUSES = ["closed", "open", "reopened"]
SEVERITY_WORDS = ["one", "two", "three", "four", "five"]
HIGH_LITIGATION_STATES = ["NY", "CA", "FL", "TX"]


def sql_text(value) -> str:
    """A Python value as a SQL literal."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def values_frame(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """An inline VALUES relation. Its exact size is known to the optimizer, so joins to it broadcast by themselves."""
    body = ", ".join("(" + ", ".join(sql_text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def diagnoses(spark: SparkSession) -> DataFrame:
    rows = [(f"DX{i:02d}", code, name, weight) for i, (code, name, weight) in enumerate(DIAGNOSES, 1)]
    return values_frame(spark, rows, ["diagnosis_id", "code", "category", "severity_weight"])


def root_causes(spark: SparkSession) -> DataFrame:
    rows = [(f"RC{i:02d}", name, prevent) for i, (name, prevent) in enumerate(ROOT_CAUSES, 1)]
    return values_frame(spark, rows, ["root_cause_id", "category", "preventability"])
