"""Source columns, sentinels and fixed feature names."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Sentinel dates for missing timestamps.
OPEN_END = "9000-01-01 00:00:00"
UNSET_INDEX = "1971-01-01 00:00:00"
UNDATED = "1900-01-01 00:00:00"

# File names and header columns of the input tables.
SOURCE_FILES = {
    "entities": "PATIENTS.csv",
    "episodes": "ICUSTAYS.csv",
    "chart_events": "CHARTEVENTS.csv",
    "scores": "SAPSII.csv",
    "flags": "EHCOMORBIDITIES.csv",
    "labs": "LABEVENTS.csv",
    "diagnoses": "DIAGNOSES_ICD.csv",
    "medications": "PRESCRIPTIONS.csv",
    "notes": "NOTEEVENTS.csv",
    "holdout_ids": "icu_mortality_test_patients.csv",
}

# Score column -> feature name.
SCORE_FEATURES = {
    "sapsii": "saps_score",
    "sapsii_prob": "saps_probab",
    "age_score": "age_score",
    "hr_score": "hr_score",
    "sysbp_score": "sysbp_score",
    "temp_score": "temp_score",
    "pao2fio2_score": "pao2fio_score",
    "uo_score": "uo_score",
    "bun_score": "bun_score",
    "wbc_score": "wbc_score",
    "potassium_score": "potassium_score",
    "sodium_score": "sodium_score",
    "bicarbonate_score": "bicarbonate_score",
    "bilirubin_score": "bilirubin_score",
    "gcs_score": "gcs_score",
    "comorbidity_score": "comorbidity_score",
    "admissiontype_score": "admissiontype_score",
}

# The comorbidity flag columns.
FLAG_COLUMNS = """
    congestive_heart_failure cardiac_arrhythmias valvular_disease pulmonary_circulation
    peripheral_vascular hypertension paralysis other_neurological chronic_pulmonary
    diabetes_uncomplicated diabetes_complicated hypothyroidism renal_failure liver_disease
    peptic_ulcer aids lymphoma metastatic_cancer solid_tumor rheumatoid_arthritis
    coagulopathy obesity weight_loss fluid_electrolyte blood_loss_anemia deficiency_anemias
    alcohol_abuse drug_abuse psychoses depression
""".split()

# Prefixes that keep feature families apart.
DIAGNOSIS_PREFIX = "DIAG-"
MEDICATION_PREFIX = "MED-"
LAB_PREFIX = "LAB-"
FLAG_PREFIX = "com-"
TOPIC_PREFIX = "topic-"


def camel_case(column: str) -> str:
    """``weight_loss`` -> ``weightLoss``."""
    return re.sub(r"_(\w)", lambda m: m.group(1).upper(), column)


FLAG_FEATURES = {c: FLAG_PREFIX + camel_case(c) for c in FLAG_COLUMNS}


def strings(*columns: str) -> T.StructType:
    """A schema of nullable string columns, as read from a text file."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
