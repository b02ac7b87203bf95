"""Table schemas, code lists and feature names.

Everything in this module is a fixed value that results depend on; all of it can be passed as an
argument instead.
"""

from __future__ import annotations

# Column names and types of the warehouse tables, as DDL; `not null` marks required columns.
_MONEY, _DEGREES = "decimal(12,2)", "decimal(9,6)"
_DDL = {
    "dim_patient": (
        "patient_id string not null; birth_date date not null; death_date date; gender string; race string; "
        "ethnicity string; marital_status string; city string; state string; county string; zip string; "
        f"lat {_DEGREES}; lon {_DEGREES}"
    ),
    "dim_organization": "organization_id string not null; name string; city string; state string; zip string",
    "dim_code": "code_system string not null; code string not null; description string",
    "fact_encounter": (
        "encounter_id string not null; patient_id string not null; organization_id string; "
        "start_ts timestamp not null; stop_ts timestamp; encounter_class string; code_system string; code string; "
        f"base_cost {_MONEY}; total_claim_cost {_MONEY}; payer_coverage {_MONEY}"
    ),
    "fact_condition": (
        "condition_id bigint not null; patient_id string not null; encounter_id string; "
        "start_date date not null; stop_date date; code_system string; code string"
    ),
    "fact_procedure": (
        "procedure_id bigint not null; patient_id string not null; encounter_id string; "
        f"start_ts timestamp not null; stop_ts timestamp; code_system string; code string; base_cost {_MONEY}"
    ),
    "fact_medication": (
        "medication_id bigint not null; patient_id string not null; encounter_id string; "
        "start_ts timestamp not null; stop_ts timestamp; code_system string; code string; "
        f"base_cost {_MONEY}; dispenses int; total_cost {_MONEY}"
    ),
    "fact_observation": (
        "observation_id bigint not null; patient_id string not null; encounter_id string; "
        "obs_date timestamp not null; category string; code_system string; code string; value string; units string"
    ),
}
_FIELDS = {table: [field.split(" ", 1) for field in ddl.split("; ")] for table, ddl in _DDL.items()}
# Table -> column -> type name.
TABLES = {t: {name: kind.removesuffix(" not null") for name, kind in fields} for t, fields in _FIELDS.items()}
REQUIRED = {t: tuple(name for name, kind in fields if kind.endswith("not null")) for t, fields in _FIELDS.items()}

# Keys and references declared on those tables.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_patient": ("patient_id",),
    "dim_organization": ("organization_id",),
    "dim_code": ("code_system", "code"),
    "fact_encounter": ("encounter_id",),
    "fact_condition": ("condition_id",),
    "fact_procedure": ("procedure_id",),
    "fact_medication": ("medication_id",),
    "fact_observation": ("observation_id",),
}
FOREIGN_KEYS: list[tuple[str, tuple[str, ...], str]] = [
    ("fact_encounter", ("patient_id",), "dim_patient"),
    ("fact_encounter", ("organization_id",), "dim_organization"),
    ("fact_encounter", ("code_system", "code"), "dim_code"),
    *[
        (fact, columns, target)
        for fact in ("fact_condition", "fact_procedure", "fact_medication", "fact_observation")
        for columns, target in (
            (("patient_id",), "dim_patient"),
            (("encounter_id",), "fact_encounter"),
            (("code_system", "code"), "dim_code"),
        )
    ],
]

# LOINC codes kept at load time.
LAB_PANEL: dict[str, str] = {
    "39156-5": "bmi",
    "8480-6": "systolic_bp",
    "8462-4": "diastolic_bp",
    "8867-4": "heart_rate",
    "2339-0": "glucose",
    "2093-3": "cholesterol",
    "4548-4": "hba1c",
    "718-7": "hemoglobin",
    "6299-2": "urea_nitrogen",
    "2160-0": "creatinine",
}
# The readings used as features.
VITALS = ("bmi", "systolic_bp", "diastolic_bp", "heart_rate", "glucose", "hba1c")
VITAL_CODES: dict[str, str] = {code: name for code, name in LAB_PANEL.items() if name in VITALS}

# SNOMED-CT codes of diabetes, hypertension, COPD and heart failure.
CHRONIC_CODES = ("44054006", "38341003", "13645005", "88805009")

# Feature names, in model order.
PAIR_FEATURES = ("first_sim", "last_sim", "zip_sim", "dob_year_match", "ssn_agree", "ssn_both_present")
COUNT_FEATURES = (
    "prior_encounter_count",
    "prior_inpatient_count",
    "prior_condition_count",
    "prior_procedure_count",
    "prior_medication_count",
    "chronic_condition_count",
)
NUMERIC_FEATURES = (*COUNT_FEATURES, *VITALS, "age_at_encounter", "base_cost", "total_claim_cost")
# The costs of the stay itself are not known when it starts; this list leaves them out.
STRICT_NUMERIC_FEATURES = (*COUNT_FEATURES, *VITALS, "age_at_encounter")
CATEGORICAL_FEATURES = ("gender", "race", "ethnicity")
TARGET = "readmitted_30d"

PERSON_COLUMNS = ("first", "last", "dob", "zip", "ssn")
SYSTEM_A = "patient_id string, dob string, first string, last string, ssn string, zip string"
SYSTEM_B = "system_b_id string, first string, last string, dob string, ssn string, zip string"
GROUND_TRUTH = "system_b_id string, true_patient_id string"

# Records as they arrive for scoring.
_PERSON = "struct<first:string,last:string,dob:string,zip:string,ssn:string>"
PAIR_REQUEST = f"record_a {_PERSON}, record_b {_PERSON}"
RISK_REQUEST = ", ".join([f"{c} double" for c in NUMERIC_FEATURES] + [f"{c} string" for c in CATEGORICAL_FEATURES])

SEED = 42
MATCH_THRESHOLD = 0.5
