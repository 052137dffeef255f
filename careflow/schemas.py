"""Table schemas, dataset rules and fixed domain constants."""

from __future__ import annotations

from pyspark.sql import types as T

# TIMESTAMP (without time zone) -> TimestampNTZType
S, I, D, DT, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results).
THERAPY_AREAS = ["Oncology", "Cardiology", "Neurology", "Immunology", "Diabetes", "Respiratory"]
DRUGS = {
    "Oncology": ["DrugA-Onc", "DrugB-Onc", "DrugC-Onc"],
    "Cardiology": ["DrugA-Card", "DrugB-Card", "DrugC-Card"],
    "Neurology": ["DrugA-Neuro", "DrugB-Neuro"],
    "Immunology": ["DrugA-Imm", "DrugB-Imm", "DrugC-Imm"],
    "Diabetes": ["DrugA-Diab", "DrugB-Diab", "DrugC-Diab", "DrugD-Diab"],
    "Respiratory": ["DrugA-Resp", "DrugB-Resp"],
}
SPECIALTIES = ["Oncologist", "Cardiologist", "Neurologist", "Immunologist", "Endocrinologist", "Pulmonologist"]
REGIONS = ["North", "South", "East", "West", "Central"]
ICD_CODES = ["C34.1", "I25.1", "G30.0", "M05.7", "E11.9", "J44.1", "C50.9", "I48.0", "G20", "E10.9"]
GENDERS = ["M", "F", "Other"]
SEVERITIES = ["mild", "moderate", "severe"]
CLAIM_STATUSES = ["approved", "denied", "pending"]
PAYERS = ["InsuranceA", "InsuranceB", "InsuranceC", "Medicare", "Medicaid"]
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
HIGH_DATE = "9999-12-31"
EXPLANATION_LIMITS = {"total_prescriptions": 200, "avg_quantity": 100,
                      "max_quantity": 400, "unique_patients": 100}
DROP_OFF_MAX_RX = 2
ZSCORE_WINDOW = 30
ZSCORE_LIMIT = 2.5
DQ_GATE = 0.8
# Default dataset sizes and dirty shares of the generator.
DEFAULT_SIZES = {"patients": 5000, "physicians": 500, "prescriptions": 50000,
                 "diagnoses": 30000, "claims": 40000}
DIRTY_SHARE = {"prescriptions": 0.03, "diagnoses": 0.02, "claims": 0.04}
# ---------------------------------------------------------------------------

# The rules and the table columns and types below.
# Validation rules per dataset: (column, type, extra) with type in
# string / integer / number; extra keys: pattern, enum, minimum.
RULES = {
    "prescriptions": {
        "required": ["prescription_id", "patient_id", "physician_id", "drug_name",
                     "prescription_date", "quantity"],
        "properties": [
            ("prescription_id", "string", {}),
            ("patient_id", "string", {}),
            ("physician_id", "string", {}),
            ("drug_name", "string", {}),
            ("prescription_date", "string", {"pattern": DATE_PATTERN}),
            ("quantity", "integer", {"minimum": 1}),
            ("refills", "integer", {"minimum": 0}),
            ("therapy_area", "string", {}),
        ],
    },
    "diagnoses": {
        "required": ["diagnosis_id", "patient_id", "icd_code", "diagnosis_date"],
        "properties": [
            ("diagnosis_id", "string", {}),
            ("patient_id", "string", {}),
            ("icd_code", "string", {}),
            ("diagnosis_date", "string", {"pattern": DATE_PATTERN}),
            ("physician_id", "string", {}),
            ("severity", "string", {"enum": SEVERITIES}),
        ],
    },
    "claims": {
        "required": ["claim_id", "patient_id", "claim_date", "amount"],
        "properties": [
            ("claim_id", "string", {}),
            ("patient_id", "string", {}),
            ("claim_date", "string", {"pattern": DATE_PATTERN}),
            ("amount", "number", {"minimum": 0}),
            ("status", "string", {"enum": CLAIM_STATUSES}),
            ("payer", "string", {}),
        ],
    },
    "patients": {
        "required": ["patient_id", "gender", "date_of_birth", "region"],
        "properties": [
            ("patient_id", "string", {}),
            ("gender", "string", {"enum": GENDERS}),
            ("date_of_birth", "string", {"pattern": DATE_PATTERN}),
            ("region", "string", {}),
            ("enrollment_date", "string", {}),
        ],
    },
    "physicians": {
        "required": ["physician_id", "specialty", "region"],
        "properties": [
            ("physician_id", "string", {}),
            ("specialty", "string", {}),
            ("region", "string", {}),
            ("years_experience", "integer", {"minimum": 0}),
        ],
    },
}

RAW_COLUMNS = {name: [p[0] for p in r["properties"]] for name, r in RULES.items()}
KEYS = {"patients": "patient_id", "physicians": "physician_id", "prescriptions": "prescription_id",
        "diagnoses": "diagnosis_id", "claims": "claim_id"}
STAGING_TABLE = {"patients": "stg_patients", "physicians": "stg_physicians",
                 "prescriptions": "stg_prescriptions", "diagnoses": "stg_diagnoses",
                 "claims": "stg_claims"}

# Loaded (staging) types; everything not listed is STRING.
STAGING_TYPES = {
    "patients": {"date_of_birth": DT, "enrollment_date": DT},
    "physicians": {"years_experience": I},
    "prescriptions": {"prescription_date": DT, "quantity": I, "refills": I},
    "diagnoses": {"diagnosis_date": DT},
    "claims": {"claim_date": DT, "amount": T.DecimalType(10, 2)},
}


def raw_schema(dataset: str, corrupt: str | None = "_corrupt") -> T.StructType:
    fields = [(c, S) for c in RAW_COLUMNS[dataset]]
    if corrupt:
        fields.append((corrupt, S))
    return _struct(*fields)


def staging_schema(dataset: str) -> T.StructType:
    types = STAGING_TYPES[dataset]
    return _struct(*[(c, types.get(c, S)) for c in RAW_COLUMNS[dataset]], ("ingested_at", TS))


DIM_PATIENT = _struct(("patient_id", S), ("gender", S), ("date_of_birth", DT), ("region", S),
                      ("enrollment_date", DT), ("effective_from", DT), ("effective_to", DT),
                      ("is_current", T.ShortType()))
DIM_PHYSICIAN = _struct(("physician_id", S), ("specialty", S), ("region", S), ("years_experience", I))
DIM_THERAPY = _struct(("therapy_area", S), ("drug_count", T.LongType()))
FACT_PRESCRIPTION = _struct(("prescription_id", S), ("patient_id", S), ("physician_id", S),
                            ("drug_name", S), ("prescription_date", DT), ("quantity", I),
                            ("refills", I), ("therapy_area", S))
FACT_JOURNEY = _struct(("patient_id", S), ("event_type", S), ("event_date", DT), ("event_detail", S),
                       ("therapy_area", S), ("sequence_num", I))
THERAPY_SWITCHES = _struct(("patient_id", S), ("from_drug", S), ("to_drug", S), ("switch_date", DT),
                           ("therapy_area", S))
ANOMALY_RESULTS = _struct(("physician_id", S), ("anomaly_score", D), ("anomaly_type", S),
                          ("total_prescriptions", I), ("avg_quantity", T.DecimalType(10, 2)),
                          ("max_quantity", I), ("unique_patients", I), ("detection_date", DT),
                          ("confidence", T.DecimalType(5, 4)), ("explanation", S))
PIPELINE_RUNS = _struct(("run_id", S), ("pipeline_name", S), ("status", S), ("started_at", TS),
                        ("completed_at", TS), ("records_processed", I), ("records_failed", I))
DQ_SCORES = _struct(("run_id", S), ("run_timestamp", TS), ("total_checks", I), ("passed_checks", I),
                    ("overall_score", T.DecimalType(5, 4)), ("report_path", S))

WAREHOUSE_SCHEMAS = {
    "dim_patient": DIM_PATIENT, "dim_physician": DIM_PHYSICIAN, "dim_therapy": DIM_THERAPY,
    "fact_prescription": FACT_PRESCRIPTION, "fact_patient_journey": FACT_JOURNEY,
    "therapy_switches": THERAPY_SWITCHES, "anomaly_results": ANOMALY_RESULTS,
    "pipeline_runs": PIPELINE_RUNS, "dq_scores": DQ_SCORES,
}
