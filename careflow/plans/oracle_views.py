"""DuckDB SQL for the derived warehouse tables of ``DomainTables``.

Each view states, in plain SQL over the driver's tables, what the Spark
operator computes; ``careflow.plans.registry`` uses them as the oracle.
"""

from __future__ import annotations

from ..schemas import HIGH_DATE
from ..sources.fixtures import AS_OF, _view
from .domain import TEST_LIMITS


def _parse(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"


# V9 keep-last: the greatest row by the arrival order, then the other columns.
_view("rx_last", """
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY prescription_id ORDER BY
        prescription_date DESC NULLS LAST, physician_id DESC NULLS LAST, source_part DESC NULLS LAST,
        quantity DESC NULLS LAST, source_price DESC NULLS LAST, patient_id DESC NULLS LAST,
        drug_name DESC NULLS LAST, refills DESC NULLS LAST, therapy_area DESC NULLS LAST) AS _rn
    FROM rx_stage) WHERE _rn = 1""", "rx_stage")

# T3
_view("fact_rx", f"""
  SELECT prescription_id, patient_id, physician_id, drug_name,
         {_parse('prescription_date')} AS prescription_date,
         COALESCE(quantity, 0) AS quantity, COALESCE(refills, 0) AS refills, therapy_area
  FROM rx_last WHERE {_parse('prescription_date')} IS NOT NULL""", "rx_last")

# T1
_view("dim_patient", f"""
  SELECT patient_id, gender, {_parse('date_of_birth')} AS date_of_birth, region,
         {_parse('enrollment_date')} AS enrollment_date,
         DATE '{AS_OF}' AS effective_from, DATE '{HIGH_DATE}' AS effective_to,
         CAST(1 AS SMALLINT) AS is_current
  FROM (SELECT * EXCLUDE (_rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY gender DESC NULLS LAST,
              date_of_birth DESC NULLS LAST, region DESC NULLS LAST, enrollment_date DESC NULLS LAST) AS _rn
          FROM patients_stage) WHERE _rn = 1)
  WHERE {_parse('date_of_birth')} IS NOT NULL AND {_parse('enrollment_date')} IS NOT NULL""",
      "patients_stage")

# T2
_view("dim_physician", """
  SELECT physician_id, specialty, region, CAST(COALESCE(years_experience, 0) AS INTEGER) AS years_experience
  FROM (SELECT * EXCLUDE (_rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY physician_id ORDER BY specialty DESC NULLS LAST,
              region DESC NULLS LAST, years_experience DESC NULLS LAST) AS _rn
          FROM physicians_stage) WHERE _rn = 1)""", "physicians_stage")

# T5
_view("journey", """
  SELECT patient_id, event_type, event_date, event_detail, therapy_area,
         CASE WHEN patient_id IS NULL THEN NULL ELSE CAST(row_number() OVER (
             PARTITION BY patient_id ORDER BY event_date NULLS LAST, event_type DESC, src) AS INTEGER)
         END AS sequence_num
  FROM (SELECT patient_id, 'prescription' AS event_type, prescription_date AS event_date,
               drug_name AS event_detail, therapy_area, prescription_id AS src FROM fact_rx
        UNION ALL
        SELECT patient_id, 'diagnosis', diagnosis_date, icd_code, '', CAST(diagnosis_id AS VARCHAR)
        FROM dx_stage)""", "fact_rx", "dx_stage")

# T6
_view("switches", """
  SELECT patient_id, from_drug, to_drug, switch_date, therapy_area FROM (
    SELECT patient_id, lag(drug_name) OVER w AS from_drug, drug_name AS to_drug,
           prescription_date AS switch_date, therapy_area, row_number() OVER w AS _rn
    FROM fact_rx WHERE patient_id IS NOT NULL
    WINDOW w AS (PARTITION BY patient_id ORDER BY prescription_date, prescription_id))
  WHERE _rn > 1 AND from_drug IS DISTINCT FROM to_drug""", "fact_rx")

# M1
_view("features", """
  SELECT physician_id, COUNT(*) AS total_prescriptions, AVG(quantity) AS avg_quantity,
         MAX(quantity) AS max_quantity, COUNT(DISTINCT patient_id) AS unique_patients,
         COUNT(DISTINCT drug_name) AS unique_drugs
  FROM fact_rx GROUP BY physician_id""", "fact_rx")

# Stand-in score + M5 confidence.
_view("scored", """
  SELECT *, COALESCE(ABS(anomaly_score) / NULLIF((SELECT MAX(ABS(anomaly_score)) FROM s0), 0), 0.0)
            AS confidence
  FROM (SELECT *, anomaly_score < 0 AS is_anomaly FROM s0)""", "s0")
_view("s0", """
  SELECT *, ROUND(1.0 - total_prescriptions / (SELECT AVG(total_prescriptions) FROM features), 6)
            AS anomaly_score
  FROM features""", "features")


def explanation_sql(limits: dict) -> str:
    """M6 in SQL; mean quantity rounded half-to-even."""
    reasons = ", ".join([
        f"CASE WHEN total_prescriptions > {limits['total_prescriptions']} THEN "
        "printf('High prescription volume (%d)', CAST(total_prescriptions AS BIGINT)) END",
        f"CASE WHEN avg_quantity > {limits['avg_quantity']} THEN "
        "printf('High avg quantity (%d)', CAST(round_even(avg_quantity, 0) AS BIGINT)) END",
        f"CASE WHEN max_quantity > {limits['max_quantity']} THEN "
        "printf('Very high max quantity (%d)', CAST(max_quantity AS BIGINT)) END",
        f"CASE WHEN unique_patients > {limits['unique_patients']} THEN "
        "printf('Unusually many patients (%d)', CAST(unique_patients AS BIGINT)) END",
    ])
    text = f"concat_ws('; ', {reasons})"
    return f"CASE WHEN {text} = '' THEN 'Statistical outlier in prescribing pattern' ELSE {text} END"


# M7 table (from the stand-in score).
_view("anomalies", f"""
  SELECT physician_id, CAST(anomaly_score AS DOUBLE) AS anomaly_score,
         'prescription_volume' AS anomaly_type,
         CAST(total_prescriptions AS INTEGER) AS total_prescriptions,
         CAST(avg_quantity AS DECIMAL(10,2)) AS avg_quantity,
         CAST(max_quantity AS INTEGER) AS max_quantity,
         CAST(unique_patients AS INTEGER) AS unique_patients,
         DATE '{AS_OF}' AS detection_date,
         CAST(confidence AS DECIMAL(5,4)) AS confidence,
         {explanation_sql(TEST_LIMITS)} AS explanation
  FROM scored WHERE is_anomaly""", "scored")
