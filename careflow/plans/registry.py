"""Registered queries: one Spark callable and, where SQL can say it, one DuckDB
oracle per operator of the inventory.  Keys start with the operator id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning
from ..operators import anomaly, kpis
from ..sources.fixtures import sql_with
from . import oracle_views  # noqa: F401  (registers the derived SQL views)
from .domain import TEST_LIMITS, DomainTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters of the lookup / filter queries (the lookup is the feature).
PATIENT = 7
PHYSICIAN = 3
REGION = "AMERICA"
THERAPY = "PROMO"
TEST_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
TEST_AREAS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def register(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    def deco(fn: Callable[[DomainTables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(DomainTables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql_with(sql, *views)
        return fn
    return deco


# ----------------------------------------------------------------- V (cleaning)
@register("v9_keep_last_prescriptions", "SELECT * FROM rx_last", ("rx_last",))
def _v9(t):
    from ..operators.warehouse import dedup_keep_last
    from ..sources.fixtures import RX_ORDER
    return dedup_keep_last(t.rx_stage, "prescription_id", RX_ORDER)


@register("v10_normalize_dates", """
  SELECT patient_id, gender, CAST(try_strptime(date_of_birth, '%Y-%m-%d') AS DATE) AS date_of_birth, region,
         CAST(try_strptime(enrollment_date, '%Y-%m-%d') AS DATE) AS enrollment_date
  FROM patients_stage
  WHERE try_strptime(date_of_birth, '%Y-%m-%d') IS NOT NULL
    AND try_strptime(enrollment_date, '%Y-%m-%d') IS NOT NULL""", ("patients_stage",))
def _v10(t):
    return cleaning.normalize_dates(t.patients_stage, ["date_of_birth", "enrollment_date", "absent_col"])


@register("v11_to_int_or_zero", """
  SELECT claim_id, COALESCE(CAST(trunc(try_cast(CAST(amount AS VARCHAR) AS DOUBLE)) AS INTEGER), 0) AS amount
  FROM claims_stage""", ("claims_stage",))
def _v11(t):
    df = t.claims_stage.select("claim_id", F.col("amount").cast("string").alias("amount"))
    return cleaning.to_int_or_zero(df, ["amount"])


# ----------------------------------------------------------------- T (warehouse)
@register("t1_dim_patient", "SELECT * FROM dim_patient", ("dim_patient",))
def _t1(t):
    return t.dim_patient


@register("t2_dim_physician", "SELECT * FROM dim_physician", ("dim_physician",))
def _t2(t):
    return t.dim_physician


@register("t3_fact_prescription", "SELECT * FROM fact_rx", ("fact_rx",))
def _t3(t):
    return t.fact_prescription


@register("t4_dim_therapy", """
  SELECT therapy_area, COUNT(DISTINCT drug_name) AS drug_count FROM fact_rx
  GROUP BY therapy_area ORDER BY drug_count DESC, therapy_area""", ("fact_rx",))
def _t4(t):
    return t.dim_therapy


@register("t5_patient_journey", "SELECT * FROM journey", ("journey",))
def _t5(t):
    return t.fact_patient_journey


@register("t6_therapy_switches", "SELECT * FROM switches", ("switches",))
def _t6(t):
    return t.therapy_switches


# ----------------------------------------------------------------- K (SQL file)
@register("k1_switch_rate", """
  SELECT s.therapy_area, s.patients_switched,
         ROUND(CAST(s.patients_switched AS DOUBLE) / NULLIF(r.n, 0) * 100, 2) AS switch_rate
  FROM (SELECT therapy_area, COUNT(DISTINCT patient_id) AS patients_switched FROM switches
        GROUP BY therapy_area) s
  LEFT JOIN (SELECT therapy_area, COUNT(DISTINCT patient_id) AS n FROM fact_rx GROUP BY therapy_area) r
    ON s.therapy_area = r.therapy_area
  ORDER BY switch_rate DESC NULLS LAST, therapy_area""", ("switches", "fact_rx"))
def _k1(t):
    return kpis.switch_rate(t.therapy_switches, t.fact_prescription)


@register("k2_drop_off_by_therapy", """
  SELECT therapy_area, COUNT(*) AS total,
         CAST(SUM(CASE WHEN rx_count <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS dropoffs,
         ROUND(CAST(SUM(CASE WHEN rx_count <= 2 THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100, 2) AS dropoff_pct
  FROM (SELECT patient_id, therapy_area, COUNT(*) AS rx_count FROM fact_rx GROUP BY patient_id, therapy_area)
  GROUP BY therapy_area""", ("fact_rx",))
def _k2(t):
    return kpis.drop_off_by_therapy(t.fact_prescription)


@register("k3_monthly_physician_volume", """
  SELECT physician_id, strftime(prescription_date, '%Y-%m') AS month, COUNT(*) AS rx_count,
         AVG(quantity) AS avg_qty
  FROM fact_rx GROUP BY physician_id, strftime(prescription_date, '%Y-%m')
  ORDER BY physician_id, month""", ("fact_rx",))
def _k3(t):
    return kpis.monthly_physician_volume(t.fact_prescription)


@register("k4_anomalies_by_region", """
  SELECT dp.region, COUNT(*) AS flagged_physicians,
         ROUND(AVG(CAST(ar.confidence AS DOUBLE)), 6) AS avg_confidence
  FROM anomalies ar JOIN dim_physician dp ON ar.physician_id = dp.physician_id
  GROUP BY dp.region""", ("anomalies", "dim_physician"))
def _k4(t):
    return (kpis.anomalies_by_region(t.anomaly_results, t.dim_physician)
            .withColumn("avg_confidence", F.round("avg_confidence", 6)))


# ----------------------------------------------------------------- A (API routes)
@register("a1_patient_journey", f"""
  SELECT j.*, p.gender, p.date_of_birth, p.region, p.enrollment_date,
         (SELECT COUNT(*) FROM journey WHERE patient_id = {PATIENT}) AS total_events
  FROM journey j
  LEFT JOIN (SELECT * FROM dim_patient WHERE patient_id = {PATIENT} AND is_current = 1) p
    ON j.patient_id = p.patient_id
  WHERE j.patient_id = {PATIENT}
  ORDER BY j.sequence_num""", ("journey", "dim_patient"))
def _a1(t):
    return kpis.patient_journey_lookup(t.fact_patient_journey, t.dim_patient, PATIENT)


@register("a2_list_patients_region", f"""
  SELECT * FROM dim_patient WHERE is_current = 1 AND region = '{REGION}'
  ORDER BY patient_id LIMIT 50""", ("dim_patient",))
def _a2r(t):
    return kpis.list_patients(t.dim_patient, region=REGION, limit=50)


@register("a2_list_patients", """
  SELECT * FROM dim_patient WHERE is_current = 1 ORDER BY patient_id LIMIT 50""", ("dim_patient",))
def _a2(t):
    return kpis.list_patients(t.dim_patient)


_AORDER = ", ".join(kpis.ANOMALY_ORDER)


@register("a3_list_anomalies", f"""
  SELECT * FROM anomalies WHERE detection_date = DATE '2025-01-01' AND confidence >= 0.5
  ORDER BY {_AORDER} LIMIT 50""", ("anomalies",))
def _a3(t):
    return kpis.list_anomalies(t.anomaly_results, date="2025-01-01", min_confidence=0.5)


@register("a3_list_anomalies_all", f"SELECT * FROM anomalies ORDER BY {_AORDER} LIMIT 50", ("anomalies",))
def _a3a(t):
    return kpis.list_anomalies(t.anomaly_results)


@register("a4_physician_anomaly", f"""
  SELECT {PHYSICIAN} AS physician_id,
         (SELECT COUNT(*) FROM anomalies WHERE physician_id = {PHYSICIAN}) > 0 AS is_anomalous,
         d.* EXCLUDE (physician_id)
  FROM (SELECT 1 AS one) o
  LEFT JOIN (SELECT * FROM anomalies WHERE physician_id = {PHYSICIAN} ORDER BY {_AORDER} LIMIT 1) d ON true""",
          ("anomalies",))
def _a4(t):
    return kpis.physician_anomaly(t.anomaly_results, PHYSICIAN)


@register("a5_anomaly_summary", """
  SELECT COUNT(*) AS total_anomalies, ROUND(AVG(CAST(confidence AS DOUBLE)), 3) AS avg_confidence
  FROM anomalies""", ("anomalies",))
def _a5(t):
    return kpis.anomaly_summary(t.anomaly_results)


@register("a5_anomaly_by_type", "SELECT anomaly_type, COUNT(*) AS n FROM anomalies GROUP BY anomaly_type",
          ("anomalies",))
def _a5t(t):
    return kpis.anomaly_count_by_type(t.anomaly_results)


@register("a5_top_anomalies", f"""
  SELECT physician_id, anomaly_score, explanation FROM anomalies ORDER BY {_AORDER} LIMIT 5""",
          ("anomalies",))
def _a5k(t):
    return kpis.top_anomalies(t.anomaly_results)


_SW_LIST = f"""SELECT * FROM switches WHERE therapy_area = '{THERAPY}'
  ORDER BY switch_date, patient_id, from_drug, to_drug, therapy_area LIMIT 100"""


@register("a6_switch_list", _SW_LIST, ("switches",))
def _a6(t):
    return kpis.list_switches(t.therapy_switches, therapy_area=THERAPY)


@register("a6_switch_summary", f"""
  SELECT COUNT(*) AS total_switches, COUNT(DISTINCT patient_id) AS unique_patients
  FROM switches WHERE therapy_area = '{THERAPY}'""", ("switches",))
def _a6s(t):
    return kpis.switch_summary(t.therapy_switches, THERAPY)


@register("a6_top_from_drugs", f"""
  SELECT from_drug AS drug, COUNT(*) AS n FROM switches WHERE therapy_area = '{THERAPY}' GROUP BY from_drug
  ORDER BY n DESC, drug NULLS LAST LIMIT 5""", ("switches",))
def _a6f(t):
    return kpis.switch_top(t.therapy_switches, "from_drug", THERAPY)


@register("a6_top_to_drugs", f"""
  SELECT to_drug AS drug, COUNT(*) AS n FROM switches WHERE therapy_area = '{THERAPY}' GROUP BY to_drug
  ORDER BY n DESC, drug NULLS LAST LIMIT 5""", ("switches",))
def _a6t(t):
    return kpis.switch_top(t.therapy_switches, "to_drug", THERAPY)


@register("a7_global_totals", """
  SELECT (SELECT COUNT(*) FROM dim_patient WHERE is_current = 1) AS total_patients,
         (SELECT COUNT(*) FROM fact_rx) AS total_prescriptions,
         (SELECT COUNT(*) FROM switches) AS total_therapy_switches,
         (SELECT COUNT(*) FROM anomalies) AS total_anomalies_detected""",
          ("dim_patient", "fact_rx", "switches", "anomalies"))
def _a7(t):
    return kpis.global_totals(t.dim_patient, t.fact_prescription, t.therapy_switches, t.anomaly_results)


@register("a7_rx_by_therapy", "SELECT therapy_area, COUNT(*) AS vol FROM fact_rx GROUP BY therapy_area",
          ("fact_rx",))
def _a7t(t):
    return kpis.prescriptions_by_therapy(t.fact_prescription)


def _a8_sql(where: str) -> str:
    return f"""
  SELECT COUNT(*) AS pairs_analyzed, COUNT(*) FILTER (WHERE total_rx <= 2) AS drop_off_count,
         COALESCE(ROUND(CAST(COUNT(*) FILTER (WHERE total_rx <= 2) AS DOUBLE) / NULLIF(COUNT(*), 0), 4), 0.0)
           AS drop_off_rate
  FROM (SELECT patient_id, therapy_area, COUNT(*) AS total_rx FROM fact_rx {where}
        GROUP BY patient_id, therapy_area)"""


@register("a8_drop_off", _a8_sql(""), ("fact_rx",))
def _a8(t):
    return kpis.overall_drop_off(t.fact_prescription)


@register("a8_drop_off_area", _a8_sql(f"WHERE therapy_area = '{THERAPY}'"), ("fact_rx",))
def _a8a(t):
    return kpis.overall_drop_off(t.fact_prescription, therapy_area=THERAPY)


@register("a8_drop_off_unknown_area", _a8_sql("WHERE therapy_area = 'no-such-area'"), ("fact_rx",))
def _a8u(t):
    return kpis.overall_drop_off(t.fact_prescription, therapy_area="no-such-area")


# ----------------------------------------------------------------- D (dashboard)
@register("d1_filter_values", """
  SELECT * FROM (SELECT DISTINCT 'region' AS kind, region AS value FROM dim_patient
                 UNION SELECT DISTINCT 'therapy', therapy_area FROM fact_rx)
  ORDER BY kind, value""", ("dim_patient", "fact_rx"))
def _d1(t):
    return kpis.filter_values(t.dim_patient, t.fact_prescription)


def _dash_sql(region: str | None, therapy: str | None) -> dict[str, str]:
    conds = []
    if region:
        conds.append(f"p.region = '{region}'")
    if therapy:
        conds.append(f"fp.therapy_area = '{therapy}'")
    where = ("WHERE " + " AND ".join(conds)) if conds else ""
    pwhere = "WHERE p.is_current = 1" if not where else where + " AND p.is_current = 1"
    ts = f"AND ts.therapy_area = '{therapy}'" if therapy else ""
    dimp = "(SELECT * FROM dim_patient WHERE is_current = 1) p"
    rx_pat = f"SELECT DISTINCT fp.patient_id FROM fact_rx fp JOIN {dimp} ON fp.patient_id = p.patient_id {where}"
    rx_phy = f"SELECT DISTINCT fp.physician_id FROM fact_rx fp JOIN {dimp} ON fp.patient_id = p.patient_id {where}"
    return {
        "d2_patient_card": f"""SELECT COUNT(DISTINCT p.patient_id) AS cnt FROM dim_patient p
            LEFT JOIN fact_rx fp ON p.patient_id = fp.patient_id {pwhere}""",
        "d3_rx_card": f"""SELECT COUNT(*) AS cnt FROM fact_rx fp JOIN {dimp}
            ON fp.patient_id = p.patient_id {where}""",
        "d4_switch_card": f"""SELECT COUNT(*) AS cnt FROM switches ts
            WHERE ts.patient_id IN ({rx_pat}) {ts}""",
        "d5_anomaly_card": f"""SELECT COUNT(DISTINCT ar.physician_id) AS cnt FROM anomalies ar
            WHERE ar.physician_id IN ({rx_phy})""",
        "d6_rx_by_therapy": f"""SELECT fp.therapy_area, COUNT(*) AS volume FROM fact_rx fp
            JOIN {dimp} ON fp.patient_id = p.patient_id {where} GROUP BY fp.therapy_area""",
        "d7_top_switch_pairs": f"""SELECT ts.from_drug, ts.to_drug, COUNT(*) AS count FROM switches ts
            WHERE ts.patient_id IN ({rx_pat}) {ts}
            GROUP BY ts.from_drug, ts.to_drug
            ORDER BY count DESC, from_drug NULLS LAST, to_drug NULLS LAST LIMIT 10""",
        "d8_top_anomalies": f"""SELECT DISTINCT ar.physician_id, ar.anomaly_score, ar.confidence, ar.explanation
            FROM anomalies ar WHERE ar.physician_id IN ({rx_phy})
            ORDER BY anomaly_score, physician_id, confidence, explanation LIMIT 10""",
        "d9_daily_rx_volume": f"""SELECT fp.prescription_date, COUNT(*) AS volume FROM fact_rx fp
            JOIN {dimp} ON fp.patient_id = p.patient_id {where}
            GROUP BY fp.prescription_date ORDER BY fp.prescription_date""",
    }


_DASH = {
    "d2_patient_card": lambda t, f: kpis.patient_card(t.dim_patient, t.fact_prescription, f),
    "d3_rx_card": lambda t, f: kpis.rx_card(t.fact_prescription, t.dim_patient, f),
    "d4_switch_card": lambda t, f: kpis.switch_card(t.therapy_switches, t.fact_prescription, t.dim_patient, f),
    "d5_anomaly_card": lambda t, f: kpis.anomaly_card(t.anomaly_results, t.fact_prescription, t.dim_patient, f),
    "d6_rx_by_therapy": lambda t, f: kpis.rx_volume_by_therapy(t.fact_prescription, t.dim_patient, f),
    "d7_top_switch_pairs": lambda t, f: kpis.top_switch_pairs(t.therapy_switches, t.fact_prescription,
                                                              t.dim_patient, f),
    "d8_top_anomalies": lambda t, f: kpis.top_anomalies_filtered(t.anomaly_results, t.fact_prescription,
                                                                 t.dim_patient, f),
    "d9_daily_rx_volume": lambda t, f: kpis.daily_rx_volume(t.fact_prescription, t.dim_patient, f),
}
_DASH_VIEWS = ("dim_patient", "fact_rx", "switches", "anomalies")

for _suffix, _region, _therapy in [("", None, None), ("_filtered", REGION, THERAPY),
                                   ("_region", REGION, None), ("_unknown_value", None, None)]:
    _f = kpis.DashboardFilter(region=_region or "All", therapy=_therapy or "All",
                              valid_regions=TEST_REGIONS, valid_therapies=TEST_AREAS)
    if _suffix == "_unknown_value":
        # a value outside the allowed set is ignored (same rows as no filter)
        _f = kpis.DashboardFilter(region="Atlantis", therapy="Alchemy",
                                  valid_regions=TEST_REGIONS, valid_therapies=TEST_AREAS)
    _sqls = _dash_sql(_region, _therapy)
    for _name, _fn in _DASH.items():
        if _suffix in ("_region", "_unknown_value") and _name not in ("d2_patient_card", "d3_rx_card"):
            continue
        register(_name + _suffix, _sqls[_name], _DASH_VIEWS)(
            (lambda fn, flt: (lambda t: fn(t, flt)))(_fn, _f))


# ----------------------------------------------------------------- M (anomaly)
@register("m1_physician_features", "SELECT * FROM features", ("features",))
def _m1(t):
    return t.features


_M_COLS = anomaly.FEATURE_COLS


@register("m2_standard_scale", f"""
  SELECT physician_id, {", ".join(
      f"ROUND((COALESCE(CAST({c} AS DOUBLE), 0) - (SELECT AVG(COALESCE(CAST({c} AS DOUBLE), 0)) FROM features))"
      f" / (SELECT CASE WHEN STDDEV_POP(COALESCE(CAST({c} AS DOUBLE), 0)) = 0 THEN 1.0"
      f" ELSE STDDEV_POP(COALESCE(CAST({c} AS DOUBLE), 0)) END FROM features), 6) AS {c}" for c in _M_COLS)}
  FROM features""", ("features",))
def _m2(t):
    scaled = anomaly.standard_scale(t.features)
    return scaled.select("physician_id", *[F.round(c, 6).alias(c) for c in _M_COLS])


@register("m5_confidence", """
  SELECT physician_id, anomaly_score, is_anomaly, ROUND(confidence, 6) AS confidence FROM scored""",
          ("scored",))
def _m5(t):
    return t.scored.select("physician_id", "anomaly_score", "is_anomaly", F.round("confidence", 6).alias("confidence"))


@register("m6_explanations", f"""
  SELECT physician_id, {oracle_views.explanation_sql(TEST_LIMITS)} AS explanation FROM features""",
          ("features",))
def _m6(t):
    return t.features.select("physician_id", anomaly.explanation(TEST_LIMITS).alias("explanation"))


@register("m7_anomaly_results_standin", "SELECT * FROM anomalies", ("anomalies",))
def _m7s(t):
    return t.anomaly_results


@register("m8_daily_zscore", """
  SELECT prescription_date, daily_volume, ROUND(rolling_mean, 6) AS rolling_mean,
         ROUND(rolling_std, 6) AS rolling_std, ROUND(z, 6) AS z_score,
         COALESCE(ABS(z) > 2.5, false) AS is_anomaly
  FROM (SELECT *, (daily_volume - rolling_mean) / NULLIF(rolling_std, 0) AS z FROM (
          SELECT prescription_date, daily_volume,
                 AVG(daily_volume) OVER w AS rolling_mean,
                 COALESCE(STDDEV_SAMP(daily_volume) OVER w, 1.0) AS rolling_std
          FROM (SELECT prescription_date, COUNT(*) AS daily_volume FROM fact_rx GROUP BY prescription_date)
          WINDOW w AS (ORDER BY prescription_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)))
  ORDER BY prescription_date""", ("fact_rx",))
def _m8(t):
    return anomaly.daily_zscore(t.fact_prescription).select(
        "prescription_date", "daily_volume", *[F.round(c, 6).alias(c) for c in ("rolling_mean", "rolling_std", "z_score")],
        "is_anomaly")


# ----------------------------------------------------------------- Q (data quality)
from ..operators import quality  # noqa: E402
from .oracle_quality import suite_sql  # noqa: E402

_STG_VIEW = {"stg_prescriptions": "rx_stage", "stg_diagnoses": "dx_stage", "stg_claims": "claims_stage",
             "stg_patients": "patients_stage", "stg_physicians": "physicians_stage"}
_STG_VIEWS = tuple(_STG_VIEW.values())


def _staging(t: DomainTables) -> dict[str, DataFrame]:
    return {"stg_prescriptions": t.rx_stage, "stg_diagnoses": t.dx_stage, "stg_claims": t.claims_stage,
            "stg_patients": t.patients_stage, "stg_physicians": t.physicians_stage}


def _suite(kind: str | None = None) -> list:
    return [c for c in quality.default_suite() if kind is None or c.check_type == kind]


for _qid, _kind in [("q1_completeness", "completeness"), ("q2_uniqueness", "uniqueness"),
                    ("q3_referential_integrity", "referential_integrity"), ("q4_row_count", "row_count"),
                    ("q5_distribution", "distribution"), ("q6_quality_suite", None)]:
    register(_qid, suite_sql(_suite(_kind), _STG_VIEW), _STG_VIEWS)(
        (lambda checks: (lambda t: quality.run_checks(_staging(t), checks)
                          .withColumn("score", F.round("score", 6))))(_suite(_kind)))

_SUITE_SQL = suite_sql(_suite(), _STG_VIEW)
_REPORT_SQL = f"""
  SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed,
         COUNT(*) FILTER (WHERE NOT passed) AS failed_count,
         ROUND(COALESCE(CAST(COUNT(*) FILTER (WHERE passed) AS DOUBLE) / NULLIF(COUNT(*), 0), 0.0), 6)
           AS overall_score,
         COALESCE(string_agg(CASE WHEN NOT passed THEN name END, ', ' ORDER BY name), '') AS failed_names
  FROM ({_SUITE_SQL})"""


def _report(t: DomainTables, written: bool = False) -> DataFrame:
    """``written``: the prescriptions, a join that three parts of the suite read, as a table."""
    tables = _staging(t) | ({"stg_prescriptions": t.rx_written} if written else {})
    return quality.dq_report(quality.run_checks(tables))


@register("q7_dq_report", _REPORT_SQL, _STG_VIEWS)
def _q7(t):
    return _report(t).select(
        "total_checks", "passed", "failed_count", F.round("overall_score", 6).alias("overall_score"),
        F.concat_ws(", ", F.transform("failed_checks", lambda s: s.getField("name"))).alias("failed_names"))


@register("q8_dq_gate", f"""
  SELECT overall_score, overall_score >= 0.8 AS gate_passed FROM ({_REPORT_SQL})""", _STG_VIEWS)
def _q8(t):
    g = quality.gate(_report(t))
    return g.select(F.round("overall_score", 6).alias("overall_score"), "gate_passed")


# ----------------------------------------------------------------- V1-V8 (validation)
from ..operators import validate as _val  # noqa: E402
from ..sources import fixtures as _fx  # noqa: E402
from .oracle_validate import coerced_select, validated_sql  # noqa: E402

for _ds, _view_name, _builder in [("prescriptions", "rx_raw", _fx.rx_raw), ("claims", "claims_raw", _fx.claims_raw)]:
    _vsql = validated_sql(_ds, _view_name)
    register(f"v8_validate_{_ds}_valid",
             f"SELECT {coerced_select(_ds)} FROM ({_vsql}) WHERE _validation_error IS NULL", (_view_name,))(
        (lambda ds, b: (lambda t: _val.split(_val.validate(b(t.spark, t.sf_dir), ds), ds)[0]))(_ds, _builder))
    register(f"v8_validate_{_ds}_invalid",
             f"SELECT * FROM ({_vsql}) WHERE _validation_error IS NOT NULL", (_view_name,))(
        (lambda ds, b: (lambda t: _val.split(_val.validate(b(t.spark, t.sf_dir), ds), ds)[1]))(_ds, _builder))


# ----------------------------------------------------------------- M3/M4/M7 (forest; rows-only)
from ..operators import forest as _forest  # noqa: E402
from . import anomaly_jobs as _aj  # noqa: E402


@register("m3_forest_nodes")
def _m3(t):
    model, _stats, _f = _aj.train(t.fact_prescription)
    return _forest.nodes_frame(t.spark, model)


@register("m4_forest_scores")
def _m4(t):
    _model, _stats, scored = _aj.train_and_score(t.fact_prescription)
    return scored


@register("m7_anomaly_results")
def _m7(t):
    _model, _stats, scored = _aj.train_and_score(t.fact_prescription)
    return anomaly.anomaly_results(scored, t.as_of, TEST_LIMITS)


# ----------------------------------------------------------------- I1-I3, T8 (incremental, SCD-2)
from ..operators import incremental as _inc  # noqa: E402
from ..sources.fixtures import _view as _sqlview  # noqa: E402

INC_CUT = "2024-01-20 00:00:00"   # target = diagnoses ingested before this instant
SCD_AS_OF = "2025-02-01"          # date of the second dimension load
_fx_as_of = _fx.AS_OF


def _inc_target(t: DomainTables) -> DataFrame:
    return t.dx_stage.filter(F.col("ingested_at") < F.lit(INC_CUT).cast("timestamp_ntz"))


def _inc_source(t: DomainTables) -> DataFrame:
    """New staging content: every diagnosis, plus re-sent copies of the
    'purchase' diagnoses before the cut with a revised code, stamped 30 days
    later."""
    d = t.dx_stage
    resent = (d.filter((F.col("icd_code") == "purchase") & (F.col("ingested_at") < F.lit(INC_CUT).cast("timestamp_ntz")))
              .withColumn("icd_code", F.concat(F.col("icd_code"), F.lit("-rev")))
              .withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 30 DAYS")))
    return d.unionByName(resent)


_sqlview("inc_target", f"SELECT * FROM dx_stage WHERE ingested_at < TIMESTAMP '{INC_CUT}'", "dx_stage")
_sqlview("inc_source", f"""
  SELECT * FROM dx_stage
  UNION ALL
  SELECT diagnosis_id, patient_id, icd_code || '-rev', diagnosis_date, physician_id, severity,
         ingested_at + INTERVAL 30 DAY
  FROM dx_stage WHERE icd_code = 'purchase' AND ingested_at < TIMESTAMP '{INC_CUT}'""", "dx_stage")
_sqlview("inc_delta", """
  SELECT * FROM inc_source WHERE ingested_at > (SELECT MAX(ingested_at) FROM inc_target)""",
         "inc_source", "inc_target")


@register("i1_high_water_mark", "SELECT MAX(ingested_at) AS last_watermark FROM inc_target", ("inc_target",))
def _i1(t):
    mark = _inc.high_water_mark(_inc_target(t))
    return t.spark.createDataFrame([(mark,)], "last_watermark timestamp_ntz")


@register("i2_delta_rows", "SELECT * FROM inc_delta", ("inc_delta",))
def _i2(t):
    return _inc.delta_rows(_inc_source(t), _inc.mark_text(_inc_target(t)))


@register("i3_upsert", """
  SELECT * FROM inc_target WHERE diagnosis_id NOT IN (SELECT diagnosis_id FROM inc_delta)
  UNION ALL
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY diagnosis_id ORDER BY ingested_at DESC NULLS LAST,
        patient_id DESC NULLS LAST, icd_code DESC NULLS LAST, diagnosis_date DESC NULLS LAST,
        physician_id DESC NULLS LAST, severity DESC NULLS LAST) AS _rn
    FROM inc_delta) WHERE _rn = 1""", ("inc_target", "inc_delta"))
def _i3(t):
    new_target, _delta = _inc.incremental_load(_inc_source(t), _inc_target(t), "diagnosis_id")
    return new_target


_SCD_ATTRS = ["gender", "date_of_birth", "region", "enrollment_date"]


def _scd_current(t: DomainTables) -> DataFrame:
    """The dimension after an earlier load: all versions of the first load, a closed
    older version of the 'MACHINERY' segment, and one row without a key."""
    d = t.dim_patient
    older = d.filter(F.col("gender") == "MACHINERY").select(
        "patient_id", "gender", "date_of_birth", F.concat(F.col("region"), F.lit("-old")).alias("region"), "enrollment_date",
        F.lit("2024-01-01").cast("date").alias("effective_from"), F.lit("2024-12-31").cast("date").alias("effective_to"),
        F.lit(0).cast("smallint").alias("is_current"))
    return d.unionByName(older).unionByName(_scd_keyless(d, "first"))


def _scd_keyless(d: DataFrame, region: str) -> DataFrame:
    """The dimension's first enrolment as a row without a key."""
    one = d.agg(F.min("enrollment_date").alias("enrollment_date"))
    return one.select(F.lit(None).cast("long").alias("patient_id"), F.lit("X").alias("gender"),
                      F.lit(None).cast("date").alias("date_of_birth"), F.lit(region).alias("region"), "enrollment_date",
                      F.lit(_fx.AS_OF).cast("date").alias("effective_from"), F.lit("9999-12-31").cast("date").alias("effective_to"),
                      F.lit(1).cast("smallint").alias("is_current"))


def _scd_incoming(t: DomainTables) -> DataFrame:
    """Second load of the patient dimension: the 'BUILDING' segment moved
    region; the 'AUTOMOBILE' segment arrives again under new keys (key +
    1,000,000); the row without a key moved."""
    d = t.dim_patient.select("patient_id", *_SCD_ATTRS)
    moved = d.withColumn("region", F.when(F.col("gender") == "BUILDING", F.concat(F.col("region"), F.lit("-moved")))
                         .otherwise(F.col("region")))
    new = d.filter(F.col("gender") == "AUTOMOBILE").withColumn("patient_id", F.col("patient_id") + 1000000)
    return moved.unionByName(new).unionByName(_scd_keyless(d, "second").select("patient_id", *_SCD_ATTRS))


_SAME = " AND ".join(f"c.{a} IS NOT DISTINCT FROM i.{a}" for a in _SCD_ATTRS)
_sqlview("scd_cur", f"""
  SELECT * FROM dim_patient
  UNION ALL
  SELECT patient_id, gender, date_of_birth, region || '-old', enrollment_date, DATE '2024-01-01', DATE '2024-12-31',
         CAST(0 AS SMALLINT) FROM dim_patient WHERE gender = 'MACHINERY'
  UNION ALL
  SELECT NULL, 'X', NULL, 'first', MIN(enrollment_date), DATE '{_fx_as_of}', DATE '9999-12-31', CAST(1 AS SMALLINT)
  FROM dim_patient""", "dim_patient")
_sqlview("scd_in", """
  SELECT patient_id, gender, date_of_birth,
         CASE WHEN gender = 'BUILDING' THEN region || '-moved' ELSE region END AS region, enrollment_date
  FROM dim_patient
  UNION ALL
  SELECT patient_id + 1000000, gender, date_of_birth, region, enrollment_date FROM dim_patient
  WHERE gender = 'AUTOMOBILE'
  UNION ALL
  SELECT NULL, 'X', NULL, 'second', MIN(enrollment_date) FROM dim_patient""", "dim_patient")


@register("t8_scd2_merge", f"""
  SELECT * FROM scd_cur WHERE is_current <> 1
  UNION ALL
  SELECT c.* FROM scd_cur c LEFT JOIN (SELECT *, true AS here FROM scd_in) i ON c.patient_id IS NOT DISTINCT FROM i.patient_id
  WHERE c.is_current = 1 AND (i.here IS NULL OR ({_SAME}))
  UNION ALL
  SELECT c.patient_id, c.gender, c.date_of_birth, c.region, c.enrollment_date, c.effective_from,
         CAST(DATE '{SCD_AS_OF}' - INTERVAL 1 DAY AS DATE), CAST(0 AS SMALLINT)
  FROM scd_cur c JOIN scd_in i ON c.patient_id IS NOT DISTINCT FROM i.patient_id
  WHERE c.is_current = 1 AND NOT ({_SAME}) AND c.effective_from <> DATE '{SCD_AS_OF}'
  UNION ALL
  SELECT i.patient_id, i.gender, i.date_of_birth, i.region, i.enrollment_date, DATE '{SCD_AS_OF}',
         DATE '9999-12-31', CAST(1 AS SMALLINT)
  FROM scd_in i LEFT JOIN (SELECT *, true AS here FROM scd_cur WHERE is_current = 1) c ON c.patient_id IS NOT DISTINCT FROM i.patient_id
  WHERE c.here IS NULL OR NOT ({_SAME})""", ("scd_cur", "scd_in"))
def _t8(t):
    return _inc.scd2_merge(_scd_current(t), _scd_incoming(t), "patient_id", _SCD_ATTRS, SCD_AS_OF)


# ----------------------------------------------------------------- S5-S8, S10, S11, I4 (files)
# These write CSV derived from the given tables into the shared checkpoint
# folder, then read it back the way raw files arrive.
import datetime as _dt  # noqa: E402
import uuid as _uuid  # noqa: E402

from ..schemas import KEYS as _KEYS, RAW_COLUMNS as _RAW_COLUMNS, STAGING_TABLE as _STAGING_TABLE  # noqa: E402
from ..session import scratch_path as _scratch  # noqa: E402
from ..sources import tables as _tables  # noqa: E402
from ..sources.csv import read_raw_csv as _read_raw_csv, write_csv as _write_csv  # noqa: E402

_RAW = {"prescriptions": (_fx.rx_raw, "rx_raw", "prescription_id"), "claims": (_fx.claims_raw, "claims_raw", "claim_id")}
_STAMP = _dt.datetime(2025, 1, 1)


def _root(t: DomainTables, name: str) -> str:
    return _scratch(t.spark, f"careflow-{name}-{_uuid.uuid4().hex[:12]}")


def _landing(t: DomainTables, root: str, dataset: str = "prescriptions") -> str:
    """The dataset as CSV files: all rows of a key lie in one file, ordered by all
    columns, so the last row of a key is the greatest."""
    build, _, _ = _RAW[dataset]
    parts = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    raw = build(t.spark, t.sf_dir, parts).select(*_RAW_COLUMNS[dataset])
    return _write_csv(raw.sortWithinPartitions(*_RAW_COLUMNS[dataset]), f"{root}/raw/{dataset}.csv")


def _staged_sql(dataset: str) -> str:
    """Valid rows, the last one of each key in the landing's order, coerced."""
    _, view, key = _RAW[dataset]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in _RAW_COLUMNS[dataset])
    return f"""SELECT {coerced_select(dataset)} FROM (
      SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn
      FROM ({validated_sql(dataset, view)}) WHERE _validation_error IS NULL) WHERE _rn = 1"""


def _ingested(t: DomainTables, name: str, dataset: str = "prescriptions") -> tuple[_tables.TableStore, str]:
    from .ingest import ingest_file
    root = _root(t, name)
    store = _tables.TableStore(t.spark, f"{root}/tables")
    ingest_file(t.spark, _landing(t, root, dataset), dataset, store, f"{root}/quarantine", _STAMP)
    return store, f"{root}/quarantine"


@register("s5_csv_scan", "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt FROM rx_raw", ("rx_raw",))
def _s5(t):
    return _read_raw_csv(t.spark, _landing(t, _root(t, "s5"))).drop("_file", "_row_number")


@register("s5_csv_row_numbers", """
  SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS files_with_gaps FROM rx_raw""", ("rx_raw",))
def _s5n(t):
    """Row numbers of every file run from 1 to its number of rows."""
    rows = _read_raw_csv(t.spark, _landing(t, _root(t, "s5"))).groupBy("_file").agg(
        F.count(F.lit(1)).alias("n"), F.min("_row_number").alias("low"), F.max("_row_number").alias("high"),
        F.sum("_row_number").alias("total"))
    gap = (F.col("low") != 1) | (F.col("high") != F.col("n")) | (2 * F.col("total") != F.col("n") * (F.col("n") + 1))
    return rows.agg(F.sum("n").alias("n"), F.count_if(gap).alias("files_with_gaps"))


@register("s6_ingest_prescriptions", _staged_sql("prescriptions"), ("rx_raw",))
def _s6(t):
    return _ingested(t, "s6")[0].read("stg_prescriptions").drop("ingested_at")


@register("s6_ingest_claims", _staged_sql("claims"), ("claims_raw",))
def _s6c(t):
    return _ingested(t, "s6", "claims")[0].read("stg_claims").drop("ingested_at")


_fx._view("dx_raw", """
  SELECT CAST(diagnosis_id AS VARCHAR) AS diagnosis_id, CAST(patient_id AS VARCHAR) AS patient_id, icd_code,
         CAST(diagnosis_date AS VARCHAR) AS diagnosis_date, 'none-known' AS physician_id, severity FROM dx_stage""", "dx_stage")
_fx._view("patients_raw", """
  SELECT CAST(patient_id AS VARCHAR) AS patient_id, CASE WHEN gender IN ('BUILDING', 'MACHINERY') THEN 'M' ELSE 'F' END AS gender,
         date_of_birth, region, enrollment_date FROM patients_stage""", "patients_stage")
_fx._view("physicians_raw", """
  SELECT CAST(physician_id AS VARCHAR) AS physician_id, specialty, region, CAST(years_experience AS VARCHAR) AS years_experience
  FROM physicians_stage""", "physicians_stage")
_RAW_VIEW = {"prescriptions": "rx_raw", "claims": "claims_raw", "diagnoses": "dx_raw", "patients": "patients_raw",
             "physicians": "physicians_raw"}


def _tally_sql(dataset: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, COUNT(*) FILTER (WHERE _validation_error IS NULL) AS records_valid,
      COUNT(*) FILTER (WHERE _validation_error IS NOT NULL) AS records_invalid,
      COUNT(*) FILTER (WHERE _validation_error IS NOT NULL) AS records_quarantined,
      COUNT(DISTINCT {_KEYS[dataset]}) FILTER (WHERE _validation_error IS NULL) AS records_loaded
      FROM ({validated_sql(dataset, _RAW_VIEW[dataset])})"""


@register("s7_ingest_all", " UNION ALL ".join(_tally_sql(d) for d in _RAW_VIEW), tuple(_RAW_VIEW.values()))
def _s7(t):
    """The five datasets of a landing folder, one run."""
    from .ingest import ingest_all
    from .landing import write_landing
    root = _root(t, "s7")
    write_landing(t.spark, t.sf_dir, f"{root}/raw")
    done = ingest_all(t.spark, f"{root}/raw", _tables.TableStore(t.spark, f"{root}/tables"), f"{root}/quarantine", _STAMP)
    names = ["dataset_type", "records_valid", "records_invalid", "records_quarantined", "records_loaded"]
    return t.spark.createDataFrame([tuple(r[n] for n in names) for r in done],
                                   "dataset string, " + ", ".join(f"{n} long" for n in names[1:]))


@register("s8_staging_write", "SELECT * EXCLUDE (ingested_at) FROM inc_source QUALIFY row_number() OVER ("
          "PARTITION BY diagnosis_id ORDER BY icd_code DESC NULLS LAST, patient_id DESC NULLS LAST, "
          "diagnosis_date DESC NULLS LAST, physician_id DESC NULLS LAST, severity DESC NULLS LAST) = 1", ("inc_source",))
def _s8(t):
    """Staging write with the last row of a key by a stated order."""
    store = _tables.TableStore(t.spark, f"{_root(t, 's8')}/tables")
    rows = _inc_source(t).drop("ingested_at")
    _tables.load_staging(store, rows, "stg_diagnoses", "diagnosis_id", _STAMP, order=["icd_code"])
    return store.read("stg_diagnoses").drop("ingested_at")


@register("s10_create_if_absent", """
  SELECT 'stg_claims' AS table, COUNT(*) AS n FROM claims_stage
  UNION ALL SELECT * FROM (VALUES ('stg_diagnoses', 0), ('stg_patients', 0), ('stg_physicians', 0), ('stg_prescriptions', 0))""",
          ("claims_stage",))
def _s10(t):
    """Absent tables are created empty; one that is there keeps its rows."""
    from .full_run import ensure_tables
    store = _tables.TableStore(t.spark, f"{_root(t, 's10')}/tables")
    store.write(t.claims_stage, "stg_claims")
    ensure_tables(store)
    parts = [store.read(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table"), "n")
             for n in sorted(_STAGING_TABLE.values())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register("s11_quarantine_prescriptions", f"""
  SELECT *, 'prescriptions' AS source, '20250101_000000' AS batch_ts
  FROM ({validated_sql("prescriptions", "rx_raw")}) WHERE _validation_error IS NOT NULL""", ("rx_raw",))
def _s11(t):
    return t.spark.read.parquet(_ingested(t, "s11")[1]).drop("_file", "_row_number")


@register("v4_missing_column", f"""
  SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE contains(e, '''drug_name'' is a required property')) AS n_missing,
         COUNT(*) FILTER (WHERE contains(e, 'is not of type') OR contains(e, 'less than')) AS n_other
  FROM (SELECT '''drug_name'' is a required property' || COALESCE('; ' || _validation_error, '') AS e
        FROM ({validated_sql("prescriptions", "(SELECT * REPLACE ('x' AS drug_name) FROM rx_raw)")}))""", ("rx_raw",))
def _v4(t):
    """A table without a required column: every row says so, beside its other errors."""
    error = F.col(_val.ERROR_COL)
    return _val.validate(_fx.rx_raw(t.spark, t.sf_dir).drop("drug_name"), "prescriptions").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.contains(error, F.lit("'drug_name' is a required property"))).alias("n_missing"),
        F.count_if(F.contains(error, F.lit("is not of type")) | F.contains(error, F.lit("less than"))).alias("n_other"))


@register("i4_stream_upsert_prescriptions", _staged_sql("prescriptions"), ("rx_raw",))
def _i4(t):
    from ..streaming.incremental_stream import run_available
    root = _root(t, "i4")
    store = _tables.TableStore(t.spark, f"{root}/tables")
    return run_available(t.spark, _landing(t, root), "prescriptions", store, f"{root}/quarantine",
                         f"{root}/stream-ckpt").drop("ingested_at")


# ----------------------------------------------------------------- Q9, T7 (tables written by the job)
@register("q9_dq_trend", """
  SELECT date_trunc('month', o_orderdate) AS run_timestamp,
         CAST(ROUND(CAST(COUNT(*) FILTER (WHERE o_totalprice <= 200000) AS DOUBLE) / COUNT(*), 4) AS DECIMAL(5,4)) AS overall_score
  FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 10""")
def _q9(t):
    """The newest of many scores: one run a month of orders, the share of prices within limits."""
    from ..sources.fixtures import table
    scores = (table(t.spark, t.sf_dir, "orders")
              .groupBy(F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz").alias("run_timestamp"))
              .agg(F.round(F.count_if(F.col("o_totalprice") <= 200000).cast("double") / F.count(F.lit(1)), 4)
                   .cast("decimal(5,4)").alias("overall_score")))
    return quality.dq_trend(scores, n=10)


def _staged_store(t: DomainTables, name: str) -> _tables.TableStore:
    store = _tables.TableStore(t.spark, f"{_root(t, name)}/tables")
    for table, df in {"stg_patients": t.patients_stage, "stg_physicians": t.physicians_stage,
                      "stg_prescriptions": t.rx_stage, "stg_diagnoses": t.dx_stage}.items():
        store.write(df, table)
    return store


@register("t7_transform_counts", """
  SELECT 'dim_patient' AS table, COUNT(*) AS row_count FROM dim_patient
  UNION ALL SELECT 'dim_physician', COUNT(*) FROM dim_physician
  UNION ALL SELECT 'fact_prescription', COUNT(*) FROM fact_rx
  UNION ALL SELECT 'dim_therapy', COUNT(DISTINCT therapy_area) FROM fact_rx
  UNION ALL SELECT 'fact_patient_journey', (SELECT COUNT(*) FROM fact_rx) + (SELECT COUNT(*) FROM dx_stage)
  UNION ALL SELECT 'therapy_switches', COUNT(*) FROM switches""",
          ("dim_patient", "dim_physician", "fact_rx", "dx_stage", "switches"))
def _t7(t):
    """Stage the fixture tables, run every warehouse transform, report rows per table."""
    from .full_run import run_all_transformations
    counts = run_all_transformations(_staged_store(t, "t7"), t.as_of, rx_order=_fx.RX_ORDER)
    return t.spark.createDataFrame(sorted(counts.items()), "table string, row_count long")


# ----------------------------------------------------------------- S13, S14 (sinks), S15 and M9 (rows-only)
@register("s13_dq_report_saved", f"""
  SELECT 'dq_20250101_000000' AS run_id, TIMESTAMP '2025-01-01 00:00:00' AS run_timestamp,
         CAST(COUNT(*) AS INTEGER) AS total_checks, CAST(COUNT(*) FILTER (WHERE passed) AS INTEGER) AS passed_checks,
         CAST(CAST(COUNT(*) FILTER (WHERE passed) AS DOUBLE) / COUNT(*) AS DECIMAL(5,4)) AS overall_score
  FROM ({_SUITE_SQL})""", _STG_VIEWS)
def _s13(t):
    """Run the suite on the fixture staging tables, save the JSON report and
    the dq_scores row, read the dq_scores table back."""
    root = _root(t, "s13")
    store = _tables.TableStore(t.spark, f"{root}/tables")
    path = _tables.save_dq_report(store, _report(t, written=True), f"{root}/reports", _STAMP)
    t.spark.read.json(path).count()                      # the report is readable JSON
    return store.read("dq_scores").drop("report_path")


@register("s14_pipeline_run_log", """
  SELECT 'warehouse_build_20250101_000500' AS run_id, 'warehouse_build' AS pipeline_name, 'success' AS status,
         TIMESTAMP '2025-01-01 00:00:00' AS started_at, TIMESTAMP '2025-01-01 00:05:00' AS completed_at,
         CAST((SELECT COUNT(*) FROM fact_rx) + (SELECT COUNT(*) FROM dx_stage) AS INTEGER) AS records_processed,
         CAST(0 AS INTEGER) AS records_failed""", ("fact_rx", "dx_stage"))
def _s14(t):
    """Build the warehouse from the fixture staging tables and log the run with its journey rows."""
    from .full_run import run_all_transformations
    store = _staged_store(t, "s14")
    counts = run_all_transformations(store, t.as_of, rx_order=_fx.RX_ORDER)
    _tables.record_pipeline_run(store, "warehouse_build", "success", _STAMP, _dt.datetime(2025, 1, 1, 0, 5),
                                counts["fact_patient_journey"], 0)
    return store.read("pipeline_runs")


@register("m9_train_save_load")
def _m9(t):
    """M9 + S15: train on the fixture fact table, save the model, load it back,
    score with the loaded model."""
    root = _root(t, "m9")
    model, stats, feats = _aj.train(t.fact_prescription)
    _forest.save_model(t.spark, model, f"{root}/model", stats)
    loaded, loaded_stats = _forest.load_model(t.spark, f"{root}/model")
    return _aj.score(feats, loaded, loaded_stats)


from . import registry_forest, registry_incremental  # noqa: E402, F401  (register their queries)
