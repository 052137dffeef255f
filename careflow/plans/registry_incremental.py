"""Registered queries on bucketed tables: upserts of touched buckets, the
incremental job, late dimension changes.  Each has the SQL of a full rebuild."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import to_date_strict
from ..operators import incremental, warehouse
from ..schemas import HIGH_DATE
from ..session import reliable_checkpoint, scratch_path
from ..sources import fixtures
from ..sources.buckets import BucketStore
from ..sources.fixtures import _view
from . import incremental_run, quality_run
from .domain import DomainTables
from ..operators import kpi_state
from ..operators.kpis import DashboardFilter
from .oracle_quality import suite_sql
from .registry import (_STG_VIEW, _STG_VIEWS, ORACLE, REGION, TEST_AREAS, TEST_REGIONS, THERAPY, _dash_sql, _inc_source,
                       _inc_target, _landing, _scd_current, _staging, _suite, register)


def _store(t: DomainTables, name: str) -> BucketStore:
    return BucketStore(t.spark, scratch_path(t.spark, f"careflow-{name}-{uuid.uuid4().hex[:12]}"), buckets=16)


# ----------------------------------------------------------------- I3
@register("i3_upsert_touched_buckets", None)
def _i3_buckets(t):
    """The upsert of ``i3_upsert`` into a bucketed table: only touched buckets are written."""
    store = _store(t, "upsert")
    first = store.begin()
    first.write("diagnosis", _inc_target(t), "diagnosis_id")
    first.marks["diagnosis"] = incremental.mark_text(_inc_target(t))
    first.publish()
    second = store.begin()
    delta = incremental.delta_rows(_inc_source(t), second.marks["diagnosis"])
    second.upsert("diagnosis", warehouse.dedup_keep_last(delta, "diagnosis_id"), "diagnosis_id")
    second.publish()
    return store.read("diagnosis")


ORACLE["i3_upsert_touched_buckets"] = ORACLE["i3_upsert"]


# ----------------------------------------------------------------- I4
@register("i4_stream_touched_buckets", None)
def _i4_buckets(t):
    """The stream of ``i4_stream_upsert_prescriptions`` into a bucketed table, in
    micro-batches of two files (of more, where that would be more than eight batches):
    each reads and writes the buckets of its keys only."""
    from ..streaming.incremental_stream import ARRIVAL, run_available
    root = scratch_path(t.spark, f"careflow-i4b-{uuid.uuid4().hex[:12]}")
    store = BucketStore(t.spark, f"{root}/tables", buckets=16)
    return run_available(t.spark, _landing(t, root), "prescriptions", store, f"{root}/quarantine", f"{root}/stream-ckpt",
                         max_files_per_trigger=2, most_batches=8).drop("ingested_at", *ARRIVAL)


ORACLE["i4_stream_touched_buckets"] = ORACLE["i4_stream_upsert_prescriptions"]


# ----------------------------------------------------------------- the incremental job
# Stand-in input: prescriptions stamped with their day, and copies that come later:
# of some first lines under the next patient, of some second lines with a bad date.
RESENT, SPOILED = "1999-06-01 00:00:00", "1999-06-02 00:00:00"
#: Instants at which the job runs; the last run sees everything.
RUNS = ["1995-01-01 00:00:00", "1997-06-30 00:00:00", None]
MOVED_TO = "AMERICA"
_RX = ["prescription_id", "patient_id", "physician_id", "drug_name", "prescription_date", "quantity", "refills", "therapy_area"]


def rx_arrivals(t: DomainTables) -> DataFrame:
    """Joined, stamped and written once: every run of the job and all three parts read it."""
    staged = t.rx_written if t.has_rx_written else fixtures.rx_dealt(t.spark, t.sf_dir)
    rows = staged.select(*_RX).withColumn(
        "ingested_at", F.coalesce(to_date_strict(F.col("prescription_date")).cast("timestamp_ntz"),
                                  F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")))
    if not t.has_rx_written:
        rows = reliable_checkpoint(rows)
    moved = rows.filter("refills = 1 and quantity > 45").withColumn("patient_id", F.col("patient_id") + 1).withColumn(
        "drug_name", F.concat("drug_name", F.lit("-rev"))).withColumn("ingested_at", F.lit(RESENT).cast("timestamp_ntz"))
    spoiled = rows.filter("refills = 2 and quantity > 45").withColumn(
        "prescription_date", F.lit(fixtures.BAD_DATE)).withColumn("ingested_at", F.lit(SPOILED).cast("timestamp_ntz"))
    return rows.unionByName(moved).unionByName(spoiled)


_view("rx_arrivals", f"""
  SELECT {", ".join(_RX)}, coalesce(try_strptime(prescription_date, '%Y-%m-%d'), TIMESTAMP '1996-01-01') AS ingested_at FROM rx_stage
  UNION ALL
  SELECT prescription_id, patient_id + 1, physician_id, drug_name || '-rev', prescription_date, quantity, refills, therapy_area,
         TIMESTAMP '{RESENT}' FROM rx_stage WHERE refills = 1 AND quantity > 45
  UNION ALL
  SELECT prescription_id, patient_id, physician_id, drug_name, '{fixtures.BAD_DATE}', quantity, refills, therapy_area,
         TIMESTAMP '{SPOILED}' FROM rx_stage WHERE refills = 2 AND quantity > 45""", "rx_stage")
_view("fact_arrivals", """
  SELECT prescription_id, patient_id, physician_id, drug_name, CAST(try_strptime(prescription_date, '%Y-%m-%d') AS DATE) AS prescription_date,
         COALESCE(quantity, 0) AS quantity, COALESCE(refills, 0) AS refills, therapy_area
  FROM (SELECT *, row_number() OVER (PARTITION BY prescription_id ORDER BY ingested_at DESC,
          patient_id DESC, physician_id DESC, drug_name DESC, prescription_date DESC, quantity DESC, refills DESC, therapy_area DESC) AS _rn
        FROM rx_arrivals)
  WHERE _rn = 1 AND try_strptime(prescription_date, '%Y-%m-%d') IS NOT NULL""", "rx_arrivals")
_view("dx_arrivals", """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY diagnosis_id ORDER BY ingested_at DESC) AS _rn FROM inc_source)
  WHERE _rn = 1""", "inc_source")


def patient_arrivals(t: DomainTables) -> DataFrame:
    """Stand-in input: every patient comes once, those of one segment once more from another region."""
    rows = t.patients_stage.withColumn("ingested_at", F.lit("1994-01-01 00:00:00").cast("timestamp_ntz"))
    moved = rows.filter(F.col("gender") == "MACHINERY").withColumn("region", F.lit(MOVED_TO)).withColumn(
        "ingested_at", F.lit("1997-01-15 00:00:00").cast("timestamp_ntz"))
    return rows.unionByName(moved)


def _loaded(t: DomainTables, *names: str, kpis: bool = False) -> BucketStore:
    """The store after a run of the job at each instant of ``RUNS``."""
    store = _store(t, "job")
    sources = {"prescriptions": rx_arrivals(t), "diagnoses": _inc_source(t), "patients": patient_arrivals(t)}
    dx_until = ["2024-01-10 00:00:00", "2024-02-01 00:00:00", None]
    for i, until in enumerate(RUNS):
        limits = {"prescriptions": until, "diagnoses": dx_until[i], "patients": until}
        incremental_run.run(store, {n: sources[n] if limits[n] is None else
                                    sources[n].filter(F.col("ingested_at") < F.lit(limits[n]).cast("timestamp_ntz")) for n in names},
                            kpis=kpis)
    return store


@register("i3_fact_incremental", "SELECT * FROM fact_arrivals", ("fact_arrivals",))
def _i3_fact(t):
    """fact_prescription after three incremental runs equals one rebuild."""
    return _loaded(t, "prescriptions").read("fact_prescription")


@register("t5_journey_incremental", """
  SELECT patient_id, event_type, event_date, event_detail, therapy_area,
         CASE WHEN patient_id IS NULL THEN NULL ELSE CAST(row_number() OVER (
             PARTITION BY patient_id ORDER BY event_date NULLS LAST, event_type DESC, src) AS INTEGER) END AS sequence_num
  FROM (SELECT patient_id, 'prescription' AS event_type, prescription_date AS event_date,
               drug_name AS event_detail, therapy_area, prescription_id AS src FROM fact_arrivals
        UNION ALL
        SELECT patient_id, 'diagnosis', diagnosis_date, icd_code, '', CAST(diagnosis_id AS VARCHAR) FROM dx_arrivals)""",
          ("fact_arrivals", "dx_arrivals"))
def _t5_incremental(t):
    """fact_patient_journey after three incremental runs equals one rebuild."""
    return _loaded(t, "prescriptions", "diagnoses").read("fact_patient_journey")


@register("t6_switches_incremental", """
  SELECT patient_id, from_drug, to_drug, switch_date, therapy_area FROM (
    SELECT patient_id, lag(drug_name) OVER w AS from_drug, drug_name AS to_drug,
           prescription_date AS switch_date, therapy_area, row_number() OVER w AS _rn
    FROM fact_arrivals WHERE patient_id IS NOT NULL
    WINDOW w AS (PARTITION BY patient_id ORDER BY prescription_date, prescription_id))
  WHERE _rn > 1 AND from_drug IS DISTINCT FROM to_drug""", ("fact_arrivals",))
def _t6_incremental(t):
    """therapy_switches after three incremental runs equals one rebuild."""
    return _loaded(t, "prescriptions").read("therapy_switches")


# ----------------------------------------------------------------- KPIs of the job
_view("dim_arrivals", f"""
  SELECT * REPLACE (CASE WHEN gender = 'MACHINERY' THEN '{MOVED_TO}' ELSE region END AS region) FROM dim_patient""", "dim_patient")
_view("switch_arrivals", """
  SELECT patient_id, from_drug, drug_name AS to_drug, therapy_area FROM (
    SELECT *, lag(drug_name) OVER w AS from_drug, row_number() OVER w AS _rn
    FROM fact_arrivals WHERE patient_id IS NOT NULL
    WINDOW w AS (PARTITION BY patient_id ORDER BY prescription_date, prescription_id))
  WHERE _rn > 1 AND from_drug IS DISTINCT FROM drug_name""", "fact_arrivals")
_KPI_VIEWS = ("dim_arrivals", "fact_arrivals", "switch_arrivals", "anomalies")
_FILTERED = DashboardFilter(REGION, THERAPY, TEST_REGIONS, TEST_AREAS)
_IN_REGION = DashboardFilter(REGION, "All", TEST_REGIONS, TEST_AREAS)


def _kpi_tables(t: DomainTables) -> dict[str, DataFrame]:
    """The KPI state after three incremental runs."""
    store = _loaded(t, "prescriptions", "patients", kpis=True)
    return {name: store.read(f"kpi_{name}") for name in ("counts", "members", "physicians")}


def _over_arrivals(sql: str) -> str:
    for old, new in [("dim_patient", "dim_arrivals"), ("fact_rx", "fact_arrivals"), ("switches ts", "switch_arrivals ts")]:
        sql = sql.replace(old, new)
    return sql


@register("k1_switch_rate_incremental", """
  SELECT s.therapy_area, s.n AS patients_switched, ROUND(s.n * 100.0 / f.n, 2) AS switch_rate
  FROM (SELECT therapy_area, COUNT(DISTINCT patient_id) AS n FROM switch_arrivals GROUP BY therapy_area) s
  LEFT JOIN (SELECT therapy_area, COUNT(DISTINCT patient_id) AS n FROM fact_arrivals GROUP BY therapy_area) f USING (therapy_area)
  ORDER BY switch_rate DESC, therapy_area""", ("fact_arrivals", "switch_arrivals"))
def _k1_incremental(t):
    """K1 from the bitmaps that three incremental runs left."""
    state = _kpi_tables(t)
    return kpi_state.switch_rate(state["members"], state["counts"])


@register("a7_totals_incremental", """
  SELECT (SELECT COUNT(*) FROM dim_arrivals) AS total_patients, (SELECT COUNT(*) FROM fact_arrivals) AS total_prescriptions,
         (SELECT COUNT(*) FROM switch_arrivals) AS total_therapy_switches,
         (SELECT COUNT(*) FROM anomalies) AS total_anomalies_detected""", _KPI_VIEWS)
def _a7_incremental(t):
    """A7 from the counts that three incremental runs left."""
    t.rx_written    # read by the job and by the anomalies
    return kpi_state.global_totals(_kpi_tables(t)["counts"], t.anomaly_results)


_CARDS = ["d2_patient_card", "d3_rx_card", "d4_switch_card", "d5_anomaly_card"]


@register("d2_d5_cards_incremental", " UNION ALL ".join(
    f"SELECT '{name}' AS card, cnt FROM ({_over_arrivals(_dash_sql(REGION, THERAPY)[name])})" for name in _CARDS), _KPI_VIEWS)
def _cards_incremental(t):
    """The cards D2 to D5 under both filters from the state that three incremental runs left."""
    t.rx_written    # read by the job and by the anomalies
    state = _kpi_tables(t)
    cards = [kpi_state.patient_card(state["members"], _FILTERED), kpi_state.rx_card(state["counts"], _FILTERED),
             kpi_state.switch_card(state["counts"], _FILTERED),
             kpi_state.anomaly_card(state["physicians"], t.anomaly_results, _FILTERED)]
    named = [card.select(F.lit(name).alias("card"), "cnt") for name, card in zip(_CARDS, cards, strict=True)]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


@register("d6_rx_by_therapy_incremental", _over_arrivals(_dash_sql(REGION, None)["d6_rx_by_therapy"]), _KPI_VIEWS)
def _d6_incremental(t):
    """D6 of one region from the counts that three incremental runs left."""
    return kpi_state.rx_volume_by_therapy(_kpi_tables(t)["counts"], _IN_REGION)


# ----------------------------------------------------------------- Q1-Q6 by load
#: Stand-in input: every staged row is stamped with a day of its own; loads end before these days.
_STAMPED_BY = {"stg_prescriptions": "prescription_date", "stg_diagnoses": "diagnosis_date", "stg_claims": "claim_date",
               "stg_patients": "enrollment_date", "stg_physicians": None}
_LOADS = {"stg_prescriptions": ["1994-06-01", "1996-06-01"], "stg_diagnoses": ["2024-01-10", "2024-02-01"],
          "stg_claims": ["1993-01-01", "1998-01-01"], "stg_patients": ["2015-06-01", "2015-12-01"],
          "stg_physicians": ["2000-01-01", "2000-01-02"]}


def _stamped(rows: DataFrame, day: str | None) -> DataFrame:
    stamp = F.lit("1970-01-01") if day is None else F.coalesce(F.col(day).cast("string"), F.lit("1970-01-01"))
    stamp = F.coalesce(F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd")).cast("timestamp_ntz"), F.lit("1970-01-01").cast("timestamp_ntz"))
    return rows.withColumn("ingested_at", stamp)


@register("q6_suite_by_load", suite_sql(_suite(), _STG_VIEW), _STG_VIEWS)
def _q6_by_load(t):
    """The 16 checks from the profiles of three loads equal those over the whole tables."""
    store = _store(t, "dq")
    tables = {name: _stamped(rows, _STAMPED_BY[name]) for name, rows in _staging(t).items()}
    for i in range(3):
        quality_run.run(store, {name: rows if i == 2 else rows.filter(F.col("ingested_at") < F.lit(_LOADS[name][i]).cast("timestamp_ntz"))
                                for name, rows in tables.items()})
    return quality_run.suite(store).withColumn("score", F.round("score", 6))


# ----------------------------------------------------------------- T5, T6: the path of very long journeys
@register("t5_journey_in_slices", "SELECT * FROM journey", ("journey",))
def _t5_slices(t):
    """The journey with every patient of more than 60 events cut into ordered slices."""
    return warehouse.build_patient_journey(t.fact_prescription, t.dx_stage, hot_rows=60)


@register("t6_switches_in_slices", "SELECT * FROM switches", ("switches",))
def _t6_slices(t):
    """Switches with every patient of more than 40 prescriptions cut into ordered slices."""
    return warehouse.detect_therapy_switches(t.fact_prescription, hot_rows=40)


# ----------------------------------------------------------------- T8
_ATTRIBUTES = incremental_run.PATIENT_ATTRIBUTES
#: Changes by segment: days before, inside and after the history that ``_scd_current`` has.
LATE = [("BUILDING", "2024-06-15", "-early"), ("MACHINERY", "2024-03-10", "-inside"), ("MACHINERY", "2025-01-01", "-start"),
        ("AUTOMOBILE", "2025-03-01", "-after"), ("FURNITURE", "2024-12-31", "-eve"), ("FURNITURE", "2025-01-02", ""),
        ("HOUSEHOLD", "2025-02-02", "")]


def late_changes(t: DomainTables) -> DataFrame:
    table = F.array(*(F.struct(F.lit(g).alias("segment"), F.lit(d).cast("date").alias("changed_on"), F.lit(x).alias("suffix"))
                      for g, d, x in LATE))
    rows = t.dim_patient.select("patient_id", *_ATTRIBUTES, F.inline(table)).filter("segment = gender")
    return rows.withColumn("region", F.concat("region", "suffix")).drop("segment", "suffix")


_A = ", ".join(_ATTRIBUTES)
_view("late_events", f"""
  SELECT patient_id, day, 2 AS kind, gender, date_of_birth, region || suffix AS region, enrollment_date
  FROM dim_patient JOIN (VALUES {", ".join(f"('{g}', DATE '{d}', '{x}')" for g, d, x in LATE)}) AS l(segment, day, suffix)
    ON segment = gender
  UNION ALL SELECT patient_id, effective_from, 1, {_A} FROM scd_cur
  UNION ALL SELECT patient_id, CAST(effective_to + INTERVAL 1 DAY AS DATE), 0, {_A} FROM scd_cur WHERE effective_to < DATE '{HIGH_DATE}'""",
      "dim_patient", "scd_cur")


@register("t8_scd2_late_changes", f"""
  SELECT patient_id, {_A}, day AS effective_from,
         COALESCE(CAST(next - INTERVAL 1 DAY AS DATE), DATE '{HIGH_DATE}') AS effective_to,
         CAST(CASE WHEN next IS NULL THEN 1 ELSE 0 END AS SMALLINT) AS is_current
  FROM (SELECT *, lead(day) OVER (PARTITION BY patient_id ORDER BY day) AS next
        FROM (SELECT *, lag(kind) OVER w AS before_kind, lag(({_A})) OVER w AS before
              FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, day ORDER BY kind DESC) AS _rn FROM late_events)
              WHERE _rn = 1 WINDOW w AS (PARTITION BY patient_id ORDER BY day))
        WHERE NOT (kind > 0 AND COALESCE(before_kind, 0) > 0 AND before IS NOT DISTINCT FROM ({_A})))
  WHERE kind > 0""", ("late_events",))
def _t8_late(t):
    """Changes dated before, inside and after a key's history are spliced into it."""
    return incremental.scd2_splice(_scd_current(t), late_changes(t), "patient_id", _ATTRIBUTES)


# ----------------------------------------------------------------- A1 / D10
@register("a1_journey_of_one_patient", "SELECT * FROM journey WHERE patient_id = 7", ("journey",))
def _a1_point(t):
    """One patient's journey from the bucketed table: one bucket is read, with a pushed filter."""
    store = _store(t, "point")
    commit = store.begin()
    commit.write("fact_patient_journey", t.fact_patient_journey, "patient_id")
    commit.publish()
    return store.rows_of("fact_patient_journey", 7)
