"""Batch job entry (P1) and the warehouse build step.

``run(steps=...)`` runs any subset of (generate ->) ingest -> validate ->
transform -> train -> infer, in that order, against one table folder, and
always appends a pipeline_runs row (S14), also when a step fails.
Stages pass through tables; inside a stage everything is one lazy plan per
output table.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, warehouse
from ..operators.incremental import scd2_merge
from ..schemas import DQ_GATE, STAGING_TABLE, WAREHOUSE_SCHEMAS, staging_schema
from ..session import drop_checkpoint, reliable_checkpoint
from ..sources import generate as gen
from ..sources.tables import TableStore, record_pipeline_run, save_dq_report
from . import anomaly_jobs, ingest
from .ledger import StepLedger

log = logging.getLogger(__name__)

STEPS = ["generate", "ingest", "validate", "transform", "train", "infer"]
#: Steps of a run that names none: all but the one that makes test data.
DEFAULT_STEPS = STEPS[1:]


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _write_counted(store: TableStore, df: DataFrame, name: str) -> int:
    obs = Observation(f"rows_{name}")
    store.replace(df.observe(obs, F.count(F.lit(1)).alias("rows")), name)
    return int(obs.get["rows"])


PATIENT_ATTRIBUTES = ["gender", "date_of_birth", "region", "enrollment_date"]


def run_all_transformations(store: TableStore, as_of: _dt.date | str, incremental: bool = False,
                            rx_order: list[str] | None = None) -> dict[str, int]:
    """Staging -> warehouse tables; returns rows written per table
    (counted by ``observe`` while writing).  dim_therapy is built after
    fact_prescription so it reflects the current run.

    With ``incremental`` the patient dimension keeps its history: the staged
    patients are merged into it (T8) instead of replacing it.  ``rx_order``
    names the columns that order prescriptions of one id (default: arrival)."""
    counts = {}
    patients = warehouse.transform_patients(store.read("stg_patients"), as_of)
    before = store.read_or_none("dim_patient") if incremental else None
    if before is not None:
        patients = scd2_merge(before, patients.select("patient_id", *PATIENT_ATTRIBUTES), "patient_id",
                              PATIENT_ATTRIBUTES, as_of)
    counts["dim_patient"] = _write_counted(store, patients, "dim_patient")
    counts["dim_physician"] = _write_counted(
        store, warehouse.transform_physicians(store.read("stg_physicians")), "dim_physician")
    counts["fact_prescription"] = _write_counted(
        store, warehouse.transform_prescriptions(store.read("stg_prescriptions"), rx_order), "fact_prescription")
    fact = store.read("fact_prescription")
    counts["dim_therapy"] = _write_counted(store, warehouse.transform_therapy(fact), "dim_therapy")
    dx = store.read_or_none("stg_diagnoses")
    counts["fact_patient_journey"] = _write_counted(
        store, warehouse.build_patient_journey(fact, dx), "fact_patient_journey")
    counts["therapy_switches"] = _write_counted(store, warehouse.detect_therapy_switches(fact), "therapy_switches")
    return counts


def ensure_tables(store: TableStore) -> list[str]:
    """Create every staging / warehouse / log table that is absent."""
    schemas = {STAGING_TABLE[d]: staging_schema(d) for d in STAGING_TABLE}
    schemas.update(WAREHOUSE_SCHEMAS)
    return store.create_if_absent(schemas)


STAGING = list(STAGING_TABLE.values())
WAREHOUSE = ["dim_patient", "dim_physician", "fact_prescription", "dim_therapy", "fact_patient_journey", "therapy_switches"]
#: Tables that a step writes.
OUTPUTS = {"generate": [], "ingest": STAGING, "validate": [], "transform": WAREHOUSE, "train": [], "infer": ["anomaly_results"]}


def run(spark: SparkSession, root: str, steps: list[str] | None = None, scale: float = 1.0,
        as_of: _dt.date | None = None, gate: bool = False, n_trees: int = 100,
        gate_threshold: float = DQ_GATE, incremental: bool = False, raw_dir: str | None = None,
        resume: bool = False) -> dict:
    """Run the chosen steps (default: all but generate) in order; log the run (S14) in any case.
    ``incremental`` keeps the history of the patient dimension; ``raw_dir`` names a
    landing folder other than the job's own.  With ``resume`` a step is left out
    whose inputs, parameters and outputs are those of its last success
    (``plans/ledger.py``): a run that failed goes on at the step that failed.  The
    result of a step left out is that of its last success; ``skipped`` names them."""
    steps = steps or DEFAULT_STEPS
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    as_of = as_of or _now().date()
    store = TableStore(spark, f"{root}/tables")
    raw_dir, quarantine_dir = raw_dir or f"{root}/raw", f"{root}/quarantine"
    model_dir, report_dir = f"{root}/models/isolation_forest", f"{root}/reports"
    ledger = StepLedger(spark, f"{root}/ledger", store)
    started, status, processed, failed = _now(), "success", 0, 0
    out: dict = {"skipped": []}

    def inputs(step: str) -> dict:
        """What decides the result of a step."""
        if step == "generate":
            return {"scale": scale, "as_of": str(as_of)}
        if step == "ingest":
            return {"files": ledger.files(raw_dir)}
        if step in ("validate", "transform"):
            more = {"gate": [gate, gate_threshold]} if step == "validate" else {"as_of": str(as_of), "incremental": incremental}
            return {"tables": ledger.versions(STAGING), **more}
        fact = {"tables": ledger.versions(["fact_prescription"])}
        return {**fact, "n_trees": n_trees} if step == "train" else {**fact, "as_of": str(as_of), "model": ledger.files(model_dir)}

    def work(step: str):
        if step == "generate":
            return gen.generate_all(spark, raw_dir, scale=scale, as_of=str(as_of))
        if step == "ingest":
            return ingest.ingest_all(spark, raw_dir, store, quarantine_dir, _now())
        if step == "validate":
            staging = {t: store.read(t) for t in STAGING if store.exists(t)}
            report = reliable_checkpoint(quality.dq_report(quality.run_checks(staging)))
            try:
                save_dq_report(store, report, report_dir, _now())
                if gate:
                    quality.enforce_gate(report, gate_threshold)  # Q8 (scheduled job only)
                return report.select("total_checks", "passed", "overall_score").first().asDict()
            finally:
                drop_checkpoint(report)
        if step == "transform":
            return run_all_transformations(store, as_of, incremental)
        if step == "train":
            return anomaly_jobs.train_and_save(spark, store, model_dir, n_trees=n_trees)
        return anomaly_jobs.run_inference(spark, store, model_dir, detection_date=as_of)

    try:
        ensure_tables(store)
        for step in STEPS:
            if step not in steps:
                continue
            needs = inputs(step)
            result = ledger.done(step, needs) if resume else None
            if result is not None:
                out["skipped"].append(step)
            else:
                result = work(step)
                ledger.record(step, needs, OUTPUTS[step], json.loads(json.dumps(result, default=str)))
            out[step] = result
            if step == "ingest":
                processed = sum(r["records_loaded"] for r in result)
                failed = sum(r["records_quarantined"] for r in result)
    except Exception:
        status = "failed"
        log.exception("pipeline failed")
        raise
    finally:
        try:
            out["run_id"] = record_pipeline_run(store, "full_pipeline", status, started, _now(),
                                                processed, failed)
        except Exception as e:  # noqa: BLE001
            log.warning("the run log could not be written: %s", e)
    return out
