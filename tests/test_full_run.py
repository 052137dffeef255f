"""The whole batch job on tiny generated data (the reference's integration test)."""
import datetime as dt
import os

import pytest

from careflow.plans import full_run
from careflow.sources.tables import TableStore


def test_full_run_end_to_end(spark, tmpdir_path):
    out = full_run.run(spark, tmpdir_path, steps=full_run.STEPS, scale=0.01, as_of=dt.date(2025, 1, 1), n_trees=20)
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    loaded = {r["dataset_type"]: r["records_loaded"] for r in out["ingest"]}
    assert loaded == {"patients": 50, "physicians": 5, "prescriptions": 500, "diagnoses": 300, "claims": 400}
    assert out["validate"]["total_checks"] == 16
    t = out["transform"]
    assert t["fact_prescription"] == 500
    assert t["fact_patient_journey"] == 800                   # Rx + Dx
    assert t["dim_therapy"] == 6
    assert out["infer"]["total_scored"] == 5
    runs = store.read("pipeline_runs").collect()
    assert len(runs) == 1 and runs[0].status == "success" and runs[0].records_processed == 1255
    assert runs[0].records_failed > 0
    assert store.read("dq_scores").count() == 1
    assert store.read("anomaly_results").count() >= 1


def test_full_run_on_a_landing_of_the_given_tables(spark, tmpdir_path):
    """The default steps on CSV files of the given tables, against plain counts of what was landed."""
    from careflow.plans.landing import raw_tables, write_landing
    from tests.conftest import SF_SMALL
    write_landing(spark, SF_SMALL, f"{tmpdir_path}/raw")
    out = full_run.run(spark, tmpdir_path, as_of=dt.date(2025, 1, 1), n_trees=10)
    assert "generate" not in out and [r["dataset_type"] for r in out["ingest"]] == [
        "patients", "physicians", "prescriptions", "diagnoses", "claims"]
    landed = {n: df.count() for n, df in raw_tables(spark, SF_SMALL).items()}
    for r in out["ingest"]:
        assert r["records_valid"] + r["records_invalid"] == landed[r["dataset_type"]]
        assert 0 < r["records_loaded"] <= r["records_valid"] and r["records_quarantined"] == r["records_invalid"]
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    fact, dx = store.read("fact_prescription"), store.read("stg_diagnoses")
    assert out["transform"]["fact_patient_journey"] == fact.count() + dx.count()
    assert fact.count() == fact.select("prescription_id").distinct().count()
    assert out["infer"]["total_scored"] == fact.select("physician_id").distinct().count()
    assert store.read("pipeline_runs").first()["status"] == "success"


def test_a_run_that_failed_goes_on_where_it_failed(spark, tmpdir_path, monkeypatch):
    """Fails in train; the next run skips what is done and gives what an undisturbed run gives."""
    from careflow.plans import anomaly_jobs
    from careflow.plans.landing import raw_tables
    from careflow.sources.csv import write_csv
    from tests.conftest import SF_SMALL
    raw = f"{tmpdir_path}/raw"
    for name, df in raw_tables(spark, SF_SMALL).items():
        write_csv(df, f"{raw}/{name}.csv")
    named = {"as_of": dt.date(2025, 1, 1), "n_trees": 10, "raw_dir": raw, "resume": True}
    whole = full_run.run(spark, f"{tmpdir_path}/whole", **named)
    assert whole["skipped"] == []
    train = anomaly_jobs.train_and_save
    monkeypatch.setattr(anomaly_jobs, "train_and_save", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        full_run.run(spark, f"{tmpdir_path}/broken", **named)
    monkeypatch.setattr(anomaly_jobs, "train_and_save", train)
    store, other = (TableStore(spark, f"{tmpdir_path}/{n}/tables") for n in ("broken", "whole"))
    before = store.current("fact_prescription")
    out = full_run.run(spark, f"{tmpdir_path}/broken", **named)
    assert out["skipped"] == ["ingest", "validate", "transform"] and store.current("fact_prescription") == before
    for t in (*full_run.WAREHOUSE, "anomaly_results"):
        rows = [sorted(map(str, s.read(t).drop("ingested_at").collect())) for s in (store, other)]
        assert rows[0] == rows[1], t
    assert [out[s] for s in ("transform", "infer")] == [whole[s] for s in ("transform", "infer")]
    assert full_run.run(spark, f"{tmpdir_path}/broken", **named)["skipped"] == full_run.DEFAULT_STEPS
    again = full_run.run(spark, f"{tmpdir_path}/broken", **{**named, "n_trees": 12})
    assert again["skipped"] == ["ingest", "validate", "transform"]
    store.write(store.read("fact_prescription").limit(50), "fact_prescription")     # somebody replaced a table
    assert full_run.run(spark, f"{tmpdir_path}/broken", **named)["skipped"] == ["ingest", "validate"]
    assert sorted(r["status"] for r in store.read("pipeline_runs").collect()) == ["failed", *["success"] * 4]


def test_failed_gate_is_logged(spark, tmpdir_path):
    with pytest.raises(ValueError):
        full_run.run(spark, tmpdir_path, steps=["generate", "ingest", "validate"], scale=0.01,
                     as_of=dt.date(2025, 1, 1), gate=True, gate_threshold=1.01)
    runs = TableStore(spark, os.path.join(tmpdir_path, "tables")).read("pipeline_runs").collect()
    assert [r.status for r in runs] == ["failed"]


def test_unknown_step(spark, tmpdir_path):
    with pytest.raises(ValueError):
        full_run.run(spark, tmpdir_path, steps=["teleport"])
