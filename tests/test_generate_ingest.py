"""Generator (S1-S4) and ingest (S6-S8, S11) invariants."""
import datetime as dt
import os

from careflow.plans import ingest
from careflow.sources import generate as G
from careflow.sources.tables import TableStore


def test_generated_sizes_and_dirt(spark):
    sizes = {"patients": 100, "physicians": 50, "prescriptions": 500, "diagnoses": 200, "claims": 300}
    rx = G.inject_dirty(spark, "prescriptions", 500, 0.03, sizes=sizes, as_of="2025-01-01")
    assert rx.count() == 515
    again = G.inject_dirty(spark, "prescriptions", 500, 0.03, sizes=sizes, as_of="2025-01-01")
    assert sorted(map(str, rx.collect())) == sorted(map(str, again.collect()))   # deterministic
    pats = {r.patient_id for r in G.generate(spark, "patients", 100, sizes=sizes).collect()}
    assert {r.patient_id for r in rx.collect() if r.patient_id} <= pats
    clean = G.generate(spark, "prescriptions", 500, sizes=sizes, as_of="2025-01-01").collect()
    assert int(clean[0].quantity) >= 500 and all(1 <= int(r.quantity) <= 90 for r in clean[1:500])


def test_ingest_end_to_end(spark, tmpdir_path):
    sizes_scale = 0.01     # 50 patients ... 500 prescriptions
    raw = os.path.join(tmpdir_path, "raw")
    G.generate_all(spark, raw, scale=sizes_scale, as_of="2025-01-01")
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    res = {r["dataset_type"]: r for r in ingest.ingest_all(spark, raw, store, os.path.join(tmpdir_path, "q"))}
    # every dirty copy is either quarantined or removed as a duplicate
    assert res["prescriptions"]["records_loaded"] == 500
    assert res["diagnoses"]["records_loaded"] == 300
    assert res["claims"]["records_loaded"] == 400
    assert store.read("stg_prescriptions").count() == 500
    q = spark.read.parquet(os.path.join(tmpdir_path, "q"))
    assert q.filter("source = 'prescriptions'").count() == res["prescriptions"]["records_quarantined"]
    assert set(store.read("stg_prescriptions").columns) >= {"ingested_at", "quantity"}
    # valid + invalid = input rows; every invalid row is quarantined; 3 % dirty copies
    for name, n in [("prescriptions", 500), ("diagnoses", 300), ("claims", 400)]:
        total_in = spark.read.option("header", True).csv(os.path.join(raw, f"{name}.csv")).count()
        r = res[name]
        assert r["records_valid"] + r["records_invalid"] == total_in
        assert r["records_quarantined"] == r["records_invalid"]
        assert r["records_loaded"] == n <= r["records_valid"]


def test_missing_file_is_skipped(spark, tmpdir_path):
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    assert ingest.ingest_all(spark, os.path.join(tmpdir_path, "none"), store, os.path.join(tmpdir_path, "q")) == []
    try:
        ingest.ingest_file(spark, "x.csv", "unknown", store, "q")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_load_staging_without_row_numbers_and_empty(spark, tmpdir_path):
    import datetime as dt
    from careflow.sources.tables import load_staging
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    df = spark.createDataFrame([("PHY-1", "A"), ("PHY-1", "B"), ("PHY-2", "C")], "physician_id string, specialty string")
    assert load_staging(store, df, "stg_physicians", "physician_id", dt.datetime(2025, 1, 1)) == 2
    # an empty load leaves the table as it was
    assert load_staging(store, df.limit(0), "stg_physicians", "physician_id", dt.datetime(2025, 1, 2)) == 0
    assert store.read("stg_physicians").count() == 2


def test_generated_claims_and_patients_look_right(spark):
    import re
    sizes = {"patients": 20, "physicians": 5, "prescriptions": 50, "diagnoses": 30, "claims": 40}
    claims = G.generate(spark, "claims", 40, sizes=sizes, as_of="2025-01-01").collect()
    assert all(re.fullmatch(r"CLM-\d{7}", r.claim_id) for r in claims)
    assert all(50.0 <= float(r.amount) <= 15000.0 and re.fullmatch(r"\d+\.\d{2}", r.amount) for r in claims)
    assert {r.status for r in claims} <= {"approved", "denied", "pending"}
    pats = G.generate(spark, "patients", 20, sizes=sizes, as_of="2025-01-01").collect()
    assert [r.patient_id for r in pats][:2] == ["PAT-000001", "PAT-000002"]
    assert all("1939-" < r.date_of_birth < "2007-" for r in pats)


def test_files_are_numbered_in_the_order_of_their_paths(spark):
    """The last row of a key is that of the greatest path; its path is not carried along."""
    from careflow.sources.tables import numbered_files
    rows = [("file:/x/b.csv", 1, "k", "b1"), ("file:/x/a.csv", 9, "k", "a9"), ("file:/x/b.csv", 2, "k", "b2"), (None, 3, "k", "n3")]
    out = numbered_files(spark.createDataFrame(rows, "_file string, _row_number long, k string, v string"))
    assert out.columns == ["_file", "_row_number", "k", "v"] and dict(out.dtypes)["_file"] == "int"
    assert {r.v: r._file for r in out.collect()} == {"n3": 1, "a9": 2, "b1": 3, "b2": 3}


def test_ingest_writes_the_parsed_rows_once(spark, tmpdir_path, monkeypatch):
    """Rows are validated on the way into the one table that gives them their numbers."""
    from careflow.plans import ingest
    from careflow.sources import csv, tables
    wide = []
    for module in (csv, tables):
        was = module.reliable_checkpoint
        monkeypatch.setattr(module, "reliable_checkpoint",
                            lambda df, was=was: (wide.append("claim_id" in df.columns), was(df))[1])
    with open(f"{tmpdir_path}/claims.csv", "w") as f:
        f.write("claim_id,patient_id,claim_date,amount,status,payer\n1,5,2024-01-01,10,approved,x\n"
                "2,5,2024-01-01,ten,approved,x\n1,6,2024-01-02,11,approved,x\n")
    assert not hasattr(ingest, "reliable_checkpoint")
    store = tables.TableStore(spark, f"{tmpdir_path}/t")
    done = ingest.ingest_file(spark, f"{tmpdir_path}/claims.csv", "claims", store, f"{tmpdir_path}/q", dt.datetime(2025, 1, 1))
    assert (done["records_valid"], done["records_quarantined"], done["records_loaded"]) == (2, 1, 1)
    assert sum(wide) == 1
    assert store.read("stg_claims").first().patient_id == "6"
    assert spark.read.parquet(f"{tmpdir_path}/q").first()["_row_number"] == 2
