"""Incremental load, SCD-2 and the streaming form: idempotence invariants."""
import datetime as dt
import os

import pytest

from careflow.operators import incremental as I
from careflow.sources.tables import TableStore
from careflow.streaming.incremental_stream import run_available

SCHEMA = "id string, v string, ingested_at timestamp"


def test_mark_and_delta(spark):
    t = spark.createDataFrame([("a", "1", dt.datetime(2024, 1, 1)), ("b", "1", dt.datetime(2024, 1, 2))], SCHEMA)
    assert I.high_water_mark(t) == dt.datetime(2024, 1, 2)
    assert I.high_water_mark(None) is None
    assert I.high_water_mark(spark.createDataFrame([], SCHEMA)) is None
    assert I.high_water_mark(t.drop("ingested_at")) is None
    src = t.union(spark.createDataFrame([("c", "1", dt.datetime(2024, 1, 2)), ("a", "2", dt.datetime(2024, 1, 3))], SCHEMA))
    assert sorted(r.id for r in I.delta_rows(src, I.high_water_mark(t)).collect()) == ["a"]   # strict >


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([("a", "1", dt.datetime(2024, 1, 1)), ("b", "1", dt.datetime(2024, 1, 1))], SCHEMA)
    delta = spark.createDataFrame([("a", "2", dt.datetime(2024, 1, 5)), ("a", "3", dt.datetime(2024, 1, 6)),
                                   ("c", "1", dt.datetime(2024, 1, 5))], SCHEMA)
    once = I.upsert(target, delta, "id")
    twice = I.upsert(once, delta, "id")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.id: r.v for r in once.collect()} == {"a": "3", "b": "1", "c": "1"}


def _dim(spark, rows):
    return spark.createDataFrame(rows, "patient_id string, region string, effective_from date, effective_to date, "
                                       "is_current smallint")


def test_scd2(spark):
    hi = dt.date(9999, 12, 31)
    cur = _dim(spark, [("p1", "North", dt.date(2024, 1, 1), hi, 1), ("p2", "East", dt.date(2024, 1, 1), hi, 1),
                       ("p0", "West", dt.date(2023, 1, 1), dt.date(2023, 12, 31), 0)])
    inc = spark.createDataFrame([("p1", "South"), ("p2", "East"), ("p3", "West")], "patient_id string, region string")
    once = I.scd2_merge(cur, inc, "patient_id", ["region"], "2025-01-01")
    rows = sorted((r.patient_id, r.region, r.effective_from, r.effective_to, r.is_current) for r in once.collect())
    assert rows == [("p0", "West", dt.date(2023, 1, 1), dt.date(2023, 12, 31), 0),
                    ("p1", "North", dt.date(2024, 1, 1), dt.date(2024, 12, 31), 0),
                    ("p1", "South", dt.date(2025, 1, 1), hi, 1),
                    ("p2", "East", dt.date(2024, 1, 1), hi, 1),
                    ("p3", "West", dt.date(2025, 1, 1), hi, 1)]
    twice = I.scd2_merge(once, inc, "patient_id", ["region"], "2025-01-01")
    assert sorted(once.collect()) == sorted(twice.collect())
    # a same-day correction replaces the version it created
    fix = spark.createDataFrame([("p1", "Central")], "patient_id string, region string")
    again = I.scd2_merge(once, fix, "patient_id", ["region"], "2025-01-01").filter("patient_id = 'p1'").collect()
    assert sorted((r.region, r.is_current) for r in again) == [("Central", 1), ("North", 0)]


def test_stream_twice_is_once(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write("physician_id,specialty,region,years_experience\nPHY-1,Onc,North,5\nPHY-2,Onc,North,x\n"
                "PHY-1,Card,South,7\n")
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    ck = os.path.join(tmpdir_path, "ckpt")
    out = run_available(spark, land, "physicians", store, os.path.join(tmpdir_path, "q"), ck).collect()
    assert [(r.physician_id, r.specialty) for r in out] == [("PHY-1", "Card")]
    out2 = run_available(spark, land, "physicians", store, os.path.join(tmpdir_path, "q"), ck).collect()
    assert sorted(out) == sorted(out2)
    with open(os.path.join(land, "b.csv"), "w") as f:
        f.write("physician_id,specialty,region,years_experience\nPHY-3,Neuro,East,1\nPHY-1,Onc,West,9\n")
    out3 = {r.physician_id: r.region for r in
            run_available(spark, land, "physicians", store, os.path.join(tmpdir_path, "q"), ck).collect()}
    assert out3 == {"PHY-1": "West", "PHY-3": "East"}


def test_replace_reading_itself(spark, tmpdir_path):
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    store.write(spark.createDataFrame([("a", "1")], "id string, v string"), "t")
    for i in range(3):
        cur = store.read("t")
        store.replace(cur.unionByName(spark.createDataFrame([(f"n{i}", "1")], "id string, v string")), "t")
    assert sorted(r.id for r in store.read("t").collect()) == ["a", "n0", "n1", "n2"]
    assert sorted(os.listdir(os.path.join(tmpdir_path, "tables"))) == ["t"]


def test_stream_in_small_batches(spark, tmpdir_path):
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    for i in range(3):
        with open(os.path.join(land, f"f{i}.csv"), "w") as f:
            f.write(f"physician_id,specialty,region,years_experience\nPHY-{i},Onc,North,{i}\nPHY-9,S{i},East,1\n")
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    out = run_available(spark, land, "physicians", store, os.path.join(tmpdir_path, "q"),
                        os.path.join(tmpdir_path, "ckpt"), max_files_per_trigger=1)
    rows = {r.physician_id: r.specialty for r in out.collect()}
    assert set(rows) == {"PHY-0", "PHY-1", "PHY-2", "PHY-9"}
    assert rows["PHY-9"] == "S2"  # the newest file wins


def _physicians(path, *rows, header="physician_id,specialty,region,years_experience"):
    with open(path, "w") as f:
        f.write("\n".join([header, *rows]) + "\n")


def test_keep_last_across_files_and_in_one_batch(spark, tmpdir_path):
    """The key's last row stands at the first line of the later file."""
    import datetime as dt

    from careflow.plans.ingest import ingest_file
    land = os.path.join(tmpdir_path, "physicians.csv")
    os.makedirs(land)
    _physicians(os.path.join(land, "a.csv"), "PHY-00007,Onc,North,1", "PHY-00008,Onc,North,2", "PHY-00009,old,North,3")
    _physicians(os.path.join(land, "b.csv"), "PHY-00009,new,South,4")
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    ingest_file(spark, land, "physicians", store, os.path.join(tmpdir_path, "q"), dt.datetime(2025, 1, 1))
    assert {r.physician_id: r.specialty for r in store.read("stg_physicians").collect()}["PHY-00009"] == "new"
    other = TableStore(spark, os.path.join(tmpdir_path, "stream-tables"))
    out = run_available(spark, land, "physicians", other, os.path.join(tmpdir_path, "q2"), os.path.join(tmpdir_path, "ck"))
    assert {r.physician_id: r.specialty for r in out.collect()}["PHY-00009"] == "new"


def test_quoted_newlines_and_wrong_headers(spark, tmpdir_path):
    import datetime as dt

    from careflow.plans.ingest import ingest_file
    path = os.path.join(tmpdir_path, "physicians.csv")
    _physicians(path, 'PHY-00001,"two\nlines",North,5', "PHY-00002,Onc,South,6")
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    got = ingest_file(spark, path, "physicians", store, os.path.join(tmpdir_path, "q"), dt.datetime(2025, 1, 1), multiline=True)
    assert (got["records_valid"], got["records_invalid"]) == (2, 0)
    assert {r.specialty for r in store.read("stg_physicians").collect()} == {"two\nlines", "Onc"}
    land = os.path.join(tmpdir_path, "landing")
    os.makedirs(land)
    _physicians(os.path.join(land, "a.csv"), "PHY-00001,North,Onc,5", header="physician_id,region,specialty,years_experience")
    with pytest.raises(Exception, match="(?i)header"):
        run_available(spark, land, "physicians", store, os.path.join(tmpdir_path, "q"), os.path.join(tmpdir_path, "ck"))
    _physicians(os.path.join(land, "b.csv"), "PHY-00002,Onc,North,5")
    with pytest.raises(Exception, match="(?i)header"):
        ingest_file(spark, land, "physicians", store, os.path.join(tmpdir_path, "q"), dt.datetime(2025, 1, 1))


def test_failed_publish_leaves_the_old_table(spark, tmpdir_path, monkeypatch):
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    store.write(spark.createDataFrame([("a",)], "id string"), "t")
    publish = store._publish

    def broken(name, tag):
        raise OSError("lost")

    monkeypatch.setattr(store, "_publish", broken)
    with pytest.raises(OSError):
        store.replace(spark.createDataFrame([("b",)], "id string"), "t")
    assert [r.id for r in store.read("t").collect()] == ["a"]
    monkeypatch.setattr(store, "_publish", publish)
    store.replace(spark.createDataFrame([("c",)], "id string"), "t")
    store.write(spark.createDataFrame([("d",)], "id string"), "t", mode="append")
    assert sorted(r.id for r in store.read("t").collect()) == ["c", "d"]


def test_quarantine_of_a_repeated_batch_is_stored_once(spark, tmpdir_path):
    from careflow.sources.tables import quarantine
    rows = spark.createDataFrame([("x", "bad")], "raw string, _validation_error string")
    for _ in range(2):
        assert quarantine(rows, tmpdir_path, "physicians", "epoch_3") == 1
    assert spark.read.parquet(tmpdir_path).count() == 1
    assert quarantine(rows.limit(0), tmpdir_path, "physicians", "epoch_4") == 0


def test_scd2_with_null_keys(spark):
    schema = "k string, v string"
    current = spark.createDataFrame([("a", "1"), (None, "n")], schema).selectExpr(
        "k", "v", "date'2024-01-01' AS effective_from", "date'9999-12-31' AS effective_to", "cast(1 AS smallint) AS is_current")
    same = I.scd2_merge(current, spark.createDataFrame([(None, "n")], schema), "k", ["v"], "2025-01-01")
    assert sorted(map(str, same.collect())) == sorted(map(str, current.collect()))
    new = I.scd2_merge(current, spark.createDataFrame([(None, "m"), ("b", "2")], schema), "k", ["v"], "2025-01-01")
    assert sorted((r.k or "", r.v, r.is_current) for r in new.collect()) == [
        ("", "m", 1), ("", "n", 0), ("a", "1", 1), ("b", "2", 1)]
    fresh = I.scd2_merge(current.filter("k = 'a'"), spark.createDataFrame([(None, "m")], schema), "k", ["v"], "2025-01-01")
    assert sorted((r.k or "", r.v, r.is_current) for r in fresh.collect()) == [("", "m", 1), ("a", "1", 1)]
