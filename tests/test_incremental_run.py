"""Bucketed tables, the incremental job and late dimension changes."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from careflow.operators import incremental, warehouse
from careflow.plans import incremental_run
from careflow.sources.buckets import BucketStore, Commit

RX = ("prescription_id string, patient_id long, physician_id long, drug_name string, prescription_date string, "
      "quantity string, refills string, therapy_area string, ingested_at timestamp_ntz")
DX = "diagnosis_id long, patient_id long, icd_code string, diagnosis_date date, severity string, ingested_at timestamp_ntz"
PAT = "patient_id long, gender string, date_of_birth string, region string, enrollment_date string, ingested_at timestamp_ntz"


def arrivals(spark, seed=1, n=400):
    draw = random.Random(seed)
    stamp = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=draw.randrange(2400))
    rx = [(f"rx{draw.randrange(150)}", draw.choice([None, *range(20)]), draw.randrange(5), draw.choice("abc"),
           draw.choice(["2024-01-01", "2024-02-03", "2024-05-06", "bad"]), str(draw.randrange(9)), "x", "area", stamp()) for _ in range(n)]
    dx = [(draw.randrange(80), draw.choice([None, *range(25)]), draw.choice(["I1", "I2"]),
           draw.choice([None, dt.date(2024, 2, 3), dt.date(2023, 1, 1)]), "mild", stamp()) for _ in range(n // 2)]
    pat = [(draw.choice([None, *range(25)]), draw.choice("MF"), draw.choice(["1980-01-01", "1990-01-01", "bad"]), draw.choice("NS"),
            "2020-01-01", stamp()) for _ in range(n // 2)]
    return {"prescriptions": spark.createDataFrame(rx, RX), "diagnoses": spark.createDataFrame(dx, DX),
            "patients": spark.createDataFrame(pat, PAT)}


TABLES = ["fact_prescription", "prescription_patient", "diagnosis", "fact_patient_journey", "therapy_switches", "dim_patient"]


def contents(store):
    return {name: sorted(map(str, store.read(name).collect())) for name in TABLES}


def until(sources, day):
    limit = F.lit(str(day)).cast("timestamp_ntz")
    return {n: d.filter(F.col("ingested_at") < limit) for n, d in sources.items()}


@pytest.fixture(scope="module")
def sources(spark):
    return arrivals(spark)


@pytest.fixture(scope="module")
def whole(spark, sources, tmp_path_factory):
    store = BucketStore(spark, str(tmp_path_factory.mktemp("whole")), buckets=4)
    incremental_run.run(store, sources)
    return contents(store)


def test_one_run_equals_a_rebuild(spark, sources, whole):
    fact = warehouse.transform_prescriptions(sources["prescriptions"])
    dx = warehouse.dedup_keep_last(sources["diagnoses"], "diagnosis_id")
    assert whole["fact_prescription"] == sorted(map(str, fact.collect()))
    assert whole["fact_patient_journey"] == sorted(map(str, warehouse.build_patient_journey(fact, dx).collect()))
    assert whole["therapy_switches"] == sorted(map(str, warehouse.detect_therapy_switches(fact).collect()))


def test_runs_over_parts_equal_one_run(spark, sources, whole, tmpdir_path):
    store = BucketStore(spark, tmpdir_path, buckets=4)
    first = incremental_run.run(store, {"diagnoses": until(sources, dt.date(2024, 1, 20))["diagnoses"]})
    assert first["rows"]["diagnoses"] > 0 and store.head()["marks"].keys() == {"diagnoses"}
    for day in (dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2025, 1, 1), dt.date(2025, 1, 1)):
        out = incremental_run.run(store, until(sources, day))
    assert set(out["rows"].values()) == {0} and set(out["touched"].values()) == {0}
    assert contents(store) == whole
    assert len(store.commits()) == 2 and store.head()["number"] == 5


def test_a_run_that_dies_between_two_writes(spark, sources, whole, tmpdir_path, monkeypatch):
    """Kill the job at every write and at the commit: the state is that of the commit before, and the next run ends right."""
    store = BucketStore(spark, tmpdir_path, buckets=4)
    incremental_run.run(store, until(sources, dt.date(2024, 2, 1)))
    before, record = contents(store), store.head()
    write, publish, at = Commit.write, Commit.publish, 0
    while True:
        calls = iter(range(100))

        def dying(self, *args, calls=calls, at=at, **named):
            write(self, *args, **named)
            if next(calls) == at:
                raise RuntimeError("killed")

        monkeypatch.setattr(Commit, "write", dying)
        try:
            incremental_run.run(store, sources)
            break
        except RuntimeError:
            assert store.head() == record and (at % 3 or contents(store) == before)
            at += 1
    assert at == 7 and contents(store) == whole
    monkeypatch.setattr(Commit, "write", write)
    monkeypatch.setattr(Commit, "publish", lambda self: publish(self) and 1 / 0)     # dies after the commit
    more = {n: d.withColumn("ingested_at", F.lit("2026-01-01").cast("timestamp_ntz")).limit(3) for n, d in sources.items()}
    with pytest.raises(ZeroDivisionError):
        incremental_run.run(store, more)
    monkeypatch.setattr(Commit, "publish", publish)
    assert incremental_run.run(store, more)["rows"] == {"prescriptions": 0, "diagnoses": 0, "patients": 0}


def test_an_upsert_writes_touched_buckets_only(spark, tmpdir_path):
    store = BucketStore(spark, tmpdir_path, buckets=32)
    first = store.begin()
    first.write("t", spark.range(1000).selectExpr("id as k", "'old' as v"), "k")
    first.publish()
    before = store.head()["tables"]["t"]["parts"]
    second = store.begin()
    delta = spark.createDataFrame([(5, "new"), (2000, "new"), (None, "new")], "k long, v string")
    touched = second.upsert("t", delta, "k")
    second.publish()
    after = store.head()["tables"]["t"]["parts"]
    assert 1 <= len(touched) <= 3 and len(before) == 32
    assert {b for b in after if before.get(b) != after[b]} == set(map(str, touched))
    got = {r["k"]: r["v"] for r in store.read("t").collect()}
    assert len(got) == 1002 and got[5] == got[2000] == got[None] == "new" and got[6] == "old"
    plan = second.read("t", touched)
    assert len({f.split("_bucket=")[1].split("/")[0] for f in plan.inputFiles()}) == len(touched)
    third = store.begin()
    third.upsert("t", delta.limit(0), "k", keys=spark.createDataFrame([(5,), (None,)], "k long"))
    third.publish()
    assert store.read("t").count() == 1000 and store.rows_of("t", 5).count() == 0
    assert store.rows_of("t", 2000).collect()[0]["v"] == "new"
    explained = store.rows_of("t", 6)._jdf.queryExecution().toString()
    assert "PushedFilters" in explained and len(store.rows_of("t", 6).inputFiles()) == 1


def test_the_second_of_two_writers_fails(spark, tmpdir_path):
    store = BucketStore(spark, tmpdir_path, buckets=2)
    one, two = store.begin(), store.begin()
    one.write("t", spark.range(3), "id")
    two.write("t", spark.range(9), "id")
    assert one.publish() == 1
    with pytest.raises(Exception):  # noqa: B017 - the file system's own error
        two.publish()
    assert store.read("t").count() == 3
    assert len(store.vacuum()) >= 1 and store.read("t").count() == 3


def test_empty_and_unknown_sources(spark, sources, tmpdir_path):
    store = BucketStore(spark, tmpdir_path)
    none = {n: d.limit(0) for n, d in sources.items()}
    assert incremental_run.run(store, none)["rows"] == {"prescriptions": 0, "diagnoses": 0, "patients": 0}
    with pytest.raises(ValueError):
        incremental_run.run(store, {"claims": none["patients"]})


# --- late changes ---
HIGH = dt.date(9999, 12, 31)


def day_by_day(history, changes):
    """Versions of one key by looking at every day on its own."""
    days = sorted({d for _, a, b in history for d in (a, *([b + dt.timedelta(1)] if b < HIGH else []))} | {d for _, d in changes})
    on = []
    for d in days:
        past = [(c, 2, v) for v, c in changes if c <= d] + [(a, 1, v) for v, a, _ in history if a <= d] \
            + [(b + dt.timedelta(1), 0, v) for v, _, b in history if b < HIGH and b + dt.timedelta(1) <= d]
        _, kind, v = max(past, key=lambda x: (x[0], x[1], x[2]))
        on.append((d, v if kind else None))
    out = []
    for i, (d, v) in enumerate(on):
        end = on[i + 1][0] - dt.timedelta(1) if i + 1 < len(on) else HIGH
        if v is not None:
            if out and out[-1][0] == v and out[-1][2] + dt.timedelta(1) == d:
                out[-1] = (v, out[-1][1], end)
            else:
                out.append((v, d, end))
    return out


def test_late_changes_against_every_day(spark):
    draw = random.Random(8)
    history, changes, want = [], [], []
    base = dt.date(2024, 1, 1)
    for key in [None, *range(60)]:
        h, at = [], 0
        for _ in range(draw.randrange(4)):
            at += draw.randrange(3)             # a gap now and then
            long = draw.randrange(1, 6)
            h.append((draw.choice("ABC"), base + dt.timedelta(at), base + dt.timedelta(at + long - 1)))
            at += long
        if h and draw.random() < 0.7:
            h[-1] = (*h[-1][:2], HIGH)
        c = {base + dt.timedelta(draw.randrange(-3, 20)): draw.choice("ABC") for _ in range(draw.randrange(4))}
        history += [(key, v, a, b, int(b == HIGH)) for v, a, b in h]
        changes += [(key, v, d) for d, v in c.items()]
        want += [(key, v, a, b, int(b == HIGH)) for v, a, b in day_by_day(h, [(v, d) for d, v in c.items()])]
    old = spark.createDataFrame(history, "k long, a string, effective_from date, effective_to date, is_current smallint")
    new = spark.createDataFrame([*changes, (1, "Z", None)], "k long, a string, changed_on date")
    got = [tuple(r) for r in incremental.scd2_splice(old, new, "k", ["a"]).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    for k in {g[0] for g in got}:
        spans = sorted(g[2:4] for g in got if g[0] == k)
        assert all(a <= b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_a_merge_dated_before_the_current_version(spark):
    old = spark.createDataFrame([(1, "x", dt.date(2025, 2, 1), HIGH, 1), (2, "x", dt.date(2024, 1, 1), HIGH, 1)],
                                "k long, a string, effective_from date, effective_to date, is_current smallint")
    new = spark.createDataFrame([(1, "y"), (2, "y")], "k long, a string")
    got = sorted(tuple(r) for r in incremental.scd2_merge(old, new, "k", ["a"], "2025-01-10").collect())
    assert got == [(1, "x", dt.date(2025, 2, 1), HIGH, 1), (1, "y", dt.date(2025, 1, 10), dt.date(2025, 1, 31), 0),
                   (2, "x", dt.date(2024, 1, 1), dt.date(2025, 1, 9), 0), (2, "y", dt.date(2025, 1, 10), HIGH, 1)]


def test_rows_placed_by_their_key_lie_in_few_files(spark, tmpdir_path):
    """Rows behind a shuffle by the key are written without another one: a task has few buckets."""
    store = BucketStore(spark, f"{tmpdir_path}/tables", buckets=8)
    commit = store.begin()
    rows = spark.range(2000).selectExpr("id as k", "id * 2 as v").repartition(16, "k")
    commit.upsert("t", rows, "k", placed=True)
    commit.publish()
    assert len(store.read("t").inputFiles()) == 16
    second = store.begin()
    gone = spark.createDataFrame([(5,), (6,)], "k long")
    second.upsert("t", spark.createDataFrame([(5, 1), (5, 2)], "k long, v long"), "k", keys=gone, placed=True)
    second.publish()
    got = sorted(tuple(r) for r in store.read("t").collect())
    assert got == sorted([(i, 2 * i) for i in range(2000) if i not in (5, 6)] + [(5, 1), (5, 2)])
    assert store.rows_of("t", 5).count() == 2


def test_rows_that_stay_are_not_shuffled_for_the_write(spark, tmpdir_path, monkeypatch):
    """Rows that stay keep their place, and so do rows that lie in a table; null keys too."""
    store = BucketStore(spark, f"{tmpdir_path}/tables", buckets=4)
    first = store.begin()
    old = spark.range(100).selectExpr("id as k", "0 as v").union(spark.sql("select cast(null as bigint), 0"))
    first.upsert("t", old, "k")
    first.publish()
    shuffled, write = [], Commit.write

    def noted(self, name, rows, key, touched=None, placed=None):
        shuffled.append(rows.count())
        write(self, name, rows, key, touched, placed)

    monkeypatch.setattr(Commit, "write", noted)
    second = store.begin()
    second.upsert("t", spark.createDataFrame([(None, 1), (7, 1)], "k long, v int"), "k")
    second.upsert("t", spark.createDataFrame([(8, 1)], "k long, v int"), "k", placed=True)
    second.publish()
    assert shuffled == [2, 0]
    rows = sorted((-1 if r.k is None else r.k, r.v) for r in store.read("t").collect())
    assert rows == sorted([(k, 0) for k in range(100) if k not in (7, 8)] + [(7, 1), (8, 1), (-1, 1)])


def test_many_files_of_a_bucket_are_joined(spark, tmpdir_path, monkeypatch):
    from careflow.sources import buckets
    store = BucketStore(spark, f"{tmpdir_path}/tables", buckets=1)
    commit = store.begin()
    commit.upsert("t", spark.range(0, 400, 1, 20).withColumnRenamed("id", "k"), "k", placed=True)
    commit.publish()
    assert len(store.read("t").inputFiles()) == 20
    monkeypatch.setattr(buckets, "MOST_FILES", 4)
    second = store.begin()
    second.upsert("t", spark.createDataFrame([(5,)], "k long"), "k", placed=True)
    second.publish()
    assert len(store.read("t").inputFiles()) <= 8 and store.read("t").count() == 400


def test_rows_of_keys_hold_null_keys_and_keep_their_shuffle(spark, tmpdir_path):
    """A semi join by plain equality: a window by the key needs no second shuffle."""
    from pyspark.sql import Window, functions as F
    store = BucketStore(spark, f"{tmpdir_path}/tables", buckets=4)
    commit = store.begin()
    commit.upsert("t", spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string"), "k")
    keys = spark.createDataFrame([(None,), (2,)], "k long")
    assert sorted(r.v for r in commit.rows_of_keys("t", keys, "k").collect()) == ["b", "c"]
    assert [r.v for r in commit.rows_of_keys("t", keys.filter("k = 2"), "k").collect()] == ["b"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = commit.rows_of_keys("t", keys.filter("k = 2"), "k").withColumn(
            "n", F.row_number().over(Window.partitionBy("k").orderBy("v")))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2


def test_journeys_and_switches_from_one_pass(spark):
    """The rows of both functions, also where patients are cut into slices or unknown."""
    from careflow.operators import warehouse as W
    rx = [(f"p{i}", None if i % 11 == 0 else i % 5, f"d{i % 3}" if i % 7 else None,
           dt.date(2024, 1, 1 + i % 4) if i % 6 else None, "area") for i in range(80)]
    facts = spark.createDataFrame(rx, "prescription_id string, patient_id long, drug_name string, prescription_date date, therapy_area string")
    dx = spark.createDataFrame([(i, i % 6, f"c{i}", dt.date(2024, 1, 1 + i % 5), "x") for i in range(30)],
                               "diagnosis_id long, patient_id long, icd_code string, diagnosis_date date, severity string")
    def rows(df):
        return sorted(map(repr, df.collect()))

    for diagnoses in (dx, None):
        for hot in (1000, 15):
            journeys, switches = W.journeys_and_switches(facts, diagnoses, hot_rows=hot)
            assert rows(journeys) == rows(W.build_patient_journey(facts, diagnoses))
            assert rows(switches) == rows(W.detect_therapy_switches(facts))


def test_tables_of_older_records_keep_their_buckets(spark, tmpdir_path):
    store = BucketStore(spark, f"{tmpdir_path}/tables", buckets=4)
    commit = store.begin()
    commit.tables["t"] = {"key": "k", "buckets": 4, "parts": {}}
    commit.write("t", spark.range(50).withColumnRenamed("id", "k"), "k")
    commit.publish()
    assert all(store.rows_of("t", k).count() == 1 for k in (0, 7, 49))


# --- the stream into a bucketed table ---
def _file(folder, name, *rows):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(["physician_id,specialty,region,years_experience", *rows]) + "\n")


def _stream(spark, land, store, base, checkpoint, **named):
    from careflow.streaming.incremental_stream import run_available
    out = run_available(spark, land, "physicians", store, f"{base}/quarantine", f"{base}/{checkpoint}", **named)
    return {r["physician_id"]: r["specialty"] for r in out.collect()}


def test_stream_order_of_files_and_replays(spark, tmpdir_path):
    """A late earlier file, and all files again under a new checkpoint, change nothing; only touched buckets are written."""
    land = f"{tmpdir_path}/landing"
    store = BucketStore(spark, f"{tmpdir_path}/tables", buckets=8)
    _file(land, "b.csv", "PHY-1,second,N,1", "PHY-1,third,N,1", "PHY-2,second,N,1")
    assert _stream(spark, land, store, tmpdir_path, "one") == {"PHY-1": "third", "PHY-2": "second"}
    before = store.head()["tables"]["stg_physicians"]["parts"]
    _file(land, "a.csv", "PHY-1,first,N,1", "PHY-3,first,N,1")
    want = {"PHY-1": "third", "PHY-2": "second", "PHY-3": "first"}
    assert _stream(spark, land, store, tmpdir_path, "one") == want
    after = store.head()["tables"]["stg_physicians"]["parts"]
    assert sum(before.get(b) != t for b, t in after.items()) == 1
    assert _stream(spark, land, store, tmpdir_path, "two", max_files_per_trigger=1) == want
    assert store.head()["tables"]["stg_physicians"]["parts"] == after


def test_a_large_backlog_takes_few_batches(spark, tmpdir_path):
    land = f"{tmpdir_path}/landing"
    store = BucketStore(spark, f"{tmpdir_path}/tables", buckets=2)
    for i in range(7):
        _file(land, f"{i}.csv", f"PHY-{i},x{i},N,1", f"PHY-0,x{i},N,1")
    out = _stream(spark, land, store, tmpdir_path, "few", max_files_per_trigger=1, most_batches=2)
    assert out == {"PHY-0": "x6"} | {f"PHY-{i}": f"x{i}" for i in range(1, 7)}
    assert store.head()["number"] == 2


def test_an_epoch_that_was_committed_is_not_run_again(spark, tmpdir_path):
    from careflow.streaming import incremental_stream as S
    land = f"{tmpdir_path}/landing"
    store = BucketStore(spark, f"{tmpdir_path}/tables", buckets=4)
    _file(land, "a.csv", "PHY-1,x,N,1")
    _stream(spark, land, store, tmpdir_path, "ck")
    number = store.head()["number"]
    batch = spark.createDataFrame([("PHY-9", "y", "N", "1", None, "a.csv", 0)],
                                  "physician_id string, specialty string, region string, years_experience string, "
                                  "_corrupt string, _mpath string, _mblk long")
    handler = S._bucket_handler(store, "physicians", f"{tmpdir_path}/quarantine", f"{tmpdir_path}/ck")
    handler(batch, 0)
    assert store.head()["number"] == number
    handler(batch, 1)
    assert store.head()["number"] == number + 1 and store.read("stg_physicians").count() == 2


@pytest.mark.parametrize("bucketed", [True, False])
def test_two_streams_on_one_quarantine_folder(spark, tmpdir_path, bucketed):
    from careflow.sources.tables import TableStore
    for name in ("one", "two"):
        store = (BucketStore if bucketed else TableStore)(spark, f"{tmpdir_path}/{name}")
        _file(f"{tmpdir_path}/landing-{name}", "a.csv", "PHY-1,x,N,1", f"{name},x,N", "PHY-3,None,N,2")
        _stream(spark, f"{tmpdir_path}/landing-{name}", store, tmpdir_path, f"ck-{name}")
    bad = spark.read.parquet(f"{tmpdir_path}/quarantine")
    assert {r["physician_id"] for r in bad.collect()} >= {"one", "two"}


# ----------------------------------------------------------------- tables dealt out by a key
def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_dealt_rows_are_not_shuffled_again(spark, sources, monkeypatch):
    from careflow import session
    monkeypatch.setattr(session, "DEALT_ROWS", 40)
    rx = sources["prescriptions"]
    dealt = session.dealt_checkpoint(rx, "prescription_id", session.dealt_buckets(spark, rx.count()))
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rx.collect()))
    last = warehouse.dedup_keep_last(dealt, "prescription_id")
    assert exchanges(last) == 0
    assert sorted(map(str, last.collect())) == sorted(map(str, warehouse.dedup_keep_last(rx, "prescription_id").collect()))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("careflow_dealt")]
    assert session.dealt_buckets(spark, 40) == 1


@pytest.mark.parametrize("most", [True, False])
def test_loads_of_many_keys_equal_one_run(spark, sources, whole, tmp_path, monkeypatch, most):
    """Large loads deal tables out by key, and write journeys of whole buckets where most patients are touched."""
    from careflow import session
    from careflow.operators import warehouse as W
    monkeypatch.setattr(session, "DEALT_ROWS", 20)
    monkeypatch.setattr(incremental_run, "MANY_KEYS", 3 if most else 10**6)
    made, steps = [], W.journeys_and_switches
    monkeypatch.setattr(W, "journeys_and_switches", lambda *a, **k: made.append(k.get("buckets", 0)) or steps(*a, **k))
    store = BucketStore(spark, str(tmp_path), buckets=4)
    for day in [dt.date(2024, 1, 20), dt.date(2024, 2, 20), dt.date(2024, 5, 1)]:
        incremental_run.run(store, until(sources, day))
    assert contents(store) == whole
    assert len(made) == 3 and all(b > 1 for b in made) == most


def test_dealt_prescriptions_are_the_staged_ones(spark, monkeypatch):
    from careflow import session
    from careflow.sources import fixtures
    sf = "/root/testdata/sf0.001"
    plain = fixtures.rx_stage(spark, sf).drop("source_part", "source_price")
    monkeypatch.setattr(session, "DEALT_ROWS", 1000)
    dealt = fixtures.rx_dealt(spark, sf)
    assert dealt.columns == plain.columns and dealt.dtypes == plain.dtypes
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))


def test_steps_on_dealt_rows_sort_once(spark, sources, monkeypatch):
    """Keep-last, the anti join and the windows of a large load: one sort of its rows or none."""
    from careflow import session
    from careflow.operators import warehouse as W
    from careflow.sources.buckets import matching
    rx = sources["prescriptions"]
    dealt = session.dealt_checkpoint(rx, "prescription_id", 4)

    def sorts(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Sort [")

    last = warehouse.dedup_keep_last(dealt, "prescription_id", placed=True)
    assert (sorts(last), exchanges(last)) == (1, 0) and "Aggregate" not in last._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, last.collect())) == sorted(map(str, warehouse.dedup_keep_last(rx, "prescription_id").collect()))
    keys = session.dealt_checkpoint(rx.filter("patient_id is not null").select("prescription_id"), "prescription_id", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left_semi", "left_anti"):
            met = matching(dealt, "prescription_id", keys, how, False, 4)
            assert (sorts(met), exchanges(met)) == (0, 0)
            assert sorted(map(str, met.collect())) == sorted(map(str, matching(rx, "prescription_id", keys, how, False).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    written = []
    monkeypatch.setattr(W, "reliable_checkpoint", lambda df: written.append(sorts(df)) or session.reliable_checkpoint(df))
    W.journeys_and_switches(warehouse.transform_prescriptions(rx), None, buckets=4)
    assert written == [1]


def test_arrivals_are_stamped_once(spark):
    """The stamps lie in the written table; no run of the job parses the dates again."""
    from careflow.plans import registry_incremental as R
    from careflow.plans.domain import DomainTables
    rows = R.rx_arrivals(DomainTables(spark, "/root/testdata/sf0.001"))
    assert all("ingested_at" in spark.read.parquet(path).columns for path in rows.inputFiles())
    assert "gettimestamp" not in rows._jdf.queryExecution().optimizedPlan().toString().lower()
