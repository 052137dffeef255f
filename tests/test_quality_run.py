"""Checks from profiles of loads against checks over the whole tables."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from careflow.operators import quality as Q
from careflow.operators import quality_profile
from careflow.plans import quality_run
from careflow.sources.buckets import BucketStore, Commit

CHECKS = [Q.completeness("c", "p"), Q.completeness("c", "x"), Q.completeness("c", "absent"), Q.uniqueness("c", "id"),
          Q.uniqueness("p", "p"), Q.row_count("c", 90), Q.distribution("c", "x", -5, 50), Q.distribution("c", "words", 1, 2),
          Q.distribution("c", "x", None, 3.5), Q.referential_integrity("c", "p", "p", "p"),
          Q.referential_integrity("p", "p", "c", "p"), Q.referential_integrity("c", "p", "nowhere", "p"),
          Q.completeness("nowhere", "p")]
DAYS = ["2024-01-03", "2024-01-06", "2024-01-06", "2025-01-01"]


@pytest.fixture(scope="module")
def tables(spark):
    """Keys repeat within and across loads, parents come after and before their children, some never."""
    draw = random.Random(3)
    stamp = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=draw.randrange(240))
    child = [(draw.randrange(90), draw.choice([None, *range(40)]), draw.choice([None, float("nan"), 1e6, *map(float, range(-9, 60))]),
              draw.choice(["w", "1.5", None]), stamp()) for _ in range(150)]
    parent = [(draw.choice([None, *range(15, 60)]), stamp()) for _ in range(60)]
    return {"c": spark.createDataFrame(child, "id long, p long, x double, words string, ingested_at timestamp_ntz"),
            "p": spark.createDataFrame(parent, "p long, ingested_at timestamp_ntz")}


def until(tables, day):
    return {n: d.filter(F.col("ingested_at") < F.lit(day).cast("timestamp_ntz")) for n, d in tables.items()}


def rows(df):
    return sorted((r.name, r.check_type, r.passed, round(r.score, 9), r.details) for r in df.collect())


def expected(tables):
    return rows(Q.run_checks(tables, CHECKS))


@pytest.fixture(scope="module")
def loaded(spark, tables, tmp_path_factory):
    store = BucketStore(spark, str(tmp_path_factory.mktemp("dq")), buckets=4)
    states = []
    for day in DAYS:
        quality_run.run(store, until(tables, day), CHECKS)
        states.append(rows(quality_run.suite(store, CHECKS)))
    return store, states


def test_every_state_equals_the_suite_over_the_tables(tables, loaded):
    for day, state in zip(DAYS, loaded[1], strict=True):
        assert state == expected(until(tables, day))


def test_a_load_without_new_rows_changes_nothing(loaded):
    assert loaded[1][1] == loaded[1][2]


def test_profiles_merge_to_the_same_checks(spark, loaded):
    profiles = loaded[0].read(quality_run.PROFILES)
    assert rows(quality_profile.run_checks(quality_profile.merge(profiles), CHECKS)) == loaded[1][-1]


def test_a_load_that_dies_counts_once(spark, tables, loaded, tmpdir_path, monkeypatch):
    store = BucketStore(spark, tmpdir_path, buckets=4)
    quality_run.run(store, until(tables, DAYS[0]), CHECKS)
    head = store.head()
    monkeypatch.setattr(Commit, "publish", lambda self: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        quality_run.run(store, tables, CHECKS)
    monkeypatch.undo()
    assert store.head() == head
    quality_run.run(store, tables, CHECKS)
    assert rows(quality_run.suite(store, CHECKS)) == expected(tables)


def test_keys_of_two_types_are_refused(spark, tmpdir_path):
    store = BucketStore(spark, tmpdir_path, buckets=2)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz").alias("ingested_at")
    quality_run.run(store, {"p": spark.range(3).select(F.col("id").cast("string").alias("p"), stamp)}, CHECKS)
    with pytest.raises(ValueError, match="holds string"):
        quality_run.run(store, {"c": spark.range(3).select("id", F.col("id").alias("p"), stamp)}, CHECKS)
    with pytest.raises(ValueError, match="holds string"):
        quality_run.run(store, {"p": spark.range(3).select(F.col("id").alias("p"), F.lit("2025-01-01").cast("timestamp_ntz").alias("ingested_at"))}, CHECKS)


def test_a_saved_report_runs_its_checks_once(spark, tmpdir_path):
    """The JSON report and the score row come from one run of the checks."""
    from careflow.operators import quality
    from careflow.sources import tables
    seen = spark.sparkContext.accumulator(0)

    def mark(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.createDataFrame([(1,), (2,)], "claim_id long").mapInPandas(mark, "claim_id long")
    report = quality.dq_report(quality.run_checks({"stg_claims": rows}, [quality.row_count("stg_claims")]))
    tables.save_dq_report(tables.TableStore(spark, f"{tmpdir_path}/t"), report, f"{tmpdir_path}/r", dt.datetime(2025, 1, 1))
    assert seen.value == 2
