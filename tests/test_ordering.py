"""Skew-safe ordering helpers against a brute-force pandas reference."""
import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F

from careflow.functions.ordering import keep_last, previous_value, sequence_number


def _skewed_rows(n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # patient 1 holds about a third of all rows; a few null patients and null dates
        pid = 1 if rnd.random() < 0.34 else rnd.choice([2, 3, 4, 5, None])
        day = None if rnd.random() < 0.03 else dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 20))
        drug = rnd.choice(["A", "B", "C", None])
        rows.append((pid, day, f"id{i:04d}", drug))
    return rows


def _brute_prev(rows):
    df = pd.DataFrame(rows, columns=["patient_id", "d", "tie", "drug"])
    df = df[df["patient_id"].notna()].copy()
    df["dk"] = df["d"].fillna(dt.date(9999, 12, 31))
    df = df.sort_values(["patient_id", "dk", "tie"])
    df["prev"] = df.groupby("patient_id")["drug"].shift(1)
    df["has"] = df.groupby("patient_id").cumcount() > 0
    return {r.tie: (r.prev if r.has else "<none>") for r in df.itertuples()}


def test_previous_value_matches_window(spark):
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "patient_id int, d date, tie string, drug string")
    got = previous_value(df, "patient_id", "d", ["tie"], "drug", out="prev", has_out="has").collect()
    exp = _brute_prev(rows)
    assert len(got) == len(exp)
    for r in got:
        want = exp[r["tie"]]
        if want == "<none>":
            assert not r["has"]
        else:
            assert r["has"]
            assert (r["prev"] if r["prev"] is not None else None) == (None if pd.isna(want) else want)


def test_sequence_number_is_dense_per_group(spark):
    rows = _skewed_rows()
    df = spark.createDataFrame(rows, "patient_id int, d date, tie string, drug string")
    out = sequence_number(df, "patient_id", "d", ["tie"]).toPandas()
    assert len(out) == len(rows)
    assert out[out.patient_id.isna()].sequence_num.isna().all()
    for pid, g in out[out.patient_id.notna()].groupby("patient_id"):
        g = g.assign(dk=g.d.fillna(dt.date(9999, 12, 31))).sort_values(["dk", "tie"])
        assert list(g.sequence_num) == list(range(1, len(g) + 1))


def test_keep_last_picks_greatest_order_and_null_key_group(spark):
    df = spark.createDataFrame(
        [("A", 1, 1), ("B", 2, 2), ("A", 3, 3), ("C", 4, 4), (None, 5, 5), (None, 6, 6), ("A", None, 9)],
        "id string, seq int, value int")
    out = {r["id"]: r["value"] for r in keep_last(df, "id", ["seq"]).collect()}
    assert out == {"A": 3, "B": 2, "C": 4, None: 6}


def test_keep_last_of_placed_rows_is_the_same(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["A", "B", None]), rnd.choice([1, 2, None]), rnd.choice([1.0, float("nan"), None]), rnd.choice(["x", "", None]))
            for _ in range(60)] + [("one", None, None, None)]
    df = spark.createDataFrame(rows, "id string, seq int, value double, word string")
    for order in (["seq"], ["word", "seq"], []):
        assert sorted(map(repr, keep_last(df, "id", order, placed=True).collect())) == sorted(map(repr, keep_last(df, "id", order).collect()))
    assert keep_last(df.select("id"), "id", [], placed=True).count() == 4


def test_keep_last_hot_key_reduces_map_side(spark):
    df = spark.range(20000).select((F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))).alias("k"),
                                   F.col("id").alias("seq"))
    out = keep_last(df, "k", ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # partial aggregation before the shuffle
    assert out.filter("k = 0").first()["seq"] == 19998


def _hot_day_rows(n=900, seed=11):
    """One (patient, day) bucket holds over a third of all rows."""
    rnd = random.Random(seed)
    rows = _skewed_rows(n // 2, seed)
    for i in range(n // 2):
        rows.append((9, dt.date(2023, 1, 5), f"h{rnd.randint(0, 10**6):07d}-{i}", rnd.choice(["A", "B", None])))
    rnd.shuffle(rows)
    return rows


def test_hot_bucket_is_sliced_and_exact(spark):
    rows = _hot_day_rows()
    df = spark.createDataFrame(rows, "patient_id int, d date, tie string, drug string")
    got = previous_value(df, "patient_id", "d", ["tie"], "drug", out="prev", has_out="has",
                         hot_rows=40).collect()
    exp = _brute_prev(rows)
    assert len(got) == len(exp)
    for r in got:
        want = exp[r["tie"]]
        if want == "<none>":
            assert not r["has"]
        else:
            assert r["has"] and r["prev"] == (None if pd.isna(want) else want)
    seq = sequence_number(df, "patient_id", "d", ["tie"], hot_rows=40).toPandas()
    assert len(seq) == len(rows)
    for pid, g in seq[seq.patient_id.notna()].groupby("patient_id"):
        g = g.assign(dk=g.d.fillna(dt.date(9999, 12, 31))).sort_values(["dk", "tie"])
        assert list(g.sequence_num) == list(range(1, len(g) + 1))
    assert seq[seq.patient_id.isna()].sequence_num.isna().all()


def test_hot_group_gets_several_slices_and_others_one_shuffle(spark):
    from careflow.functions.ordering import _hot_groups, _sliced
    rows = _hot_day_rows()
    df = spark.createDataFrame(rows, "patient_id int, d date, tie string, drug string").filter("patient_id is not null")
    hot, n = _hot_groups(df, "patient_id", 300)
    assert {r["patient_id"] for r in hot.collect()} == {9} and n == 450
    sliced = _sliced(df.filter("patient_id = 9"), "patient_id", [F.col("d"), F.col("tie")], n, 100)
    sizes = [r["count"] for r in sliced.groupBy("_sl").count().collect()]
    assert len(sizes) > 5 and sum(sizes) == 450 and max(sizes) < 150
    plan = previous_value(df, "patient_id", "d", ["tie"], "drug")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(patient_id") == 1


def test_hot_patient_in_shuffled_input_is_exact(spark):
    """A third of all rows belong to one patient, over many days and partitions."""
    rnd = random.Random(5)
    rows = [(1 if i % 3 == 0 else rnd.randint(2, 60), dt.date(2023, 1, 1) + dt.timedelta(days=rnd.randint(0, 90)),
             f"id{i:05d}", rnd.choice(["A", "B", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "patient_id int, d date, tie string, drug string").repartition(7)
    got = {r["tie"]: (r["has"], r["prev"]) for r in
           previous_value(df, "patient_id", "d", ["tie"], "drug", out="prev", has_out="has", hot_rows=500).collect()}
    want = _brute_prev(rows)
    assert len(got) == len(rows)
    assert got == {k: (False, None) if v == "<none>" else (True, None if pd.isna(v) else v) for k, v in want.items()}
    seq = sequence_number(df, "patient_id", "d", ["tie"], hot_rows=500).toPandas()
    for _, g in seq.groupby("patient_id"):
        assert list(g.sort_values(["d", "tie"]).sequence_num) == list(range(1, len(g) + 1))


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_row = st.tuples(st.sampled_from([1, 2, 3, None]),
                 st.one_of(st.none(), st.integers(0, 4).map(lambda d: dt.date(2023, 1, 1) + dt.timedelta(days=d))),
                 st.sampled_from(["A", "B", None]),
                 st.integers(0, 3))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_row, min_size=1, max_size=40), st.sampled_from([1, 3, 10**6]))
def test_property_previous_and_keep_last(spark, rows, hot):
    data = [(p, d, f"t{i:03d}", drug, v) for i, (p, d, drug, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "patient_id int, d date, tie string, drug string, v int")
    got = {r["tie"]: (r["has"], r["prev"]) for r in
           previous_value(df, "patient_id", "d", ["tie"], "drug", out="prev", has_out="has",
                          hot_rows=hot).collect()}
    exp = _brute_prev([(p, d, t, drug) for p, d, t, drug, _ in data])
    assert set(got) == set(exp)
    for k, want in exp.items():
        assert got[k] == ((False, None) if want == "<none>" else (True, None if pd.isna(want) else want))
    # keep-last per patient by (v, tie) equals pandas
    kl = {r["patient_id"]: r["tie"] for r in keep_last(df, "patient_id", ["v", "tie"]).collect()}
    pdf = pd.DataFrame(data, columns=["patient_id", "d", "tie", "drug", "v"])
    pdf["k"] = pdf["patient_id"].astype("object").where(pdf["patient_id"].notna(), None)
    want = {(None if pd.isna(k) else int(k)): g.sort_values(["v", "tie"]).iloc[-1]["tie"]
            for k, g in pdf.groupby("k", dropna=False)}
    assert kl == want


def test_slices_are_many_and_partitions_few(spark):
    """Small slices do not ask for a partition each; every large group is cut, in order."""
    from careflow.functions.ordering import _sliced
    df = spark.range(20000).selectExpr("id % 100 AS g", "id AS d")
    out = _sliced(df, "g", [F.col("d")], 20000, 10)
    slices = out.groupBy("g", "_sl").agg(F.count("*").alias("n"), F.min("d").alias("low"), F.max("d").alias("high")).toPandas()
    assert slices.n.max() <= 5 and slices.groupby("g").size().min() >= 40
    for _, g in slices.sort_values("_sl").groupby("g"):
        assert (g.high.shift().dropna().values < g.low.iloc[1:].values).all()
    assert out.select(F.shiftright("_sl", 33).alias("p")).distinct().count() <= 2
