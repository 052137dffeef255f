"""Anomaly model (FIXTURES.md A5) and the daily z-score."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from careflow.operators import anomaly as A
from careflow.operators import forest
from careflow.plans import anomaly_jobs


def _fact(spark):
    h = lambda tag: F.xxhash64(F.lit(42), F.lit(tag), F.col("id"))
    phy = (F.pmod(h("phy"), F.lit(50)) + 1).cast("int")
    hot = phy <= 2
    qty = F.when(hot, F.pmod(h("qh"), F.lit(501)) + 500).otherwise(F.pmod(h("q"), F.lit(81)) + 10).cast("int")
    return spark.range(5000).select(
        F.format_string("RX-%07d", "id").alias("prescription_id"),
        F.format_string("PAT-%06d", F.pmod(h("pat"), F.lit(200)) + 1).alias("patient_id"),
        F.format_string("PHY-%05d", phy).alias("physician_id"),
        F.element_at(F.array(F.lit("DrugA"), F.lit("DrugB"), F.lit("DrugC")),
                     (F.pmod(h("drug"), F.lit(3)) + 1).cast("int")).alias("drug_name"),
        F.date_add(F.lit(dt.date(2023, 1, 1)), F.pmod(h("day"), F.lit(365)).cast("int")).alias("prescription_date"),
        qty.alias("quantity"))


def test_planted_physicians_flagged(spark):
    fact = _fact(spark)
    model, stats, feats = anomaly_jobs.train(fact, n_trees=100)
    scored = anomaly_jobs.score(feats, model, stats).collect()
    flagged = {r.physician_id for r in scored if r.is_anomaly}
    assert 0 < len(flagged) < len(scored)
    assert len(flagged) <= 3                       # 5 % of 50, rounded up
    assert {"PHY-00001", "PHY-00002"} <= flagged
    assert all(0.0 <= r.confidence <= 1.0 for r in scored)
    assert max(r.confidence for r in scored) == 1.0
    assert model.nodes.groupby("tree").size().max() <= 2 ** (model.max_depth + 1) - 1
    res = A.anomaly_results(anomaly_jobs.score(feats, model, stats), "2024-01-15").collect()
    assert {r.physician_id for r in res} == flagged
    assert all(r.anomaly_type == "prescription_volume" for r in res)


def test_model_roundtrip(spark, tmpdir_path):
    fact = _fact(spark)
    model, stats, feats = anomaly_jobs.train(fact, n_trees=20)
    forest.save_model(spark, model, f"{tmpdir_path}/m", stats)
    m2, s2 = forest.load_model(spark, f"{tmpdir_path}/m")
    assert m2.offset == model.offset and len(m2.nodes) == len(model.nodes)
    a = {r.physician_id: r.anomaly_score for r in anomaly_jobs.score(feats, model, stats).collect()}
    b = {r.physician_id: r.anomaly_score for r in anomaly_jobs.score(feats, m2, s2).collect()}
    assert a == b
    try:
        forest.load_model(spark, f"{tmpdir_path}/absent")
        raise AssertionError("expected FileNotFoundError")
    except FileNotFoundError:
        pass


def test_average_path_length():
    import numpy as np
    c = forest.average_path_length([0, 1, 2, 256])
    assert c[0] == 0 and c[1] == 0 and c[2] == 1
    assert np.isclose(c[3], 2 * (np.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_explanations(spark):
    df = spark.createDataFrame([(500, 150.0, 700, 200), (50, 30.0, 90, 20), (10, 100.5, 1, 1), (10, 101.5, 1, 1)],
                               "total_prescriptions long, avg_quantity double, max_quantity int, unique_patients long")
    texts = [r.e for r in df.select(A.explanation().alias("e")).collect()]
    assert texts[0] == ("High prescription volume (500); High avg quantity (150); Very high max quantity (700); "
                        "Unusually many patients (200)")
    assert texts[1] == "Statistical outlier in prescribing pattern"
    assert texts[2] == "High avg quantity (100)"   # half to even, as Python formats
    assert texts[3] == "High avg quantity (102)"


def test_zscore_first_days_never_flagged(spark):
    rows = [(dt.date(2023, 1, 1) + dt.timedelta(days=i), ) for i in range(40) for _ in range(1 + (50 if i in (3, 35) else i % 3))]
    fact = spark.createDataFrame(rows, "prescription_date date")
    z = A.daily_zscore(fact).collect()
    assert len(z) == 40
    assert not any(r.is_anomaly for r in z[:8])
    assert z[0].rolling_std == 1.0
    assert z[35].is_anomaly


def test_confidence_zero_max(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "anomaly_score double")
    assert [r.confidence for r in A.with_confidence(df).collect()] == [0.0, 0.0]


def test_train_and_score_equals_separate_scoring(spark):
    fact = _fact(spark)
    model, stats, scored = anomaly_jobs.train_and_score(fact, n_trees=30)
    feats = A.physician_features(fact)
    again = {r.physician_id: (round(r.anomaly_score, 12), r.is_anomaly)
             for r in anomaly_jobs.score(feats, model, stats).collect()}
    once = {r.physician_id: (round(r.anomaly_score, 12), r.is_anomaly) for r in scored.collect()}
    assert once == again


def test_exact_quantile_equals_numpy(spark, monkeypatch):
    """Narrowing brackets or not, ties or not: the value of the definition."""
    import numpy as np

    from careflow.operators import forest
    rng = np.random.default_rng(3)
    for values in (rng.normal(size=5000), np.round(rng.normal(size=3000), 1), np.zeros(700), np.array([2.0]), np.array([1.0, 4.0])):
        df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
        for rows in (100, 100_000):
            monkeypatch.setattr(forest, "QUANTILE_ROWS", rows)
            for share in (0.0, 0.05, 0.5, 1.0):
                assert forest.exact_quantile(df, "x", share, len(values)) == pytest.approx(np.quantile(values, share), abs=1e-12)


def test_features_need_no_expand(spark):
    fact = spark.createDataFrame([(1, 1, "A", 5), (1, 1, "B", None), (1, None, "A", 7), (None, 2, None, 3)],
                                 "physician_id int, patient_id int, drug_name string, quantity int")
    features = A.physician_features(fact)
    assert "Expand" not in features._jdf.queryExecution().toString()
    got = {r["physician_id"]: tuple(r)[1:] for r in features.collect()}
    assert got == {1: (3, 6.0, 7, 1, 2), None: (1, 3.0, 3, 1, 0)}


def test_native_scores_equal_the_vectorised_ones(spark):
    from careflow.operators import forest
    rows = [(i, float(i % 17), float(i * i % 29), None if i == 5 else float(i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "physician_id long, a double, b double, c double")
    model = forest.fit(df.fillna(0.0), ["a", "b", "c"], n_trees=12, max_samples=64)
    one = {r["physician_id"]: r["score_samples"] for r in forest.score_samples(df, model).collect()}
    native = forest.score_samples_native(df, model)
    two = {r["physician_id"]: r["score_samples"] for r in native.collect()}
    assert one.keys() == two.keys() and max(abs(one[k] - two[k]) for k in one) < 1e-12
    plan = native._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
