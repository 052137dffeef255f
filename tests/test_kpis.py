"""KPI / API / dashboard queries on the reference's route fixture (FIXTURES.md A6)
and the journey / switch invariants on the registered queries (SURVEY §7.5)."""
import datetime as dt

import pytest

from careflow.operators import kpis as K
from careflow.operators import warehouse as W
from careflow.plans.domain import DomainTables

HI = dt.date(9999, 12, 31)


@pytest.fixture(scope="module")
def wh(spark):
    rx = spark.createDataFrame(
        [("RX-0000001", "PAT-000001", "PHY-00001", "DrugA-Onc", "2023-01-15", 30, 2, "Oncology"),
         ("RX-0000002", "PAT-000001", "PHY-00001", "DrugB-Onc", "2023-03-20", 60, 1, "Oncology")],
        "prescription_id string, patient_id string, physician_id string, drug_name string, "
        "prescription_date string, quantity int, refills int, therapy_area string")
    fact = W.transform_prescriptions(rx, order=[])
    dim = spark.createDataFrame(
        [("PAT-000001", "M", dt.date(1980, 1, 1), "North", dt.date(2020, 1, 1), dt.date(2024, 1, 1), HI, 1),
         ("PAT-000002", "F", dt.date(1990, 1, 1), "South", dt.date(2021, 1, 1), dt.date(2024, 1, 1), HI, 1)],
        "patient_id string, gender string, date_of_birth date, region string, enrollment_date date, "
        "effective_from date, effective_to date, is_current smallint")
    anomalies = spark.createDataFrame(
        [("PHY-00001", -0.8, "prescription_volume", 500, 150.0, 700, 200, dt.date(2024, 1, 15), 0.85,
          "High prescription volume (500)")],
        "physician_id string, anomaly_score double, anomaly_type string, total_prescriptions int, "
        "avg_quantity double, max_quantity int, unique_patients int, detection_date date, confidence double, "
        "explanation string")
    switches = W.detect_therapy_switches(fact)
    journey = W.build_patient_journey(fact, None)
    return dict(fact=fact, dim=dim, anomalies=anomalies, switches=switches, journey=journey)


def test_routes(wh):
    j = K.patient_journey_lookup(wh["journey"], wh["dim"], "PAT-000001").collect()
    assert [r.sequence_num for r in j] == [1, 2] and j[0].total_events == 2 and j[0].region == "North"
    assert K.patient_journey_lookup(wh["journey"], wh["dim"], "PAT-999999").count() == 0   # not found
    assert [r.patient_id for r in K.list_patients(wh["dim"], region="South").collect()] == ["PAT-000002"]
    assert K.list_patients(wh["dim"], limit=500).count() == 2
    for call in (lambda n: K.list_patients(wh["dim"], limit=n), lambda n: K.list_anomalies(wh["anomalies"], limit=n),
                 lambda n: K.list_switches(wh["switches"], limit=n)):
        for wrong in (0, -1, 1001):
            with pytest.raises(ValueError):
                call(wrong)
    assert K.list_anomalies(wh["anomalies"], min_confidence=0.9).count() == 0
    assert K.list_anomalies(wh["anomalies"], date="2024-01-15").count() == 1
    a4 = K.physician_anomaly(wh["anomalies"], "PHY-00001").first()
    assert a4.is_anomalous and a4.confidence == 0.85
    assert not K.physician_anomaly(wh["anomalies"], "PHY-99999").first().is_anomalous
    s = K.anomaly_summary(wh["anomalies"]).first()
    assert (s.total_anomalies, s.avg_confidence) == (1, 0.85)
    assert K.list_switches(wh["switches"]).count() == 1
    assert K.switch_summary(wh["switches"]).first().asDict() == {"total_switches": 1, "unique_patients": 1}
    assert K.switch_summary(wh["switches"], "no-such-area").first().asDict() == {"total_switches": 0, "unique_patients": 0}
    assert [r.drug for r in K.switch_top(wh["switches"], "from_drug").collect()] == ["DrugA-Onc"]
    g = K.global_totals(wh["dim"], wh["fact"], wh["switches"], wh["anomalies"]).first()
    assert (g.total_patients, g.total_prescriptions, g.total_therapy_switches, g.total_anomalies_detected) == (2, 2, 1, 1)
    d = K.overall_drop_off(wh["fact"]).first()
    assert (d.pairs_analyzed, d.drop_off_count, d.drop_off_rate) == (1, 1, 1.0)
    assert K.overall_drop_off(wh["fact"], therapy_area="Cardiology").first().drop_off_rate == 0.0


def test_dashboard(wh):
    f_all = K.DashboardFilter()
    f_south = K.DashboardFilter(region="South")
    f_bad = K.DashboardFilter(region="Atlantis", therapy="Alchemy")
    assert K.patient_card(wh["dim"], wh["fact"], f_all).first().cnt == 2
    assert K.rx_card(wh["fact"], wh["dim"], f_all).first().cnt == 2
    assert K.rx_card(wh["fact"], wh["dim"], f_south).first().cnt == 0
    assert K.rx_card(wh["fact"], wh["dim"], f_bad).first().cnt == 2          # unknown values are ignored
    assert K.switch_card(wh["switches"], wh["fact"], wh["dim"], f_all).first().cnt == 1
    assert K.anomaly_card(wh["anomalies"], wh["fact"], wh["dim"], f_all).first().cnt == 1
    assert K.anomaly_card(wh["anomalies"], wh["fact"], wh["dim"], f_south).first().cnt == 0
    pairs = K.top_switch_pairs(wh["switches"], wh["fact"], wh["dim"], f_all).collect()
    assert [(r.from_drug, r.to_drug, r["count"]) for r in pairs] == [("DrugA-Onc", "DrugB-Onc", 1)]
    assert [r.therapy_area for r in K.rx_volume_by_therapy(wh["fact"], wh["dim"], f_all).collect()] == ["Oncology"]
    assert K.daily_rx_volume(wh["fact"], wh["dim"], f_all).count() == 2


def test_invariants_on_registered_tables(spark):
    t = DomainTables(spark, "/root/testdata/sf0.001")
    n_fact, n_dx = t.fact_prescription.count(), t.dx_stage.count()
    assert t.fact_patient_journey.count() == n_fact + n_dx
    n_pat = t.fact_prescription.select("patient_id").distinct().count()
    sw = t.therapy_switches
    assert sw.count() <= n_fact - n_pat
    assert sw.filter("from_drug <=> to_drug").count() == 0
    # sequence numbers are 1..n without gaps
    gaps = t.fact_patient_journey.groupBy("patient_id").agg({"sequence_num": "max", "*": "count"})
    assert gaps.filter("`max(sequence_num)` != `count(1)`").count() == 0
