"""Borders of every rule, and the difference between the rule sets."""

import pytest
from pyspark.sql import functions as F

from seawake.functions import rules as R
from seawake.operators import aggregates, anomalies, eta, ports
from seawake.schemas import OperatingRules
from tests.helpers import rows_of


@pytest.mark.parametrize("values,kind", [
    ({"carburant_litres": 9999.0}, "CARBURANT_BAS"),
    ({"carburant_litres": 10000.0}, None),
    ({"vitesse_noeuds": 4.99}, "VITESSE_ANORMALE"),
    ({"vitesse_noeuds": 5.0}, None),
    ({"etat_moteur": "optimal"}, "MOTEUR_ANOMALIE"),
    ({"carburant_litres": 1.0, "vitesse_noeuds": 1.0, "etat_moteur": "surchauffe"}, "CARBURANT_BAS"),
    ({"vitesse_noeuds": 1.0, "etat_moteur": "surchauffe"}, "VITESSE_ANORMALE"),
])
def test_anomaly_class(spark, values, kind):
    found = [r.type_anomalie for r in anomalies.anomalies_detected(rows_of(spark, values)).collect()]
    assert found == ([] if kind is None else [kind])


def test_anomaly_label_is_a_parameter(spark):
    rows = rows_of(spark, {"etat_moteur": "surchauffe"})
    rules = OperatingRules(engine_label="MOTEUR_PROBLEME")
    found = anomalies.anomalies_detected(rows, rules)
    assert found.first().type_anomalie == "MOTEUR_PROBLEME"
    assert anomalies.alert_pivot(found, rules).first().moteur == 1


def test_fanout(spark):
    rows = rows_of(
        spark,
        {"carburant_litres": 9876.9, "vitesse_noeuds": 4.9, "etat_moteur": "surchauffe", "meteo": "tempete"},
        {"etat_moteur": "optimal"},
        {"etat_moteur": "maintenance_requise"},
        {})
    texts = {}
    for r in anomalies.alert_fanout(rows).select("message").collect():
        texts[r.message] = texts.get(r.message, 0) + 1
    assert texts == {
        "ALERTE: Carburant bas (9876L)": 1,
        "ALERTE: Navire dans une tempête": 1,
        "ALERTE: Moteur en état surchauffe": 1,
        "ALERTE: Vitesse anormalement basse (4 nœuds)": 1,
        "ALERTE: Moteur en état maintenance_requise": 1,
    }


def test_documented_rules(spark):
    rows = rows_of(spark, {"carburant_litres": 19999.0}, {"carburant_litres": 20000.0}, {"vitesse_noeuds": 1.99},
                   {"vitesse_noeuds": 2.0}, {"vitesse_noeuds": 25.0}, {"vitesse_noeuds": 25.01})
    codes = [r.anomalies for r in anomalies.anomaly_array(rows).orderBy("event_id").collect()]
    assert codes == [["LOW_FUEL"], [], ["ABNORMAL_SPEED"], [], [], ["ABNORMAL_SPEED"]]
    warm = rows_of(spark, {}, {}).withColumn("temperature_moteur_celsius", F.col("event_id") * 0.5 + 85.0)
    assert [r.anomalies for r in anomalies.anomaly_array(warm).orderBy("event_id").collect()] == [[], ["HIGH_TEMP"]]


def test_alert_score(spark):
    rows = rows_of(spark, {"carburant_litres": 1.0, "vitesse_noeuds": 1.0}, {})
    scores = anomalies.anomaly_array(rows).select(anomalies.alert_score().alias("s")).collect()
    assert sorted(r.s for r in scores) == [0, 4]


def test_tiers_and_bands(spark):
    df = spark.createDataFrame([(v,) for v in (4999.0, 5000.0, 9999.0, 10000.0, 19999.0, 20000.0, 39999.0, 40000.0)], "v double")
    rows = df.select(R.fuel_alert_tier(F.col("v")).alias("a"), R.fuel_fleet_tier(F.col("v")).alias("f")).collect()
    assert [r.a for r in rows] == ["CRITIQUE", "ATTENTION", "ATTENTION"] + ["OK"] * 5
    assert [r.f for r in rows] == ["CRITIQUE"] * 5 + ["BAS", "BAS", "OK"]
    bands = spark.createDataFrame([(v,) for v in (0.1, 0.11, 0.3, 0.31, 0.5, 0.51)], "v double")
    assert [r.b for r in bands.select(R.performance_band(F.col("v")).alias("b")).collect()] == [
        "Problématique", "Acceptable", "Acceptable", "Bon", "Bon", "Excellent"]


@pytest.mark.parametrize("temp,engine,fuel,score,priority", [
    (25.0, "normal", 15000.0, 0, "BAS"),
    (25.01, "normal", 15000.0, 1, "BAS"),
    (25.01, "normal", 14999.0, 2, "MOYEN"),
    (20.0, "optimal", 20000.0, 2, "MOYEN"),
    (25.01, "surchauffe", 14999.0, 4, "URGENT"),
])
def test_risk(spark, temp, engine, fuel, score, priority):
    row = aggregates.maintenance_prediction(rows_of(
        spark, dict(temperature_eau_celsius=temp, etat_moteur=engine, carburant_litres=fuel))).first()
    assert (row.score_risque, row.priorite_maintenance) == (score, priority)


def test_zero_divisors(spark):
    rows = rows_of(spark, {"vitesse_noeuds": 0.0, "distance_restante_nm": 0.0, "consommation_horaire_litres": 0.0})
    assert aggregates.ship_statistics(rows).first().efficacite_carburant_nm_per_litre == 0.0
    assert aggregates.route_performance(rows).first().temps_estime_heures == 0.0
    assert aggregates.route_efficiency(aggregates.voyages(rows)).first().efficacite_moyenne is None
    assert eta.eta_predictions(rows).isEmpty()


def test_empty_input_gives_empty_results(spark):
    none = rows_of(spark, {}).filter("event_id < 0")
    for df in (aggregates.ship_statistics(none), anomalies.anomalies_detected(none), eta.eta_adjusted(none),
               anomalies.alerts_per_hour(none), ports.off_course(none)):
        assert df.isEmpty() and df.columns
    kpis = aggregates.fleet_kpis(none).first()
    assert (kpis.total_navires, kpis.total_anomalies, kpis.maintenances_urgentes) == (0, 0, 0)


def test_hourly_calendar_fills_gaps(spark):
    import datetime as dt
    from tests.helpers import T0
    low = {"carburant_litres": 1.0}
    rows = rows_of(spark, low, low, {**low, "ts": T0 + dt.timedelta(hours=3, minutes=59)})
    hours = [(r.heure.hour, r.nombre) for r in anomalies.alerts_per_hour(rows).orderBy("heure").collect()]
    assert hours == [(0, 2), (1, 0), (2, 0), (3, 1)]
