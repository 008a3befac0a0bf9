"""JSON in and out."""

import json

import pytest
from pyspark.sql import functions as F

from seawake.operators import anomalies
from seawake.sources import messages
from tests.helpers import rows_of

GOOD = {
    "navire_id": "SHIP_001", "timestamp": "2024-01-01T00:00:00Z", "latitude": 40.0, "longitude": 3.0,
    "vitesse_noeuds": 15.0, "cap_degres": 90.0, "carburant_litres": 5000.0, "temperature_eau_celsius": 20.0,
    "meteo": "claire", "etat_moteur": "normal", "port_depart": "Tanger", "port_arrivee": "Tunis",
    "distance_restante_nm": 100.0, "consommation_horaire_litres": 40.0,
}


def parsed(spark, *texts):
    return messages.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"))


@pytest.mark.parametrize("text,reason", [
    ("oops", "json"),
    (json.dumps({**GOOD, "vitesse_noeuds": "fast"}), "json"),
    (None, "json"),
    (json.dumps({k: v for k, v in GOOD.items() if k != "navire_id"}), "champ_manquant"),
    (json.dumps({k: v for k, v in GOOD.items() if k != "timestamp"}), "champ_manquant"),
    (json.dumps({**GOOD, "timestamp": "junk"}), "horodatage"),
    (json.dumps(GOOD), None),
    (json.dumps({**GOOD, "unknown": 1}), None),
])
def test_rejects(spark, text, reason):
    rows = parsed(spark, text)
    assert [r.rejet for r in messages.rejected(rows).collect()] == ([reason] if reason else [])
    assert messages.accepted(rows).count() == (0 if reason else 1)


def test_reject_keeps_the_message(spark):
    assert messages.rejected(parsed(spark, "oops")).first().message == "oops"


def test_time_columns(spark):
    row = messages.enrich_time(messages.accepted(parsed(spark, json.dumps({**GOOD, "timestamp": "2024-02-03T23:59:59.5Z"})))).first()
    assert str(row.date) == "2024-02-03" and row.hour == 23 and row.ts.microsecond == 500000
    assert row.processing_time is not None


def test_keys_topics_and_bodies(spark):
    rows = rows_of(spark, {"carburant_litres": 1.0, "meteo": "tempete"}, {"navire_id": "SHIP_002"})
    sent = messages.to_messages(rows).collect()
    assert sorted((r.key, r.topic) for r in sent) == [
        ("SHIP_001", "alerts"), ("SHIP_001", "alerts"), ("SHIP_001", "tracking"), ("SHIP_002", "tracking")]
    alert = json.loads(next(r.value for r in sent if r.topic == "alerts"))
    assert list(alert) == ["navire_id", "timestamp", "type", "message", "latitude", "longitude"]
    assert alert["type"] == "alert" and alert["timestamp"] == "2024-01-01T00:00:00.000000Z"


def test_documented_routing(spark):
    rows = anomalies.anomaly_array(rows_of(spark, {"carburant_litres": 1.0}, {"navire_id": "SHIP_002"}))
    assert {r.key: r.topic for r in messages.route_by_anomaly(rows).collect()} == {
        "SHIP_001": "alerts", "SHIP_002": "tracking"}


def test_same_message_same_id(spark):
    a, b = parsed(spark, json.dumps(GOOD)), parsed(spark, json.dumps(GOOD), "x")
    assert a.first().event_id == b.filter(F.col("rejet").isNull()).first().event_id


def test_engine_temperature_reaches_the_archive(spark, tmp_path):
    from seawake.operators import aggregates
    from seawake.schemas import EXTENDED_MESSAGE
    from seawake.sources import tables
    from seawake.streaming import io

    sent = rows_of(spark, {}, {"navire_id": "SHIP_002"}).withColumns({
        "rpm_moteur": F.lit(900), "poids_cargo_tonnes": F.lit(1),
        "temperature_moteur_celsius": F.when(F.col("event_id") == 0, 90.0)})
    rows = io.telemetry(sent.select(messages.encode(sent, EXTENDED_MESSAGE).alias("value")))
    tables.write_partitioned(rows.select(*tables.RAW_ARCHIVE.fieldNames()), str(tmp_path))
    raw = tables.read_raw(spark, str(tmp_path))
    assert [(r.navire_id, r.anomalie) for r in anomalies.active_alerts(raw).collect()] == [("SHIP_001", "HIGH_TEMP")]
    assert anomalies.alerts_recent(raw, date="date").count() == 1 and aggregates.fleet_stats(raw).count() > 0
    assert [r.temp_max_recente for r in anomalies.urgent_maintenance(raw, more_than=0).collect()] == [90.0]
