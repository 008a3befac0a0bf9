"""Readings that are no numbers, or out of all bounds, must neither stop a job nor be counted as data."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from seawake import session
from seawake.operators import aggregates, anomalies, eta, latest, windows
from seawake.sources import messages
from tests.helpers import T0, rows_of

BAD = (math.nan, math.inf, -math.inf)


def test_arrivals(spark):
    rows = rows_of(spark, {}, *({"vitesse_noeuds": v} for v in BAD), *({"distance_restante_nm": v} for v in BAD),
                   {"vitesse_noeuds": 1e-6, "distance_restante_nm": 1000.0}, {"vitesse_noeuds": 1e-20})
    got = eta.eta_predictions(rows).collect()
    assert len(got) == 3 and sum(r.eta_timestamp is None for r in got) == 2
    assert all(r.vitesse_recente < math.inf for r in eta.eta_adjusted(rows).collect())


def test_alerts(spark):
    rows = rows_of(spark, {"carburant_litres": -math.inf}, {"vitesse_noeuds": -math.inf}, {"carburant_litres": math.nan})
    assert anomalies.alert_fanout(rows).count() == 2


def test_histogram_grid_and_direction(spark):
    rows = rows_of(spark, {}, *({"vitesse_noeuds": v, "latitude": math.nan, "cap_degres": v} for v in BAD))
    assert [r.nombre for r in aggregates.speed_histogram(rows).collect()] == [1]
    assert [r.nombre for r in aggregates.traffic_grid(rows).collect()] == [1]
    assert windows.dominant_direction(rows, 3600).count() >= 1


def test_messages_with_non_finite_numbers_are_rejected(spark):
    text = '{"navire_id": "S", "timestamp": "2024-01-01T00:00:00Z", "vitesse_noeuds": %s}'
    sent = spark.createDataFrame([(text % v,) for v in ("12.5", "NaN", "Infinity", "null")], "message string")
    parsed = messages.parse_messages(sent.select(F.col("message").alias("value"), "message"))
    assert sorted(str(r.rejet) for r in messages.rejected(parsed).collect()) == ["nombre", "nombre"]


def test_a_column_named_date_is_no_partition(spark):
    rows = rows_of(spark, {"carburant_litres": 1.0}).withColumn("date", F.lit(dt.date(1990, 1, 1)))
    assert anomalies.alerts_recent(rows).count() == 1
    assert anomalies.alerts_recent(rows, as_of=F.lit(T0), date="date").count() == 0


def test_water_temperature_is_not_the_engine(spark):
    assert [r.temp_actuelle for r in latest.current_positions(rows_of(spark, {})).collect()] == [None]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError):
        session.shared_dir(Session(), "x")


@pytest.mark.parametrize("missing", [0, 2, 4])
def test_window_distance_with_an_unknown_position(spark, missing):
    rows = rows_of(spark, *({"event_id": i, "ts": T0 + dt.timedelta(seconds=50 * i), "longitude": 5.0 + i / 10,
                             "latitude": None if i == missing else 43.0} for i in range(5)))
    batch, stream = (sorted((r.window_start, r.nombre_positions, round(r.distance_nm, 9)) for r in f(rows, 3600).collect())
                     for f in (windows.window_distance, windows.window_distance_by_pieces))
    assert batch == stream
