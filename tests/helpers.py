"""Comparison helpers and hand-written telemetry rows."""

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession

T0 = dt.datetime(2024, 1, 1)

DEFAULTS = dict(
    event_id=0, ts=T0, navire_id="SHIP_001", latitude=40.0, longitude=3.0, vitesse_noeuds=15.0, cap_degres=90.0,
    carburant_litres=50000.0, temperature_eau_celsius=20.0, meteo="claire", etat_moteur="normal",
    port_depart="Tanger", port_arrivee="Marseille", distance_restante_nm=100.0, consommation_horaire_litres=40.0,
)
SCHEMA = ("event_id long, ts timestamp_ntz, navire_id string, latitude double, longitude double, "
          "vitesse_noeuds double, cap_degres double, carburant_litres double, temperature_eau_celsius double, "
          "meteo string, etat_moteur string, port_depart string, port_arrivee string, "
          "distance_restante_nm double, consommation_horaire_litres double")


def rows_of(spark: SparkSession, *overrides: dict) -> DataFrame:
    """Telemetry rows: the defaults with the given values put over them."""
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    data = []
    for i, override in enumerate(overrides):
        row = {**DEFAULTS, "event_id": i, **override}
        data.append(tuple(row[n] for n in names))
    return spark.createDataFrame(data, SCHEMA)


def plain(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value)
    return "NULL" if value is None else str(value)


def as_multiset(columns: list[str], records) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in records)


def same(a: DataFrame, b: DataFrame) -> bool:
    return sorted(a.columns) == sorted(b.columns) and \
        as_multiset(a.columns, a.collect()) == as_multiset(b.columns, b.collect())
