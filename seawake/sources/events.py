"""Telemetry derived from the generic ``events`` table (see FIXTURES.md section 2).

All columns are plain expressions over the scan, so a query reads and computes
only the columns it uses. Every number except the position is a dyadic
rational: sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.schemas import PORTS

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _port(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def telemetry(events: DataFrame, extended: bool = False) -> DataFrame:
    """One telemetry row per event; ``extended`` adds the documented engine and cargo fields."""
    event, user = F.col("event_id"), F.col("user_id")
    # A column of its own, so that the JSON text is read once per row.
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, number = F.col("k"), (user + 1).cast("string")
    dep = F.pmod(user, F.lit(8))
    arr = F.pmod(dep + 1 + F.pmod(F.floor(user / 8), F.lit(7)), F.lit(8))
    names = [name for name, _, _ in PORTS]
    lats = [lat for _, lat, _ in PORTS]
    lons = [lon for _, _, lon in PORTS]

    speed = F.lit(3.0) + F.pmod(k * 7, F.lit(109)) / F.lit(4.0)
    remaining = F.pmod(event * 3, F.lit(4000)) / F.lit(4.0)
    progress = F.lit(1.0) - remaining / F.lit(1000.0)
    weather = (
        F.when(F.pmod(event, F.lit(10)) < 7, "claire")
        .when(F.pmod(event, F.lit(10)) == 7, "nuageux")
        .when(F.pmod(event, F.lit(10)) == 8, "pluie_legere")
        .when(F.pmod(event, F.lit(20)) == 9, "brouillard")
        .otherwise("tempete")
    )
    engine = (
        F.when(F.col("event_type") == "error", "surchauffe")
        .when(k >= 95, "maintenance_requise")
        .when(k == 94, "optimal")
        .otherwise("normal")
    )
    columns = [
        event,
        F.col("ts"),
        F.concat(F.lit("SHIP_"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number))
        .alias("navire_id"),
        (_port(lats, dep) + (_port(lats, arr) - _port(lats, dep)) * progress).alias("latitude"),
        (_port(lons, dep) + (_port(lons, arr) - _port(lons, dep)) * progress).alias("longitude"),
        speed.alias("vitesse_noeuds"),
        (k * F.lit(3.5)).alias("cap_degres"),
        (F.lit(80000) - F.pmod(event * 83 + user * 331, F.lit(79000))).cast("double").alias("carburant_litres"),
        (F.lit(18.0) + F.pmod(k, F.lit(33)) / F.lit(4.0)).alias("temperature_eau_celsius"),
        weather.alias("meteo"),
        engine.alias("etat_moteur"),
        _port(names, dep).alias("port_depart"),
        _port(names, arr).alias("port_arrivee"),
        remaining.alias("distance_restante_nm"),
        (F.lit(10.0) + F.lit(2.5) * speed + F.pmod(k, F.lit(20)) / F.lit(4.0)).alias("consommation_horaire_litres"),
    ]
    if extended:
        columns += [
            (F.lit(1000) + F.pmod(event * 37, F.lit(2000))).cast("int").alias("rpm_moteur"),
            (F.lit(500) + F.pmod(user * 13, F.lit(4500))).cast("int").alias("poids_cargo_tonnes"),
            (F.lit(70.0) + F.pmod(k, F.lit(80)) / F.lit(4.0)).alias("temperature_moteur_celsius"),
        ]
    return events.select(*columns)


def read_telemetry(spark: SparkSession, sf_dir: str, extended: bool = False) -> DataFrame:
    return telemetry(read_events(spark, sf_dir), extended)
