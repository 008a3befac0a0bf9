"""Batch analyses that are kept up to date: a run reads the days that changed and merges them with what is there.

Under ``<root>/incremental`` lie, by date, parts that can be merged: a rollup per ship and route, figures per weather, and
each ship's latest row. A table of fingerprints (file names, sizes and times of a day) tells which days a run has to read.
The results under ``<root>/analysis`` follow from the parts; those that belong to a day are replaced day by day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.operators import aggregates, anomalies, latest
from seawake.schemas import ROUTE, SHIP, TIE, TIME
from seawake.sources import tables

DAYS = "day date, fingerprint string"
SNAPSHOT = [SHIP, TIME, TIE, "latitude", "longitude", "vitesse_noeuds", "carburant_litres", "etat_moteur",
            "temperature_moteur_celsius"]


def known_days(spark: SparkSession, root: str) -> dict[dt.date, str]:
    """Days that the last run has seen, with their fingerprints."""
    path = f"{root}/incremental/days"
    if not tables.exists(spark, path):
        return {}
    return {r.day: r.fingerprint for r in spark.read.schema(DAYS).parquet(path).collect()}


def changed_days(spark: SparkSession, root: str) -> tuple[list[dt.date], list[dt.date], dict[dt.date, str]]:
    """(days to read, days that are gone, fingerprints of all days). One entry per day reaches the driver."""
    now, before = tables.day_fingerprints(spark, f"{root}/raw_data"), known_days(spark, root)
    return (sorted(d for d in now if now[d] != before.get(d)), sorted(before.keys() - now.keys()), now)


def rows_of_days(spark: SparkSession, root: str, days: list[dt.date]) -> DataFrame:
    """Raw rows of these days; other days' files are not opened."""
    return tables.read_raw(spark, f"{root}/raw_data").filter(F.col("date").isin(days))


def _daily_rollup(raw: DataFrame) -> DataFrame:
    return aggregates.ship_route_rollup(raw, by=("date",))


def _daily_weather(raw: DataFrame) -> DataFrame:
    return raw.groupBy("date", "meteo").agg(
        F.count("*").alias("occurrences"), F.sum("vitesse_noeuds").alias("vitesse_somme"),
        F.count("vitesse_noeuds").alias("vitesse_n"), F.sum("consommation_horaire_litres").alias("consommation_somme"),
        F.count("consommation_horaire_litres").alias("consommation_n"))


def _merged_weather(daily: DataFrame) -> DataFrame:
    return daily.groupBy("meteo").agg(
        F.sum("occurrences").alias("occurrences"),
        F.try_divide(F.sum("vitesse_somme"), F.sum("vitesse_n")).alias("vitesse_moyenne"),
        F.try_divide(F.sum("consommation_somme"), F.sum("consommation_n")).alias("consommation_moyenne"))


def _daily_latest(raw: DataFrame) -> DataFrame:
    return latest.latest_rows(raw, ["date", *SNAPSHOT], keys=("date", SHIP))


def run_incremental(spark: SparkSession, root: str) -> list[dt.date]:
    """Brings all analyses up to date; returns the days that were read, none if nothing changed.

    A day counts as changed if its files did (late rows, compaction), or if it is new. Days that vanished are taken out
    of the merged results. The fingerprints are written last: a run that fails is repeated in full, and every write
    replaces what it covers.
    """
    days, gone, now = changed_days(spark, root)
    if not days and not gone:
        return []
    parts, results = f"{root}/incremental", f"{root}/analysis"
    if days:
        raw = rows_of_days(spark, root, days)
        tables.write_partitioned(_daily_rollup(raw), f"{parts}/rollup")
        tables.write_partitioned(_daily_weather(raw), f"{parts}/weather")
        tables.write_partitioned(_daily_latest(raw), f"{parts}/latest")
        tables.write_partitioned(aggregates.temporal_analysis(raw), f"{results}/temporal_analysis")
        tables.write_partitioned(anomalies.anomalies_by_day(raw), f"{results}/anomalies_detected")
    for folder in (f"{parts}/rollup", f"{parts}/weather", f"{parts}/latest", f"{results}/temporal_analysis",
                   f"{results}/anomalies_detected"):
        tables.drop_days(spark, folder, gone)
    tables.write_analysis(aggregates.merged_rollup(spark.read.parquet(f"{parts}/rollup")), f"{results}/ship_route_rollup")
    rollup = spark.read.parquet(f"{results}/ship_route_rollup")
    merged = {
        "ship_statistics": aggregates.ship_statistics_of(rollup),
        "route_performance": aggregates.route_performance_of(rollup),
        "maintenance_prediction": aggregates.maintenance_prediction_of(rollup),
        "weather_impact": _merged_weather(spark.read.parquet(f"{parts}/weather")),
        "latest_positions": latest.latest_rows(spark.read.parquet(f"{parts}/latest"), SNAPSHOT),
    }
    for name, df in merged.items():
        tables.write_analysis(df, f"{results}/{name}")
    tables.write_analysis(spark.createDataFrame(sorted(now.items()), DAYS), f"{parts}/days")
    return days
