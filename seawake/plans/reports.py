"""The named reports.

Each takes the table it reads (raw telemetry or an analysis result). Top-k
reports sort and limit in one step, with a unique key as the last sort column
so that equal values always come out in the same order. Sorting is part of a
report only together with a limit; unlimited results are left unsorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seawake.functions import rules as R
from seawake.functions.moments import recency
from seawake.operators.latest import latest_rows
from seawake.schemas import ROUTE, SHIP, TIE, TIME


def _top(df: DataFrame, n: int, first, *ties: str) -> DataFrame:
    return df.orderBy(first, *ties).limit(n)


def _rounded(column: str, digits: int, name: str):
    return F.round(column, digits).alias(name)


# --- from the analysis tables ------------------------------------------------

def fastest_ships(stats: DataFrame, n: int = 10) -> DataFrame:
    return _top(stats, n, F.desc_nulls_last("vitesse_moyenne"), SHIP, *ROUTE).select(
        SHIP, *ROUTE, _rounded("vitesse_moyenne", 2, "vitesse_moy_noeuds"),
        _rounded("efficacite_carburant_nm_per_litre", 3, "efficacite"))


def busiest_routes(routes: DataFrame, n: int = 10) -> DataFrame:
    return _top(routes, n, F.desc_nulls_last("nombre_navires"), *ROUTE).select(
        *ROUTE, "nombre_navires", _rounded("distance_moyenne_route", 1, "distance_nm"),
        _rounded("temps_estime_heures", 1, "temps_h"))


def maintenance_urgent_report(maintenance: DataFrame) -> DataFrame:
    return maintenance.filter(F.col("priorite_maintenance") == "URGENT").select(
        SHIP, "score_risque", "priorite_maintenance", _rounded("temp_max", 1, "temp_max_C"),
        "incidents_moteur", _rounded("carburant_actuel", 0, "carburant_L"))


def weather_report(weather: DataFrame) -> DataFrame:
    # One row per weather reaches the open window.
    share = F.col("occurrences") * 100.0 / F.sum("occurrences").over(Window.partitionBy())
    return weather.select("meteo", "occurrences", F.round(share, 2).alias("pct"),
                          _rounded("vitesse_moyenne", 2, "vitesse_moy"),
                          _rounded("consommation_moyenne", 1, "conso_moy"))


def route_efficiency_report(routes: DataFrame, n: int = 10) -> DataFrame:
    ratio = F.try_divide("distance_moyenne_route", "consommation_moyenne_route")
    return _top(routes.withColumn("_ratio", ratio), n, F.desc_nulls_last("_ratio"), *ROUTE).select(
        *ROUTE, _rounded("distance_moyenne_route", 1, "dist_nm"),
        _rounded("consommation_moyenne_route", 1, "conso_L_h"), _rounded("_ratio", 3, "efficacite"))


def alert_pivot_report(pivot: DataFrame, n: int = 15) -> DataFrame:
    return _top(pivot, n, F.desc("total"), SHIP)


def ship_ranking(stats: DataFrame, n: int = 15) -> DataFrame:
    value = F.col("efficacite_carburant_nm_per_litre")
    return _top(stats.filter(value > 0), n, value.desc(), SHIP, *ROUTE).select(
        SHIP, _rounded("vitesse_moyenne", 2, "vitesse"), F.round(value, 3).alias("efficacite"),
        R.performance_band(value).alias("performance"))


def top_ships(stats: DataFrame, n: int = 10) -> DataFrame:
    best = F.desc("efficacite_carburant_nm_per_litre")
    return _top(stats.filter(F.col("carburant_utilise") > 0), n, best, SHIP, *ROUTE).select(
        SHIP, *ROUTE, "vitesse_moyenne", "consommation_moyenne", "efficacite_carburant_nm_per_litre")


def top_routes(routes: DataFrame, n: int = 10) -> DataFrame:
    return _top(routes, n, F.desc("nombre_navires"), *ROUTE).select(
        F.concat_ws(" → ", *ROUTE).alias("route"), "nombre_navires")


def fastest_routes(routes: DataFrame, n: int = 10) -> DataFrame:
    """Routes by mean travel time; the time that orders them is the averaged one."""
    known = routes.filter(F.col("port_depart").isNotNull() & F.col("port_arrivee").isNotNull())
    return _top(known, n, F.asc_nulls_last("temps_estime_heures"), *ROUTE).select(
        *ROUTE, _rounded("distance_moyenne_route", 2, "distance_nm"),
        _rounded("temps_estime_heures", 2, "temps_moyen_heures"),
        _rounded("vitesse_moyenne_route", 2, "vitesse_moyenne"))


def top_anomaly_ships(anomalies: DataFrame, n: int = 5) -> DataFrame:
    counts = anomalies.groupBy(SHIP).agg(F.count("*").alias("nombre"))
    return _top(counts, n, F.desc("nombre"), SHIP)


def priority_counts(maintenance: DataFrame) -> DataFrame:
    return maintenance.groupBy("priorite_maintenance").agg(F.count("*").alias("nombre"))


def maintenance_alerts(maintenance: DataFrame) -> DataFrame:
    """Ships whose priority is not BAS (our definition: the view is named but never defined)."""
    return maintenance.filter(F.col("priorite_maintenance") != "BAS")


# --- from raw telemetry and arrival estimates ---------------------------------

def ships_to_watch(df: DataFrame, n: int = 15) -> DataFrame:
    """Ships whose latest row breaks an operating rule, least fuel first."""
    latest = latest_rows(df, [SHIP, "carburant_litres", "vitesse_noeuds", "etat_moteur"])
    return _top(latest.filter(R.is_anomaly()), n, F.asc_nulls_last("carburant_litres"), SHIP).select(
        SHIP, _rounded("carburant_litres", 0, "carburant_L"), _rounded("vitesse_noeuds", 1, "vitesse"),
        "etat_moteur", R.fuel_alert_tier(F.col("carburant_litres")).alias("niveau_carburant"))


def newest_eta(eta: DataFrame, tie: str | None = TIE) -> DataFrame:
    """Each ship's newest arrival estimate, one row per ship."""
    values = ["timestamp", "port_arrivee", "distance_restante_nm", "eta_heures", "eta_timestamp"]
    return (eta.groupBy(SHIP)
            .agg(F.max_by(F.struct(*values), recency(tie, "timestamp")).alias("_last"))
            .select(SHIP, "_last.*"))


def next_arrivals(eta: DataFrame, n: int = 15, tie: str | None = TIE) -> DataFrame:
    due = newest_eta(eta, tie).filter(F.col("eta_heures") > 0)
    return _top(due, n, F.asc("eta_heures"), SHIP).select(
        SHIP, "port_arrivee", _rounded("distance_restante_nm", 1, "dist_nm"), _rounded("eta_heures", 2, "eta_h"),
        F.date_format("eta_timestamp", "yyyy-MM-dd HH:mm").alias("arrivee"))


def fleet_overview(df: DataFrame) -> DataFrame:
    """Fleet figures over each ship's latest row (ships are unique there, so counting rows counts ships)."""
    latest = latest_rows(df, [SHIP, "carburant_litres", "vitesse_noeuds", "etat_moteur"])
    return latest.agg(
        F.count(SHIP).alias("total_navires"),
        F.round(F.avg("vitesse_noeuds"), 2).alias("vitesse_moy"),
        F.round(F.avg("carburant_litres"), 0).alias("carburant_moy"),
        F.count_if(R.fuel_is_low()).alias("alerte_carburant"),
        F.count_if(R.engine_is_abnormal()).alias("probleme_moteur"),
    )


def fleet_status(positions: DataFrame, n: int = 50) -> DataFrame:
    """Live status of the ships heard from last (reads the current-position view)."""
    return _top(positions, n, F.desc("dernier_update"), SHIP).select(
        SHIP, "latitude", "longitude", "vitesse_actuelle", "carburant_actuel", "temp_actuelle",
        R.fuel_fleet_tier(F.col("carburant_actuel")).alias("fuel_status"), "dernier_update")


def speed_series(df: DataFrame, n: int = 1000) -> DataFrame:
    return _top(df.select(SHIP, TIME, TIE, "vitesse_noeuds"), n, F.asc(TIME), TIE)


def recent_positions(df: DataFrame, n: int = 1000) -> DataFrame:
    return _top(df.select(SHIP, TIME, TIE, "latitude", "longitude"), n, F.desc(TIME), TIE)


def trajectory_sample(df: DataFrame, fraction: float = 0.3) -> DataFrame:
    """A repeatable random sample of positions.

    A row is kept by the hash of its id, so the choice does not change with the
    partitioning or when a lost task runs again, as ``sample()`` would.
    """
    digits = F.conv(F.substring(F.md5(F.col(TIE).cast("string")), 1, 6), 16, 10).cast("bigint")
    return df.filter(digits < int(fraction * 16 ** 6)).select(SHIP, TIME, TIE, "latitude", "longitude")
