"""Anomaly and alert operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seawake.functions import rules as R
from seawake.functions.moments import after, back
from seawake.operators.latest import latest_rows, latest_time
from seawake.schemas import (DOCUMENTED, OPERATING, SEVERITY, SEVERITY_POINTS, SHIP, TIME, DocumentedRules,
                             OperatingRules)

CLASSES = {"carburant": "CARBURANT_BAS", "vitesse": "VITESSE_ANORMALE"}


def anomalies_detected(df: DataFrame, rules: OperatingRules = OPERATING, with_position: bool = False) -> DataFrame:
    """Rows that break an operating rule, with the name of the first rule broken."""
    position = ["latitude", "longitude"] if with_position else []
    return df.filter(R.is_anomaly(rules)).select(
        SHIP, F.col(TIME).alias("timestamp"), *position,
        "carburant_litres", "vitesse_noeuds", "etat_moteur",
        R.anomaly_class(rules).alias("type_anomalie"),
    )


def anomalies_by_day(df: DataFrame, rules: OperatingRules = OPERATING) -> DataFrame:
    """The anomalies with their date, for a table that is replaced day by day."""
    return anomalies_detected(df, rules).withColumn("date", F.to_date("timestamp"))


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy(SHIP, "type_anomalie").agg(F.count("*").alias("nombre_anomalies"))


def anomaly_counts(anomalies: DataFrame, by: str = SHIP) -> DataFrame:
    return anomalies.groupBy(by).agg(F.count("*").alias("nombre"))


def alert_pivot(anomalies: DataFrame, rules: OperatingRules = OPERATING) -> DataFrame:
    """One column per anomaly type and ship."""
    kind = F.col("type_anomalie")
    types = {**CLASSES, "moteur": rules.engine_label}
    return anomalies.groupBy(SHIP).agg(
        F.count("*").alias("total"),
        *[F.count_if(kind == name).alias(column) for column, name in types.items()],
    )


def alert_fanout(df: DataFrame, rules: OperatingRules = OPERATING) -> DataFrame:
    """One row per alert that holds on a message."""
    return df.select(
        SHIP, TIME, F.explode(R.alert_messages(rules)).alias("message"), "latitude", "longitude")


def anomaly_array(df: DataFrame, rules: DocumentedRules = DOCUMENTED) -> DataFrame:
    """Adds the array of documented anomaly codes to each row."""
    return df.withColumn("anomalies", R.documented_anomalies(df.columns, rules))


def documented_alerts(df: DataFrame, rules: DocumentedRules = DOCUMENTED) -> DataFrame:
    """One row per documented anomaly, with its severity."""
    return (
        df.select("*", F.explode(R.documented_anomalies(df.columns, rules)).alias("anomalie"))
        .withColumn("severite", R.severity(F.col("anomalie")))
    )


def recent(df: DataFrame, *, days: int = 0, hours: int = 0, as_of: Column | None = None,
           date: str | None = None) -> DataFrame:
    """Rows newer than ``as_of`` minus the span; ``as_of`` defaults to the newest row. ``date`` names the partition
    column of the event's day, if there is one."""
    now = latest_time(df) if as_of is None else as_of
    return df.filter(after(back(now, days=days, hours=hours), date=date))


def alerts_recent(df: DataFrame, days: int = 1, as_of: Column | None = None, date: str | None = None) -> DataFrame:
    """Documented anomalies of the last day with a readable label (unsorted: sort when showing)."""
    rows = documented_alerts(recent(df, days=days, as_of=as_of, date=date))
    return rows.select(SHIP, F.col(TIME).alias("timestamp"), "anomalie",
                       R.label(F.col("anomalie")).alias("description"))


def urgent_maintenance(df: DataFrame, days: int = 1, more_than: int = 5, as_of: Column | None = None,
                       date: str | None = None) -> DataFrame:
    """Ships with more than so many documented anomalies in the span (extended telemetry)."""
    return (
        documented_alerts(recent(df, days=days, as_of=as_of, date=date))
        .groupBy(SHIP)
        .agg(
            F.count("*").alias("anomalies_count"),
            F.array_sort(F.collect_set("anomalie")).alias("types_anomalies"),
            F.max("temperature_moteur_celsius").alias("temp_max_recente"),
            F.avg("rpm_moteur").alias("rpm_moyen"),
        )
        .filter(F.col("anomalies_count") > more_than)
    )


def anomaly_distribution(df: DataFrame, days: int = 30, as_of: Column | None = None,
                         date: str | None = None) -> DataFrame:
    """Share of each documented anomaly and the ships it touches."""
    counts = (
        documented_alerts(recent(df, days=days, as_of=as_of, date=date))
        .groupBy("anomalie")
        .agg(F.count("*").alias("occurrences"), F.count_distinct(SHIP).alias("nb_navires_affectes"))
    )
    # The open window sees one row per anomaly code, never raw rows.
    share = F.col("occurrences") * 100.0 / F.sum("occurrences").over(Window.partitionBy())
    return counts.withColumn("pourcentage", F.round(share, 2))


def alerts_per_hour(df: DataFrame) -> DataFrame:
    """Documented anomalies per hour; hours without any count 0."""
    hour = F.window(TIME, "1 hour")["start"]
    per_hour = documented_alerts(df).groupBy(hour.alias("debut")).agg(F.count("*").alias("alertes"))
    # The open window sees one row per hour with alerts, never raw rows.
    following = F.lead("debut").over(Window.partitionBy().orderBy("debut"))
    last_free = F.coalesce(following - F.expr("INTERVAL 1 HOUR"), F.col("debut"))
    return (
        per_hour.withColumn("_until", last_free)
        .select("debut", "alertes", F.explode(F.expr("sequence(debut, _until, INTERVAL 1 HOUR)")).alias("heure"))
        .select("heure", F.when(F.col("heure") == F.col("debut"), F.col("alertes")).otherwise(0).alias("nombre"))
    )


def alert_score() -> Column:
    """Severity-weighted sum over the ``anomalies`` array (the weights are ours)."""
    points = {code: SEVERITY_POINTS[level] for code, level in SEVERITY.items()}
    return F.aggregate("anomalies", F.lit(0).cast("bigint"),
                       lambda total, code: total + R.lookup(points, code, 0))


def active_alerts(df: DataFrame) -> DataFrame:
    """Documented anomalies that hold on each ship's latest row."""
    extra = [c for c in ("temperature_moteur_celsius",) if c in df.columns]
    latest = latest_rows(df, [SHIP, TIME, "carburant_litres", "vitesse_noeuds", *extra])
    return documented_alerts(latest).select(SHIP, F.col(TIME).alias("timestamp"), "anomalie", "severite")
