"""Arrival-time estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.functions.moments import is_finite, plus_seconds
from seawake.functions.rules import lookup
from seawake.schemas import ETA, SHIP, TIE, TIME, EtaRules

LATEST = 10**11  # seconds, some three thousand years
OVERLAP = 6  # windows of half an hour, renewed every five minutes, that hold a row


def eta_predictions(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Hours and moment of arrival at the present speed; ships that stand or have arrived are left out.

    So are rows whose speed or distance is no finite number. An arrival that lies beyond ``LATEST`` seconds has no
    moment: NULL.
    """
    hours = F.col("distance_restante_nm") / F.col("vitesse_noeuds")
    return (
        df.filter((F.col("distance_restante_nm") > 0) & (F.col("vitesse_noeuds") > 0))
        .filter(is_finite(F.col("distance_restante_nm")) & is_finite(F.col("vitesse_noeuds")))
        .select(SHIP, F.col(TIME).alias("timestamp"), *keep, "port_arrivee",
                "distance_restante_nm", "vitesse_noeuds", hours.alias("eta_heures"),
                plus_seconds(F.col(TIME), F.when(hours * 3600 < LATEST, (hours * 3600).cast("bigint"))).alias("eta_timestamp"))
    )


def eta_adjusted(df: DataFrame, span: str = "30 minutes", every: str = "5 minutes",
                 rules: EtaRules = ETA) -> DataFrame:
    """Arrival estimate from the mean speed of the last half hour, renewed every five minutes.

    The speed is lowered by a factor for the weather and the hours raised by a
    safety buffer; both are parameters. Rows are first summed up per step, then
    the steps of a window are: the copies for overlapping windows are made of
    step sums and not of rows. On a stream these are two stateful operators.
    """
    factor = lookup(rules.weather_factor, F.col("meteo"), 1.0)
    rows = df.select(
        TIME, SHIP, "port_arrivee", F.col("vitesse_noeuds").alias("_speed"),
        F.when(F.col("vitesse_noeuds").isNotNull(), 1).otherwise(0).alias("_n"),
        F.struct(TIME, TIE, F.col("distance_restante_nm").alias("distance"), factor.alias("factor")).alias("_last"))

    def summed(source: DataFrame, window) -> DataFrame:
        return source.groupBy(window.alias("window"), SHIP, "port_arrivee").agg(
            F.sum("_speed").alias("_speed"), F.sum("_n").alias("_n"), F.max("_last").alias("_last"))

    steps = summed(rows, F.window(TIME, every)).withColumnRenamed("window", "step")
    recent = F.col("_speed") / F.col("_n")
    speed = F.col("vitesse_recente") * F.col("_last.factor")
    return (
        summed(steps, F.window("step", span, every))
        .filter(F.col("_n") > 0)
        .withColumn("vitesse_recente", recent)
        .filter((speed > 0) & (F.col("_last.distance") > 0))
        .filter(is_finite(speed) & is_finite(F.col("_last.distance")))
        .select(
            F.col("window.end").alias("mise_a_jour"), SHIP, "port_arrivee", "vitesse_recente",
            F.col("_last.distance").alias("distance_restante_nm"),
            (F.col("_last.distance") / speed * (1.0 + rules.safety_buffer)).alias("eta_heures"),
        )
    )
