"""Anomaly, alert, tier and risk rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seawake.schemas import (ALERT_ENGINE_STATES, DOCUMENTED, LABELS, OPERATING, OTHER_LABEL, SEVERITY,
                             DocumentedRules, OperatingRules)
from seawake.functions import geo


# --- operating rules -------------------------------------------------------

def fuel_is_low(rules: OperatingRules = OPERATING) -> Column:
    return F.col("carburant_litres") < rules.fuel_low


def speed_is_low(rules: OperatingRules = OPERATING) -> Column:
    return F.col("vitesse_noeuds") < rules.speed_low


def engine_is_abnormal(rules: OperatingRules = OPERATING) -> Column:
    return F.col("etat_moteur") != rules.engine_normal


def is_anomaly(rules: OperatingRules = OPERATING) -> Column:
    return fuel_is_low(rules) | speed_is_low(rules) | engine_is_abnormal(rules)


def anomaly_class(rules: OperatingRules = OPERATING) -> Column:
    """The first rule that holds names the anomaly."""
    return (
        F.when(fuel_is_low(rules), "CARBURANT_BAS")
        .when(speed_is_low(rules), "VITESSE_ANORMALE")
        .when(engine_is_abnormal(rules), rules.engine_label)
        .otherwise("AUTRE")
    )


def alert_messages(rules: OperatingRules = OPERATING) -> Column:
    """One text per alert rule that holds, 0 to 4 of them."""
    # The texts of the four alerts.
    whole = "bigint"
    fuel = F.format_string("ALERTE: Carburant bas (%dL)", F.col("carburant_litres").try_cast(whole))
    storm = F.lit("ALERTE: Navire dans une tempête")
    engine = F.concat(F.lit("ALERTE: Moteur en état "), F.col("etat_moteur"))
    slow = F.format_string("ALERTE: Vitesse anormalement basse (%d nœuds)", F.col("vitesse_noeuds").try_cast(whole))
    return F.array_compact(F.array(
        F.when(fuel_is_low(rules), fuel),
        F.when(F.col("meteo") == "tempete", storm),
        F.when(F.col("etat_moteur").isin(*ALERT_ENGINE_STATES), engine),
        F.when(speed_is_low(rules), slow),
    ))


# --- documented rules ------------------------------------------------------

def documented_anomalies(columns: list[str], rules: DocumentedRules = DOCUMENTED) -> Column:
    """Array of the documented anomaly codes that hold on a row.

    The engine temperature is an optional field; where it is absent it is NULL, and HIGH_TEMP does not hold.
    """
    speed = F.col("vitesse_noeuds")
    name = "temperature_moteur_celsius"
    temperature = F.col(name) if name in columns else F.lit(None).cast("double")
    return F.array_compact(F.array(
        F.when(F.col("carburant_litres") < rules.fuel_low, "LOW_FUEL"),
        F.when(temperature > rules.engine_temp_high, "HIGH_TEMP"),
        F.when((speed < rules.speed_low) | (speed > rules.speed_high), "ABNORMAL_SPEED"),
    ))


def _lookup(values: dict, key: Column, default=None) -> Column:
    expr = None
    for name, value in values.items():
        expr = F.when(key == name, F.lit(value)) if expr is None else expr.when(key == name, F.lit(value))
    return expr if default is None else expr.otherwise(F.lit(default))


def severity(code: Column) -> Column:
    return _lookup(SEVERITY, code)


def label(code: Column) -> Column:
    return _lookup(LABELS, code, OTHER_LABEL)


def lookup(values: dict, key: Column, default=None) -> Column:
    """CASE over a small fixed mapping."""
    return _lookup(values, key, default)


def is_off_course(course_to_port: Column, rules: DocumentedRules = DOCUMENTED) -> Column:
    return geo.course_deviation(F.col("cap_degres"), course_to_port) > rules.course_deviation


# --- tiers, bands and scores -----------------------------------------------

def fuel_alert_tier(fuel: Column) -> Column:
    return F.when(fuel < 5000, "CRITIQUE").when(fuel < 10000, "ATTENTION").otherwise("OK")


def fuel_fleet_tier(fuel: Column) -> Column:
    return F.when(fuel < 20000, "CRITIQUE").when(fuel < 40000, "BAS").otherwise("OK")


def performance_band(efficiency: Column) -> Column:
    return (
        F.when(efficiency > 0.5, "Excellent")
        .when(efficiency > 0.3, "Bon")
        .when(efficiency > 0.1, "Acceptable")
        .otherwise("Problématique")
    )


def risk_score(temp_max: Column, incidents: Column, fuel: Column) -> Column:
    """0 to 4 points. The temperature is that of the water; no engine temperature is recorded."""
    def points(condition: Column, n: int) -> Column:
        return F.when(condition, n).otherwise(0)

    return points(temp_max > 25, 1) + points(incidents > 0, 2) + points(fuel < 15000, 1)


def maintenance_priority(score: Column) -> Column:
    return F.when(score >= 3, "URGENT").when(score == 2, "MOYEN").otherwise("BAS")


def guarded_ratio(numerator: Column, divisor: Column) -> Column:
    """0 where the divisor is not positive."""
    return F.when(divisor > 0, F.try_divide(numerator, divisor)).otherwise(0.0)
