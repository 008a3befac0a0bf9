"""Declared schemas and fixed values of the telemetry data model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SHIP = "navire_id"
TIME = "ts"
TIE = "event_id"
ROUTE = ("port_depart", "port_arrivee")

# A telemetry message: 14 flat fields, one JSON object per message.
TELEMETRY_MESSAGE = T.StructType([
    T.StructField("navire_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("vitesse_noeuds", T.DoubleType()),
    T.StructField("cap_degres", T.DoubleType()),
    T.StructField("carburant_litres", T.DoubleType()),
    T.StructField("temperature_eau_celsius", T.DoubleType()),
    T.StructField("meteo", T.StringType()),
    T.StructField("etat_moteur", T.StringType()),
    T.StructField("port_depart", T.StringType()),
    T.StructField("port_arrivee", T.StringType()),
    T.StructField("distance_restante_nm", T.DoubleType()),
    T.StructField("consommation_horaire_litres", T.DoubleType()),
])

# Optional fields of the extended message.
EXTENDED_FIELDS = T.StructType([
    T.StructField("rpm_moteur", T.IntegerType()),
    T.StructField("poids_cargo_tonnes", T.IntegerType()),
    T.StructField("temperature_moteur_celsius", T.DoubleType()),
])

# What the jobs read: optional fields are NULL in a message without them.
EXTENDED_MESSAGE = T.StructType([*TELEMETRY_MESSAGE.fields, *EXTENDED_FIELDS.fields])

# The stored raw archive: the extended message plus what ingest adds. Files from before the optional fields read as NULL.
RAW_ARCHIVE = T.StructType(
    [T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType())]
    + [f for f in EXTENDED_MESSAGE.fields if f.name != "timestamp"]
    + [T.StructField("date", T.DateType()), T.StructField("hour", T.IntegerType())]
)

# The eight ports (name, latitude, longitude), in alphabetical order.
PORTS = [
    ("Alger", 36.7538, 3.0588),
    ("Barcelona", 41.3851, 2.1734),
    ("Casablanca", 33.5731, -7.5898),
    ("Genova", 44.4056, 8.9463),
    ("Marseille", 43.2965, 5.3698),
    ("Tanger", 35.7595, -5.8340),
    ("Tunis", 36.8065, 10.1815),
    ("Valencia", 39.4699, -0.3763),
]
PORT_SCHEMA = "port string, port_latitude double, port_longitude double"

# Engine states that raise an alert.
ALERT_ENGINE_STATES = ("maintenance_requise", "surchauffe")

# Severity and French label of each documented anomaly.
SEVERITY = {
    "LOW_FUEL": "moyen",
    "HIGH_TEMP": "eleve",
    "ABNORMAL_SPEED": "moyen",
    "LOST_SIGNAL": "eleve",
    "OFF_COURSE": "faible",
}
LABELS = {
    "LOW_FUEL": "Carburant critique",
    "HIGH_TEMP": "Moteur surchauffé",
    "ABNORMAL_SPEED": "Vitesse anormale",
}
OTHER_LABEL = "Autre anomalie"

# Our own choice (no figures are given anywhere): points per severity.
SEVERITY_POINTS = {"faible": 1, "moyen": 2, "eleve": 3}

# Our own choice (no figures are given anywhere): share of the speed kept in each weather.
WEATHER_SPEED_FACTOR = {
    "claire": 1.0,
    "nuageux": 1.0,
    "pluie_legere": 0.9375,
    "brouillard": 0.75,
    "tempete": 0.5,
}


@dataclass(frozen=True)
class OperatingRules:
    """Thresholds of the operating rules (all comparisons are strict)."""

    fuel_low: float = 10000.0
    speed_low: float = 5.0
    engine_normal: str = "normal"
    engine_label: str = "MOTEUR_ANOMALIE"


@dataclass(frozen=True)
class DocumentedRules:
    """Thresholds of the documented anomaly table."""

    fuel_capacity: float = 100000.0
    fuel_fraction: float = 0.2
    engine_temp_high: float = 85.0
    speed_low: float = 2.0
    speed_high: float = 25.0
    course_deviation: float = 20.0

    @property
    def fuel_low(self) -> float:
        return self.fuel_capacity * self.fuel_fraction


@dataclass(frozen=True)
class EtaRules:
    """Parameters of the adjusted arrival estimate."""

    safety_buffer: float = 0.0625
    weather_factor: dict = field(default_factory=lambda: dict(WEATHER_SPEED_FACTOR))


OPERATING = OperatingRules()
DOCUMENTED = DocumentedRules()
ETA = EtaRules()


def ports(spark: SparkSession) -> DataFrame:
    """The port dimension."""
    return spark.createDataFrame(PORTS, PORT_SCHEMA)
