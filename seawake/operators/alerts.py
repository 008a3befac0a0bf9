"""The five documented alerts in one output: four that hold on a row, and the lost signal, which needs a ship's silence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.functions import geo, rules as R
from seawake.operators import timeline
from seawake.operators.ports import with_port
from seawake.schemas import DOCUMENTED, SHIP, TIE, TIME, DocumentedRules

LOST_SIGNAL, OFF_COURSE = "LOST_SIGNAL", "OFF_COURSE"
COLUMNS = (SHIP, "timestamp", "anomalie", "severite", "description")


def documented_codes(df: DataFrame, rules: DocumentedRules = DOCUMENTED) -> Column:
    """Codes that hold on a row, in the documented order; ``df`` has the position of the destination."""
    course = geo.bearing(*[F.col(c) for c in ("latitude", "longitude", "port_latitude", "port_longitude")])
    off = F.when(R.is_off_course(course, rules), OFF_COURSE)
    return F.array_compact(F.concat(R.documented_anomalies(df.columns, rules), F.array(off)))


def with_codes(df: DataFrame, ports: DataFrame | None = None, rules: DocumentedRules = DOCUMENTED) -> DataFrame:
    """Adds ``anomalies``, the codes that hold on each row. An unknown destination or heading makes no OFF_COURSE."""
    placed = with_port(df, ports)
    return placed.withColumn("anomalies", documented_codes(placed, rules)).select(*df.columns, "anomalies")


def _described(alerts: DataFrame) -> DataFrame:
    code = F.col("anomalie")
    return alerts.withColumns({"severite": R.severity(code), "description": R.label(code)}).select(*COLUMNS)


def row_alerts(df: DataFrame, ports: DataFrame | None = None, rules: DocumentedRules = DOCUMENTED) -> DataFrame:
    """One row per alert that a message raises by itself."""
    codes = with_codes(df, ports, rules)
    return _described(codes.select(SHIP, F.col(TIME).alias("timestamp"), F.explode("anomalies").alias("anomalie")))


def lost_signal_alerts(lost: DataFrame) -> DataFrame:
    """Alerts of what ``timeline.signal_lost`` or its stream finds, dated at the moment the signal counts as lost."""
    return _described(lost.select(SHIP, F.col("signal_perdu_a").alias("timestamp"), F.lit(LOST_SIGNAL).alias("anomalie")))


def fleet_alerts(df: DataFrame, gap_seconds: int = 300, ports: DataFrame | None = None,
                 rules: DocumentedRules = DOCUMENTED, as_of: Column | None = None) -> DataFrame:
    """All five alerts of a bounded table. A ship silent at the end counts as lost once ``as_of`` is far enough on."""
    rows = df.select(*[c for c in df.columns if c in _NEEDED])
    return row_alerts(rows, ports, rules).unionByName(
        lost_signal_alerts(timeline.signal_lost(df.select(SHIP, TIE, TIME), gap_seconds, as_of)))


_NEEDED = (SHIP, TIE, TIME, "latitude", "longitude", "cap_degres", "vitesse_noeuds", "carburant_litres", "port_arrivee",
           "temperature_moteur_celsius")
