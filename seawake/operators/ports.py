"""Operators that relate a position to a port."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake import schemas
from seawake.functions import geo
from seawake.functions.rules import is_off_course
from seawake.schemas import DOCUMENTED, SHIP, TIE, TIME, DocumentedRules


def with_port(df: DataFrame, ports: DataFrame | None = None, on: str = "port_arrivee") -> DataFrame:
    """Adds the position of the port named in ``on``.

    The built-in dimension has a fixed eight rows and is broadcast. A table
    given by the caller has no known size, so the join strategy is left to
    Spark's own size check.
    """
    side = F.broadcast(schemas.ports(df.sparkSession)) if ports is None else ports
    return df.join(side.withColumnRenamed("port", on), on, "left")


def _here_to_port():
    return F.col("latitude"), F.col("longitude"), F.col("port_latitude"), F.col("port_longitude")


def distance_to_port(df: DataFrame, ports: DataFrame | None = None, in_km: bool = False) -> DataFrame:
    measure = geo.distance_nm_from_km if in_km else geo.distance_nm
    rows = with_port(df.select(SHIP, TIE, TIME, "latitude", "longitude", "port_arrivee"), ports)
    return rows.select(SHIP, TIE, TIME, "port_arrivee", measure(*_here_to_port()).alias("distance_port_nm"))


def bearing_to_port(df: DataFrame, ports: DataFrame | None = None) -> DataFrame:
    rows = with_port(df.select(SHIP, TIE, TIME, "latitude", "longitude", "port_arrivee"), ports)
    return rows.select(SHIP, TIE, TIME, "port_arrivee", geo.bearing(*_here_to_port()).alias("cap_port_degres"))


def off_course(df: DataFrame, ports: DataFrame | None = None, rules: DocumentedRules = DOCUMENTED) -> DataFrame:
    """Rows whose heading is off the course to the destination by more than the allowed angle."""
    rows = with_port(
        df.select(SHIP, TIE, TIME, "latitude", "longitude", "cap_degres", "port_arrivee"), ports)
    course = geo.bearing(*_here_to_port())
    return (
        rows.filter(is_off_course(course, rules))
        .select(SHIP, TIE, TIME, "port_arrivee", "cap_degres",
                geo.course_deviation(F.col("cap_degres"), course).alias("deviation_degres"))
    )


def projected_position(df: DataFrame, minutes: float = 1.0) -> DataFrame:
    """Dead reckoning: where a ship is after so many minutes at its (clamped) speed and heading."""
    speed = geo.clamp(F.col("vitesse_noeuds"), 10.0, 30.0)
    run = speed * F.lit(minutes / 60.0)
    lat, lon, heading = F.col("latitude"), F.col("longitude"), F.col("cap_degres")
    return df.select(
        SHIP, TIE, TIME, speed.alias("vitesse_bornee"),
        geo.destination_latitude(lat, heading, run).alias("latitude_projetee"),
        geo.destination_longitude(lat, lon, heading, run).alias("longitude_projetee"),
    )
