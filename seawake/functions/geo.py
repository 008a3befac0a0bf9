"""Geodesic functions as Column expressions and as SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Earth radius in nautical miles; in kilometres with its factor to nautical miles.
EARTH_RADIUS_NM = 3440.065
EARTH_RADIUS_KM = 6371.0
KM_TO_NM = 0.539957


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Squared half chord between two points on the unit sphere."""
    s_lat = F.sin(F.radians(lat2 - lat1) / 2.0)
    s_lon = F.sin(F.radians(lon2 - lon1) / 2.0)
    return s_lat * s_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s_lon * s_lon


def distance_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in nautical miles."""
    h = _half_chord(lat1, lon1, lat2, lon2)
    return F.lit(2.0 * EARTH_RADIUS_NM) * F.atan2(F.sqrt(h), F.sqrt(1.0 - h))


def distance_nm_from_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                        radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance measured in kilometres, given in nautical miles."""
    h = _half_chord(lat1, lon1, lat2, lon2)
    return F.lit(2.0 * radius_km * KM_TO_NM) * F.asin(F.sqrt(h))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial course from the first point to the second, 0 <= x < 360."""
    phi1, phi2, dlon = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    east = F.sin(dlon) * F.cos(phi2)
    north = F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def course_deviation(heading: Column, course: Column) -> Column:
    """Smallest angle between two courses, 0..180."""
    return F.abs(F.pmod(heading - course + 180.0, F.lit(360.0)) - 180.0)


def destination_latitude(lat: Column, course: Column, nm: Column) -> Column:
    arc, phi = nm / EARTH_RADIUS_NM, F.radians(lat)
    return F.degrees(F.asin(
        F.sin(phi) * F.cos(arc) + F.cos(phi) * F.sin(arc) * F.cos(F.radians(course))))


def destination_longitude(lat: Column, lon: Column, course: Column, nm: Column) -> Column:
    arc, phi, theta = nm / EARTH_RADIUS_NM, F.radians(lat), F.radians(course)
    sin_phi2 = F.sin(phi) * F.cos(arc) + F.cos(phi) * F.sin(arc) * F.cos(theta)
    return lon + F.degrees(F.atan2(
        F.sin(theta) * F.sin(arc) * F.cos(phi), F.cos(arc) - F.sin(phi) * sin_phi2))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def compass_sector(heading: Column, sectors: int = 8) -> Column:
    """Index of the compass sector that holds a heading; sector 0 is centred on north."""
    width = 360.0 / sectors
    sector = F.floor(F.pmod(heading + width / 2.0, F.lit(360.0)) / width).cast("int")
    return F.when(F.abs(heading) < F.lit(float("inf")), sector)


def register_sql_functions(spark: SparkSession) -> None:
    """Make the geodesic functions usable from SQL text, without a Python worker."""
    points = "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE"
    half_chord = (
        "(sin(radians(lat2 - lat1) / 2) * sin(radians(lat2 - lat1) / 2)"
        " + cos(radians(lat1)) * cos(radians(lat2))"
        " * sin(radians(lon2 - lon1) / 2) * sin(radians(lon2 - lon1) / 2))"
    )
    bodies = {
        "haversine_nm": (points, f"{2.0 * EARTH_RADIUS_NM}D * atan2(sqrt({half_chord}), sqrt(1 - {half_chord}))"),
        "haversine_km_nm": (points, f"{2.0 * EARTH_RADIUS_KM * KM_TO_NM}D * asin(sqrt({half_chord}))"),
        "bearing_deg": (points, (
            "pmod(degrees(atan2(sin(radians(lon2 - lon1)) * cos(radians(lat2)),"
            " cos(radians(lat1)) * sin(radians(lat2))"
            " - sin(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2 - lon1)))), 360D)")),
        "course_deviation_deg": ("heading DOUBLE, course DOUBLE",
                                 "abs(pmod(heading - course + 180D, 360D) - 180D)"),
    }
    for name, (args, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS DOUBLE RETURN {body}")
