"""Geodesic properties on random points."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seawake.functions import geo

latitude = st.floats(-80, 80, allow_nan=False)
longitude = st.floats(-179, 179, allow_nan=False)
points = st.lists(st.tuples(latitude, longitude, latitude, longitude, st.floats(0, 359.99), st.floats(0.1, 500)),
                  min_size=50, max_size=100)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(points)
def test_properties(spark, sample):
    A, B = (F.col("lat1"), F.col("lon1")), (F.col("lat2"), F.col("lon2"))
    df = spark.createDataFrame(sample, "lat1 double, lon1 double, lat2 double, lon2 double, course double, nm double")
    lat, lon = (geo.destination_latitude(A[0], F.col("course"), F.col("nm")),
                geo.destination_longitude(*A, F.col("course"), F.col("nm")))
    rows = df.select(
        geo.distance_nm(*A, *B).alias("there"), geo.distance_nm(*B, *A).alias("back"),
        geo.distance_nm(*A, *A).alias("zero"), geo.distance_nm_from_km(*A, *B).alias("km"),
        geo.bearing(*A, *B).alias("bearing"), geo.course_deviation(F.col("course"), geo.bearing(*A, *B)).alias("dev"),
        "nm", geo.distance_nm(*A, lat, lon).alias("run")).collect()
    for r in rows:
        assert r.zero == 0 and r.there >= 0
        assert math.isclose(r.there, r.back, rel_tol=1e-9, abs_tol=1e-6)
        assert math.isclose(r.there, r.km, rel_tol=1e-3, abs_tol=1e-6)
        assert 0 <= r.bearing < 360 and 0 <= r.dev <= 180
        assert math.isclose(r.run, r.nm, rel_tol=1e-6, abs_tol=1e-6)


def test_known_values(spark):
    geo.register_sql_functions(spark)
    row = spark.sql("""SELECT haversine_nm(35.7595, -5.8340, 43.2965, 5.3698) AS nm,
                              haversine_km_nm(35.7595, -5.8340, 43.2965, 5.3698) AS km,
                              bearing_deg(0D, 0D, 0D, 10D) AS east, course_deviation_deg(350D, 10D) AS wrap""").first()
    assert math.isclose(row.nm, 687.351264, abs_tol=1e-6)
    assert math.isclose(row.km, row.nm, rel_tol=1e-3)
    assert row.east == 90.0 and row.wrap == 20.0


def test_sql_and_column_forms_agree(spark, telemetry):
    geo.register_sql_functions(spark)
    columns = [F.col(c) for c in ("latitude", "longitude")]
    both = telemetry.select(
        geo.distance_nm(*columns, F.lit(40.0), F.lit(5.0)).alias("a"),
        F.expr("haversine_nm(latitude, longitude, 40D, 5D)").alias("b"),
        geo.bearing(*columns, F.lit(40.0), F.lit(5.0)).alias("c"),
        F.expr("bearing_deg(latitude, longitude, 40D, 5D)").alias("d"))
    assert both.filter("abs(a - b) > 1e-9 OR abs(c - d) > 1e-9").isEmpty()


def test_sector_and_clamp(spark):
    df = spark.createDataFrame([(0.0,), (22.49,), (22.5,), (337.49,), (337.5,), (359.9,)], "h double")
    rows = df.select(geo.compass_sector(F.col("h")).alias("s"), geo.clamp(F.col("h"), 10, 30).alias("c")).collect()
    assert [r.s for r in rows] == [0, 0, 1, 7, 0, 0]
    assert [r.c for r in rows] == [10.0, 22.49, 22.5, 30.0, 30.0, 30.0]
