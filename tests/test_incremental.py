"""Batch results kept up to date day by day, "now" from the listing, the published table."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from seawake import incremental, jobs
from seawake.operators import aggregates, alerts, anomalies, latest
from seawake.sources import messages, tables
from tests.helpers import rows_of, same

RESULTS = ("ship_statistics", "route_performance", "maintenance_prediction", "weather_impact", "temporal_analysis",
           "anomalies_detected", "ship_route_rollup")


def archived(df):
    rows = messages.enrich_time(df.withColumn("ts", F.col("ts").cast("timestamp")), processing_time=False)
    return rows.select(*tables.RAW_ARCHIVE.fieldNames())


def result(spark, root, name):
    return spark.read.parquet(f"{root}/analysis/{name}")


@pytest.fixture
def roots(spark, telemetry, tmp_path):
    """The archive without its last two days, as the incremental job sees it first, and the whole one."""
    rows = archived(telemetry)
    days = sorted(r.date for r in rows.select("date").distinct().collect())
    part, whole = str(tmp_path / "part"), str(tmp_path / "whole")
    tables.write_partitioned(rows.filter(F.col("date") < F.lit(days[-2])), f"{part}/raw_data")
    tables.write_partitioned(rows, f"{whole}/raw_data")
    return part, whole, rows, days


def check_equal(spark, part, whole):
    jobs.run_batch(spark, whole)
    for name in RESULTS:
        assert same(result(spark, part, name), result(spark, whole, name)), name
    raw = tables.read_raw(spark, f"{whole}/raw_data")
    assert same(result(spark, part, "latest_positions"), latest.latest_rows(raw, incremental.SNAPSHOT))


def test_only_changed_days_are_read(spark, roots):
    part, whole, rows, days = roots
    assert incremental.run_incremental(spark, part) == days[:-2]
    assert incremental.run_incremental(spark, part) == []
    for new in days[-2:]:
        tables.write_partitioned(rows.filter(F.col("date") == F.lit(new)), f"{part}/raw_data")
        changed, gone, _ = incremental.changed_days(spark, part)
        assert (changed, gone) == ([new], [])
        read = incremental.rows_of_days(spark, part, changed)
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*date#\d+", plan) and "DataFilters: []" in plan
        assert read.select("date").distinct().count() == 1
        assert incremental.run_incremental(spark, part) == [new]
    check_equal(spark, part, whole)


def test_late_rows_and_vanished_days(spark, roots):
    part, whole, rows, days = roots
    incremental.run_incremental(spark, part)
    late = rows.filter(F.col("date") == F.lit(days[3])).withColumn("event_id", F.col("event_id") + 10**6).withColumn(
        "carburant_litres", F.lit(17.0))
    gone = days[5]
    for root in (part, whole):
        late.write.mode("append").partitionBy("date").parquet(f"{root}/raw_data")
        tables.drop_days(spark, f"{root}/raw_data", [gone])
    tables.drop_days(spark, f"{whole}/raw_data", days[-2:])
    assert incremental.run_incremental(spark, part) == [days[3]]
    check_equal(spark, part, whole)
    assert not os.path.exists(f"{part}/analysis/anomalies_detected/date={gone}")


def test_a_failed_run_is_repeated(spark, roots, monkeypatch):
    part, whole, rows, days = roots
    with monkeypatch.context() as patch:
        patch.setattr(incremental, "_merged_weather", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.run_incremental(spark, part)
    tables.write_partitioned(rows.filter(F.col("date") >= F.lit(days[-2])), f"{part}/raw_data")
    assert incremental.run_incremental(spark, part) == days
    check_equal(spark, part, whole)


def test_merged_rollup(spark, telemetry):
    by_day = aggregates.ship_route_rollup(telemetry.withColumn("date", F.to_date("ts")), by=("date",))
    assert same(aggregates.merged_rollup(by_day), aggregates.ship_route_rollup(telemetry))


def test_row_counts_are_observed(spark, roots):
    _, whole, _, _ = roots
    names = jobs.run_batch(spark, whole)
    counts = {r.table: r.lignes for r in result(spark, whole, "table_counts").collect()}
    assert counts == {n: result(spark, whole, n).count() for n in names} and counts["anomalies_detected"] > 0


def test_now_reads_the_newest_day_only(spark, roots):
    _, whole, rows, days = roots
    path = f"{whole}/raw_data"
    os.makedirs(f"{path}/date={days[-1] + dt.timedelta(days=1)}")  # a folder without files
    assert tables.newest_day(spark, path) == days[-1]
    now = tables.newest_time(spark, path)
    raw = tables.read_raw(spark, path)
    recent = anomalies.alerts_recent(raw, as_of=now, date="date")
    assert same(recent, anomalies.alerts_recent(raw)) and recent.count() > 0
    plan = recent._jdf.queryExecution().executedPlan().toString()
    subquery = plan[plan.index("Subquery"):]
    assert re.search(rf"PartitionFilters: \[[^\]]*date#\d+ = {days[-1]}", subquery)
    assert tables.newest_day(spark, f"{whole}/none") is None


def test_published_days(spark, roots, tmp_path):
    _, whole, rows, days = roots
    target, name = str(tmp_path / "published"), "telemetry_published"
    try:
        for day in (days[0], days[1], days[0]):
            tables.close_day(spark, f"{whole}/raw_data", target, day, name)
        assert spark.sql(f"SHOW PARTITIONS {name}").count() == 2
        got = spark.sql(f"SELECT event_id, anomalies FROM {name} WHERE date = DATE '{days[1]}'")
        want = alerts.with_codes(rows.filter(F.col("date") == F.lit(days[1]))).select("event_id", "anomalies")
        assert same(got, want) and got.count() > 0
        found = spark.sql(f"SELECT count(*) AS n FROM {name} WHERE array_contains(anomalies, 'OFF_COURSE')").first().n
        assert found > 0
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_optional_fields_are_read_leniently(spark):
    body = '{"navire_id":"S","timestamp":"2024-01-01T00:00:00Z","vitesse_noeuds":1.0%s}'
    texts = [body % x for x in ("", ',"rpm_moteur":900.5', ',"rpm_moteur":"x","temperature_moteur_celsius":90',
                                ',"rpm_moteur":900,"temperature_moteur_celsius":NaN', ',"poids_cargo_tonnes":null')]
    from seawake.schemas import EXTENDED_MESSAGE

    parsed = messages.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"), EXTENDED_MESSAGE)
    got = {r.message: r for r in parsed.collect()}
    assert all(r.rejet is None for r in got.values())
    assert [(got[t].rpm_moteur, got[t].temperature_moteur_celsius, got[t].remarque) for t in texts] == [
        (None, None, None), (None, None, "rpm_moteur"), (None, 90.0, "rpm_moteur"),
        (900, None, "temperature_moteur_celsius"), (None, None, None)]
    assert messages.remarks(parsed).count() == 3 and messages.accepted(parsed).columns.count("remarque") == 0


def test_alerts_on_awkward_rows(spark):
    nan = float("nan")
    rows = rows_of(spark, {"navire_id": "A", "port_arrivee": "Nowhere"}, {"navire_id": "A", "cap_degres": None},
                   {"navire_id": "B", "latitude": nan}, {"navire_id": None, "carburant_litres": None})
    assert alerts.row_alerts(rows).filter("anomalie <> 'OFF_COURSE'").isEmpty()
    assert alerts.fleet_alerts(rows.limit(0)).isEmpty()
