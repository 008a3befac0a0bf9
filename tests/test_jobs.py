"""Messages to archive to analyses to reports, through the jobs; tables and DDL."""

import csv
import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from seawake import jobs
from seawake.operators import aggregates
from seawake.plans import reports, views
from seawake.sources import messages, tables
from seawake.streaming import io
from tests.helpers import rows_of, same


@pytest.fixture(scope="module")
def root(spark, telemetry, tmp_path_factory):
    """The whole chain once: message files -> streaming job -> batch job."""
    base = tmp_path_factory.mktemp("root")
    inbox = str(base / "inbox")
    messages.tracking_messages(telemetry).select("value").repartition(2).write.text(inbox)
    source = io.message_source(spark, "files", path=inbox)
    for query in jobs.run_streaming(spark, source, str(base), slow=io.ONCE, fast=io.ONCE):
        query.awaitTermination()
    assert len(jobs.run_batch(spark, str(base))) == 6
    return str(base)


def test_archive_is_complete(spark, root, telemetry):
    raw = tables.read_raw(spark, f"{root}/raw_data")
    assert raw.count() == telemetry.count()
    assert spark.read.parquet(f"{root}/eta_predictions").count() == telemetry.filter("distance_restante_nm > 0").count()
    assert not os.path.exists(f"{root}/rejects") or spark.read.parquet(f"{root}/rejects").isEmpty()


def test_written_analyses_equal_direct_ones(spark, root, telemetry):
    assert same(spark.read.parquet(f"{root}/analysis/ship_statistics"), aggregates.ship_statistics(telemetry))
    assert same(spark.read.parquet(f"{root}/analysis/temporal_analysis"), aggregates.temporal_analysis(telemetry))


def test_batch_job_can_run_again(spark, root):
    before = spark.read.parquet(f"{root}/analysis/weather_impact").collect()
    jobs.run_batch(spark, root)
    assert sorted(spark.read.parquet(f"{root}/analysis/weather_impact").collect()) == sorted(before)


def test_reports(spark, root, telemetry):
    made = jobs.report_tables(spark, root)
    assert len(made) == 11 and all(not df.isEmpty() for df in made.values())
    assert same(made["fastest_ships"], reports.fastest_ships(aggregates.ship_statistics(telemetry)))
    assert made["alert_pivot"].agg(F.sum("moteur")).first()[0] > 0


def test_views_answer_sql(spark, root):
    views.register_views(spark, root)
    one_per_ship = spark.sql("""
        SELECT count(*) AS n FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY navire_id ORDER BY timestamp DESC) AS rn FROM raw_telemetry) t
        WHERE rn = 1""").first().n
    assert one_per_ship == 15
    for view in ("ship_statistics", "route_performance", "weather_impact", "maintenance_prediction", "anomalies",
                 "raw_telemetry", "eta_predictions", "v_current_positions", "v_route_efficiency"):
        assert spark.sql(f"SELECT count(*) AS n FROM {view}").first().n > 0
    for view in ("v_ships_requiring_attention", "v_active_alerts", "v_maintenance_alerts"):
        spark.sql(f"SELECT * FROM {view}").collect()
    joined = spark.sql("""SELECT s.navire_id, s.vitesse_moyenne - r.vitesse_moyenne_route AS ecart
        FROM ship_statistics s JOIN route_performance r USING (port_depart, port_arrivee)""")
    assert joined.count() == 15


def test_date_filter_prunes_partitions(spark, root):
    raw = tables.read_raw(spark, f"{root}/raw_data")
    day = dt.date(2024, 1, 10)
    one = tables.between_dates(raw, day, day)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "DataFilters: []" in plan
    assert one.count() == raw.filter(F.to_date("ts") == F.lit(day)).count() > 0


def test_recent_rows_prune_partitions(spark, root):
    from seawake.operators import anomalies

    raw = tables.read_raw(spark, f"{root}/raw_data")
    plan = anomalies.recent(raw, days=1, date="date")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= cast\(", plan)
    assert anomalies.recent(raw, days=1).count() > 0


def test_compaction(spark, root, tmp_path):
    day, target = dt.date(2024, 1, 10), str(tmp_path / "compact")
    for _ in range(2):
        tables.compact_day(spark, f"{root}/raw_data", target, day)
    part = f"{target}/date=2024-01-10"
    assert len(glob.glob(f"{part}/*.parquet")) == 1
    raw = tables.read_raw(spark, f"{root}/raw_data")
    assert same(tables.read_raw(spark, target), tables.between_dates(raw, day, day))
    with pytest.raises(ValueError):
        tables.compact_day(spark, target, target + "/", day)


def test_partition_overwrite_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = rows_of(spark, {}, {"ts": dt.datetime(2024, 1, 2)})
    dated = messages.enrich_time(rows, processing_time=False)
    tables.write_partitioned(dated, path)
    tables.write_partitioned(dated.filter("event_id = 1").withColumn("meteo", F.lit("tempete")), path)
    found = {r.event_id: r.meteo for r in spark.read.parquet(path).collect()}
    assert found == {0: "claire", 1: "tempete"}


def test_external_table(spark, tmp_path):
    path = str(tmp_path / "ext")
    dated = messages.enrich_time(rows_of(spark, {}, {"ts": dt.datetime(2024, 1, 2, 5)}), processing_time=False)
    tables.write_partitioned(dated, path, ["date", "hour"])
    tables.create_table(spark, "raw_ext", path, dated.schema, ["date", "hour"])
    try:
        assert spark.sql("SHOW PARTITIONS raw_ext").count() == 2
        assert spark.sql("SELECT event_id FROM raw_ext WHERE date = DATE '2024-01-02' AND hour = 5").first().event_id == 1
    finally:
        spark.sql("DROP TABLE raw_ext")
    assert os.path.exists(path)


def test_csv_export(spark, tmp_path):
    path = str(tmp_path / "csv")
    tables.export_csv(rows_of(spark, {}, {}).select("navire_id", "event_id"), path)
    lines = [row for f in glob.glob(f"{path}/*.csv") for row in csv.DictReader(open(f))]
    assert sorted(r["event_id"] for r in lines) == ["0", "1"]


def test_empty_archive_stops_the_batch_job(spark, tmp_path):
    base = str(tmp_path / "none")
    messages.enrich_time(rows_of(spark, {}), False).limit(0).drop("date").write.parquet(f"{base}/raw_data")
    assert jobs.run_batch(spark, base) == []
    assert not os.path.exists(f"{base}/analysis")


def test_command_line(spark, root, capsys):
    jobs.main(["batch", "--root", root])
    assert "ship_statistics" in capsys.readouterr().out
    jobs.main(["reports", "--root", root])
    assert "== ship_ranking" in capsys.readouterr().out


def test_command_line_streams_and_compacts(spark, telemetry, tmp_path):
    inbox, base = str(tmp_path / "inbox"), str(tmp_path / "root")
    messages.tracking_messages(telemetry).select("value").write.text(inbox)
    jobs.main(["stream", "--root", base, "--messages", inbox, "--once", "--console"])
    jobs.main(["compact", "--root", base, "--day", "2024-01-02", "--target", f"{base}/compact"])
    assert os.path.isdir(f"{base}/compact/date=2024-01-02")


def test_kafka_needs_its_connector(spark):
    from pyspark.errors import AnalysisException

    try:
        source = io.message_source(spark, "kafka", brokers="localhost:1", topic="t")
    except AnalysisException as error:
        assert "kafka" in str(error).lower()
    else:
        assert {"key", "value", "topic"} <= set(source.columns)
