"""Maps query names to library calls, and to the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle.sql import ORACLE
from seawake import session
from seawake.operators import aggregates as agg
from seawake.operators import alerts
from seawake.operators import anomalies as anom
from seawake.operators import eta, latest, ports, timeline, windows
from seawake.plans import reports
from seawake.schemas import EXTENDED_MESSAGE, SHIP, TIE, TIME
from seawake.sources import events, messages, tables
from seawake.streaming import io, queries as streams

try:  # the training-data operators are an optional part
    import corpus_pipeline
    from seawake.llm import registry as llm
except ImportError:
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
HALF_DAY = 12 * 3600
SIX_HOURS = 6 * 3600

Query = Callable[[SparkSession, str], DataFrame]


def _on_telemetry(build: Callable[[DataFrame], DataFrame], extended: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(events.read_telemetry(session.prepare(spark), sf_dir, extended))
    return run


def _round(df: DataFrame, *columns: str) -> DataFrame:
    """Trigonometric and order-dependent figures are compared to six digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP back to TIMESTAMP_NTZ, the type of the given tables."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df


def _on_stream(build: Callable[[DataFrame], DataFrame], partitions: tuple[str, ...] = (),
               extended: bool = False, copies: int = 1) -> Query:
    """Runs a streaming query over the whole table to its end and reads its sink.

    ``copies`` is the number of windows that hold a row.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.prepare(spark)
        root = session.shared_dir(spark, "stream")
        rows = events.read_events(spark, sf_dir).count()  # from the files' footers
        query = io.write_stream(build(io.event_telemetry(spark, sf_dir, extended=extended)), "out", root,
                                partitions=partitions, trigger=io.ONCE,
                                state_partitions=io.stores_for(spark, copies * rows))
        query.awaitTermination()
        return _ntz(spark.read.parquet(f"{root}/out"))
    return run


def _with_date(df: DataFrame) -> DataFrame:
    return messages.enrich_time(df, processing_time=False)


def _json_ingest(t: DataFrame) -> DataFrame:
    rows = messages.accepted(messages.parse_messages(messages.tracking_messages(t)))
    return _ntz(_with_date(rows)).drop("timestamp", TIE)


def _json_roundtrip(t: DataFrame) -> DataFrame:
    sent = messages.tracking_messages(t).withColumn("data", F.from_json("value", messages.TELEMETRY_MESSAGE))
    return sent.select("key", "topic", "data.*")


def _enrich_time(t: DataFrame) -> DataFrame:
    text = t.select(TIE, SHIP, messages.iso_text(F.col(TIME)).alias("timestamp"))
    return _ntz(_with_date(text.withColumn(TIME, F.try_to_timestamp("timestamp"))))


def _to_messages(t: DataFrame) -> DataFrame:
    field = {"type": "string", "message": "string", "timestamp": "string", "latitude": "double",
             "longitude": "double", "vitesse_noeuds": "double"}
    return messages.to_messages(t).select(
        "key", "topic", *[F.get_json_object("value", f"$.{n}").cast(kind).alias(n) for n, kind in field.items()])


def _pruned_hourly_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archive by date and hour, then reads a range of partitions."""
    import datetime as dt

    rows = _with_date(events.read_telemetry(session.prepare(spark), sf_dir)).select(
        TIE, TIME, SHIP, "vitesse_noeuds", "date", "hour")
    path = session.shared_dir(spark, "archive")
    tables.write_partitioned(rows, path, ["date", "hour"])
    archive = tables.read_raw(spark, path, T.StructType(
        [f for f in rows.schema.fields if f.name not in ("date", "hour")]
        + [T.StructField("date", T.DateType()), T.StructField("hour", T.IntegerType())]))
    days = tables.between_dates(archive, dt.date(2024, 1, 8), dt.date(2024, 1, 14))
    return days.filter(F.col("hour").between(6, 11))


def _archive_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to the archive on disk, and the alerts of its last day; "now" comes from the newest partition."""
    sent = messages.tracking_messages(events.read_telemetry(session.prepare(spark), sf_dir, extended=True),
                                      schema=EXTENDED_MESSAGE)
    path = session.shared_dir(spark, "archive")
    tables.write_partitioned(io.telemetry(sent).select(*tables.RAW_ARCHIVE.fieldNames()), path)
    now = tables.newest_time(spark, path)
    recent = anom.recent(tables.read_raw(spark, path), days=1, as_of=now, date="date")
    return _ntz(alerts.row_alerts(recent))


def _table_counts(t: DataFrame) -> DataFrame:
    return agg.table_counts({
        "raw_telemetry": t,
        "ship_statistics": agg.ship_statistics(t),
        "route_performance": agg.route_performance(t),
        "weather_impact": agg.weather_impact(t),
        "maintenance_prediction": agg.maintenance_prediction(t),
        "anomalies": anom.anomalies_detected(t),
        "eta_predictions": eta.eta_predictions(t),
    })


def _urgent(days: int) -> Callable[[DataFrame], DataFrame]:
    return lambda t: anom.urgent_maintenance(t, days=days).withColumn(
        "types_anomalies", F.array_join("types_anomalies", ","))


def _daily_fuel(t: DataFrame) -> DataFrame:
    return _round(timeline.daily_fuel(t), "distance_nm", "litres_par_100nm")


def _eta_tied(t: DataFrame) -> DataFrame:
    return eta.eta_predictions(t, keep=(TIE,))


def entry(spark: SparkSession) -> DataFrame:
    return agg.ship_statistics(events.read_telemetry(session.prepare(spark), SMOKE_DIR))


def queries() -> dict[str, Query]:
    optional = {} if llm is None else {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    return _telemetry_queries() | optional


def _telemetry_queries() -> dict[str, Query]:
    on, ext = _on_telemetry, lambda build: _on_telemetry(build, extended=True)
    return {
        # scans, messages, tables
        "telemetry_scan": on(lambda t: t),
        "enrich_time": on(_enrich_time),
        "json_ingest": on(_json_ingest),
        "json_roundtrip": on(_json_roundtrip),
        "to_messages": on(_to_messages),
        "route_by_anomaly": ext(lambda t: messages.route_by_anomaly(anom.anomaly_array(t)).select("key", "topic")),
        "pruned_hourly_scan": _pruned_hourly_scan,
        "table_counts": on(_table_counts),
        # anomalies and alerts
        "anomalies_detected": on(anom.anomalies_detected),
        "anomaly_summary": on(lambda t: anom.anomaly_summary(anom.anomalies_detected(t))),
        "anomaly_counts": on(lambda t: anom.anomaly_counts(anom.anomalies_detected(t))),
        "anomaly_type_counts": on(lambda t: anom.anomaly_counts(anom.anomalies_detected(t), "type_anomalie")),
        "top_anomaly_ships": on(lambda t: reports.top_anomaly_ships(anom.anomalies_detected(t))),
        "alert_pivot": on(lambda t: reports.alert_pivot_report(anom.alert_pivot(anom.anomalies_detected(t)))),
        "alert_fanout": on(anom.alert_fanout),
        "anomaly_array": ext(lambda t: anom.anomaly_array(t).select(
            TIE, SHIP, F.array_join("anomalies", ",").alias("anomalies"), F.size("anomalies").alias("nombre"),
            F.array_contains("anomalies", "LOW_FUEL").alias("carburant_bas"))),
        "anomaly_severity": ext(lambda t: anom.documented_alerts(t).select(TIE, SHIP, "anomalie", "severite")),
        "alerts_recent": ext(anom.alerts_recent),
        "alerts_per_hour": ext(anom.alerts_per_hour),
        "anomaly_distribution": ext(anom.anomaly_distribution),
        "urgent_maintenance": ext(_urgent(1)),
        "urgent_maintenance_30d": ext(_urgent(30)),
        "active_alerts": ext(anom.active_alerts),
        "fleet_alerts": ext(lambda t: alerts.fleet_alerts(t, HALF_DAY)),
        "alert_codes": ext(lambda t: alerts.with_codes(t).select(
            TIE, SHIP, F.array_join("anomalies", ",").alias("anomalies"))),
        "archive_alerts": _archive_alerts,
        # batch analyses
        "ship_statistics": on(agg.ship_statistics),
        "route_performance": on(agg.route_performance),
        "temporal_analysis": on(agg.temporal_analysis),
        "weather_impact": on(agg.weather_impact),
        "maintenance_prediction": on(agg.maintenance_prediction),
        "fleet_stats": ext(agg.fleet_stats),
        "low_fuel_counts": on(agg.low_fuel_counts),
        "route_efficiency": on(lambda t: _round(agg.route_efficiency(agg.voyages(t)),
                                                "efficacite_moyenne", "temps_moyen")),
        "ship_vs_route": on(agg.ship_vs_route),
        "ship_rank_in_route": on(lambda t: agg.ship_rank_in_route(agg.ship_statistics(t))),
        "fleet_kpis": on(lambda t: _round(agg.fleet_kpis(t), "vitesse_moyenne")),
        "speed_histogram": on(agg.speed_histogram),
        "speed_fuel_corr": on(lambda t: _round(agg.speed_fuel_corr(t), "correlation")),
        "ship_quartiles": on(agg.ship_quartiles),
        "traffic_grid": on(agg.traffic_grid),
        # latest state
        "latest_positions": on(latest.latest_positions),
        "latest_eta": on(lambda t: latest.latest_with_ties(eta.eta_predictions(t), time="timestamp")),
        "current_positions": ext(latest.current_positions),
        # time line
        "fuel_drops": on(timeline.fuel_drops),
        "signal_gaps": on(timeline.signal_gaps),
        "signal_lost": on(timeline.signal_lost),
        "signal_lost_12h": on(lambda t: timeline.signal_lost(t, HALF_DAY)),
        "rolling_speed": on(timeline.rolling_speed),
        "rolling_speed_12h": on(lambda t: timeline.rolling_speed(t, HALF_DAY)),
        "running_fuel": on(timeline.running_fuel),
        "distance_travelled": on(lambda t: _round(timeline.distance_travelled(t), "distance_nm")),
        "daily_fuel": on(_daily_fuel),
        # windows
        "window_stats": on(windows.window_stats),
        "window_stats_6h": on(lambda t: windows.window_stats(t, SIX_HOURS)),
        "window_distance": on(lambda t: _round(windows.window_distance(t), "distance_nm")),
        "window_distance_6h": on(lambda t: _round(windows.window_distance(t, SIX_HOURS), "distance_nm")),
        "dominant_direction": on(lambda t: windows.dominant_direction(t, SIX_HOURS)),
        "window_alert_score": ext(lambda t: windows.window_alert_score(t, SIX_HOURS)),
        "window_efficiency": on(lambda t: _round(windows.window_efficiency(t, SIX_HOURS),
                                                 "distance_nm", "efficacite_nm_par_litre")),
        # positions and arrivals
        "distance_to_port": on(lambda t: _round(ports.distance_to_port(t), "distance_port_nm")),
        "distance_to_port_km": on(lambda t: _round(ports.distance_to_port(t, in_km=True), "distance_port_nm")),
        "bearing_to_port": on(lambda t: _round(ports.bearing_to_port(t), "cap_port_degres")),
        "projected_position": on(lambda t: _round(ports.projected_position(t),
                                                  "latitude_projetee", "longitude_projetee")),
        "off_course": on(lambda t: _round(ports.off_course(t), "deviation_degres")),
        "eta_predictions": on(eta.eta_predictions),
        "eta_adjusted": on(eta.eta_adjusted),
        # reports
        "fastest_ships": on(lambda t: reports.fastest_ships(agg.ship_statistics(t))),
        "busiest_routes": on(lambda t: reports.busiest_routes(agg.route_performance(t))),
        "ships_to_watch": on(reports.ships_to_watch),
        "maintenance_urgent_report": on(lambda t: reports.maintenance_urgent_report(agg.maintenance_prediction(t))),
        "weather_report": on(lambda t: reports.weather_report(agg.weather_impact(t))),
        "route_efficiency_report": on(lambda t: reports.route_efficiency_report(agg.route_performance(t))),
        "next_arrivals": on(lambda t: reports.next_arrivals(_eta_tied(t))),
        "next_arrivals_5": on(lambda t: reports.next_arrivals(_eta_tied(t), 5)),
        "fleet_overview": on(reports.fleet_overview),
        "ship_ranking": on(lambda t: reports.ship_ranking(agg.ship_statistics(t))),
        "fleet_status": ext(lambda t: reports.fleet_status(latest.current_positions(t))),
        "fastest_routes": on(lambda t: reports.fastest_routes(agg.route_performance(t))),
        "top_ships": on(lambda t: reports.top_ships(agg.ship_statistics(t))),
        "top_routes": on(lambda t: reports.top_routes(agg.route_performance(t))),
        "top_routes_5": on(lambda t: reports.top_routes(agg.route_performance(t), 5)),
        "priority_counts": on(lambda t: reports.priority_counts(agg.maintenance_prediction(t))),
        "maintenance_alerts": on(lambda t: reports.maintenance_alerts(agg.maintenance_prediction(t))),
        "speed_series": on(reports.speed_series),
        "recent_positions": on(reports.recent_positions),
        "trajectory_sample": on(reports.trajectory_sample),
        # streams
        "stream_raw": _on_stream(lambda t: _with_date(streams.raw(t)), ("date",)),
        "stream_window_stats": _on_stream(streams.window_stats),
        "stream_window_stats_6h": _on_stream(lambda t: streams.window_stats(t, SIX_HOURS)),
        "stream_anomalies": _on_stream(streams.detected_anomalies),
        "stream_eta": _on_stream(streams.eta_predictions),
        "stream_alerts": _on_stream(lambda t: streams.alerts(t).select(
            "key", "topic", F.get_json_object("value", "$.message").alias("message"),
            F.get_json_object("value", "$.timestamp").alias("timestamp"))),
        "stream_signal_lost": _on_stream(lambda t: streams.signal_lost(t, HALF_DAY)),
        "stream_window_distance": _on_stream(lambda t: _round(streams.window_distance(t, SIX_HOURS), "distance_nm")),
        "stream_window_alert_score": _on_stream(lambda t: streams.window_alert_score(t, SIX_HOURS), extended=True),
        "stream_eta_adjusted": _on_stream(streams.eta_adjusted, copies=eta.OVERLAP),
        "stream_fleet_alerts": _on_stream(lambda t: streams.fleet_alerts(t, HALF_DAY), extended=True),
        "stream_dominant_direction": _on_stream(lambda t: streams.dominant_direction(t, SIX_HOURS)),
        "stream_window_efficiency": _on_stream(lambda t: _round(
            streams.window_efficiency(t, SIX_HOURS), "distance_nm", "efficacite_nm_par_litre")),
    }


def oracle_sql() -> dict[str, str]:
    optional = {} if llm is None else dict(llm.ORACLE)
    if llm is not None and corpus_pipeline.ORACLE_SQL:
        optional["pipeline"] = corpus_pipeline.ORACLE_SQL
    return ORACLE | optional
