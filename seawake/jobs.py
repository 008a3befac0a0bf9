"""The batch job, the streaming job, compaction and the report run.

    python -m seawake.jobs batch   --root <path> [--incremental]
    python -m seawake.jobs stream  --root <path> --brokers <host:port>
    python -m seawake.jobs reports --root <path>
    python -m seawake.jobs compact --root <path> --day 2024-01-31 --target <path>
    python -m seawake.jobs close   --root <path> --day 2024-01-31 --target <path> --table <name>
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from seawake import incremental, session
from seawake.operators import aggregates, anomalies
from seawake.plans import reports, views
from seawake.schemas import EXTENDED_MESSAGE, TIE
from seawake.sources import messages, tables
from seawake.streaming import io, queries
from seawake.streaming.supervision import ProgressLog, supervise


ROLLUP = "ship_route_rollup"


def run_batch(spark: SparkSession, root: str) -> list[str]:
    """Writes the six analyses of ``root``/raw_data; returns their names, none for an empty archive.

    The raw rows are read four times, a few columns each, and are not cached:
    one pass writes the rollup per ship and route, which is read back for the
    three analyses that follow from it. The results' row counts are observed as
    they are written (``table_counts``). ``incremental.run_incremental`` gives
    the same results from the days that changed.
    """
    raw = tables.read_raw(spark, f"{root}/raw_data")
    if raw.isEmpty():
        return []
    folder = f"{root}/analysis"
    tables.write_analysis(aggregates.ship_route_rollup(raw), f"{folder}/{ROLLUP}")
    rollup = spark.read.parquet(f"{folder}/{ROLLUP}")
    results = {
        "ship_statistics": aggregates.ship_statistics_of(rollup),
        "route_performance": aggregates.route_performance_of(rollup),
        "maintenance_prediction": aggregates.maintenance_prediction_of(rollup),
        "weather_impact": aggregates.weather_impact(raw),
    }
    by_day = {"anomalies_detected": anomalies.anomalies_by_day(raw), "temporal_analysis": aggregates.temporal_analysis(raw)}
    rows = {}
    for name, df in (results | by_day).items():
        df, seen = tables.counted(df)
        if name in by_day:
            tables.write_partitioned(df, f"{folder}/{name}", whole=True)
        else:
            tables.write_analysis(df, f"{folder}/{name}")
        rows[name] = seen.get["lignes"]
    tables.write_analysis(spark.createDataFrame(list(rows.items()), "`table` string, lignes long"), f"{folder}/table_counts")
    return list(rows)


def report_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The ten reports and the fleet figures over the written tables, by name."""
    t = views.load_tables(spark, root)
    tie = TIE if TIE in t["eta_predictions"].columns else None
    return {
        "fastest_ships": reports.fastest_ships(t["ship_statistics"]),
        "busiest_routes": reports.busiest_routes(t["route_performance"]),
        "ships_to_watch": reports.ships_to_watch(t["raw_telemetry"]),
        "maintenance_urgent_report": reports.maintenance_urgent_report(t["maintenance_prediction"]),
        "weather_report": reports.weather_report(t["weather_impact"]),
        "route_efficiency_report": reports.route_efficiency_report(t["route_performance"]),
        "alert_pivot": reports.alert_pivot_report(anomalies.alert_pivot(t["anomalies"])),
        "next_arrivals": reports.next_arrivals(t["eta_predictions"], tie=tie),
        "fleet_overview": reports.fleet_overview(t["raw_telemetry"]),
        "ship_ranking": reports.ship_ranking(t["ship_statistics"]),
        "fleet_kpis": aggregates.fleet_kpis_of(spark.read.parquet(f"{root}/analysis/{ROLLUP}")),
    }


def streams(source: DataFrame, root: str, *, slow: str = "1 minute", fast: str = "30 seconds", console: bool = False,
            alert_brokers: str | None = None) -> dict[str, Callable[[], StreamingQuery]]:
    """One function per sink that starts its query from a message source: raw archive, windows, anomalies, the five
    documented alerts, arrivals (plain and adjusted), path, direction, efficiency and alert score per window, rejects.

    Each query keeps its own offsets and checkpoint, so one that fails restarts
    without touching the others. Raw files are partitioned by date only:
    a partition per ship and minute would drown the file system in small files
    (``compact`` merges a finished day).
    """
    rows = io.telemetry(source)
    archive = rows.select(*tables.RAW_ARCHIVE.fieldNames())
    parsed = messages.parse_messages(source, EXTENDED_MESSAGE)
    stores = io.one_store_per_core(source.sparkSession)

    def to(df: DataFrame, name: str, trigger: str, **more) -> tuple[str, Callable[[], StreamingQuery]]:
        return name, partial(io.write_stream, df, name, root, trigger=trigger, **more)

    starts = [
        to(archive, "raw_data", slow, partitions=["date"]),
        to(queries.window_stats(rows), "aggregated", slow, state_partitions=stores),
        to(queries.detected_anomalies(rows), "anomalies", fast),
        to(queries.fleet_alerts(rows), "fleet_alerts", fast, state_partitions=stores),
        to(queries.eta_predictions(rows), "eta_predictions", slow),
        to(queries.eta_adjusted(rows), "eta_adjusted", slow, state_partitions=stores),
        to(queries.window_distance(rows), "window_distance", slow, state_partitions=stores),
        to(queries.dominant_direction(rows), "window_direction", slow, state_partitions=stores),
        to(queries.window_efficiency(rows), "window_efficiency", slow, state_partitions=stores),
        to(queries.window_alert_score(rows), "window_alert_score", slow, state_partitions=stores),
        to(messages.rejected(parsed), "rejects", slow),
        to(messages.remarks(parsed), "remarks", slow),
    ]
    if console:
        starts.append(to(rows, "console_output", fast, kind="console"))
    if alert_brokers:
        starts.append(to(queries.alerts(rows), "alerts", fast, kind="kafka", brokers=alert_brokers))
    return dict(starts)


def run_streaming(spark: SparkSession, source: DataFrame, root: str, **options) -> list[StreamingQuery]:
    """Starts all of :func:`streams`."""
    return [start() for start in streams(source, root, **options).values()]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["batch", "stream", "reports", "compact", "close"])
    parser.add_argument("--root", required=True, help="folder that holds raw_data and the results")
    parser.add_argument("--brokers", default="localhost:9092")
    parser.add_argument("--topic", default=messages.TRACKING_TOPIC)
    parser.add_argument("--messages", help="folder of message files to stream instead of Kafka")
    parser.add_argument("--once", action="store_true", help="work off what is there, then stop")
    parser.add_argument("--console", action="store_true")
    parser.add_argument("--alerts", action="store_true", help="publish alerts to the brokers")
    parser.add_argument("--day", type=dt.date.fromisoformat)
    parser.add_argument("--target")
    parser.add_argument("--table", help="external table that a closed day is added to")
    parser.add_argument("--incremental", action="store_true", help="read only the days that changed")
    parser.add_argument("--restarts", type=int, default=3, help="of each failing stream")
    args = parser.parse_args(argv)

    spark = session.build(f"seawake-{args.job}")
    if args.job == "batch" and args.incremental:
        days = incremental.run_incremental(spark, args.root)
        print("days read: " + ", ".join(map(str, days)) if days else "nothing changed")
    elif args.job == "batch":
        written = run_batch(spark, args.root)
        print("written: " + ", ".join(written) if written else "no raw data")
    elif args.job == "reports":
        for name, df in report_tables(spark, args.root).items():
            tables.write_analysis(df, f"{args.root}/reports/{name}")
            print(f"== {name} (all rows are in reports/{name})")
            spark.read.parquet(f"{args.root}/reports/{name}").show(50, truncate=False)
    elif args.job == "compact":
        tables.compact_day(spark, f"{args.root}/raw_data", args.target, args.day)
    elif args.job == "close":
        tables.close_day(spark, f"{args.root}/raw_data", args.target, args.day, args.table)
    else:
        kind = "files" if args.messages else "kafka"
        source = io.message_source(spark, kind, brokers=args.brokers, topic=args.topic, path=args.messages)
        pace = {"slow": io.ONCE, "fast": io.ONCE} if args.once else {}
        starts = streams(source, args.root, console=args.console, alert_brokers=args.brokers if args.alerts else None,
                         **pace)
        supervise(starts, restarts=args.restarts, pause=1.0 if args.once else 5.0,
                  log=ProgressLog(spark, f"{args.root}/progress"))


if __name__ == "__main__":
    main()
