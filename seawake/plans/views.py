"""Temporary views over the tables the jobs write, and the documented views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.functions.geo import register_sql_functions
from seawake.operators import aggregates, anomalies
from seawake.operators.latest import current_positions
from seawake.plans import reports
from seawake.schemas import TIME
from seawake.sources.tables import exists, newest_time, read_raw

# View name -> folder under the root.
TABLES = {
    "ship_statistics": "analysis/ship_statistics",
    "route_performance": "analysis/route_performance",
    "temporal_analysis": "analysis/temporal_analysis",
    "weather_impact": "analysis/weather_impact",
    "maintenance_prediction": "analysis/maintenance_prediction",
    "anomalies": "analysis/anomalies_detected",
    "raw_telemetry": "raw_data",
    "eta_predictions": "eta_predictions",
}


ROLLUP = "analysis/ship_route_rollup"


def load_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every table under ``root`` by view name; raw rows also carry their time as ``timestamp``."""
    tables = {}
    for name, folder in TABLES.items():
        if name == "raw_telemetry":
            tables[name] = read_raw(spark, f"{root}/{folder}").withColumn("timestamp", F.col(TIME))
        else:
            tables[name] = spark.read.parquet(f"{root}/{folder}")
    return tables


def register_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Registers the tables, the documented views and the geodesic SQL functions."""
    tables = load_tables(spark, root)
    raw = tables["raw_telemetry"]
    now = newest_time(spark, f"{root}/{TABLES['raw_telemetry']}")
    written = f"{root}/{ROLLUP}"  # the batch job's; without it the view reads the raw rows
    voyages = (aggregates.voyages_of(spark.read.parquet(written)) if exists(spark, written) else aggregates.voyages(raw))
    views = {
        **tables,
        "v_current_positions": current_positions(raw),
        "v_ships_requiring_attention": anomalies.alerts_recent(raw, as_of=now, date="date"),
        "v_route_efficiency": aggregates.route_efficiency(voyages),
        "v_active_alerts": anomalies.active_alerts(raw),
        "v_maintenance_alerts": reports.maintenance_alerts(tables["maintenance_prediction"]),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    register_sql_functions(spark)
    return tables
