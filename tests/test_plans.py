"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

BATCH = [n for n in entry._telemetry_queries() if not n.startswith("stream_") and n != "pruned_hourly_scan"]
# Queries whose only single-partition step follows an aggregation (or is a bounded top-k).
OPEN_WINDOW = {"anomaly_distribution", "weather_report", "alerts_per_hour"}


def plan_of(spark, name):
    return entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(spark, name) for name in BATCH}


@pytest.fixture(scope="module")
def hinted(spark):
    """Queries whose optimized plan has a join with a broadcast hint."""
    query = entry.queries()
    return {n for n in BATCH
            if "strategy=broadcast" in query[n](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()}


def test_no_python_workers(plans):
    for name, plan in plans.items():
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroupsIn", plan), name


def test_no_cross_joins(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_rows_are_never_gathered_in_one_partition(plans):
    """A single-partition exchange may only sit on top of an aggregate."""
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = "\n".join(lines[i + 1:i + 4])
                assert "Aggregate" in below or "TakeOrdered" in below, name
    for name in OPEN_WINDOW:
        assert "SinglePartition" in plans[name], name


def test_limits_are_top_k(plans):
    for name in ("fastest_ships", "busiest_routes", "ships_to_watch", "next_arrivals", "recent_positions",
                 "speed_series", "alert_pivot", "ship_ranking", "fleet_status", "top_ships"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_no_global_sort(plans):
    for name, plan in plans.items():
        assert "rangepartitioning" not in plan, name


def test_only_ports_are_broadcast(plans, hinted):
    for name, plan in plans.items():
        if "BroadcastExchange" in plan and name not in ("distance_to_port", "distance_to_port_km",
                                                        "bearing_to_port", "off_course", "fleet_alerts",
                                                        "alert_codes", "archive_alerts"):
            # Chosen by Spark from a size estimate, never by a hint on data that grows.
            assert name not in hinted, name
    assert "BroadcastExchange" in plans["distance_to_port"] and "distance_to_port" in hinted


def test_columns_are_pruned(plans):
    def read(name):
        return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*)>", plans[name]).group(1)))

    assert read("low_fuel_counts") <= {"event_id", "user_id"}
    assert read("weather_impact") <= {"event_id", "props"}
    assert read("traffic_grid") <= {"event_id", "user_id"}


def test_windows_are_partitioned_by_time_slot(plans):
    for name in ("fuel_drops", "signal_gaps", "running_fuel", "rolling_speed", "distance_travelled"):
        assert re.search(r"hashpartitioning\(navire_id#\d+, _slot#\d+L", plans[name]), name


def test_distinct_counts_shuffle_reduced_rows(plans):
    below = plans["temporal_analysis"].split("Exchange hashpartitioning")[-1]
    assert "HashAggregate" in below


def test_rollup_parts_not_used_are_pruned(plans):
    assert "max(" not in plans["route_performance"] and "struct(" not in plans["route_performance"]
