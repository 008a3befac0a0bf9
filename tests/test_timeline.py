"""Slotted ordered computations against brute force, with a ship that holds a third of all rows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seawake.operators import aggregates, latest, timeline, windows
from tests.helpers import T0, rows_of, same


@pytest.fixture(scope="module")
def skewed(spark):
    """300 rows, 100 of them of one ship, clustered in time and with equal timestamps."""
    rng = random.Random(7)
    made = []
    for i in range(300):
        ship = "SHIP_001" if i < 100 else f"SHIP_{rng.randint(2, 12):03d}"
        offset = rng.choice([0, 1, 2, 3, 50, 51, 200]) * 3600 + rng.randint(0, 90) * 60
        made.append(dict(
            navire_id=ship, ts=T0 + dt.timedelta(seconds=offset), latitude=36 + rng.randint(0, 64) / 8,
            longitude=rng.randint(0, 64) / 8, vitesse_noeuds=rng.randint(0, 120) / 4,
            cap_degres=rng.randint(0, 719) / 2, carburant_litres=float(rng.randint(1000, 90000)),
            consommation_horaire_litres=rng.randint(0, 400) / 4))
    return rows_of(spark, *made).cache()


def whole():
    return Window.partitionBy("navire_id").orderBy("ts", "event_id")


@pytest.mark.parametrize("slot", [60, 3600, 86400])
def test_previous_and_next(skewed, slot):
    rows = skewed.select("navire_id", "event_id", "ts", "carburant_litres")
    names = {"carburant_litres": "other", "ts": "when"}
    for ours, theirs in ((timeline.with_previous, F.lag), (timeline.with_next, F.lead)):
        expected = rows.withColumns({new: theirs(old).over(whole()) for old, new in names.items()})
        assert same(ours(rows, names, slot_seconds=slot), expected)


@pytest.mark.parametrize("slot", [60, 3600, 86400])
def test_running_sum(skewed, slot):
    rows = skewed.select("navire_id", "event_id", "ts", "consommation_horaire_litres")
    expected = rows.withColumn("total", F.sum("consommation_horaire_litres").over(
        whole().rowsBetween(Window.unboundedPreceding, 0)))
    assert same(timeline.running_sum(rows, "consommation_horaire_litres", "total", slot_seconds=slot), expected)


@pytest.mark.parametrize("seconds,slot", [(1800, 3600), (1800, 7), (7200, 9000), (86400, 3600), (3600, 60), (97, 60)])
def test_trailing_mean(skewed, seconds, slot):
    rows = skewed.select("navire_id", "event_id", "ts", "vitesse_noeuds")
    span = Window.partitionBy("navire_id").orderBy(F.unix_seconds(F.col("ts").cast("timestamp"))).rangeBetween(-seconds, 0)
    expected = rows.withColumn("mean", F.avg("vitesse_noeuds").over(span))
    assert same(timeline.trailing_mean(rows, "vitesse_noeuds", "mean", seconds, slot_seconds=slot), expected)


@pytest.mark.parametrize("slot", [60, 600, 3600])
def test_trailing_mean_forgets_what_has_left_the_span(spark, slot):
    values = [0.1, float("nan"), 0.2, 1e16, 0.3, None, 0.7] + [0.1 * (i % 7) for i in range(60)]
    rows = rows_of(spark, *({"event_id": i, "ts": T0 + dt.timedelta(minutes=7 * i), "vitesse_noeuds": v}
                            for i, v in enumerate(values)))
    rows = rows.select("navire_id", "event_id", "ts", "vitesse_noeuds")
    span = Window.partitionBy("navire_id").orderBy(F.unix_seconds(F.col("ts").cast("timestamp"))).rangeBetween(-1800, 0)
    got = timeline.trailing_mean(rows, "vitesse_noeuds", "mean", 1800, slot_seconds=slot)
    both = got.withColumn("plain", F.avg("vitesse_noeuds").over(span)).collect()
    assert len(both) == len(values)
    for r in both:
        assert r.mean == r.plain or math.isnan(r.mean) and math.isnan(r.plain) or math.isclose(r.mean, r.plain, rel_tol=1e-12)


def test_latest_rows_keep_ties(spark):
    rows = rows_of(spark, {"event_id": 1}, {"event_id": 2}, {"event_id": 3, "ts": T0 - dt.timedelta(hours=1)})
    assert {r.event_id for r in latest.latest_with_ties(rows).collect()} == {1, 2}


def test_since_keeps_one_older_row(skewed):
    cutoff = F.lit(T0 + dt.timedelta(hours=40)).cast("timestamp_ntz")
    columns = ["navire_id", "event_id", "ts", "carburant_litres"]
    full = skewed.select(columns).withColumn("p", F.lag("carburant_litres").over(whole())).filter(F.col("ts") > cutoff)
    part = timeline.with_previous(timeline.since(skewed, columns, cutoff), {"carburant_litres": "p"})
    assert same(part.filter(F.col("ts") > cutoff), full)
    older = timeline.since(skewed, columns, cutoff).filter(F.col("ts") <= cutoff)
    assert older.count() == older.select("navire_id").distinct().count()


def test_latest_rows(skewed):
    expected = (skewed.withColumn("n", F.row_number().over(
        Window.partitionBy("navire_id").orderBy(F.desc("ts"), F.desc("event_id")))).filter("n = 1"))
    columns = ["navire_id", "ts", "latitude", "longitude", "vitesse_noeuds", "carburant_litres"]
    assert same(latest.latest_positions(skewed), expected.select(columns))


def test_latest_keeps_ties(spark):
    rows = rows_of(spark, {}, {}, {"ts": T0 - dt.timedelta(hours=1)}, {"navire_id": "SHIP_002"})
    assert latest.latest_with_ties(rows).count() == 3


def test_window_distance_forms_agree(skewed):
    for span in (300, 6 * 3600, 48 * 3600):
        a = windows.window_distance(skewed, span).withColumn("distance_nm", F.round("distance_nm", 6))
        b = windows.window_distance_by_pieces(skewed, span).withColumn("distance_nm", F.round("distance_nm", 6))
        assert same(a, b)


@pytest.mark.parametrize("ranges", [2, 7, 64])
def test_quantiles_are_exact(skewed, ranges):
    names = {"minimum": 0.0, "p10": 0.1, "q1": 0.25, "mediane": 0.5, "q3": 0.75, "maximum": 1.0}
    ours = aggregates.quantiles(skewed, "vitesse_noeuds", names, ranges=ranges)
    spark_own = skewed.groupBy("navire_id").agg(
        F.count("*").alias("nombre"), *[F.percentile("vitesse_noeuds", p).alias(n) for n, p in names.items()])
    rounded = {n: F.round(n, 9) for n in names}
    assert same(ours.withColumns(rounded), spark_own.withColumns(rounded))


def test_signal_lost_borders(spark):
    five = dt.timedelta(minutes=5)
    rows = rows_of(spark, {}, {"ts": T0 + five}, {"ts": T0 + 2 * five - dt.timedelta(seconds=1)},
                   {"navire_id": "SHIP_002", "ts": T0 + 2 * five})
    lost = {(r.navire_id, r.dernier_message) for r in timeline.signal_lost(rows).collect()}
    # A message exactly at the gap comes too late; a silence not yet five minutes long is not lost.
    assert lost == {("SHIP_001", T0)}


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_results_do_not_depend_on_partitioning(spark, skewed, partitions):
    def results(rows):
        stats = aggregates.ship_statistics(rows)
        return [sorted(map(str, df.collect())) for df in (
            stats, aggregates.maintenance_prediction(rows), windows.window_stats(rows, 6 * 3600),
            timeline.fuel_drops(rows), windows.dominant_direction(rows))]

    expected = results(skewed)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert results(skewed.orderBy(F.rand(3))) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fit_slot(skewed):
    peak = (skewed.groupBy("navire_id", F.window("ts", "1 minute")).count().agg(F.max("count")).first()[0])
    assert timeline.fit_slot(skewed, rows_per_slot=peak * 5) == 300
    assert timeline.fit_slot(skewed, rows_per_slot=1) == 60
    assert timeline.fit_slot(skewed) == 86400
    assert timeline.fit_slot(skewed.limit(0)) == 86400
