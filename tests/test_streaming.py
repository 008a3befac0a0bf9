"""Several micro-batches, late rows, restarts, and streams against batch."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from seawake import session
from seawake.operators import anomalies, eta, windows
from seawake.sources import messages
from seawake.streaming import io, queries
from tests.helpers import T0, rows_of, same


def write_file(folder, name, *texts):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path + ".part", "w") as out:
        out.write("\n".join(texts) + "\n")
    os.rename(path + ".part", path)


def message(ship="SHIP_001", minutes=0.0, **values):
    body = {
        "navire_id": ship, "timestamp": (T0 + dt.timedelta(minutes=minutes)).isoformat() + "Z", "latitude": 40.0,
        "longitude": 3.0, "vitesse_noeuds": 15.0, "cap_degres": 90.0, "carburant_litres": 50000.0,
        "temperature_eau_celsius": 20.0, "meteo": "claire", "etat_moteur": "normal", "port_depart": "Tanger",
        "port_arrivee": "Tunis", "distance_restante_nm": 100.0, "consommation_horaire_litres": 40.0}
    return json.dumps({**body, **values})


def source(spark, folder):
    return io.telemetry(io.message_source(spark, "files", path=str(folder), max_files=1))


def run(df, name, root, **options):
    query = io.write_stream(df, name, str(root), trigger=io.ONCE, **options)
    query.awaitTermination()
    return query


def test_late_rows_leave_windows_but_stay_in_raw(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "out"
    write_file(inbox, "1.json", message(minutes=1), message(minutes=2))
    write_file(inbox, "2.json", message(minutes=60))
    # Rows are late against the watermark the previous micro-batch ran with.
    write_file(inbox, "3.json", message(minutes=61))
    write_file(inbox, "4.json", message(minutes=3, vitesse_noeuds=99.0), message(minutes=62))
    write_file(inbox, "5.json", message(minutes=120))
    # Files are taken oldest first; give them distinct ages.
    for i in range(1, 6):
        os.utime(inbox / f"{i}.json", (i, i))
    query = run(queries.window_stats(source(spark, inbox)), "aggregated", root)
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1
    first = spark.read.parquet(str(root / "aggregated")).orderBy("window_start").first()
    assert (first.nombre_mesures, first.vitesse_max) == (2, 15.0)

    run(source(spark, inbox), "raw_data", root, partitions=["date"])
    assert spark.read.parquet(str(root / "raw_data")).count() == 7


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "out"
    expected = 0
    for turn in range(3):
        write_file(inbox, f"{turn}.json", *[message(minutes=10 * turn + i) for i in range(4)])
        expected += 4
        run(queries.raw(source(spark, inbox)), "raw_data", root, partitions=["date"])
        assert spark.read.parquet(str(root / "raw_data")).count() == expected


def test_window_state_survives_restart(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "out"
    for turn, minutes in enumerate([(0, 1), (2, 3), (100,)]):
        write_file(inbox, f"{turn}.json", *[message(minutes=m) for m in minutes])
        run(queries.window_stats(source(spark, inbox)), "aggregated", root)
    row = spark.read.parquet(str(root / "aggregated")).first()
    assert row.nombre_mesures == 4 and row.window_start == T0


def test_signal_lost_closes_after_the_watermark(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "out"
    write_file(inbox, "1.json", message("SHIP_001", 0), message("SHIP_002", 0))
    write_file(inbox, "2.json", message("SHIP_002", 4), message("SHIP_002", 8), message("SHIP_002", 30))
    for i in (1, 2):
        os.utime(inbox / f"{i}.json", (i, i))
    run(queries.signal_lost(source(spark, inbox)), "lost", root)
    rows = spark.read.parquet(str(root / "lost")).collect()
    minute = dt.timedelta(minutes=1)
    assert {(r.navire_id, r.signal_perdu_a) for r in rows} == {
        ("SHIP_001", T0 + 5 * minute), ("SHIP_002", T0 + 13 * minute)}


def test_rejects_and_alerts_streams(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "out"
    write_file(inbox, "1.json", "oops", message(carburant_litres=1.0), message(meteo="tempete", vitesse_noeuds=1.0))
    raw = io.message_source(spark, "files", path=str(inbox))
    run(messages.rejected(messages.parse_messages(raw)), "rejects", root)
    run(queries.alerts(io.telemetry(raw)), "alerts", root)
    assert [r.message for r in spark.read.parquet(str(root / "rejects")).collect()] == ["oops"]
    assert spark.read.parquet(str(root / "alerts")).count() == 3


def test_processing_time_windows(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "out"
    write_file(inbox, "1.json", message(minutes=0), message(minutes=5000))
    df = queries.window_stats(source(spark, inbox), time="processing_time")
    run(df, "aggregated", root)
    # Arrival-time windows are still open when the run ends; nothing is emitted early.
    assert spark.read.schema(df.schema).parquet(str(root / "aggregated")).count() == 0


@pytest.mark.parametrize("stream,batch,end", [
    (lambda t: queries.window_stats(t, 21600), lambda t: windows.window_stats(t, 21600), "window_end"),
    (queries.eta_adjusted, eta.eta_adjusted, "mise_a_jour"),
    (lambda t: queries.window_alert_score(t, 21600), lambda t: windows.window_alert_score(t, 21600), "window_end"),
    (queries.detected_anomalies, lambda t: anomalies.anomalies_detected(t, with_position=True), None),
])
def test_stream_equals_batch(spark, tmp_path, stream, batch, end):
    from seawake.sources.events import read_telemetry
    from tests.conftest import SMALL

    run(stream(io.event_telemetry(spark, SMALL)), "out", tmp_path)
    rows = read_telemetry(spark, SMALL).withColumn("ts", F.col("ts").cast("timestamp"))
    expected = batch(rows)
    if end:
        newest = rows.agg(F.max("ts")).first()[0]
        expected = expected.filter(F.col(end) <= F.lit(newest - dt.timedelta(minutes=10)))
    assert same(spark.read.parquet(str(tmp_path / "out")), expected)


def test_console_and_unknown_kinds(spark, tmp_path):
    inbox = tmp_path / "in"
    write_file(inbox, "1.json", message())
    run(source(spark, inbox), "console_output", tmp_path / "out", kind="console")
    with pytest.raises(ValueError):
        io.message_source(spark, "carrier-pigeon")
    with pytest.raises(ValueError):
        io.write_stream(source(spark, inbox), "x", str(tmp_path), kind="carrier-pigeon")


def test_shared_dir_comes_from_the_session(spark):
    assert session.shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_of_has_event_time(spark):
    assert rows_of(spark, {}).schema["ts"].dataType.typeName() == "timestamp_ntz"


def test_state_partitions(spark, tmp_path):
    inbox, root = tmp_path / "in", tmp_path / "out"
    write_file(inbox, "1.json", message())
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    query = run(queries.window_stats(source(spark, inbox)), "aggregated", root, state_partitions=2)
    assert query.recentProgress[0].stateOperators[0].numShufflePartitions == 2
    assert spark.conf.get(key) == before
    assert io.one_store_per_core(spark) == 4


def test_stores_grow_with_the_rows(spark, tmp_path, monkeypatch):
    """A store's rows, and so a task's memory, stay the same when the input grows; a row counts once per window."""
    from __spark_entry__ import queries as registered
    from seawake.sources import events

    rows = [(i, T0 + dt.timedelta(minutes=7 * i), i % 3, "click", 1.0, f'{{"k": {i}}}') for i in range(40)]
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, events.EVENTS).write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(io, "ROWS_PER_STORE", 24, raising=False)
    monkeypatch.setattr(session, "shared_dir", lambda *_: str(tmp_path / "run"))
    found = registered()["stream_eta_adjusted"](spark, folder)

    stores = os.listdir(tmp_path / "run" / "checkpoints" / "out" / "state" / "0")
    assert len([s for s in stores if s.isdigit()]) == 40 * 6 // 24
    newest = T0 + dt.timedelta(minutes=7 * 39 - 10)
    expected = eta.eta_adjusted(events.read_telemetry(spark, folder)).filter(F.col("mise_a_jour") <= F.lit(newest))
    assert found.count() > 0 and same(found, expected)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4" and spark.conf.get(io.BOUNDED_STORES, None) is None


def test_overlap_is_the_number_of_windows_of_a_row(spark):
    assert eta.eta_adjusted(rows_of(spark, {})).count() == eta.OVERLAP
