"""A failing query restarts alone; late rows are counted in a table."""

import os

import pytest
from pyspark.sql import functions as F

from seawake.streaming import io, queries
from seawake.streaming.supervision import ProgressLog, supervise
from tests.test_streaming import message, source, write_file


def test_a_failing_query_restarts_alone(spark, tmp_path):
    inbox = tmp_path / "in"
    for i in range(4):
        write_file(inbox, f"{i}.json", message(minutes=i), message(ship="SHIP_002", minutes=i))
    marker, began = tmp_path / "mended", {"good": 0, "bad": 0}

    def flaky(batch, number):
        if number == 2 and not marker.exists():
            marker.touch()
            raise ValueError("the sink is away")
        batch.write.mode("append").parquet(str(tmp_path / "bad"))

    rows = source(spark, inbox).select("navire_id", "ts")

    def bad():
        began["bad"] += 1
        return (rows.writeStream.foreachBatch(flaky).option("checkpointLocation", str(tmp_path / "c")).queryName("bad")
                .trigger(availableNow=True).start())

    def good():
        began["good"] += 1
        return io.write_stream(rows, "good", str(tmp_path), trigger=io.ONCE)

    assert supervise({"good": good, "bad": bad}, pause=0.2) == {"good": 0, "bad": 1}
    assert began == {"good": 1, "bad": 2}
    for name in ("good", "bad"):
        assert spark.read.parquet(str(tmp_path / name)).count() == 8


def test_a_query_that_keeps_failing_is_given_up(spark, tmp_path):
    inbox = tmp_path / "in"
    write_file(inbox, "1.json", message())

    def broken(batch, number):
        raise ValueError("no sink")

    rows = source(spark, inbox).select("navire_id")
    starts = {
        "broken": lambda: rows.writeStream.foreachBatch(broken).option("checkpointLocation", str(tmp_path / "c")).trigger(
            availableNow=True).start(),
        "good": lambda: io.write_stream(rows, "good", str(tmp_path), trigger=io.ONCE)}
    with pytest.raises(RuntimeError, match="given up after 1 restarts: broken"):
        supervise(starts, restarts=1, pause=0.2)
    assert spark.read.parquet(str(tmp_path / "good")).count() == 1


def test_late_rows_are_logged(spark, tmp_path):
    inbox, path = tmp_path / "in", str(tmp_path / "progress")
    for i, texts in enumerate(([message(minutes=1)], [message(minutes=60)], [message(minutes=61)],
                               [message(minutes=3), message(minutes=8), message(minutes=62)], [message(minutes=120)])):
        write_file(inbox, f"{i}.json", *texts)
        os.utime(inbox / f"{i}.json", (i + 1, i + 1))
    windows = queries.window_stats(source(spark, inbox))
    supervise({"aggregated": lambda: io.write_stream(windows, "aggregated", str(tmp_path), trigger=io.ONCE)},
              pause=0.5, log=ProgressLog(spark, path))
    log = spark.read.parquet(path).filter("query = 'aggregated'")
    total = log.agg(F.sum("late_rows").alias("late"), F.sum("rows_in").alias("rows"), F.count("*").alias("n")).first()
    assert (total.late, total.rows) == (2, 7) and total.n >= 5
