"""Streaming sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from seawake.schemas import EXTENDED_MESSAGE, TIME
from seawake.sources import events
from seawake.sources.messages import TRACKING_TOPIC, accepted, enrich_time, parse_messages

ONCE = "available"
ROWS_PER_STORE = 2**19  # a task sorts the rows of its store: some 700 bytes each for adjusted arrivals
BOUNDED_STORES = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"


def message_source(spark: SparkSession, kind: str = "kafka", *, brokers: str = "localhost:9092",
                   topic: str = TRACKING_TOPIC, path: str | None = None, starting_offsets: str = "latest",
                   fail_on_data_loss: bool = False, max_files: int | None = None) -> DataFrame:
    """Messages with a ``value`` column, from Kafka or from text files with one message per line."""
    if kind == "kafka":
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", brokers)
                .option("subscribe", topic)
                .option("startingOffsets", starting_offsets)
                .option("failOnDataLoss", str(fail_on_data_loss).lower())
                .load())
    if kind == "files":
        reader = spark.readStream
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.text(path)
    raise ValueError(f"unknown source kind: {kind}")


def telemetry(messages: DataFrame) -> DataFrame:
    """Usable messages as telemetry rows with their time columns."""
    return enrich_time(accepted(parse_messages(messages, EXTENDED_MESSAGE)))


def event_telemetry(spark: SparkSession, sf_dir: str, max_files: int | None = None,
                    extended: bool = False) -> DataFrame:
    """The ``events`` table as a telemetry stream; watermarks need TIMESTAMP."""
    reader = spark.readStream.schema(events.EVENTS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A glob is accepted whether the table is one file or a folder of files.
    rows = events.telemetry(reader.parquet(f"{sf_dir}/events.parque[t]"), extended)
    return rows.withColumn(TIME, F.col(TIME).cast("timestamp"))


def _triggered(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    if trigger == ONCE:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def write_stream(df: DataFrame, name: str, root: str, *, kind: str = "parquet",
                 partitions: Sequence[str] = (), trigger: str = "1 minute",
                 brokers: str = "localhost:9092", state_partitions: int | None = None) -> StreamingQuery:
    """Starts an append query with its own checkpoint under ``root``.

    ``parquet`` and a restart from the checkpoint give exactly-once files;
    ``kafka`` takes columns key, value, topic and delivers at least once;
    ``console`` is for debugging. ``trigger`` is an interval, or ``ONCE`` to
    work off what is there and stop. ``state_partitions`` is the number of state
    stores of a stateful query, fixed by its first start (default: the session's
    shuffle partitions). The stores of an executor then share one bounded cache,
    so that their number costs no memory.
    """
    writer = (df.writeStream.outputMode("append").queryName(name)
              .option("checkpointLocation", f"{root}/checkpoints/{name}"))
    if kind == "parquet":
        writer = writer.format("parquet").option("path", f"{root}/{name}")
        if partitions:
            writer = writer.partitionBy(*partitions)
    elif kind == "kafka":
        writer = writer.format("kafka").option("kafka.bootstrap.servers", brokers)
    elif kind == "console":
        writer = writer.format("console").option("truncate", False)
    else:
        raise ValueError(f"unknown sink kind: {kind}")
    writer = _triggered(writer, trigger)
    if state_partitions is None:
        return writer.start()
    # A query copies the session's settings when it starts.
    conf, settings = df.sparkSession.conf, {"spark.sql.shuffle.partitions": str(state_partitions)}
    if conf.get(BOUNDED_STORES, None) is None:
        settings[BOUNDED_STORES] = "true"
    before = {key: conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            conf.set(key, value)
        return writer.start()
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def one_store_per_core(spark: SparkSession) -> int:
    """State partitions for a cluster: the session's shuffle partitions, but no more than there are cores."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def stores_for(spark: SparkSession, rows: int) -> int:
    """State partitions for a query that works off ``rows`` in one run: one per core, and more once a store would
    take more than ``ROWS_PER_STORE``, so that a task's memory does not grow with the input."""
    return max(one_store_per_core(spark), -(-rows // ROWS_PER_STORE))
