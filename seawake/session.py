"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(app_name: str = "seawake", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; ``extra`` keys without a dot use ``_`` for it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key if "." in key else key.replace("_", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    Event times are UTC, so the session zone has to be UTC wherever a
    TIMESTAMP_NTZ column meets epoch arithmetic.
    """
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for ``purpose`` that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only on one
    machine may that be unset; a local temporary folder is then taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "seawake")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
