"""Small helpers of the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake import session

ROWS_PER_BATCH = "512"


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches: a few MB of text each, so that long texts don't add up in a worker's memory."""
    session.prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, with fixed types; other columns, whatever their names, go no further."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from rows(batch)
    return df.mapInArrow(run, schema)


def posix_dir(path: str) -> str:
    """The shared folder as a path for open() and memory maps; it has to be mounted on every machine."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        path = "/" + rest.lstrip("/")
    elif rest and "/" not in scheme:
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {path}")
    return os.path.abspath(path)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared folder and reads it: the work is done once and survives lost executors."""
    spark = df.sparkSession
    path = session.shared_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
