"""Tables: scans, partitioned writes, compaction, DDL, CSV."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.operators.alerts import with_codes
from seawake.schemas import RAW_ARCHIVE, TIME


def read_raw(spark: SparkSession, path: str, schema: T.StructType | None = RAW_ARCHIVE) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str] = ("date",), whole: bool = False) -> None:
    """Overwrites the partitions present in ``df``, or the ``whole`` table.

    The rebalance hint gathers a partition's rows so that few files are written,
    lets AQE split a partition that is too large for one task and merges small
    ones; a plain ``repartition(by)`` would put a whole day into one task.
    """
    (df.hint("rebalance", *[F.col(c) for c in by])
     .write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
     .partitionBy(*by).parquet(path))


def write_analysis(df: DataFrame, path: str) -> None:
    """Replaces a result table; rebalance keeps its files near the advisory size."""
    df.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system, for listings."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _folder(spark, path)
    return files.exists(place)


def _days(spark: SparkSession, path: str) -> Iterator[tuple[dt.date, list]]:
    """(day, its data files) for every partition folder ``date=...``, newest first."""
    place, files = _folder(spark, path)
    if not files.exists(place):
        return
    folders = sorted((f.getPath() for f in files.listStatus(place) if f.getPath().getName().startswith("date=")),
                     key=lambda p: p.getName(), reverse=True)
    for folder in folders:
        try:
            day = dt.date.fromisoformat(folder.getName().removeprefix("date="))
        except ValueError:  # the partition of rows without a time
            continue
        yield day, [f for f in files.listStatus(folder) if not f.getPath().getName().startswith(("_", "."))]


def day_fingerprints(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """A digest of the names, sizes and times of each day's files; a day whose files change has another one."""
    return {day: hashlib.md5("|".join(sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}"
                                             for f in found)).encode()).hexdigest()
            for day, found in _days(spark, path) if found}


def newest_day(spark: SparkSession, path: str, schema: T.StructType | None = RAW_ARCHIVE) -> dt.date | None:
    """The newest day that has rows, from the listing; a day's first row is read to be sure."""
    table = None
    for day, found in _days(spark, path):
        if found:
            table = read_raw(spark, path, schema) if table is None else table
            if not table.filter(F.col("date") == F.lit(day)).isEmpty():
                return day
    return None


def newest_time(spark: SparkSession, path: str, schema: T.StructType | None = RAW_ARCHIVE) -> Column:
    """The newest event time of an archive partitioned by date, as a scalar subquery that reads the newest day only."""
    day = newest_day(spark, path, schema)
    rows = read_raw(spark, path, schema)
    return rows.filter(F.col("date") == F.lit(day) if day else F.lit(False)).select(F.max(TIME)).scalar()


def drop_days(spark: SparkSession, path: str, days: Sequence[dt.date]) -> None:
    """Removes the partitions of these days."""
    for day in days:
        place, files = _folder(spark, f"{path}/date={day.isoformat()}")
        files.delete(place, True)


def between_dates(df: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of the days ``first``..``last``; the filter is on the partition column, so other days are not read."""
    return df.filter(F.col("date").between(F.lit(first), F.lit(last)))


def compact_day(spark: SparkSession, source: str, target: str, day: dt.date,
                schema: T.StructType | None = RAW_ARCHIVE) -> None:
    """Rewrites one day of a many-files archive into ``target`` in files of the advisory size.

    The source is left alone, so the job can run again after a failure.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("compaction needs a target other than its source")
    write_partitioned(between_dates(read_raw(spark, source, schema), day, day), target)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter that is known once ``df`` has been written; counting costs no pass of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("lignes")), seen


def export_csv(df: DataFrame, path: str) -> None:
    """Writes CSV from the executors, without collecting the rows."""
    df.write.mode("overwrite").option("header", True).csv(path)


def create_table(spark: SparkSession, name: str, path: str, schema: T.StructType,
                 partitions: Sequence[str]) -> None:
    """Defines an external Parquet table over ``path`` and registers the partitions found there."""
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(map(_quoted, partitions))}) LOCATION {_text(path)}")
    spark.catalog.recoverPartitions(name)


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# The documented table: the archive's fields and the codes of the alerts that hold on a row.
TELEMETRY_TABLE = T.StructType([*[f for f in RAW_ARCHIVE.fields if f.name != "date"],
                                T.StructField("anomalies", T.ArrayType(T.StringType())), T.StructField("date", T.DateType())])


def close_day(spark: SparkSession, source: str, target: str, day: dt.date, name: str) -> None:
    """Publishes a finished day of the archive in the external table ``name`` over the folder ``target``.

    The day is rewritten in files of the advisory size with the ``anomalies`` array, then its partition is added; other
    partitions are not looked at. Running it again replaces the day.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the table needs a folder other than its source")
    rows = with_codes(between_dates(read_raw(spark, source), day, day))
    write_partitioned(rows.select(*TELEMETRY_TABLE.fieldNames()), target)
    if not spark.catalog.tableExists(name):
        create_table(spark, name, target, TELEMETRY_TABLE, ["date"])
    spark.sql(f"ALTER TABLE {_quoted(name)} ADD IF NOT EXISTS PARTITION (date = DATE '{day.isoformat()}')")
    spark.sql(f"REFRESH TABLE {_quoted(name)}")
