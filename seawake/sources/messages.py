"""JSON messages: decoding with a rejects path, encoding, topic routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.operators.anomalies import alert_fanout
from seawake.functions.moments import is_finite
from seawake.schemas import EXTENDED_FIELDS, SHIP, TELEMETRY_MESSAGE, TIE, TIME

TRACKING_TOPIC = "tracking"
ALERTS_TOPIC = "alerts"
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
CORRUPT = "_corrupt_record"


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_UTC)


def parse_messages(messages: DataFrame, schema: T.StructType = TELEMETRY_MESSAGE) -> DataFrame:
    """Columns of every message plus ``rejet``, the reason why it cannot be used (NULL if it can).

    The event time is TIMESTAMP. ``event_id`` is a hash of the message text: a
    stable tie-breaker for messages that carry the same time. An optional field
    that cannot be read is NULL and named in ``remarque``; the reading counts.
    """
    text, message = F.col("value").cast("string"), F.col("message")
    optional = {f.name: f.dataType for f in schema.fields if f.name in EXTENDED_FIELDS.fieldNames()}
    read_as = T.StructType([T.StructField(f.name, T.StringType() if f.name in optional else f.dataType)
                            for f in schema.fields] + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(message, read_as, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = (
        messages.select(text.alias("message"))
        # inline() is a boundary that filters on the fields are not pushed through:
        # the text is parsed once per row, not once more for every field a filter uses.
        .select("message", F.inline(F.array(parsed)))
        .withColumn(TIME, F.try_to_timestamp("timestamp"))
        .withColumn(TIE, F.xxhash64("message"))
    )
    reason = (
        F.when(F.col(CORRUPT).isNotNull() | F.col("message").isNull(), "json")
        .when(F.col(SHIP).isNull() | F.col("timestamp").isNull(), "champ_manquant")
        .when(F.col(TIME).isNull(), "horodatage")
        .when(F.array_contains(F.array(*[~is_finite(F.col(f.name)) for f in schema.fields
                                         if isinstance(f.dataType, T.DoubleType) and f.name not in optional]), True),
              "nombre")
    )
    rows = rows.withColumn("rejet", reason).drop(CORRUPT)
    values = {name: _lenient(F.col(name), kind) for name, kind in optional.items()}
    unread = F.concat_ws(",", *[F.when(F.col(n).isNotNull() & v.isNull(), F.lit(n)) for n, v in values.items()])
    return rows.withColumn("remarque", F.nullif(unread, F.lit(""))).withColumns(values)


def _lenient(text: Column, kind: T.DataType) -> Column:
    """The number in ``text``; NULL if it is none of this type."""
    number = text.try_cast("double")
    return F.when(is_finite(number), number) if isinstance(kind, T.DoubleType) else text.try_cast(kind)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("rejet").isNull()).drop("rejet", "remarque", "message")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("rejet").isNotNull()).select("message", "rejet")


def remarks(parsed: DataFrame) -> DataFrame:
    """Accepted messages of which an optional field was left out, with the names of such fields."""
    return parsed.filter(F.col("rejet").isNull() & F.col("remarque").isNotNull()).select("message", "remarque")


def enrich_time(df: DataFrame, processing_time: bool = True) -> DataFrame:
    """Adds the processing time, the calendar date and the hour of the event."""
    extra = {"date": F.to_date(TIME), "hour": F.hour(TIME)}
    if processing_time:
        extra["processing_time"] = F.current_timestamp()
    return df.withColumns(extra)


def encode(df: DataFrame, schema: T.StructType = TELEMETRY_MESSAGE) -> Column:
    """The JSON text of a telemetry row."""
    fields = [iso_text(F.col(TIME)).alias("timestamp") if f.name == "timestamp" else F.col(f.name)
              for f in schema.fields]
    return F.to_json(F.struct(*fields))


def tracking_messages(df: DataFrame, topic: str = TRACKING_TOPIC, schema: T.StructType = TELEMETRY_MESSAGE) -> DataFrame:
    return df.select(F.col(SHIP).alias("key"), encode(df, schema).alias("value"), F.lit(topic).alias("topic"))


def alert_messages(df: DataFrame, topic: str = ALERTS_TOPIC) -> DataFrame:
    body = F.struct(SHIP, iso_text(F.col(TIME)).alias("timestamp"), F.lit("alert").alias("type"), "message",
                    "latitude", "longitude")
    return alert_fanout(df).select(
        F.col(SHIP).alias("key"), F.to_json(body).alias("value"), F.lit(topic).alias("topic"))


def to_messages(df: DataFrame, tracking: str = TRACKING_TOPIC, alerts: str = ALERTS_TOPIC) -> DataFrame:
    """Keyed messages for both topics; the key keeps a ship's messages in order."""
    return tracking_messages(df, tracking).unionByName(alert_messages(df, alerts))


def route_by_anomaly(df: DataFrame, tracking: str = TRACKING_TOPIC, alerts: str = ALERTS_TOPIC) -> DataFrame:
    """The documented routing: a row with anomalies goes to the alerts topic, any other to tracking."""
    topic = F.when(F.size("anomalies") > 0, alerts).otherwise(tracking)
    return df.select(F.col(SHIP).alias("key"), encode(df).alias("value"), topic.alias("topic"))
