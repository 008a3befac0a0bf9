"""Latest state per ship."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.functions.moments import recency
from seawake.schemas import SHIP, TIE, TIME


def latest_rows(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (SHIP,),
                tie: str | None = TIE) -> DataFrame:
    """The newest row of every key, cut to ``columns``.

    One aggregate, no self-join and no per-key sort: each map task keeps a
    single row per key, so a ship with a third of all rows costs no more than
    any other.
    """
    packed = F.struct(*[c for c in columns if c not in keys])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(packed, recency(tie)).alias("_last"))
        .select(*[F.col(c) if c in keys else F.col(f"_last.{c}") for c in columns])
    )


def latest_positions(df: DataFrame) -> DataFrame:
    return latest_rows(df, [SHIP, TIME, "latitude", "longitude", "vitesse_noeuds", "carburant_litres"])


def latest_with_ties(df: DataFrame, keys: Sequence[str] = (SHIP,), time: str = TIME) -> DataFrame:
    """Every row that carries the newest time of its key.

    The newest times come from a hash aggregate; joining on key and time spreads a busy key over many tasks.
    """
    newest = df.groupBy(*keys).agg(F.max(time).alias(time))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"n.{c}")) for c in (*keys, time)]
    return df.alias("d").join(newest.alias("n"), same, "left_semi")


def current_positions(df: DataFrame) -> DataFrame:
    """The documented current-position view; all values come from one row.

    ``temp_actuelle`` is that of the engine; where the table doesn't have it, it is NULL.
    """
    temperature = "temperature_moteur_celsius"
    if temperature not in df.columns:
        df = df.withColumn(temperature, F.lit(None).cast("double"))
    wanted = [SHIP, TIME, "latitude", "longitude", "vitesse_noeuds", "carburant_litres", temperature]
    return latest_rows(df, wanted).select(
        SHIP,
        F.col(TIME).alias("dernier_update"),
        "latitude",
        "longitude",
        F.col("vitesse_noeuds").alias("vitesse_actuelle"),
        F.col("carburant_litres").alias("carburant_actuel"),
        F.col(temperature).alias("temp_actuelle"),
    )


def latest_time(df: DataFrame) -> "F.Column":
    """Newest event time as a scalar subquery: the default meaning of "now"."""
    return df.select(F.max(TIME)).scalar()
