"""Streaming queries: the shared operators behind an event-time watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.operators import alerts as fleet
from seawake.operators import anomalies, eta, windows
from seawake.schemas import SHIP, TIE, TIME
from seawake.sources.messages import alert_messages

DELAY = "10 minutes"


def window_stats(df: DataFrame, span: int = windows.FIVE_MINUTES, delay: str = DELAY, time: str = TIME) -> DataFrame:
    """Tumbling-window figures; ``time="processing_time"`` gives arrival-time windows instead."""
    return windows.window_stats(df.withWatermark(time, delay), span, time)


def window_distance(df: DataFrame, span: int = windows.FIVE_MINUTES, delay: str = DELAY) -> DataFrame:
    return windows.window_distance_by_pieces(df.withWatermark(TIME, delay), span)


def window_alert_score(df: DataFrame, span: int = windows.FIVE_MINUTES, delay: str = DELAY) -> DataFrame:
    return windows.window_alert_score(df.withWatermark(TIME, delay), span)


def raw(df: DataFrame) -> DataFrame:
    return df


def detected_anomalies(df: DataFrame) -> DataFrame:
    return anomalies.anomalies_detected(df, with_position=True)


def eta_predictions(df: DataFrame) -> DataFrame:
    return eta.eta_predictions(df, keep=(TIE,))


def eta_adjusted(df: DataFrame, delay: str = DELAY) -> DataFrame:
    return eta.eta_adjusted(df.withWatermark(TIME, delay))


def fleet_alerts(df: DataFrame, gap_seconds: int = 300, delay: str = DELAY) -> DataFrame:
    """All five documented alerts: a stateless branch for those of a row, closed sessions for the lost signal."""
    lost = fleet.lost_signal_alerts(signal_lost(df, gap_seconds, delay))
    return fleet.row_alerts(df).unionByName(lost)


def dominant_direction(df: DataFrame, span: int = windows.FIVE_MINUTES, delay: str = DELAY) -> DataFrame:
    return windows.dominant_direction(df.withWatermark(TIME, delay), span)


def window_efficiency(df: DataFrame, span: int = windows.FIVE_MINUTES, delay: str = DELAY) -> DataFrame:
    return windows.window_efficiency_by_pieces(df.withWatermark(TIME, delay), span)


def alerts(df: DataFrame) -> DataFrame:
    return alert_messages(df)


def signal_lost(df: DataFrame, gap_seconds: int = 300, delay: str = DELAY) -> DataFrame:
    """Ships that fell silent: a session that closes ends ``gap_seconds`` after its last message.

    The state per ship is one session, whatever its number of messages.
    """
    sessions = (
        df.withWatermark(TIME, delay)
        .groupBy(F.session_window(TIME, f"{gap_seconds} seconds"), SHIP)
        .agg(F.count("*").alias("nombre_messages"))
    )
    end = F.col("session_window.end")
    return sessions.select(SHIP, (end - F.make_dt_interval(secs=F.lit(gap_seconds))).alias("dernier_message"),
                           end.alias("signal_perdu_a"))
