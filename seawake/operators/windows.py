"""Tumbling-window operators; all but the LAG-based ones run unchanged on streams."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.functions import geo, rules as R
from seawake.functions.moments import recency
from seawake.functions.rules import guarded_ratio
from seawake.operators import timeline
from seawake.operators.anomalies import alert_score
from seawake.schemas import ROUTE, SHIP, TIE, TIME

FIVE_MINUTES = 300


def tumbling(span: int, time: str = TIME) -> Column:
    return F.window(time, f"{span} seconds")


def window_stats(df: DataFrame, span: int = FIVE_MINUTES, time: str = TIME, tie: str | None = TIE) -> DataFrame:
    """Speed, fuel and last position per window, ship and route."""
    at = recency(tie, time)
    last = F.struct("latitude", "longitude", "distance_restante_nm")
    return (
        df.groupBy(tumbling(span, time), SHIP, *ROUTE)
        .agg(
            F.avg("vitesse_noeuds").alias("vitesse_moyenne"),
            F.max("vitesse_noeuds").alias("vitesse_max"),
            F.min("vitesse_noeuds").alias("vitesse_min"),
            F.avg("carburant_litres").alias("carburant_moyen"),
            F.avg("consommation_horaire_litres").alias("consommation_moyenne"),
            F.sum("consommation_horaire_litres").alias("consommation_totale"),
            F.count("*").alias("nombre_mesures"),
            F.max_by(last, at).alias("_last"),
        )
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            SHIP, *ROUTE, "vitesse_moyenne", "vitesse_max", "vitesse_min", "carburant_moyen",
            "consommation_moyenne", "consommation_totale", "nombre_mesures",
            F.col("_last.latitude").alias("derniere_latitude"),
            F.col("_last.longitude").alias("derniere_longitude"),
            F.col("_last.distance_restante_nm").alias("distance_restante"),
        )
    )


def _windowed(df: DataFrame, span: int) -> DataFrame:
    w = tumbling(span)
    return df.withColumn("_w", w).withColumns(
        {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")


WINDOW_KEYS = (SHIP, "window_start", "window_end")


def window_distance(df: DataFrame, span: int = FIVE_MINUTES) -> DataFrame:
    """Distance covered inside each window and ship; legs across window borders do not count."""
    rows = _windowed(df.select(SHIP, TIE, TIME, "latitude", "longitude"), span)
    legs = timeline.with_leg(rows, WINDOW_KEYS, bounded_by=span)
    return legs.groupBy(*WINDOW_KEYS).agg(
        F.count("*").alias("nombre_positions"),
        F.coalesce(F.sum("etape_nm"), F.lit(0.0)).alias("distance_nm"),
    )


def _leg(a: Column, b: Column) -> Column:
    """A leg with an unknown end counts 0, as a missing leg does in a sum."""
    nm = geo.distance_nm(a["latitude"], a["longitude"], b["latitude"], b["longitude"])
    return F.coalesce(nm, F.lit(0.0))


def _walk(ordered: Column) -> Column:
    """Length of a chain of pieces, each with its length ``nm`` and its points ``first`` and ``last``."""
    start = F.struct(ordered[0]["nm"].alias("nm"), ordered[0]["last"].alias("last"))

    def step(state: Column, piece: Column) -> Column:
        nm = state["nm"] + _leg(state["last"], piece["first"]) + piece["nm"]
        return F.struct(nm.alias("nm"), piece["last"].alias("last"))

    return F.aggregate(F.slice(ordered, F.lit(2), F.size(ordered)), start, step, lambda state: state["nm"])


def _paths(df: DataFrame, span: int, piece: int, *extra: str) -> DataFrame:
    """Path pieces of each window and ship, in order, by two stacked window aggregations (LAG is not available on streams).

    The positions of a ship within one minute become a piece of the path, and a window gathers its pieces. An array
    therefore holds one ship's messages of a minute, or one entry per minute of the window. ``extra`` columns travel
    with the first and the last position of a piece.
    """
    piece = math.gcd(span, piece)
    place = F.struct("latitude", "longitude", *extra)
    point = F.struct(TIME, TIE, F.lit(0.0).alias("nm"), place.alias("first"), place.alias("last"))
    points = F.array_sort(F.col("_points"))
    pieces = (
        df.groupBy(tumbling(piece).alias("piece"), SHIP).agg(F.collect_list(point).alias("_points"))
        .select("piece", SHIP, F.size("_points").cast("bigint").alias("_n"), F.struct(
            F.col("piece.start").alias("at"), _walk(points).alias("nm"), points[0]["first"].alias("first"),
            F.element_at(points, -1)["last"].alias("last")).alias("_piece"))
    )
    return (
        pieces.groupBy(F.window("piece", f"{span} seconds").alias("window"), SHIP)
        .agg(F.sum("_n").alias("_n"), F.collect_list("_piece").alias("_pieces"))
        .select(SHIP, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "_n", F.array_sort("_pieces").alias("_pieces"))
    )


def window_distance_by_pieces(df: DataFrame, span: int = FIVE_MINUTES, piece: int = 60) -> DataFrame:
    """The streaming form of :func:`window_distance`."""
    return _paths(df, span, piece).select(SHIP, "window_start", "window_end", F.col("_n").alias("nombre_positions"),
                                          _walk(F.col("_pieces")).alias("distance_nm"))


def window_efficiency_by_pieces(df: DataFrame, span: int = FIVE_MINUTES, piece: int = 60) -> DataFrame:
    """The streaming form of :func:`window_efficiency`: the first and last fuel levels travel with the path."""
    pieces, fuel = F.col("_pieces"), "carburant_litres"
    paths = _paths(df, span, piece, fuel).select(
        SHIP, "window_start", "window_end", _walk(pieces).alias("distance_nm"),
        (pieces[0]["first"][fuel] - F.element_at(pieces, -1)["last"][fuel]).alias("carburant_utilise"))
    return paths.withColumn("efficacite_nm_par_litre", guarded_ratio(F.col("distance_nm"), F.col("carburant_utilise")))


def dominant_direction(df: DataFrame, span: int = FIVE_MINUTES) -> DataFrame:
    """Most frequent of eight compass sectors per window and ship; the lowest sector wins ties.

    A counter for each sector and one for unknown headings are the whole state, so one aggregation serves batch and
    stream.
    """
    sector = geo.compass_sector(F.col("cap_degres"))
    counts = [F.struct(F.count_if(sector == k).alias("nombre"), F.lit(-k).alias("rang")) for k in range(8)]
    unknown = F.struct(F.count_if(sector.isNull()).alias("nombre"), F.lit(None).cast("int").alias("rang"))
    return (
        df.groupBy(tumbling(span), SHIP).agg(F.array_max(F.array(*counts, unknown)).alias("_top"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), SHIP,
                (-F.col("_top.rang")).alias("secteur"), F.col("_top.nombre").alias("nombre"))
    )


def window_alert_score(df: DataFrame, span: int = FIVE_MINUTES) -> DataFrame:
    """Documented anomalies and their weighted score per window and ship."""
    marked = df.withColumn("anomalies", R.documented_anomalies(df.columns))
    return (
        marked.groupBy(tumbling(span), SHIP)
        .agg(F.sum(F.size("anomalies")).alias("nombre_anomalies"), F.sum(alert_score()).alias("score_alerte"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), SHIP,
                "nombre_anomalies", "score_alerte")
    )


def window_efficiency(df: DataFrame, span: int = FIVE_MINUTES) -> DataFrame:
    """Nautical miles per litre within each window and ship; 0 where no fuel was used."""
    rows = _windowed(df.select(SHIP, TIE, TIME, "latitude", "longitude", "carburant_litres"), span)
    at = recency(TIE)
    per_window = timeline.with_leg(rows, WINDOW_KEYS, bounded_by=span).groupBy(*WINDOW_KEYS).agg(
        F.coalesce(F.sum("etape_nm"), F.lit(0.0)).alias("distance_nm"),
        (F.min_by("carburant_litres", at) - F.max_by("carburant_litres", at)).alias("carburant_utilise"),
    )
    return per_window.withColumn(
        "efficacite_nm_par_litre", guarded_ratio(F.col("distance_nm"), F.col("carburant_utilise")))
