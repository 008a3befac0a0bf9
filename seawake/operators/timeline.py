"""Ordered computations along each ship's time line.

A window partitioned by ship alone would send a ship's whole history to one
task. Here time is cut into fixed slots and every window is partitioned by
(ship, slot). What has to cross a slot border travels as *halo rows*: extra
rows in the next (or previous) slot, dropped again after the window. The
per-ship windows that remain run over one pre-aggregated row per slot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seawake.functions import geo
from seawake.functions.moments import after, micros, recency, slot
from seawake.operators.latest import latest_rows, latest_time
from seawake.schemas import SHIP, TIE, TIME

HOUR = 3600


def _slotted(df: DataFrame, slot_seconds: int) -> DataFrame:
    return df.withColumn("_slot", slot(F.col(TIME), slot_seconds)).withColumn("_halo", F.lit(False))


def _neighbours(df: DataFrame, columns: Mapping[str, str], keys: Sequence[str], tie: str,
                slot_seconds: int, bounded_by: int | None, forward: bool) -> DataFrame:
    shift = F.lag if forward else F.lead
    if bounded_by is not None and bounded_by <= slot_seconds:
        in_key = Window.partitionBy(*keys).orderBy(TIME, tie)
        return df.withColumns({new: shift(old).over(in_key) for old, new in columns.items()})
    rows = _slotted(df, slot_seconds)
    edge = [c for c in dict.fromkeys([TIME, tie, *columns]) if c not in keys]
    pick = F.max_by if forward else F.min_by
    per_ship = Window.partitionBy(*keys).orderBy("_slot")
    target = F.lead("_slot") if forward else F.lag("_slot")
    halo = (
        rows.groupBy(*keys, "_slot")
        .agg(pick(F.struct(*edge), recency(tie)).alias("_edge"))
        .withColumn("_target", target.over(per_ship))
        .filter(F.col("_target").isNotNull())
        .select(*keys, F.col("_target").alias("_slot"), "_edge.*", F.lit(True).alias("_halo"))
    )
    in_slot = Window.partitionBy(*keys, "_slot").orderBy(TIME, tie)
    return (
        rows.unionByName(halo, allowMissingColumns=True)
        .withColumns({new: shift(old).over(in_slot) for old, new in columns.items()})
        .filter(~F.col("_halo"))
        .drop("_slot", "_halo")
    )


def with_previous(df: DataFrame, columns: Mapping[str, str], keys: Sequence[str] = (SHIP,),
                  tie: str = TIE, slot_seconds: int = HOUR, bounded_by: int | None = None) -> DataFrame:
    """LAG along (time, tie) per key; ``columns`` maps a column to its new name.

    ``bounded_by`` says that a key spans at most so many seconds (a window is
    part of it); a key that fits in a slot needs no halo rows.
    """
    return _neighbours(df, columns, keys, tie, slot_seconds, bounded_by, forward=True)


def with_next(df: DataFrame, columns: Mapping[str, str], keys: Sequence[str] = (SHIP,),
              tie: str = TIE, slot_seconds: int = HOUR, bounded_by: int | None = None) -> DataFrame:
    """LEAD along (time, tie) per key."""
    return _neighbours(df, columns, keys, tie, slot_seconds, bounded_by, forward=False)


def running_sum(df: DataFrame, value: str, out: str, keys: Sequence[str] = (SHIP,),
                tie: str = TIE, slot_seconds: int = HOUR) -> DataFrame:
    """SUM over all rows up to the current one, per key."""
    rows = _slotted(df, slot_seconds).withColumn("_part", F.col(value))
    before = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    halo = (
        rows.groupBy(*keys, "_slot")
        .agg(F.sum("_part").alias("_total"))
        .withColumn("_part", F.sum("_total").over(before))
        .filter(F.col("_part").isNotNull())
        .select(*keys, "_slot", "_part", F.lit(True).alias("_halo"))
    )
    in_slot = (
        Window.partitionBy(*keys, "_slot")
        .orderBy(F.col("_halo").desc(), TIME, tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.unionByName(halo, allowMissingColumns=True)
        .withColumn(out, F.sum("_part").over(in_slot))
        .filter(~F.col("_halo"))
        .drop("_slot", "_halo", "_part")
    )


def trailing_mean(df: DataFrame, value: str, out: str, seconds: int, keys: Sequence[str] = (SHIP,),
                  slot_seconds: int = HOUR) -> DataFrame:
    """AVG over the rows of the last ``seconds`` (current time included), per key.

    The span is cut into whole slots, ``slot_seconds`` long at most. A row's sum has three parts: its own slot up to
    it, the whole slots before, and the end of the slot in which the span begins. For the last part each row is sent
    to the slot one span later too. Nothing is subtracted, so a NaN or a huge value counts only as long as it is
    inside the span; the cost per row does not depend on how many rows the span holds.
    """
    width = next(seconds // n for n in range(1, seconds + 1) if seconds % n == 0 and seconds // n <= slot_seconds)
    own, at, lag = slot(F.col(TIME), width), micros(F.col(TIME)), seconds // width
    copies = F.array(*[F.struct(F.lit(late).alias("_late"), (own + n).alias("_slot"),
                                (at + n * width * 1_000_000).alias("_at")) for late, n in ((False, 0), (True, lag))])
    rows = df.withColumn("_copy", F.explode(copies)).select(
        *df.columns, "_copy.*", F.lit(False).alias("_halo"), F.col(value).alias("_part"),
        F.when(F.col(value).isNotNull(), 1).otherwise(0).alias("_count"))
    if lag > 1:
        rows = rows.unionByName(_whole_slots(df, value, keys, width, lag), allowMissingColumns=True)
    in_slot = Window.partitionBy(*keys, "_slot")
    upto = in_slot.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    since_then = in_slot.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def inside(part: str) -> Column:
        head = F.sum(F.when(~F.col("_late"), F.col(part))).over(upto)
        tail = F.sum(F.when(F.col("_late"), F.col(part))).over(since_then)
        return F.coalesce(head, F.lit(0)) + F.coalesce(tail, F.lit(0))

    return (
        rows.withColumn(out, F.try_divide(inside("_part"), inside("_count")))
        .filter(~F.col("_late") & ~F.col("_halo"))
        .drop("_late", "_slot", "_at", "_halo", "_part", "_count")
    )


def _whole_slots(df: DataFrame, value: str, keys: Sequence[str], width: int, lag: int) -> DataFrame:
    """One halo row per key and slot: the totals of the slots that a span ending there covers whole."""
    totals = df.groupBy(*keys, slot(F.col(TIME), width).alias("_slot")).agg(
        F.sum(value).alias("_part"), F.count(value).alias("_count"))
    whole = Window.partitionBy(*keys).orderBy("_slot").rangeBetween(1 - lag, -1)
    return totals.select(
        *keys, "_slot", F.sum("_part").over(whole).alias("_part"), F.sum("_count").over(whole).alias("_count"),
        (F.col("_slot") * width * 1_000_000).alias("_at"), F.lit(False).alias("_late"), F.lit(True).alias("_halo"))


def since(df: DataFrame, columns: Sequence[str], cutoff: Column, keys: Sequence[str] = (SHIP,),
          tie: str = TIE, date: str | None = None) -> DataFrame:
    """The rows after ``cutoff`` plus each key's last row up to it.

    That one older row is all LAG needs, so history is reduced to a row per key
    and only the recent part goes through the ordered computation.
    """
    older = latest_rows(df.filter(F.col(TIME) <= cutoff), columns, keys, tie)
    return df.filter(after(cutoff, date=date)).select(*columns).unionByName(older)


def fit_slot(df: DataFrame, rows_per_slot: int = 5_000_000, keys: Sequence[str] = (SHIP,)) -> int:
    """Slot length in seconds at which the busiest key stays near ``rows_per_slot`` rows a slot.

    One counted pass; only the peak count per minute comes back. For fleets in
    which one ship sends far more than the others.
    """
    per_minute = df.groupBy(*keys, slot(F.col(TIME), 60).alias("_m")).agg(F.count("*").alias("n"))
    peak = per_minute.agg(F.max("n")).first()[0] or 1
    return 60 * min(max(rows_per_slot // peak, 1), 1440)


# --- results ---------------------------------------------------------------

def fuel_drops(df: DataFrame, slot_seconds: int = HOUR) -> DataFrame:
    """Rows whose fuel fell against the ship's previous row."""
    rows = with_previous(df.select(SHIP, TIE, TIME, "carburant_litres"),
                         {"carburant_litres": "carburant_precedent"}, slot_seconds=slot_seconds)
    used = F.col("carburant_precedent") - F.col("carburant_litres")
    return rows.withColumn("carburant_consomme", used).filter(used > 0)


def signal_gaps(df: DataFrame, slot_seconds: int = HOUR) -> DataFrame:
    """Every row with the ship's next message time and the seconds until then."""
    rows = with_next(df.select(SHIP, TIE, TIME), {TIME: "ts_suivant"}, slot_seconds=slot_seconds)
    gap = (micros(F.col("ts_suivant")) - micros(F.col(TIME))) / 1e6
    return rows.withColumn("ecart_secondes", gap)


def signal_lost(df: DataFrame, gap_seconds: int = 300, as_of: Column | None = None) -> DataFrame:
    """Moments at which a ship had been silent for ``gap_seconds``, known at ``as_of``."""
    rows = with_next(df.select(SHIP, TIE, TIME), {TIME: "ts_suivant"})
    lost = F.col(TIME) + F.make_dt_interval(secs=F.lit(gap_seconds))
    silent = F.col("ts_suivant").isNull() | (F.col("ts_suivant") >= lost)
    return (
        rows.filter(silent & (lost <= (latest_time(df) if as_of is None else as_of)))
        .select(SHIP, F.col(TIME).alias("dernier_message"), lost.alias("signal_perdu_a"))
    )


def with_leg(df: DataFrame, keys: Sequence[str] = (SHIP,), slot_seconds: int = HOUR,
             bounded_by: int | None = None) -> DataFrame:
    """Adds ``etape_nm``, the distance from the previous position of the same key."""
    rows = with_previous(df, {"latitude": "_lat", "longitude": "_lon"}, keys, slot_seconds=slot_seconds,
                         bounded_by=bounded_by)
    leg = geo.distance_nm(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"))
    return rows.withColumn("etape_nm", leg).drop("_lat", "_lon")


def distance_travelled(df: DataFrame) -> DataFrame:
    legs = with_leg(df.select(SHIP, TIE, TIME, "latitude", "longitude"))
    return legs.groupBy(SHIP).agg(
        F.count("*").alias("nombre_positions"),
        F.coalesce(F.sum("etape_nm"), F.lit(0.0)).alias("distance_nm"),
    )


def rolling_speed(df: DataFrame, seconds: int = 1800) -> DataFrame:
    rows = df.select(SHIP, TIE, TIME, "vitesse_noeuds")
    return trailing_mean(rows, "vitesse_noeuds", "vitesse_recente", seconds)


def running_fuel(df: DataFrame) -> DataFrame:
    rows = df.select(SHIP, TIE, TIME, "consommation_horaire_litres")
    return running_sum(rows, "consommation_horaire_litres", "consommation_cumulee")


def daily_fuel(df: DataFrame, days: int = 7, as_of: Column | None = None) -> DataFrame:
    """Fuel, distance and litres per 100 nm by ship and day over the last ``days``.

    Fuel is the sum of the drops between messages, distance the sum of the legs.
    """
    now = latest_time(df) if as_of is None else as_of
    cutoff = now - F.make_dt_interval(days=F.lit(days))
    columns = [SHIP, TIE, TIME, "latitude", "longitude", "carburant_litres"]
    rows = with_previous(since(df, columns, cutoff),
                         {"latitude": "_lat", "longitude": "_lon", "carburant_litres": "_fuel"})
    drop = F.greatest(F.col("_fuel") - F.col("carburant_litres"), F.lit(0.0))
    leg = geo.distance_nm(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"))
    return (
        rows.filter(F.col(TIME) > cutoff)
        .groupBy(SHIP, F.to_date(TIME).alias("date_voyage"))
        .agg(F.coalesce(F.sum(F.when(F.col("_fuel").isNotNull(), drop)), F.lit(0.0)).alias("total_litre"),
             F.coalesce(F.sum(leg), F.lit(0.0)).alias("distance_nm"))
        .withColumn("litres_par_100nm", F.try_divide("total_litre", "distance_nm") * 100)
    )
