"""Grouped analyses of the raw telemetry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seawake.functions.moments import is_finite, micros
from seawake.functions.rules import guarded_ratio, is_anomaly, maintenance_priority, risk_score
from seawake.schemas import OPERATING, ROUTE, SHIP, TIE, TIME, OperatingRules


def ship_route_rollup(df: DataFrame, rules: OperatingRules = OPERATING, tie: str | None = TIE,
                      by: Sequence[str] = ()) -> DataFrame:
    """Everything the ship and route analyses need, one row per ship and route (and ``by``, say the day).

    Sums, counts, extremes and the first and last fuel level can be merged
    further, so ship statistics, route performance, maintenance, voyages,
    comparisons and the fleet figures all follow from this one pass over the raw
    rows. A caller that wants several of them writes the rollup once (see
    ``jobs.run_batch``); for a single one Spark prunes the parts not used.
    """
    moment = F.struct(TIME, *([tie] if tie else []), "carburant_litres")

    def parts(column: str, short: str) -> list:
        return [F.sum(column).alias(f"{short}_somme"), F.count(column).alias(f"{short}_n"),
                F.max(column).alias(f"{short}_max"), F.min(column).alias(f"{short}_min")]

    return df.groupBy(*by, SHIP, *ROUTE).agg(
        F.count("*").alias("nombre_mesures"),
        *parts("vitesse_noeuds", "vitesse"),
        *parts("consommation_horaire_litres", "consommation"),
        *parts("distance_restante_nm", "distance"),
        *parts("temperature_eau_celsius", "temp"),
        F.count_if(F.col("etat_moteur") != rules.engine_normal).alias("incidents"),
        F.count_if(is_anomaly(rules)).alias("anomalies"),
        F.min(moment).alias("premier"),
        F.max(moment).alias("dernier"),
    )


def merged_rollup(parts: DataFrame) -> DataFrame:
    """The rollup of all rows from rollups of parts of them (of single days, for instance)."""
    merge = {"somme": F.sum, "n": F.sum, "max": F.max, "min": F.min}
    figures = [merge[how](f"{short}_{how}").alias(f"{short}_{how}")
               for short in ("vitesse", "consommation", "distance", "temp") for how in merge]
    return parts.groupBy(SHIP, *ROUTE).agg(
        F.sum("nombre_mesures").alias("nombre_mesures"), *figures, F.sum("incidents").alias("incidents"),
        F.sum("anomalies").alias("anomalies"), F.min("premier").alias("premier"), F.max("dernier").alias("dernier"))


def _mean(short: str) -> Column:
    return F.try_divide(F.col(f"{short}_somme"), F.col(f"{short}_n"))


def _merged_mean(short: str) -> Column:
    return F.try_divide(F.sum(f"{short}_somme"), F.sum(f"{short}_n"))


FUEL_USED = "premier.carburant_litres - dernier.carburant_litres"
COVERED = "distance_max - distance_min"


def ship_statistics_of(rollup: DataFrame) -> DataFrame:
    """Speed, consumption, fuel and distance figures per ship and route."""
    used, covered = F.expr(FUEL_USED), F.expr(COVERED)
    return rollup.select(
        SHIP, *ROUTE, "nombre_mesures",
        _mean("vitesse").alias("vitesse_moyenne"), "vitesse_max", "vitesse_min",
        _mean("consommation").alias("consommation_moyenne"),
        F.col("consommation_somme").alias("consommation_totale"),
        F.col("premier.carburant_litres").alias("carburant_initial"),
        F.col("dernier.carburant_litres").alias("carburant_final"),
        F.col("distance_max").alias("distance_debut"),
        F.col("distance_min").alias("distance_min_restante"),
        used.alias("carburant_utilise"),
        covered.alias("distance_parcourue"),
        guarded_ratio(covered, used).alias("efficacite_carburant_nm_per_litre"),
    )


def ship_statistics(df: DataFrame, tie: str | None = TIE) -> DataFrame:
    return ship_statistics_of(ship_route_rollup(df, tie=tie))


def route_performance_of(rollup: DataFrame) -> DataFrame:
    """A ship has one row per route, so counting rows counts ships; no distinct is needed."""
    return (
        rollup.groupBy(*ROUTE)
        .agg(
            F.count(SHIP).alias("nombre_navires"),
            _merged_mean("vitesse").alias("vitesse_moyenne_route"),
            _merged_mean("consommation").alias("consommation_moyenne_route"),
            _merged_mean("distance").alias("distance_moyenne_route"),
        )
        .withColumn("temps_estime_heures",
                    guarded_ratio(F.col("distance_moyenne_route"), F.col("vitesse_moyenne_route")))
    )


def route_performance(df: DataFrame) -> DataFrame:
    return route_performance_of(ship_route_rollup(df))


def temporal_analysis(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date(TIME).alias("date"), F.hour(TIME).alias("hour")).agg(
        F.count_distinct(SHIP).alias("navires_actifs"),
        F.avg("vitesse_noeuds").alias("vitesse_moyenne"),
        F.avg("consommation_horaire_litres").alias("consommation_moyenne"),
    )


def weather_impact(df: DataFrame) -> DataFrame:
    return df.groupBy("meteo").agg(
        F.count("*").alias("occurrences"),
        F.avg("vitesse_noeuds").alias("vitesse_moyenne"),
        F.avg("consommation_horaire_litres").alias("consommation_moyenne"),
    )


def maintenance_prediction_of(rollup: DataFrame) -> DataFrame:
    """Risk score and priority per ship."""
    return (
        rollup.groupBy(SHIP)
        .agg(
            _merged_mean("temp").alias("temp_moyenne"),
            F.max("temp_max").alias("temp_max"),
            F.sum("incidents").alias("incidents_moteur"),
            F.max("dernier")["carburant_litres"].alias("carburant_actuel"),
        )
        .withColumn("score_risque",
                    risk_score(F.col("temp_max"), F.col("incidents_moteur"), F.col("carburant_actuel")))
        .withColumn("priorite_maintenance", maintenance_priority(F.col("score_risque")))
    )


def maintenance_prediction(df: DataFrame, rules: OperatingRules = OPERATING, tie: str | None = TIE) -> DataFrame:
    return maintenance_prediction_of(ship_route_rollup(df, rules, tie))


def fleet_stats(df: DataFrame) -> DataFrame:
    """Records, speed, engine temperature and consumption per ship (extended telemetry)."""
    return df.groupBy(SHIP).agg(
        F.count("*").alias("nb_records"),
        F.avg("vitesse_noeuds").alias("vitesse_moy"),
        F.max("temperature_moteur_celsius").alias("temp_max"),
        F.sum("consommation_horaire_litres").alias("total_consomme"),
    )


def low_fuel_counts(df: DataFrame, threshold: float = 20000.0) -> DataFrame:
    return (df.filter(F.col("carburant_litres") < threshold)
            .groupBy(SHIP).agg(F.count("*").alias("nb_alerts")))


def voyages_of(rollup: DataFrame) -> DataFrame:
    """One row per ship and route: distance, fuel used and hours between first and last message."""
    hours = (micros(F.col("dernier.ts")) - micros(F.col("premier.ts"))) / 3.6e9
    return rollup.select(SHIP, *ROUTE, F.expr(COVERED).alias("distance_nm"),
                         F.expr(FUEL_USED).alias("carburant_consomme"), hours.alias("temps_heures"))


def voyages(df: DataFrame) -> DataFrame:
    return voyages_of(ship_route_rollup(df))


def route_efficiency(voyage: DataFrame) -> DataFrame:
    return voyage.groupBy(*ROUTE).agg(
        F.avg(F.try_divide("distance_nm", F.nullif("carburant_consomme", F.lit(0.0)))).alias("efficacite_moyenne"),
        F.count("*").alias("nb_traversees"),
        F.avg("temps_heures").alias("temps_moyen"),
    )


def ship_vs_route_of(rollup: DataFrame) -> DataFrame:
    """Each ship's mean speed and consumption beside those of its route.

    The join sees one row per ship and route on one side and one per route on
    the other, never raw rows. Both sides use the same columns of the rollup,
    so Spark computes it once and reads its shuffle twice.
    """
    routes = rollup.groupBy(*ROUTE).agg(
        F.sum("nombre_mesures").alias("nombre_mesures_route"),
        _merged_mean("vitesse").alias("vitesse_moyenne_route"),
        _merged_mean("consommation").alias("consommation_moyenne_route"),
    )
    return (
        rollup.join(routes, list(ROUTE))
        .select(SHIP, *ROUTE, "nombre_mesures", "nombre_mesures_route",
                _mean("vitesse").alias("vitesse_moyenne"), "vitesse_moyenne_route",
                _mean("consommation").alias("consommation_moyenne"), "consommation_moyenne_route")
        .withColumn("ecart_vitesse", F.col("vitesse_moyenne") - F.col("vitesse_moyenne_route"))
    )


def ship_vs_route(df: DataFrame) -> DataFrame:
    return ship_vs_route_of(ship_route_rollup(df))


def ship_rank_in_route(stats: DataFrame) -> DataFrame:
    """RANK and DENSE_RANK of the ships of a route by efficiency (one row per ship, not per message)."""
    value = "efficacite_carburant_nm_per_litre"
    return ranked(stats.select(*ROUTE, SHIP, value), value, ROUTE, "rang", "rang_dense")


def fleet_kpis_of(rollup: DataFrame) -> DataFrame:
    """Ships, distance, mean speed, anomalies and urgent maintenance in one row.

    ``total_navires`` counts rows of the ship statistics, as the dashboard does.
    """
    per_ship = rollup.groupBy(SHIP).agg(
        F.count("*").alias("rows"),
        F.sum(_mean("vitesse")).alias("speed"),
        F.sum(F.expr(COVERED)).alias("distance"),
        F.sum("anomalies").alias("anomalies"),
        risk_score(F.max("temp_max"), F.sum("incidents"), F.max("dernier")["carburant_litres"]).alias("score"),
    )
    return per_ship.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_navires"),
        F.sum("distance").alias("distance_totale_nm"),
        F.try_divide(F.sum("speed"), F.sum("rows")).alias("vitesse_moyenne"),
        F.coalesce(F.sum("anomalies"), F.lit(0)).alias("total_anomalies"),
        F.count_if(maintenance_priority(F.col("score")) == "URGENT").alias("maintenances_urgentes"),
    )


def fleet_kpis(df: DataFrame, rules: OperatingRules = OPERATING) -> DataFrame:
    return fleet_kpis_of(ship_route_rollup(df, rules))


def speed_histogram(df: DataFrame, width: float = 2.0) -> DataFrame:
    edge = F.floor(F.col("vitesse_noeuds") / width) * F.lit(width)
    return df.filter(F.col("vitesse_noeuds").isNull() | is_finite(F.col("vitesse_noeuds"))).groupBy(edge.alias("vitesse_min")).agg(F.count("*").alias("nombre"))


def speed_fuel_corr(df: DataFrame) -> DataFrame:
    return df.agg(F.corr("vitesse_noeuds", "consommation_horaire_litres").alias("correlation"))


def traffic_grid(df: DataFrame, cell_degrees: float = 0.5) -> DataFrame:
    """Messages per grid cell: the table behind a density map."""
    row = F.floor(F.col("latitude") / cell_degrees).alias("cellule_lat")
    col = F.floor(F.col("longitude") / cell_degrees).alias("cellule_lon")
    placed = df.filter((F.col("latitude").isNull() | is_finite(F.col("latitude")))
                       & (F.col("longitude").isNull() | is_finite(F.col("longitude"))))
    return placed.groupBy(row, col).agg(F.count("*").alias("nombre"))


def in_value_ranges(df: DataFrame, value: str, keys: Sequence[str], ranges: int = 64, spread: int = 16) -> DataFrame:
    """Adds ``_bin``, the number of a value's range within its key: ``ranges`` ranges of about as many rows each.

    A mergeable quantile sketch per key (its size depends on the accuracy alone) gives the values between the ranges.
    They are few, but a key may have a third of all rows, so the join that brings them together is salted over
    ``spread`` tasks. NULL has range -1, NaN the highest.
    """
    numbers = df.filter(is_finite(F.col(value)))
    at = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = numbers.groupBy(*keys).agg(F.percentile_approx(value, at, 10 * ranges).alias("_cuts"))
    cuts = cuts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_cuts",
                       F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_of_salt"))
    # Null-safe equality: a NULL key is a key.
    match = F.col("_salt") == F.col("_of_salt")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(spread)).cast("int"))
    passed = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<double>")), lambda cut: cut < F.col(value)))
    return rows.join(cuts, match, "left").withColumn("_bin", F.when(F.col(value).isNull(), -1).otherwise(passed)).drop(
        "_salt", "_of_salt", "_cuts", *[f"_of_{k}" for k in keys])


def quantiles(df: DataFrame, value: str, names: dict[str, float], keys: Sequence[str] = (SHIP,),
              ranges: int = 64) -> DataFrame:
    """Exact interpolated quantiles per key without gathering a key's values.

    Equal values are counted before any shuffle. Value ranges of about equal size per key then tell where the wanted
    ranks lie, and only the distinct values of those ranges are put in order: a task orders a ``ranges``-th part of a
    key, however the values are spread. NULL, NaN and infinite values don't count.
    """
    counted = df.filter(is_finite(F.col(value))).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    counted = in_value_ranges(counted, "_v", keys, ranges)
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    bins = (
        counted.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_bc"))
        .withColumn("_before", F.coalesce(
            F.sum("_bc").over(by_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_n", F.sum("_bc").over(Window.partitionBy(*keys)))
    )

    def rank(p: float):
        return F.lit(p) * (F.col("_n") - 1)

    ranks = F.array(*[f(rank(p)) for p in names.values() for f in (F.floor, F.ceil)])
    hit = F.exists(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_bc")))
    upto = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    wanted = bins.filter(hit).select(
        *[F.col(k).alias(f"_of_{k}") for k in [*keys, "_bin"]], "_before", "_n")
    # Null-safe equality adds no IS NOT NULL filters to one side only, so both
    # sides share the scans and shuffles below them.
    match = F.lit(True)
    for k in [*keys, "_bin"]:
        match = match & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    placed = (
        counted.join(wanted, match)
        .withColumn("_end", F.col("_before") + F.sum("_c").over(upto))
        .withColumn("_start", F.col("_end") - F.col("_c"))
    )

    def at(r):
        return F.max(F.when((r >= F.col("_start")) & (r < F.col("_end")), F.col("_v")))

    wide = placed.groupBy(*keys).agg(
        F.max("_n").alias("_n"),
        *[at(F.floor(rank(p))).alias(f"_lo_{name}") for name, p in names.items()],
        *[at(F.ceil(rank(p))).alias(f"_hi_{name}") for name, p in names.items()],
    )
    return wide.select(
        *keys, F.col("_n").alias("nombre"),
        *[(F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))
           * (rank(p) - F.floor(rank(p)))).alias(name) for name, p in names.items()],
    )


def ranked(df: DataFrame, value: str, keys: Sequence[str], rank: str, dense: str, ranges: int = 64) -> DataFrame:
    """RANK and DENSE_RANK by falling ``value`` within ``keys``, without a window over a whole key.

    A value's rank is its rank inside its range plus the rows (or the different values) of all higher ranges; ranges
    are few per key and are summed up there. NaN comes first and NULL last, as in a window.
    """
    rows = in_value_ranges(df, value, keys, ranges)
    different = F.count_distinct(value) + F.max(F.when(F.col(value).isNull(), 1).otherwise(0))
    above = Window.partitionBy(*keys).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_bin").agg(F.count("*").alias("_rows"), different.alias("_values"))
    bins = counts.select(
        *[F.col(k).alias(f"_of_{k}") for k in [*keys, "_bin"]],
        F.coalesce(F.sum("_rows").over(above), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum("_values").over(above), F.lit(0)).alias("_values"))
    match = F.lit(True)
    for k in [*keys, "_bin"]:
        match = match & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(F.col(value).desc())
    return rows.join(bins, match).select(
        *df.columns, (F.rank().over(inside) + F.col("_rows")).cast("int").alias(rank),
        (F.dense_rank().over(inside) + F.col("_values")).cast("int").alias(dense))


def ship_quartiles(df: DataFrame, value: str = "vitesse_noeuds") -> DataFrame:
    """The five figures of a box plot per ship."""
    return quantiles(df, value, {"minimum": 0.0, "q1": 0.25, "mediane": 0.5, "q3": 0.75, "maximum": 1.0})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    counts = [df.agg(F.count("*").alias("lignes")).select(F.lit(name).alias("table"), "lignes")
              for name, df in tables.items()]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result
