"""DuckDB statements that compute each query's result from the same Parquet tables."""

# The telemetry derivation of FIXTURES.md section 2, repeated in SQL.
# _text_ columns and the extended engine fields come last.
TELEMETRY = """
base AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(props->>'$.k' AS INTEGER) AS k,
         user_id % 8 AS dep,
         (user_id % 8 + 1 + (user_id // 8) % 7) % 8 AS arr,
         CAST((event_id * 3) % 4000 AS DOUBLE) / CAST(4 AS DOUBLE) AS remaining,
         CAST(3 AS DOUBLE) + CAST((CAST(props->>'$.k' AS INTEGER) * 7) % 109 AS DOUBLE) / CAST(4 AS DOUBLE) AS speed,
         ['Alger','Barcelona','Casablanca','Genova','Marseille','Tanger','Tunis','Valencia'] AS names,
         CAST([36.7538,41.3851,33.5731,44.4056,43.2965,35.7595,36.8065,39.4699] AS DOUBLE[]) AS lats,
         CAST([3.0588,2.1734,-7.5898,8.9463,5.3698,-5.8340,10.1815,-0.3763] AS DOUBLE[]) AS lons
  FROM events
), telemetry AS (
  SELECT event_id, ts,
         printf('SHIP_%03d', user_id + 1) AS navire_id,
         lats[dep + 1] + (lats[arr + 1] - lats[dep + 1]) * (CAST(1 AS DOUBLE) - remaining / CAST(1000 AS DOUBLE)) AS latitude,
         lons[dep + 1] + (lons[arr + 1] - lons[dep + 1]) * (CAST(1 AS DOUBLE) - remaining / CAST(1000 AS DOUBLE)) AS longitude,
         speed AS vitesse_noeuds,
         k * CAST(3.5 AS DOUBLE) AS cap_degres,
         CAST(80000 - (event_id * 83 + user_id * 331) % 79000 AS DOUBLE) AS carburant_litres,
         CAST(18 AS DOUBLE) + CAST(k % 33 AS DOUBLE) / CAST(4 AS DOUBLE) AS temperature_eau_celsius,
         CASE WHEN event_id % 10 < 7 THEN 'claire' WHEN event_id % 10 = 7 THEN 'nuageux'
              WHEN event_id % 10 = 8 THEN 'pluie_legere' WHEN event_id % 20 = 9 THEN 'brouillard'
              ELSE 'tempete' END AS meteo,
         CASE WHEN event_type = 'error' THEN 'surchauffe' WHEN k >= 95 THEN 'maintenance_requise'
              WHEN k = 94 THEN 'optimal' ELSE 'normal' END AS etat_moteur,
         names[dep + 1] AS port_depart, names[arr + 1] AS port_arrivee,
         remaining AS distance_restante_nm,
         CAST(10 AS DOUBLE) + CAST(2.5 AS DOUBLE) * speed + CAST(k % 20 AS DOUBLE) / CAST(4 AS DOUBLE) AS consommation_horaire_litres,
         lats[arr + 1] AS port_latitude, lons[arr + 1] AS port_longitude,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso,
         CAST(1000 + (event_id * 37) % 2000 AS INTEGER) AS rpm_moteur,
         CAST(70 AS DOUBLE) + CAST(k % 80 AS DOUBLE) / CAST(4 AS DOUBLE) AS temperature_moteur_celsius
  FROM base
)"""

BASIC = """event_id, ts, navire_id, latitude, longitude, vitesse_noeuds, cap_degres, carburant_litres,
  temperature_eau_celsius, meteo, etat_moteur, port_depart, port_arrivee, distance_restante_nm,
  consommation_horaire_litres"""

SHIP_STATS = """ship_stats AS (
  SELECT *, carburant_initial - carburant_final AS carburant_utilise,
         distance_debut - distance_min_restante AS distance_parcourue,
         CASE WHEN carburant_initial - carburant_final > 0
              THEN (distance_debut - distance_min_restante) / (carburant_initial - carburant_final)
              ELSE 0.0::DOUBLE END AS efficacite_carburant_nm_per_litre
  FROM (SELECT navire_id, port_depart, port_arrivee, count(*) AS nombre_mesures,
               avg(vitesse_noeuds) AS vitesse_moyenne, max(vitesse_noeuds) AS vitesse_max,
               min(vitesse_noeuds) AS vitesse_min, avg(consommation_horaire_litres) AS consommation_moyenne,
               sum(consommation_horaire_litres) AS consommation_totale,
               arg_min(carburant_litres, (ts, event_id)) AS carburant_initial,
               arg_max(carburant_litres, (ts, event_id)) AS carburant_final,
               max(distance_restante_nm) AS distance_debut, min(distance_restante_nm) AS distance_min_restante
        FROM telemetry GROUP BY ALL) s
)"""

ROUTE_PERF = """route_perf AS (
  SELECT *, CASE WHEN vitesse_moyenne_route > 0 THEN distance_moyenne_route / vitesse_moyenne_route
                 ELSE 0.0::DOUBLE END AS temps_estime_heures
  FROM (SELECT port_depart, port_arrivee, count(DISTINCT navire_id) AS nombre_navires,
               avg(vitesse_noeuds) AS vitesse_moyenne_route,
               avg(consommation_horaire_litres) AS consommation_moyenne_route,
               avg(distance_restante_nm) AS distance_moyenne_route
        FROM telemetry GROUP BY ALL) r
)"""

WEATHER = """weather AS (
  SELECT meteo, count(*) AS occurrences, avg(vitesse_noeuds) AS vitesse_moyenne,
         avg(consommation_horaire_litres) AS consommation_moyenne
  FROM telemetry GROUP BY meteo
)"""

MAINTENANCE = """maintenance AS (
  SELECT *, CASE WHEN score_risque >= 3 THEN 'URGENT' WHEN score_risque = 2 THEN 'MOYEN' ELSE 'BAS' END AS priorite_maintenance
  FROM (SELECT *, (CASE WHEN temp_max > 25 THEN 1 ELSE 0 END) + (CASE WHEN incidents_moteur > 0 THEN 2 ELSE 0 END)
                  + (CASE WHEN carburant_actuel < 15000 THEN 1 ELSE 0 END) AS score_risque
        FROM (SELECT navire_id, avg(temperature_eau_celsius) AS temp_moyenne, max(temperature_eau_celsius) AS temp_max,
                     count(*) FILTER (etat_moteur <> 'normal') AS incidents_moteur,
                     arg_max(carburant_litres, (ts, event_id)) AS carburant_actuel
              FROM telemetry GROUP BY navire_id) a) b
)"""

ANOMALIES = """anomalies AS (
  SELECT navire_id, ts AS "timestamp", latitude, longitude, carburant_litres, vitesse_noeuds, etat_moteur,
         CASE WHEN carburant_litres < 10000 THEN 'CARBURANT_BAS' WHEN vitesse_noeuds < 5 THEN 'VITESSE_ANORMALE'
              WHEN etat_moteur <> 'normal' THEN 'MOTEUR_ANOMALIE' ELSE 'AUTRE' END AS type_anomalie
  FROM telemetry WHERE carburant_litres < 10000 OR vitesse_noeuds < 5 OR etat_moteur <> 'normal'
)"""

# One row per documented anomaly; ``rank`` is the position in the row's array.
DOCUMENTED = """documented AS (
  SELECT *, 1 AS rank, 'LOW_FUEL' AS anomalie, 'moyen' AS severite, 2 AS points, 'Carburant critique' AS description
  FROM telemetry WHERE carburant_litres < 20000
  UNION ALL SELECT *, 2, 'HIGH_TEMP', 'eleve', 3, 'Moteur surchauffé' FROM telemetry WHERE temperature_moteur_celsius > 85
  UNION ALL SELECT *, 3, 'ABNORMAL_SPEED', 'moyen', 2, 'Vitesse anormale' FROM telemetry WHERE vitesse_noeuds < 2 OR vitesse_noeuds > 25
)"""

ALERTS = """alerts AS (
  SELECT *, 'ALERTE: Carburant bas (' || CAST(trunc(carburant_litres) AS BIGINT) || 'L)' AS message FROM telemetry WHERE carburant_litres < 10000
  UNION ALL SELECT *, 'ALERTE: Navire dans une tempête' FROM telemetry WHERE meteo = 'tempete'
  UNION ALL SELECT *, 'ALERTE: Moteur en état ' || etat_moteur FROM telemetry WHERE etat_moteur IN ('maintenance_requise', 'surchauffe')
  UNION ALL SELECT *, 'ALERTE: Vitesse anormalement basse (' || CAST(trunc(vitesse_noeuds) AS BIGINT) || ' nœuds)' FROM telemetry WHERE vitesse_noeuds < 5
)"""

ETA = """eta AS (
  SELECT navire_id, ts AS "timestamp", event_id, port_arrivee, distance_restante_nm, vitesse_noeuds,
         distance_restante_nm / vitesse_noeuds AS eta_heures,
         ts + to_seconds(CAST(trunc(distance_restante_nm / vitesse_noeuds * 3600) AS BIGINT)) AS eta_timestamp
  FROM telemetry WHERE distance_restante_nm > 0 AND vitesse_noeuds > 0
)"""

LATEST = """latest AS (
  SELECT * FROM telemetry QUALIFY row_number() OVER (PARTITION BY navire_id ORDER BY ts DESC, event_id DESC) = 1
)"""

LATEST_ETA = """due AS (
  SELECT * FROM (SELECT * FROM eta QUALIFY row_number() OVER (PARTITION BY navire_id ORDER BY "timestamp" DESC, event_id DESC) = 1)
  WHERE eta_heures > 0
)"""

# Every row beside the ship's previous and next one.
LINKED = """linked AS (
  SELECT *, lag(carburant_litres) OVER o AS previous_fuel, lag(latitude) OVER o AS previous_lat,
         lag(longitude) OVER o AS previous_lon, lead(ts) OVER o AS next_ts
  FROM telemetry WINDOW o AS (PARTITION BY navire_id ORDER BY ts, event_id)
)"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"2 * 3440.065::DOUBLE * atan2(sqrt({h}), sqrt(1 - {h}))"


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"2 * 6371.0::DOUBLE * asin(sqrt({h})) * 0.539957::DOUBLE"


HERE_TO_PORT = ("latitude", "longitude", "port_latitude", "port_longitude")
LEG = haversine("previous_lat", "previous_lon", "latitude", "longitude")
NAIVE_BEARING = ("degrees(atan2(sin(radians(port_longitude - longitude)) * cos(radians(port_latitude)),"
                 " cos(radians(latitude)) * sin(radians(port_latitude)) - sin(radians(latitude))"
                 " * cos(radians(port_latitude)) * cos(radians(port_longitude - longitude))))")
BEARING = f"(CASE WHEN {NAIVE_BEARING} < 0 THEN {NAIVE_BEARING} + 360 ELSE {NAIVE_BEARING} END)"


def with_legs(width: str) -> str:
    """Rows of a tumbling window beside the previous row of the same window and ship."""
    return f"""windowed AS (
  SELECT *, lag(latitude) OVER o AS previous_lat, lag(longitude) OVER o AS previous_lon
  FROM (SELECT *, time_bucket(INTERVAL '{width}', ts) AS window_start,
               time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end FROM telemetry)
  WINDOW o AS (PARTITION BY navire_id, window_start ORDER BY ts, event_id)
)"""


def window_stats(width: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '{width}', ts) AS window_start,
       time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end,
       navire_id, port_depart, port_arrivee, avg(vitesse_noeuds) AS vitesse_moyenne, max(vitesse_noeuds) AS vitesse_max,
       min(vitesse_noeuds) AS vitesse_min, avg(carburant_litres) AS carburant_moyen,
       avg(consommation_horaire_litres) AS consommation_moyenne, sum(consommation_horaire_litres) AS consommation_totale,
       count(*) AS nombre_mesures, arg_max(latitude, (ts, event_id)) AS derniere_latitude,
       arg_max(longitude, (ts, event_id)) AS derniere_longitude,
       arg_max(distance_restante_nm, (ts, event_id)) AS distance_restante
FROM telemetry GROUP BY ALL"""


def window_distance() -> str:
    return f"""SELECT navire_id, window_start, window_end, count(*) AS nombre_positions,
       round(coalesce(sum({LEG}), 0), 6) AS distance_nm FROM windowed GROUP BY ALL"""


ALERT_SCORE = """SELECT time_bucket(INTERVAL '6 hours', t.ts) AS window_start,
       time_bucket(INTERVAL '6 hours', t.ts) + INTERVAL '6 hours' AS window_end, t.navire_id,
       CAST(coalesce(sum(d.n), 0) AS BIGINT) AS nombre_anomalies, CAST(coalesce(sum(d.points), 0) AS BIGINT) AS score_alerte
FROM telemetry t LEFT JOIN (SELECT event_id, count(*) AS n, sum(points) AS points FROM documented {where} GROUP BY event_id) d
  USING (event_id) GROUP BY ALL"""

# The stream has closed only the windows that end by the watermark.
def closed(statement: str, end: str = "window_end") -> str:
    return f"SELECT * FROM ({statement}) c WHERE {end} <= (SELECT max(ts) FROM telemetry) - INTERVAL '10 minutes'"


ETA_ADJUSTED = """SELECT window_end AS mise_a_jour, navire_id, port_arrivee, vitesse_recente, distance_restante_nm,
       distance_restante_nm / (vitesse_recente * factor) * 1.0625::DOUBLE AS eta_heures
FROM (SELECT time_bucket(INTERVAL '5 minutes', ts) - i * INTERVAL '5 minutes' + INTERVAL '30 minutes' AS window_end,
             navire_id, port_arrivee, avg(vitesse_noeuds) AS vitesse_recente,
             arg_max(distance_restante_nm, (ts, event_id)) AS distance_restante_nm,
             arg_max(CASE meteo WHEN 'pluie_legere' THEN 0.9375::DOUBLE WHEN 'brouillard' THEN 0.75::DOUBLE
                     WHEN 'tempete' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END, (ts, event_id)) AS factor
      FROM telemetry, (SELECT unnest(range(6)) AS i) GROUP BY ALL) w
WHERE vitesse_recente * factor > 0 AND distance_restante_nm > 0"""

URGENT = """SELECT navire_id, count(*) AS anomalies_count,
       string_agg(DISTINCT anomalie, ',' ORDER BY anomalie) AS types_anomalies,
       max(temperature_moteur_celsius) AS temp_max_recente, avg(rpm_moteur) AS rpm_moyen
FROM documented WHERE ts > (SELECT max(ts) FROM telemetry) - INTERVAL '{days} days'
GROUP BY navire_id HAVING count(*) > 5"""

NEXT_ARRIVALS = """SELECT navire_id, port_arrivee, round(distance_restante_nm, 1) AS dist_nm, round(eta_heures, 2) AS eta_h,
       strftime(eta_timestamp, '%Y-%m-%d %H:%M') AS arrivee FROM due ORDER BY eta_heures, navire_id LIMIT {n}"""


def signal_lost(gap: str, until: str = "(SELECT max(ts) FROM telemetry)") -> str:
    return f"""SELECT navire_id, ts AS dernier_message, ts + INTERVAL '{gap}' AS signal_perdu_a FROM linked
WHERE (next_ts IS NULL OR next_ts >= ts + INTERVAL '{gap}') AND ts + INTERVAL '{gap}' <= {until}"""


def rolling(span: str) -> str:
    return f"""SELECT navire_id, event_id, ts, vitesse_noeuds, avg(vitesse_noeuds) OVER (PARTITION BY navire_id ORDER BY ts
       RANGE BETWEEN INTERVAL '{span}' PRECEDING AND CURRENT ROW) AS vitesse_recente FROM telemetry"""


def top_routes(n: int) -> str:
    return f"""SELECT port_depart || ' → ' || port_arrivee AS route, nombre_navires FROM route_perf
ORDER BY nombre_navires DESC, port_depart, port_arrivee LIMIT {n}"""


COURSE = f"""course AS (
  SELECT *, 4 AS rank, 'OFF_COURSE' AS anomalie, 'faible' AS severite, 1 AS points, 'Autre anomalie' AS description
  FROM telemetry WHERE abs((cap_degres - {BEARING} + 540) % 360 - 180) > 20
)"""
ON_A_ROW = """(SELECT event_id, navire_id, ts, rank, anomalie, severite, description FROM documented
   UNION ALL SELECT event_id, navire_id, ts, rank, anomalie, severite, description FROM course)"""


def fleet_alerts(until: str) -> str:
    return f"""SELECT navire_id, ts AS "timestamp", anomalie, severite, description FROM {ON_A_ROW} r
UNION ALL SELECT navire_id, signal_perdu_a, 'LOST_SIGNAL', 'eleve', 'Autre anomalie' FROM ({signal_lost("12 hours", until)}) s"""


DIRECTION = """SELECT window_start, window_start + INTERVAL '6 hours' AS window_end, navire_id, secteur, nombre
        FROM (SELECT time_bucket(INTERVAL '6 hours', ts) AS window_start, navire_id,
                     CAST(floor(((cap_degres + 22.5) % 360) / 45) AS INTEGER) AS secteur, count(*) AS nombre
              FROM telemetry GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY window_start, navire_id ORDER BY nombre DESC, secteur) = 1"""
EFFICIENCY = f"""SELECT navire_id, window_start, window_end, round(nm, 6) AS distance_nm,
        carburant_utilise, round(CASE WHEN carburant_utilise > 0 THEN nm / carburant_utilise ELSE 0 END, 6) AS efficacite_nm_par_litre
        FROM (SELECT navire_id, window_start, window_end, coalesce(sum({LEG}), 0) AS nm,
                     arg_min(carburant_litres, (ts, event_id)) - arg_max(carburant_litres, (ts, event_id)) AS carburant_utilise
              FROM windowed GROUP BY ALL) w"""


# name -> (common table expressions, statement)
_STATEMENTS: dict[str, tuple[list[str], str]] = {
    "telemetry_scan": ([], f"SELECT {BASIC} FROM telemetry"),
    "enrich_time": ([], """SELECT event_id, navire_id, iso AS "timestamp", ts, CAST(ts AS DATE) AS date,
        CAST(hour(ts) AS INTEGER) AS hour FROM telemetry"""),
    "json_ingest": ([], f"""SELECT * EXCLUDE (event_id), CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour
        FROM (SELECT {BASIC} FROM telemetry)"""),
    "json_roundtrip": ([], f"""SELECT navire_id AS key, 'tracking' AS topic, iso AS "timestamp", * EXCLUDE (event_id, ts, iso)
        FROM (SELECT {BASIC}, iso FROM telemetry)"""),
    "to_messages": ([ALERTS], """SELECT navire_id AS key, 'tracking' AS topic, CAST(NULL AS VARCHAR) AS type,
        CAST(NULL AS VARCHAR) AS message, iso AS "timestamp", latitude, longitude, vitesse_noeuds FROM telemetry
        UNION ALL SELECT navire_id, 'alerts', 'alert', message, iso, latitude, longitude, CAST(NULL AS DOUBLE) FROM alerts"""),
    "route_by_anomaly": ([], """SELECT navire_id AS key, CASE WHEN carburant_litres < 20000 OR vitesse_noeuds < 2
        OR vitesse_noeuds > 25 OR temperature_moteur_celsius > 85 THEN 'alerts' ELSE 'tracking' END AS topic FROM telemetry"""),
    "pruned_hourly_scan": ([], """SELECT event_id, ts, navire_id, vitesse_noeuds, CAST(ts AS DATE) AS date,
        CAST(hour(ts) AS INTEGER) AS hour FROM telemetry
        WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' AND hour(ts) BETWEEN 6 AND 11"""),
    "table_counts": ([SHIP_STATS, ROUTE_PERF, WEATHER, MAINTENANCE, ANOMALIES, ETA], """
        SELECT 'raw_telemetry' AS "table", count(*) AS lignes FROM telemetry
        UNION ALL SELECT 'ship_statistics', count(*) FROM ship_stats
        UNION ALL SELECT 'route_performance', count(*) FROM route_perf
        UNION ALL SELECT 'weather_impact', count(*) FROM weather
        UNION ALL SELECT 'maintenance_prediction', count(*) FROM maintenance
        UNION ALL SELECT 'anomalies', count(*) FROM anomalies
        UNION ALL SELECT 'eta_predictions', count(*) FROM eta"""),
    "anomalies_detected": ([ANOMALIES], "SELECT * EXCLUDE (latitude, longitude) FROM anomalies"),
    "anomaly_summary": ([ANOMALIES], "SELECT navire_id, type_anomalie, count(*) AS nombre_anomalies FROM anomalies GROUP BY ALL"),
    "anomaly_counts": ([ANOMALIES], "SELECT navire_id, count(*) AS nombre FROM anomalies GROUP BY ALL"),
    "anomaly_type_counts": ([ANOMALIES], "SELECT type_anomalie, count(*) AS nombre FROM anomalies GROUP BY ALL"),
    "top_anomaly_ships": ([ANOMALIES], """SELECT navire_id, count(*) AS nombre FROM anomalies GROUP BY ALL
        ORDER BY nombre DESC, navire_id LIMIT 5"""),
    "alert_pivot": ([ANOMALIES], """SELECT navire_id, count(*) AS total,
        count(*) FILTER (type_anomalie = 'CARBURANT_BAS') AS carburant,
        count(*) FILTER (type_anomalie = 'VITESSE_ANORMALE') AS vitesse,
        count(*) FILTER (type_anomalie = 'MOTEUR_ANOMALIE') AS moteur
        FROM anomalies GROUP BY navire_id ORDER BY total DESC, navire_id LIMIT 15"""),
    "alert_fanout": ([ALERTS], "SELECT navire_id, ts, message, latitude, longitude FROM alerts"),
    "anomaly_array": ([DOCUMENTED], """SELECT t.event_id, t.navire_id, coalesce(d.codes, '') AS anomalies,
        CAST(coalesce(d.n, 0) AS INTEGER) AS nombre, t.carburant_litres < 20000 AS carburant_bas
        FROM telemetry t LEFT JOIN (SELECT event_id, string_agg(anomalie, ',' ORDER BY rank) AS codes, count(*) AS n
          FROM documented GROUP BY event_id) d USING (event_id)"""),
    "anomaly_severity": ([DOCUMENTED], "SELECT event_id, navire_id, anomalie, severite FROM documented"),
    "alerts_recent": ([DOCUMENTED], """SELECT navire_id, ts AS "timestamp", anomalie, description FROM documented
        WHERE ts > (SELECT max(ts) FROM telemetry) - INTERVAL '1 day'"""),
    "alerts_per_hour": ([DOCUMENTED], """SELECT h.heure, coalesce(c.nombre, 0) AS nombre
        FROM (SELECT unnest(generate_series(min(date_trunc('hour', ts)), max(date_trunc('hour', ts)), INTERVAL '1 hour')) AS heure
              FROM documented) h
        LEFT JOIN (SELECT date_trunc('hour', ts) AS heure, count(*) AS nombre FROM documented GROUP BY 1) c USING (heure)"""),
    "anomaly_distribution": ([DOCUMENTED], """SELECT anomalie, count(*) AS occurrences,
        count(DISTINCT navire_id) AS nb_navires_affectes,
        round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pourcentage
        FROM documented WHERE ts > (SELECT max(ts) FROM telemetry) - INTERVAL '30 days' GROUP BY anomalie"""),
    "urgent_maintenance": ([DOCUMENTED], URGENT.format(days=1)),
    "urgent_maintenance_30d": ([DOCUMENTED], URGENT.format(days=30)),
    "active_alerts": ([LATEST, DOCUMENTED], """SELECT navire_id, ts AS "timestamp", anomalie, severite FROM documented
        WHERE event_id IN (SELECT event_id FROM latest)"""),
    "ship_statistics": ([SHIP_STATS], "SELECT * FROM ship_stats"),
    "route_performance": ([ROUTE_PERF], "SELECT * FROM route_perf"),
    "temporal_analysis": ([], """SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
        count(DISTINCT navire_id) AS navires_actifs, avg(vitesse_noeuds) AS vitesse_moyenne,
        avg(consommation_horaire_litres) AS consommation_moyenne FROM telemetry GROUP BY ALL"""),
    "weather_impact": ([WEATHER], "SELECT * FROM weather"),
    "maintenance_prediction": ([MAINTENANCE], "SELECT * FROM maintenance"),
    "fleet_stats": ([], """SELECT navire_id, count(*) AS nb_records, avg(vitesse_noeuds) AS vitesse_moy,
        max(temperature_moteur_celsius) AS temp_max, sum(consommation_horaire_litres) AS total_consomme
        FROM telemetry GROUP BY navire_id"""),
    "low_fuel_counts": ([], "SELECT navire_id, count(*) AS nb_alerts FROM telemetry WHERE carburant_litres < 20000 GROUP BY navire_id"),
    "route_efficiency": ([SHIP_STATS], """SELECT port_depart, port_arrivee,
        round(avg(distance_parcourue / nullif(carburant_utilise, 0)), 6) AS efficacite_moyenne, count(*) AS nb_traversees,
        round(avg(heures), 6) AS temps_moyen
        FROM ship_stats JOIN (SELECT navire_id, port_depart, port_arrivee,
               (epoch_us(max(ts)) - epoch_us(min(ts))) / 3.6e9::DOUBLE AS heures FROM telemetry GROUP BY ALL) v
          USING (navire_id, port_depart, port_arrivee) GROUP BY ALL"""),
    "ship_vs_route": ([SHIP_STATS, ROUTE_PERF], """SELECT navire_id, port_depart, port_arrivee, nombre_mesures,
        CAST(sum(nombre_mesures) OVER (PARTITION BY port_depart, port_arrivee) AS BIGINT) AS nombre_mesures_route,
        vitesse_moyenne, vitesse_moyenne_route, consommation_moyenne, consommation_moyenne_route,
        vitesse_moyenne - vitesse_moyenne_route AS ecart_vitesse
        FROM ship_stats JOIN route_perf USING (port_depart, port_arrivee)"""),
    "ship_rank_in_route": ([SHIP_STATS], """SELECT port_depart, port_arrivee, navire_id, efficacite_carburant_nm_per_litre,
        CAST(rank() OVER o AS INTEGER) AS rang, CAST(dense_rank() OVER o AS INTEGER) AS rang_dense FROM ship_stats
        WINDOW o AS (PARTITION BY port_depart, port_arrivee ORDER BY efficacite_carburant_nm_per_litre DESC)"""),
    "fleet_kpis": ([SHIP_STATS, MAINTENANCE, ANOMALIES], """SELECT
        (SELECT count(*) FROM ship_stats) AS total_navires,
        (SELECT sum(distance_parcourue) FROM ship_stats) AS distance_totale_nm,
        (SELECT round(avg(vitesse_moyenne), 6) FROM ship_stats) AS vitesse_moyenne,
        (SELECT count(*) FROM anomalies) AS total_anomalies,
        (SELECT count(*) FROM maintenance WHERE priorite_maintenance = 'URGENT') AS maintenances_urgentes"""),
    "speed_histogram": ([], """SELECT floor(vitesse_noeuds / 2.0::DOUBLE) * 2.0::DOUBLE AS vitesse_min, count(*) AS nombre
        FROM telemetry GROUP BY 1"""),
    "speed_fuel_corr": ([], "SELECT round(corr(vitesse_noeuds, consommation_horaire_litres), 6) AS correlation FROM telemetry"),
    "ship_quartiles": ([], """SELECT navire_id, count(*) AS nombre, min(vitesse_noeuds) AS minimum,
        quantile_cont(vitesse_noeuds, 0.25) AS q1, quantile_cont(vitesse_noeuds, 0.5) AS mediane,
        quantile_cont(vitesse_noeuds, 0.75) AS q3, max(vitesse_noeuds) AS maximum FROM telemetry GROUP BY navire_id"""),
    "traffic_grid": ([], """SELECT CAST(floor(latitude / 0.5::DOUBLE) AS BIGINT) AS cellule_lat,
        CAST(floor(longitude / 0.5::DOUBLE) AS BIGINT) AS cellule_lon, count(*) AS nombre FROM telemetry GROUP BY ALL"""),
    "latest_positions": ([LATEST], "SELECT navire_id, ts, latitude, longitude, vitesse_noeuds, carburant_litres FROM latest"),
    "latest_eta": ([ETA], """SELECT * EXCLUDE (event_id) FROM eta
        QUALIFY rank() OVER (PARTITION BY navire_id ORDER BY "timestamp" DESC) = 1"""),
    "current_positions": ([LATEST], """SELECT navire_id, ts AS dernier_update, latitude, longitude,
        vitesse_noeuds AS vitesse_actuelle, carburant_litres AS carburant_actuel, temperature_moteur_celsius AS temp_actuelle
        FROM latest"""),
    "fuel_drops": ([LINKED], """SELECT navire_id, event_id, ts, carburant_litres, previous_fuel AS carburant_precedent,
        previous_fuel - carburant_litres AS carburant_consomme FROM linked WHERE previous_fuel - carburant_litres > 0"""),
    "signal_gaps": ([LINKED], """SELECT navire_id, event_id, ts, next_ts AS ts_suivant,
        (epoch_us(next_ts) - epoch_us(ts)) / 1e6::DOUBLE AS ecart_secondes FROM linked"""),
    "signal_lost": ([LINKED], signal_lost("5 minutes")),
    "signal_lost_12h": ([LINKED], signal_lost("12 hours")),
    "rolling_speed": ([], rolling("30 minutes")),
    "rolling_speed_12h": ([], rolling("12 hours")),
    "running_fuel": ([], """SELECT navire_id, event_id, ts, consommation_horaire_litres,
        sum(consommation_horaire_litres) OVER (PARTITION BY navire_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
          AS consommation_cumulee FROM telemetry"""),
    "distance_travelled": ([LINKED], f"""SELECT navire_id, count(*) AS nombre_positions,
        round(coalesce(sum({LEG}), 0), 6) AS distance_nm FROM linked GROUP BY navire_id"""),
    "daily_fuel": ([LINKED], f"""SELECT navire_id, date_voyage, total_litre, round(nm, 6) AS distance_nm,
        round(total_litre / nullif(nm, 0) * 100, 6) AS litres_par_100nm
        FROM (SELECT navire_id, CAST(ts AS DATE) AS date_voyage,
                     coalesce(sum(greatest(previous_fuel - carburant_litres, 0)), 0) AS total_litre,
                     coalesce(sum({LEG}), 0) AS nm
              FROM linked WHERE ts > (SELECT max(ts) FROM telemetry) - INTERVAL '7 days' GROUP BY ALL) d"""),
    "window_stats": ([], window_stats("5 minutes")),
    "window_stats_6h": ([], window_stats("6 hours")),
    "window_distance": ([with_legs("5 minutes")], window_distance()),
    "window_distance_6h": ([with_legs("6 hours")], window_distance()),
    "dominant_direction": ([], DIRECTION),
    "window_alert_score": ([DOCUMENTED], ALERT_SCORE.format(where="")),
    "window_efficiency": ([with_legs("6 hours")], EFFICIENCY),
    "distance_to_port": ([], f"SELECT navire_id, event_id, ts, port_arrivee, round({haversine(*HERE_TO_PORT)}, 6) AS distance_port_nm FROM telemetry"),
    "distance_to_port_km": ([], f"SELECT navire_id, event_id, ts, port_arrivee, round({haversine_km(*HERE_TO_PORT)}, 6) AS distance_port_nm FROM telemetry"),
    "bearing_to_port": ([], f"SELECT navire_id, event_id, ts, port_arrivee, round({BEARING}, 6) AS cap_port_degres FROM telemetry"),
    "projected_position": ([], """SELECT navire_id, event_id, ts, v AS vitesse_bornee, round(degrees(lat2), 6) AS latitude_projetee,
        round(longitude + degrees(atan2(sin(c) * sin(d) * cos(radians(latitude)), cos(d) - sin(radians(latitude)) * sin(lat2))), 6)
          AS longitude_projetee
        FROM (SELECT *, asin(sin(radians(latitude)) * cos(d) + cos(radians(latitude)) * sin(d) * cos(c)) AS lat2
              FROM (SELECT *, greatest(10.0::DOUBLE, least(30.0::DOUBLE, vitesse_noeuds)) AS v, radians(cap_degres) AS c,
                           greatest(10.0::DOUBLE, least(30.0::DOUBLE, vitesse_noeuds)) / 60 / 3440.065::DOUBLE AS d FROM telemetry))"""),
    "off_course": ([], f"""SELECT navire_id, event_id, ts, port_arrivee, cap_degres, round(deviation, 6) AS deviation_degres
        FROM (SELECT *, abs((cap_degres - {BEARING} + 540) % 360 - 180) AS deviation FROM telemetry) WHERE deviation > 20"""),
    "eta_predictions": ([ETA], "SELECT * EXCLUDE (event_id) FROM eta"),
    "eta_adjusted": ([], ETA_ADJUSTED),
    "fastest_ships": ([SHIP_STATS], """SELECT navire_id, port_depart, port_arrivee, round(vitesse_moyenne, 2) AS vitesse_moy_noeuds,
        round(efficacite_carburant_nm_per_litre, 3) AS efficacite FROM ship_stats
        ORDER BY vitesse_moyenne DESC, navire_id, port_depart, port_arrivee LIMIT 10"""),
    "busiest_routes": ([ROUTE_PERF], """SELECT port_depart, port_arrivee, nombre_navires,
        round(distance_moyenne_route, 1) AS distance_nm, round(temps_estime_heures, 1) AS temps_h FROM route_perf
        ORDER BY nombre_navires DESC, port_depart, port_arrivee LIMIT 10"""),
    "ships_to_watch": ([LATEST], """SELECT navire_id, round(carburant_litres, 0) AS carburant_L, round(vitesse_noeuds, 1) AS vitesse,
        etat_moteur, CASE WHEN carburant_litres < 5000 THEN 'CRITIQUE' WHEN carburant_litres < 10000 THEN 'ATTENTION'
        ELSE 'OK' END AS niveau_carburant
        FROM latest WHERE carburant_litres < 10000 OR vitesse_noeuds < 5 OR etat_moteur <> 'normal'
        ORDER BY carburant_litres, navire_id LIMIT 15"""),
    "maintenance_urgent_report": ([MAINTENANCE], """SELECT navire_id, score_risque, priorite_maintenance,
        round(temp_max, 1) AS temp_max_C, incidents_moteur, round(carburant_actuel, 0) AS carburant_L
        FROM maintenance WHERE priorite_maintenance = 'URGENT'"""),
    "weather_report": ([WEATHER], """SELECT meteo, occurrences, round(occurrences * 100.0::DOUBLE / sum(occurrences) OVER (), 2) AS pct,
        round(vitesse_moyenne, 2) AS vitesse_moy, round(consommation_moyenne, 1) AS conso_moy FROM weather"""),
    "route_efficiency_report": ([ROUTE_PERF], """SELECT port_depart, port_arrivee, round(distance_moyenne_route, 1) AS dist_nm,
        round(consommation_moyenne_route, 1) AS "conso_L_h",
        round(distance_moyenne_route / nullif(consommation_moyenne_route, 0), 3) AS efficacite FROM route_perf
        ORDER BY distance_moyenne_route / nullif(consommation_moyenne_route, 0) DESC, port_depart, port_arrivee LIMIT 10"""),
    "next_arrivals": ([ETA, LATEST_ETA], NEXT_ARRIVALS.format(n=15)),
    "next_arrivals_5": ([ETA, LATEST_ETA], NEXT_ARRIVALS.format(n=5)),
    "fleet_overview": ([LATEST], """SELECT count(DISTINCT navire_id) AS total_navires, round(avg(vitesse_noeuds), 2) AS vitesse_moy,
        round(avg(carburant_litres), 0) AS carburant_moy, count(*) FILTER (carburant_litres < 10000) AS alerte_carburant,
        count(*) FILTER (etat_moteur <> 'normal') AS probleme_moteur FROM latest"""),
    "ship_ranking": ([SHIP_STATS], """SELECT navire_id, round(vitesse_moyenne, 2) AS vitesse,
        round(efficacite_carburant_nm_per_litre, 3) AS efficacite,
        CASE WHEN efficacite_carburant_nm_per_litre > 0.5 THEN 'Excellent' WHEN efficacite_carburant_nm_per_litre > 0.3 THEN 'Bon'
             WHEN efficacite_carburant_nm_per_litre > 0.1 THEN 'Acceptable' ELSE 'Problématique' END AS performance
        FROM ship_stats WHERE efficacite_carburant_nm_per_litre > 0
        ORDER BY efficacite_carburant_nm_per_litre DESC, navire_id, port_depart, port_arrivee LIMIT 15"""),
    "fleet_status": ([LATEST], """SELECT navire_id, latitude, longitude, vitesse_noeuds AS vitesse_actuelle,
        carburant_litres AS carburant_actuel, temperature_moteur_celsius AS temp_actuelle,
        CASE WHEN carburant_litres < 20000 THEN 'CRITIQUE' WHEN carburant_litres < 40000 THEN 'BAS' ELSE 'OK' END AS fuel_status,
        ts AS dernier_update FROM latest ORDER BY ts DESC, navire_id LIMIT 50"""),
    "fastest_routes": ([ROUTE_PERF], """SELECT port_depart, port_arrivee, round(distance_moyenne_route, 2) AS distance_nm,
        round(temps_estime_heures, 2) AS temps_moyen_heures, round(vitesse_moyenne_route, 2) AS vitesse_moyenne
        FROM route_perf WHERE port_depart IS NOT NULL AND port_arrivee IS NOT NULL
        ORDER BY temps_estime_heures, port_depart, port_arrivee LIMIT 10"""),
    "top_ships": ([SHIP_STATS], """SELECT navire_id, port_depart, port_arrivee, vitesse_moyenne, consommation_moyenne,
        efficacite_carburant_nm_per_litre FROM ship_stats WHERE carburant_utilise > 0
        ORDER BY efficacite_carburant_nm_per_litre DESC, navire_id, port_depart, port_arrivee LIMIT 10"""),
    "top_routes": ([ROUTE_PERF], top_routes(10)),
    "top_routes_5": ([ROUTE_PERF], top_routes(5)),
    "priority_counts": ([MAINTENANCE], "SELECT priorite_maintenance, count(*) AS nombre FROM maintenance GROUP BY ALL"),
    "maintenance_alerts": ([MAINTENANCE], "SELECT * FROM maintenance WHERE priorite_maintenance <> 'BAS'"),
    "speed_series": ([], "SELECT navire_id, ts, event_id, vitesse_noeuds FROM telemetry ORDER BY ts, event_id LIMIT 1000"),
    "recent_positions": ([], """SELECT navire_id, ts, event_id, latitude, longitude FROM telemetry
        ORDER BY ts DESC, event_id LIMIT 1000"""),
    "trajectory_sample": ([], """SELECT navire_id, ts, event_id, latitude, longitude FROM telemetry
        WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 6) AS BIGINT) < CAST(floor(0.3 * 16777216) AS BIGINT)"""),
    "stream_raw": ([], f"SELECT {BASIC}, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour FROM telemetry"),
    "stream_window_stats": ([], closed(window_stats("5 minutes"))),
    "stream_window_stats_6h": ([], closed(window_stats("6 hours"))),
    "stream_anomalies": ([ANOMALIES], "SELECT * FROM anomalies"),
    "stream_eta": ([ETA], "SELECT * FROM eta"),
    "stream_alerts": ([ALERTS], """SELECT navire_id AS key, 'alerts' AS topic, message, iso AS "timestamp" FROM alerts"""),
    "stream_signal_lost": ([LINKED], signal_lost("12 hours", "(SELECT max(ts) FROM telemetry) - INTERVAL '10 minutes'")),
    "stream_window_distance": ([with_legs("6 hours")], closed(window_distance())),
    "stream_window_alert_score": ([DOCUMENTED], closed(ALERT_SCORE.format(where=""))),
    "stream_eta_adjusted": ([], closed(ETA_ADJUSTED, "mise_a_jour")),
    "stream_fleet_alerts": ([DOCUMENTED, COURSE, LINKED], fleet_alerts("(SELECT max(ts) FROM telemetry) - INTERVAL '10 minutes'")),
    "stream_dominant_direction": ([], closed(DIRECTION)),
    "stream_window_efficiency": ([with_legs("6 hours")], closed(EFFICIENCY)),
    "fleet_alerts": ([DOCUMENTED, COURSE, LINKED], fleet_alerts("(SELECT max(ts) FROM telemetry)")),
    "alert_codes": ([DOCUMENTED, COURSE], f"""SELECT t.event_id, t.navire_id, coalesce(d.codes, '') AS anomalies
        FROM telemetry t LEFT JOIN (SELECT event_id, string_agg(anomalie, ',' ORDER BY rank) AS codes FROM {ON_A_ROW} r
          GROUP BY event_id) d USING (event_id)"""),
    "archive_alerts": ([DOCUMENTED, COURSE], f"""SELECT navire_id, ts AS "timestamp", anomalie, severite, description
        FROM {ON_A_ROW} r WHERE ts > (SELECT max(ts) FROM telemetry) - INTERVAL '1 day'"""),
}

ORACLE = {name: "WITH " + ", ".join([TELEMETRY, *ctes]) + "\n" + statement
          for name, (ctes, statement) in _STATEMENTS.items()}
