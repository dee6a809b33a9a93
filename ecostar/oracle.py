"""DuckDB SQL with the same result as each named query.

The SQL computes from the columns of ``events`` directly; the JSON payloads that
the Spark side writes and parses never occur here.
"""

from __future__ import annotations

from ecostar.operators.anomalies import RULES, Z_FIELDS, Z_STEPS
from ecostar.operators.quality import LIMITS
from ecostar.sources import reference
from ecostar.sources.history import AQI_SPECIES, SPECIES

AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
NOW = "TIMESTAMP '2025-03-15 12:00:00'"

ORACLE: dict[str, str] = {}


def _lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(_lit(x) for x in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) t({columns})"


def _choice(items, index: str) -> str:
    return "([" + ", ".join(_lit(i) for i in items) + f"])[{index}]"


def _events(months: bool) -> str:
    ts = "ts + to_months(CAST(user_id % 24 AS INTEGER))" if months else "ts"
    city = "CAST(user_id % 10 + 1 AS INTEGER)"
    return f"""
ev AS (
  SELECT event_id AS id, {city} AS city_id, {_choice([c[1] for c in reference.CITIES], city)} AS city_name,
         user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, {ts} AS collected_at
  FROM events
),
lake AS (
  SELECT *, date_trunc('hour', collected_at) AS lake_hour,
         CASE event_type WHEN 'view' THEN 'openweather' WHEN 'click' THEN 'aqicn' WHEN 'purchase' THEN 'tomtom_flow'
              WHEN 'error' THEN 'tomtom_incidents'
              ELSE CASE WHEN user_id % 2 = 0 THEN 'hubeau_eau_potable' ELSE 'hubeau_cd_observations' END END AS source,
         k < 30 AS processed
  FROM ev
)"""


_CODES = [c[0] for c in reference.WEATHER_CODES] + [999]

_ENTRIES = f"""
weather AS (
  SELECT id, city_id, lake_hour, collected_at, round(value / 3 - 10, 2) AS temperature,
         round(round(value / 3 - 10, 2) - 2, 2) AS feels_like, CAST(960 + k AS DOUBLE) AS pressure,
         CAST(k AS DOUBLE) AS humidity, k / 5.0::DOUBLE AS wind_speed, CAST(k * 3 AS DOUBLE) AS wind_deg,
         k / 4.0::DOUBLE AS wind_gust, CAST(k AS DOUBLE) AS clouds, CAST(k * 100 AS DOUBLE) AS visibility,
         CASE WHEN k % 4 = 0 THEN k / 10.0::DOUBLE ELSE 0.0::DOUBLE END AS rain_1h, 0.0::DOUBLE AS snow_1h,
         {_choice(_CODES, "k % 37 + 1")} AS weather_id, 'M' || (k % 5) AS weather_main, 'D' || (k % 7) AS weather_description
  FROM lake WHERE source = 'openweather'
),
air AS (
  SELECT id, city_id, lake_hour, collected_at,
         CASE WHEN k % 10 <> 0 THEN CAST(floor(value * 2) AS INTEGER) END AS aqi_index, value AS pm25,
         CAST(k AS DOUBLE) AS pm10, k / 2.0::DOUBLE AS no2, CAST(NULL AS DOUBLE) AS o3, CAST(NULL AS DOUBLE) AS so2,
         CAST(NULL AS DOUBLE) AS co,
         CASE WHEN k % 3 = 0 THEN city_name ELSE 'Station ' || (user_id % 3) END AS station_attribution, k
  FROM lake WHERE source = 'aqicn'
)"""

_W = "temperature, feels_like, pressure, humidity, wind_speed, wind_deg, wind_gust, clouds, visibility, rain_1h, snow_1h, weather_id"
_A = "aqi_index, pm25, pm10, no2, o3, so2, co"

_MEASURES = f"""
wx AS (SELECT * FROM weather QUALIFY row_number() OVER (PARTITION BY city_id, lake_hour ORDER BY id DESC) = 1),
ax AS (SELECT * FROM air QUALIFY row_number() OVER (PARTITION BY city_id, lake_hour ORDER BY id DESC) = 1),
measures AS (
  SELECT coalesce(wx.city_id, ax.city_id) AS city_id, coalesce(wx.lake_hour, ax.lake_hour) AS lake_hour,
         coalesce(wx.collected_at, ax.collected_at) AS captured_at, wx.id AS raw_weather_id, ax.id AS raw_aqi_id,
         wx.collected_at AS weather_at, ax.collected_at AS air_at, {_W}, {_A}
  FROM wx FULL OUTER JOIN ax ON wx.city_id = ax.city_id AND wx.lake_hour = ax.lake_hour
)"""

_SEASON = "CASE " + " ".join(
    f"WHEN month(d) IN {months} THEN '{name}'" for name, months in reference.SEASONS.items()
) + " END"

_DATE_COLUMNS = f"""
  CAST(d AS DATE) AS date_value, CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
  dayname(d) AS day_name, CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(ceil(day(d) / 7.0) AS INTEGER) AS week_of_month, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(quarter(d) AS INTEGER) AS quarter, 'Q' || quarter(d) AS quarter_name, CAST(year(d) AS INTEGER) AS year,
  dayofweek(d) IN (0, 6) AS is_weekend, FALSE AS is_holiday, {_SEASON} AS season"""

_DIMS = f"""
dim_date AS (
  SELECT {_DATE_COLUMNS}
  FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS d)
),
dim_city AS ({_values([(c[0], c[1], c[2], c[3], c[4]) for c in reference.CITIES], "city_id, city_name, latitude, longitude, station")}),
dim_aqi AS ({_values([(n, *r) for n, r in enumerate(reference.AQI_LEVELS, 1)],
    "aqi_level_id, aqi_min, aqi_max, level_name, health_concern, color_code, health_advice")}),
dim_weather AS ({_values([(n, *r) for n, r in enumerate(reference.WEATHER_CODES, 1)],
    "weather_condition_id, weather_id, main, description, category, icon")})"""

_MEASURE_ID = "CAST(floor(epoch(lake_hour) / 3600) AS BIGINT) * 16777216 + m.city_id"


def _facts(where: str = "") -> str:
    return f"""
facts AS (
  SELECT {_MEASURE_ID} AS measure_id, m.*, CAST(captured_at AS DATE) AS capture_date,
         CAST(hour(captured_at) AS INTEGER) AS capture_hour, w.weather_condition_id, a.aqi_level_id,
         captured_at + to_minutes(m.city_id - 2) AS created_at
  FROM (SELECT * REPLACE (coalesce(rain_1h, 0) AS rain_1h, coalesce(snow_1h, 0) AS snow_1h) FROM measures) m
  LEFT JOIN dim_weather w ON m.weather_id = w.weather_id
  LEFT JOIN dim_aqi a ON m.aqi_index BETWEEN a.aqi_min AND a.aqi_max
  {where}
)"""


_WITHIN = ("WHERE NOT (coalesce(temperature, 0) > 60 OR coalesce(feels_like, 0) > 70 "
           "OR coalesce(aqi_index, 0) > 500)")

LAKE = _events(False)
ENTRIES = LAKE + "," + _ENTRIES
MEASURES = ENTRIES + "," + _MEASURES
FACTS = _events(True) + "," + _ENTRIES + "," + _MEASURES + "," + _DIMS + "," + _facts(_WITHIN)
FACTS_NOW = MEASURES + "," + _DIMS + "," + _facts(_WITHIN)
ALL_FACTS = MEASURES + "," + _DIMS + "," + _facts()


def put(name: str, with_: str, select: str, text: str = "") -> None:
    """Register SQL; the columns in ``text`` are dates or instants given as text.

    A select that starts with a comma brings further named subqueries.
    """
    replace = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in text.split())
    body = f"WITH {with_} {select}" if with_ else select
    ORACLE[name] = f"SELECT * REPLACE ({replace}) FROM ({body}) q" if replace else body


def mean(col: str, decimals: int = 2, digits: int = 2, over: str = "") -> str:
    """Mean of a column with ``decimals`` decimals, rounded half up in integers."""
    s = f"SUM(CAST(round(({col}) * {10 ** decimals}) AS HUGEINT)) {over}"
    n = f"COUNT({col}) {over} * {10 ** max(decimals - digits, 0)}"
    if decimals < digits:
        s = f"({s} * {10 ** (digits - decimals)})"
    half = f"(2 * abs({s}) + ({n})) // (2 * ({n}))"
    return f"CAST(sign({s}) * ({half}) AS DOUBLE) / {10 ** digits}"


def share(n: str, total: str) -> str:
    return f"CAST((20000 * {n} + {total}) // (2 * {total}) AS DOUBLE) / 100"


def number(v: str) -> str:
    return f"CASE WHEN {v} = floor({v}) THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) ELSE CAST({v} AS VARCHAR) END"


# Sources and sinks -----------------------------------------------------------------------

put("lake_read_json", LAKE, """
SELECT id, city_id, city_name, source, collected_at, processed,
       CASE WHEN source = 'openweather' THEN round(value / 3 - 10, 2) END AS temp,
       CASE WHEN source = 'tomtom_flow' THEN 'P' || (user_id % 3) END AS code_point FROM lake""", "collected_at")

put("lake_append", LAKE, f"""
SELECT id, source, c AS collected_at, CAST(c AS DATE) AS collected_date, FALSE AS processed
FROM (SELECT *, CASE WHEN processed THEN {AS_OF} ELSE collected_at END AS c FROM lake)""",
    "collected_at collected_date")

put("lake_export_city", LAKE, "SELECT id, city_name, source, collected_at FROM lake WHERE city_name = 'Paris'",
    "collected_at")

put("lake_unprocessed", LAKE, """
SELECT id, source, collected_at FROM lake WHERE NOT processed AND NOT value < 20 ORDER BY id LIMIT 1000""",
    "collected_at")

put("lake_mark_processed", LAKE, f"""
SELECT id, {AS_OF} AS processed_at, CASE WHEN value > 60 THEN 'rejected' ELSE 'processed' END AS outcome
FROM lake""", "processed_at")

put("lake_latest_by_source", LAKE, """
SELECT id, city_id, source, CAST(row_number() OVER w AS INTEGER) AS rank FROM lake
WHERE source IN ('openweather', 'aqicn')
WINDOW w AS (PARTITION BY city_id, source ORDER BY collected_at DESC, id DESC)
QUALIFY row_number() OVER w <= 10""")

put("lake_pending_by_source", LAKE,
    "SELECT source, count(*) AS pending FROM lake WHERE NOT processed GROUP BY source")

put("latest_measures", FACTS, """
SELECT city_id, CAST(row_number() OVER w AS INTEGER) AS rank, captured_at, temperature, aqi_index, pm25 FROM facts
WINDOW w AS (PARTITION BY city_id ORDER BY captured_at DESC, measure_id DESC) QUALIFY row_number() OVER w <= 10""", "captured_at")

_CITY_SOURCE = """
own AS (
  SELECT CAST(s_suppkey + 1 AS INTEGER) AS id, s_name AS name,
         CASE WHEN s_suppkey % 11 <> 5 THEN s_nationkey + 30.5::DOUBLE ELSE 0.0::DOUBLE END AS latitude,
         s_nationkey / 4.0::DOUBLE + 1 AS longitude,
         CASE WHEN s_suppkey % 3 = 0 THEN '/st-' || s_suppkey || '/' END AS station
  FROM supplier
),
ref AS (
  SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey + 1 END AS id, replace(c_name, 'Customer', 'Supplier') AS name,
         'ref-' || c_custkey AS station
  FROM customer WHERE c_custkey % 5 <> 4
),
cities AS (
  SELECT own.id, own.name, latitude, longitude, coalesce(own.station, i.station, n.station) AS aqi_station
  FROM own
  LEFT JOIN (SELECT id, max(station) AS station FROM ref GROUP BY id) i ON own.id = i.id
  LEFT JOIN (SELECT name, max(station) AS station FROM ref GROUP BY name) n ON own.name = n.name
)"""

put("cities_source", _CITY_SOURCE, "SELECT * FROM cities")


def _box(half: float) -> str:
    parts = (f"longitude - {half}", f"latitude - {half}", f"longitude + {half}", f"latitude + {half}")
    return "printf('%.6f,%.6f,%.6f,%.6f', " + ", ".join(f"CAST({p} AS DOUBLE)" for p in parts) + ")"


put("collection_targets", _CITY_SOURCE, f"""
SELECT id, name, CASE WHEN latitude <> 0 THEN {_box(0.05)} END AS incident_box,
       CASE WHEN latitude <> 0 THEN {_box(0.1)} END AS water_box,
       concat_ws('|', nullif(trim(aqi_station, '/'), ''), name, CASE WHEN lower(name) <> name THEN lower(name) END) AS station_names,
       CASE WHEN latitude <> 0 THEN upper(left(name, 3)) || p.suffix END AS code_point,
       CASE WHEN latitude <> 0 THEN latitude END AS latitude,
       CASE WHEN latitude <> 0 THEN round(longitude + p.shift, 6) END AS longitude
FROM cities JOIN (VALUES ('_C', 0.0::DOUBLE), ('_E', 0.02::DOUBLE), ('_W', -0.02::DOUBLE)) p(suffix, shift)
  ON latitude <> 0 OR p.suffix = '_C'""")

put("source_caps", LAKE, """
SELECT id, city_id, source FROM (
  SELECT *, row_number() OVER (PARTITION BY source, city_id, lake_hour ORDER BY id) AS r,
         first_value(user_id % 15) OVER (PARTITION BY source, city_id, lake_hour ORDER BY id) AS station
  FROM lake)
WHERE (source = 'tomtom_incidents' AND r <= 30) OR (source = 'hubeau_eau_potable' AND r <= 20)
   OR (source = 'hubeau_cd_observations' AND user_id % 15 = station)""")

_SPECIES_TEXT = [*SPECIES, "uvi"]
HISTORY = LAKE + f""",
hist AS (
  SELECT id, city_id, city_name, CAST(collected_at AS DATE) AS day, {_choice(_SPECIES_TEXT, "k % 12 + 1")} AS specie,
         value AS median
  FROM lake
  WHERE k % 13 <> 0 AND k % 17 <> 0 AND k % 19 <> 0 AND k % 11 <> 0
    AND (k % 2 = 0 OR k % 3 = 0 OR k % 5 <> 0)
    AND CAST(collected_at AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
),
last_hist AS (
  SELECT city_id, city_name, day, specie, arg_max(median, id) AS median FROM hist GROUP BY ALL
),
records AS (
  SELECT city_id, city_name, day, count(*) AS n_species,
         CAST(round_even(coalesce(max(median) FILTER (specie IN ({", ".join(_lit(s) for s in AQI_SPECIES)})), 0), 0) AS INTEGER) AS aqi,
         max(median) FILTER (specie = 'temperature') AS t, max(median) FILTER (specie = 'uvi') AS uvi
  FROM last_hist GROUP BY ALL
)"""

put("aqicn_history_csv", HISTORY, "SELECT city_id, city_name, day, specie, median FROM hist", "day")
put("history_last_value", HISTORY, "SELECT * FROM last_hist", "day")
put("aqicn_history_records", HISTORY + "," + _DIMS, """
SELECT row_number() OVER (ORDER BY day, r.city_id) AS id, r.city_id, r.city_name, CAST(day AS TIMESTAMP) AS collected_at, aqi, CAST(n_species AS INTEGER) AS n_species,
       t, uvi, r.city_name || ', France' AS station,
       'https://aqicn.org/city/' || c.station AS url, strftime(day, '%Y-%m-%dT00:00:00+00:00') AS iso,
       CAST(epoch(CAST(day AS TIMESTAMP)) AS BIGINT) AS epoch
FROM records r JOIN dim_city c ON r.city_id = c.city_id""", "collected_at")
put("aqicn_history_missing", HISTORY, """
SELECT city_id, CAST(day AS TIMESTAMP) AS collected_at,
       NOT EXISTS (SELECT 1 FROM lake l WHERE l.source = 'aqicn' AND l.processed AND l.city_name = r.city_name
                   AND CAST(l.collected_at AS DATE) = r.day) AS missing
FROM records r""", "collected_at")

put("etl_log", LAKE, f"""
SELECT {AS_OF} AS execution_time,
       CASE WHEN bad = 0 THEN 'success' WHEN good > 0 THEN 'warning' ELSE 'error' END AS status,
       'transform' AS source, good AS records_inserted,
       CASE WHEN bad > 0 THEN bad || ' échecs' END AS error_message, 0.0::DOUBLE AS execution_duration_seconds
FROM (SELECT count(*) FILTER (value <= 60) AS good, count(*) FILTER (value > 60) AS bad FROM lake)""",
    "execution_time")

# Flow, incident and water rows ----------------------------------------------------------------

TRAFFIC = LAKE + """,
flow AS (
  SELECT id, city_id, 'P' || (user_id % 3) AS code_point, collected_at, CAST(collected_at AS DATE) AS date_value,
         CAST(hour(collected_at) AS INTEGER) AS hour_of_day, 40.0::DOUBLE + city_id AS latitude,
         CAST(user_id % 3 AS DOUBLE) AS longitude,
         'model-' || k || '-with-a-rather-long-identifier' AS traffic_model_id,
         CAST(k AS DOUBLE) AS vitesse_actuelle_kmph, CAST(50 + (k % 3) * 20 AS DOUBLE) AS vitesse_fluide_kmph,
         value AS temps_trajet_actuel_s, 30.0::DOUBLE AS temps_trajet_fluide_s,
         round(value / 30.0::DOUBLE, 6) AS congestion_ratio,
         round(nullif(k, 0) / CAST(50 + (k % 3) * 20 AS DOUBLE), 6) AS speed_ratio, FALSE AS route_fermee,
         k / 100.0::DOUBLE AS indice_confiance
  FROM lake WHERE source = 'tomtom_flow'
),
points AS (
  SELECT CAST(row_number() OVER (ORDER BY early DESC, first_id) AS INTEGER) AS traffic_point_id, city_id, code_point,
         'Point ' || code_point AS libelle_point, latitude, longitude, TRUE AS actif
  FROM (SELECT city_id, code_point, latitude, longitude, min(id) AS first_id,
               count(*) FILTER (collected_at < TIMESTAMP '2024-01-02') > 0 AS early
        FROM flow GROUP BY ALL)
),
flow_facts AS (
  SELECT f.*, p.traffic_point_id FROM flow f JOIN points p ON f.city_id = p.city_id AND f.code_point = p.code_point
  QUALIFY row_number() OVER (PARTITION BY date_value, hour_of_day, f.city_id, p.traffic_point_id ORDER BY id) = 1
),
incidents AS (
  SELECT id, city_id, collected_at, CAST(k % 12 AS INTEGER) AS categorie_incident, CAST(k % 5 AS DOUBLE) AS gravite_retard,
         floor(value * 10) AS retard_s, CAST(k * 10 AS DOUBLE) AS longueur_m, 'model-' || k AS traffic_model_id,
         CAST(collected_at AS DATE) AS date_value, CAST(hour(collected_at) AS INTEGER) AS hour_of_day,
         round(0.5 * (k % 5) + 0.3 * ln(1 + floor(value * 10))
               + 0.2 * CASE k % 12 WHEN 8 THEN 5 WHEN 1 THEN 4 WHEN 6 THEN 3 ELSE 2 END, 2) AS incident_severity_score
  FROM lake WHERE source = 'tomtom_incidents'
),
categories AS (
  SELECT CAST(row_number() OVER (ORDER BY first_id) AS INTEGER) AS incident_category_id, categorie_incident AS icon_category,
         CASE categorie_incident WHEN 8 THEN 'RoadClosed' WHEN 1 THEN 'Accident' WHEN 6 THEN 'Jam' ELSE 'Unknown' END
           AS libelle_category
  FROM (SELECT categorie_incident, min(id) AS first_id FROM incidents GROUP BY ALL)
),
incident_facts AS (
  SELECT date_value, hour_of_day, city_id, incident_category_id, arg_min(traffic_model_id, id) AS traffic_model_id,
         count(*) AS nombre_incidents, sum(retard_s) AS retard_total_s,
         round(sum(retard_s) / count(*), 4) AS retard_moyen_s, arg_min(longueur_m, id) AS longueur_moyenne_m,
         max(incident_severity_score) AS incident_severity_score
  FROM incidents JOIN categories ON categorie_incident = icon_category
  GROUP BY date_value, hour_of_day, city_id, incident_category_id
)"""

WATER = LAKE + """,
drinking AS (
  SELECT id, city_id, 'Commune ' || (user_id % 20) AS nom_commune, collected_at,
         CASE WHEN k % 25 <> 0 THEN CAST(75000 + user_id % 20 AS VARCHAR) END AS code_commune,
         CAST(collected_at AS DATE) - k % 5 AS sampled, 'P' || (k % 5) AS libelle_parametre, value AS resultat_numerique,
         'mg/L' AS libelle_unite, 'C' || (k % 2) AS conclusion_conformite, k
  FROM lake WHERE source = 'hubeau_eau_potable'
),
river AS (
  SELECT id, 'S' || (user_id % 15) AS code_station, CAST(collected_at AS DATE) - k % 5 AS sampled, collected_at,
         CASE WHEN k % 2 = 0 THEN CAST(hour(collected_at) AS INTEGER) ELSE 0 END AS sampled_hour,
         'P' || (k % 5) AS libelle_parametre, value AS resultat, 'mg/L' AS symbole_unite, CAST(k % 3 AS VARCHAR) AS code_remarque
  FROM lake WHERE source = 'hubeau_cd_observations'
),
stations AS (
  SELECT CAST(row_number() OVER (ORDER BY first_id) AS INTEGER) AS station_id, * EXCLUDE (first_id)
  FROM (
    SELECT code_station, min(id) AS first_id, max(label) AS libelle_station, max(latitude) AS latitude,
           max(longitude) AS longitude, max(code_commune) AS code_commune, max(libelle_commune) AS libelle_commune
    FROM (
      SELECT 'S' || s_suppkey AS code_station, s_suppkey - 1099511627776 AS id, s_name AS label,
             s_nationkey + 30.5::DOUBLE AS latitude, s_nationkey / 2.0::DOUBLE AS longitude,
             CAST(75000 + s_nationkey AS VARCHAR) AS code_commune, 'N' || s_nationkey AS libelle_commune
      FROM supplier
      UNION ALL
      SELECT code_station, id, NULL, NULL, NULL, NULL, NULL FROM river
    ) GROUP BY code_station)
)"""

put("table_footprint", FACTS_NOW + "," + TRAFFIC[len(LAKE) + 1:], """
SELECT 'raw_data_lake' AS table_name, count(*) AS row_count, round(count(*) * 2000 / 1048576.0::DOUBLE, 6) AS mb FROM lake
UNION ALL SELECT 'fact_measures', count(*), round(count(*) * 200 / 1048576.0::DOUBLE, 6) FROM facts
UNION ALL SELECT 'fact_traffic_flow_hourly', count(*), round(count(*) * 200 / 1048576.0::DOUBLE, 6) FROM flow_facts""")

put("retention_purge", LAKE, """
SELECT source, CAST(collected_at AS DATE) AS collected_date, count(*) AS entries FROM lake
WHERE CAST(collected_at AS DATE) >= DATE '2024-02-14' - 30 GROUP BY ALL""", "collected_date")

# JSON to columns ---------------------------------------------------------------------------------

put("parse_weather", ENTRIES, "SELECT * EXCLUDE (lake_hour, collected_at) FROM weather")
put("weather_timestamp", ENTRIES, "SELECT id, date_trunc('second', collected_at) AS api_time FROM weather", "api_time")
put("parse_air_quality", ENTRIES, "SELECT * EXCLUDE (lake_hour, collected_at, k) FROM air")
put("aqi_attribution", ENTRIES, "SELECT id, station_attribution FROM air")
put("aqi_timestamp", ENTRIES, """
SELECT id, date_trunc('second', collected_at) - CASE WHEN k % 2 = 0 THEN INTERVAL 0 HOUR ELSE INTERVAL 1 HOUR END AS api_time
FROM air""", "api_time")
put("flow_flatten", LAKE, """
SELECT id, city_id, CAST(k AS DOUBLE) AS vitesse_actuelle_kmph, CAST(50 + (k % 3) * 20 AS DOUBLE) AS vitesse_fluide_kmph,
       value AS temps_trajet_actuel_s, 30.0::DOUBLE AS temps_trajet_fluide_s, k / 100.0::DOUBLE AS indice_confiance,
       k % 9 = 0 AS route_fermee, 'FRC' || (k % 4) AS frc, round(nullif(value, 0) / 30.0::DOUBLE, 6) AS congestion_ratio,
       round(nullif(k, 0) / CAST(50 + (k % 3) * 20 AS DOUBLE), 6) AS speed_ratio
FROM lake WHERE source = 'tomtom_flow' AND k % 17 <> 0""")
put("incidents_explode", LAKE, """
SELECT id, 'A' || id AS incident_id, CAST(k % 12 AS INTEGER) AS categorie_incident, 'Unknown' AS libelle_categorie,
       CAST(k % 5 AS DOUBLE) AS gravite_retard, floor(value * 10) AS retard_s, CAST(k * 10 AS DOUBLE) AS longueur_m,
       strftime(collected_at, '%Y-%m-%dT%H:%M:%S+00:00') AS debut_incident_utc, CAST(k % 6 AS INTEGER) AS nombre_signalements,
       'LineString' AS geometrie_type
FROM lake WHERE source = 'tomtom_incidents' AND k % 3 > 0
UNION ALL
SELECT id, 'B' || id, CAST(k % 7 AS INTEGER), 'Unknown', NULL, 0, 0, NULL, 0, 'Point'
FROM lake WHERE source = 'tomtom_incidents' AND k % 3 > 1""")
put("drinking_water_flatten", WATER, """
SELECT id, nom_commune, code_commune,
       CAST(sampled AS VARCHAR) || CASE WHEN k % 2 = 0 THEN '' ELSE 'T00:00:00Z' END AS date_prelevement,
       libelle_parametre, resultat_numerique, libelle_unite, conclusion_conformite AS conclusion_conformite_prelevement
FROM drinking""")
put("river_stations_flatten", "", """
SELECT s_suppkey AS id, 'S' || s_suppkey AS code_station, s_name AS libelle_station, s_nationkey + 30.5::DOUBLE AS latitude,
       s_nationkey / 2.0::DOUBLE AS longitude, CAST(75000 + s_nationkey AS VARCHAR) AS code_commune,
       'N' || s_nationkey AS libelle_commune FROM supplier""")
put("river_obs_flatten", LAKE, """
SELECT id, 'S' || (user_id % 15) AS code_station, CAST(CAST(collected_at AS DATE) - k % 5 AS VARCHAR) AS date_prelevement,
       CASE WHEN k % 4 = 0 THEN strftime(collected_at, '%H:00:00') END AS heure_prelevement,
       'P' || (k % 5) AS libelle_parametre, value AS resultat, 'mg/L' AS symbole_unite, CAST(k % 3 AS VARCHAR) AS code_remarque
FROM lake WHERE source = 'hubeau_cd_observations'""")

GROUND = LAKE + """,
ground AS (
  SELECT id, 'B' || (user_id % 40) AS bss_id, (user_id % 40) || 'X/F' AS code_bss, collected_at,
         CASE WHEN k % 2 = 0 THEN date_trunc('second', collected_at) ELSE date_trunc('day', collected_at) END AS measured_at,
         value AS groundwater_level_ngf_m, k / 4.0::DOUBLE AS groundwater_depth_m
  FROM lake
),
ground_stations AS (
  SELECT code_bss, CAST(row_number() OVER (ORDER BY min(id)) AS INTEGER) AS groundwater_station_id FROM ground GROUP BY code_bss
)"""
put("groundwater_flatten", GROUND, "SELECT * EXCLUDE (collected_at) FROM ground", "measured_at")

# Filters and routing ---------------------------------------------------------------------------------

put("route_sources", LAKE, """
SELECT id, source, CASE WHEN source IN ('openweather', 'aqicn') THEN 'weather_air'
  WHEN source IN ('tomtom_flow', 'tomtom_incidents') THEN 'traffic'
  WHEN source IN ('hubeau_eau_potable', 'hubeau_cd_stations', 'hubeau_cd_observations') THEN 'water' ELSE 'rejects' END AS family
FROM (SELECT id, source FROM lake UNION ALL SELECT doc_id, source FROM documents)""")
put("date_gate", WATER, """
SELECT id, sampled AS date_value, 0 AS hour_of_day,
       CASE WHEN sampled NOT BETWEEN DATE '2024-01-01' AND DATE '2027-12-31' THEN 'date_out_of_range' END AS reason
FROM drinking""", "date_value")
put("clamp_future", MEASURES, f"""
SELECT city_id, lake_hour, least(captured_at, {AS_OF}) AS captured_at,
       CAST(least(captured_at, {AS_OF}) AS DATE) AS capture_date FROM measures""", "lake_hour captured_at capture_date")
put("time_window_filter", MEASURES, f"""
SELECT city_id, lake_hour, captured_at FROM measures WHERE captured_at >= {AS_OF} - INTERVAL 24 HOUR""",
    "lake_hour captured_at")

# Joins and dimensions ------------------------------------------------------------------------------------

put("combine_weather_air", MEASURES,
    f"SELECT city_id, lake_hour, captured_at, raw_weather_id, raw_aqi_id, {_W}, {_A} FROM measures",
    "lake_hour captured_at")
put("weather_condition_lookup", MEASURES + "," + _DIMS, """
SELECT city_id, lake_hour, m.weather_id, w.weather_condition_id
FROM measures m LEFT JOIN dim_weather w ON m.weather_id = w.weather_id""", "lake_hour")
put("aqi_level_lookup", MEASURES + "," + _DIMS, """
SELECT city_id, lake_hour, aqi_index, a.aqi_level_id, a.aqi_level_id AS by_expression
FROM measures m LEFT JOIN dim_aqi a ON m.aqi_index BETWEEN a.aqi_min AND a.aqi_max""", "lake_hour")
put("dim_traffic_point_upsert", TRAFFIC, "SELECT * FROM points")
put("dim_incident_category_upsert", TRAFFIC, "SELECT * FROM categories")
put("dim_commune_upsert", WATER, """
SELECT CAST(row_number() OVER (ORDER BY min(id)) AS INTEGER) AS commune_id, code_commune,
       arg_min(nom_commune, id) AS nom_commune FROM drinking WHERE code_commune IS NOT NULL GROUP BY code_commune""")
put("dim_station_upsert", WATER, "SELECT * FROM stations")

_Z_COL = {"aqi": "aqi_index"}
STATS = MEASURES + """,
stats AS (
  SELECT city_id, """ + ", ".join(
    f"avg({_Z_COL.get(f, f)}) AS mean_{f}, stddev_samp({_Z_COL.get(f, f)}) AS std_{f}" for f in Z_FIELDS
) + f"""
  FROM measures WHERE captured_at >= {AS_OF} - INTERVAL 30 DAY AND captured_at < {AS_OF} GROUP BY city_id
)"""
put("city_stats_join", STATS, """
SELECT m.city_id, lake_hour, temperature, round(mean_temperature, 6) AS mean_temperature,
       round(std_temperature, 6) AS std_temperature
FROM measures m LEFT JOIN stats s ON m.city_id = s.city_id""", "lake_hour")
put("city_stats", STATS, "SELECT city_id, " + ", ".join(
    f"round({p}_{f}, 6) AS {p}_{f}" for f in Z_FIELDS for p in ("mean", "std")) + " FROM stats")
put("expected_cities_missing", MEASURES + "," + _DIMS, """
SELECT city_id, city_name FROM dim_city
WHERE city_id NOT IN (SELECT city_id FROM measures WHERE captured_at >= TIMESTAMP '2024-01-30 22:00:00')""")

# Deduplication and loading --------------------------------------------------------------------------------

put("dedup_source_hour", LAKE, """
SELECT id, city_id, source, id = max(id) OVER (PARTITION BY city_id, lake_hour, source) AS kept
FROM lake WHERE source IN ('openweather', 'aqicn')""")
put("incomplete_measures", MEASURES, f"""
SELECT city_id, lake_hour, CASE WHEN raw_weather_id IS NULL THEN 'weather' ELSE 'aqi' END AS missing,
       round((epoch_us({AS_OF}) - epoch_us(captured_at)) / 3600000000.0::DOUBLE, 4) AS age_hours
FROM measures WHERE raw_weather_id IS NULL OR raw_aqi_id IS NULL""", "lake_hour")
put("fact_measures_upsert", ENTRIES, """,
old AS (SELECT id AS measure_id, city_id, lake_hour AS captured_at, temperature, CAST(NULL AS INTEGER) AS aqi_index,
               CAST(NULL AS DOUBLE) AS pm25, FALSE AS is_anomaly FROM weather),
folded AS (
  SELECT city_id, lake_hour AS captured_at, max(id) AS ord,
         arg_max(pm25, id) FILTER (pm25 > 50) AS temperature,
         arg_max(aqi_index, id) FILTER (aqi_index IS NOT NULL) AS aqi_index, arg_max(pm25, id) AS pm25
  FROM air GROUP BY ALL),
target AS (SELECT city_id, captured_at, max(measure_id) AS measure_id FROM old GROUP BY ALL),
hit AS (SELECT f.*, t.measure_id FROM folded f LEFT JOIN target t ON f.city_id = t.city_id AND f.captured_at = t.captured_at)
SELECT o.measure_id, o.city_id, o.captured_at, coalesce(h.temperature, o.temperature) AS temperature,
       coalesce(h.aqi_index, o.aqi_index) AS aqi_index, coalesce(h.pm25, o.pm25) AS pm25, h.measure_id IS NOT NULL AS is_anomaly
FROM old o LEFT JOIN hit h ON o.measure_id = h.measure_id
UNION ALL
SELECT (SELECT max(measure_id) FROM old) + row_number() OVER (ORDER BY ord), city_id, captured_at, temperature, aqi_index, pm25, TRUE
FROM hit WHERE measure_id IS NULL""", "captured_at")

_FLOW_COLUMNS = ("id, date_value, hour_of_day, city_id, traffic_point_id, traffic_model_id, vitesse_actuelle_kmph, "
                 "vitesse_fluide_kmph, temps_trajet_actuel_s, temps_trajet_fluide_s, congestion_ratio, speed_ratio, "
                 "route_fermee, indice_confiance")
put("fact_flow_load", TRAFFIC,
    f"SELECT {_FLOW_COLUMNS} FROM flow_facts WHERE collected_at >= TIMESTAMP '2024-01-10'", "date_value")
put("incident_severity", TRAFFIC,
    "SELECT id, categorie_incident, gravite_retard, retard_s, incident_severity_score FROM incidents")
put("fact_incident_load", TRAFFIC, "SELECT * FROM incident_facts", "date_value")


def _keep_first(rows: str, keys: str, null_key: str) -> str:
    """New rows after the entries before 2024-01-10 have been loaded."""
    return f"""
SELECT * EXCLUDE (collected_at, r) FROM (
  SELECT *, CASE WHEN {null_key} THEN 1 ELSE row_number() OVER (PARTITION BY {keys} ORDER BY id) END AS r FROM ({rows})
) WHERE r = 1 AND ({null_key} OR collected_at >= TIMESTAMP '2024-01-10')"""


put("fact_drinking_water_load", WATER, _keep_first("""
  SELECT id, sampled AS date_value, 0 AS hour_of_day, city_id, code_commune, libelle_parametre, resultat_numerique,
         libelle_unite, conclusion_conformite, CAST(sampled AS TIMESTAMP) AS date_prelevement, collected_at FROM drinking""",
    "code_commune, date_prelevement, libelle_parametre", "code_commune IS NULL"), "date_value date_prelevement")
put("fact_river_load", WATER, _keep_first("""
  SELECT id, sampled AS date_value, sampled_hour AS hour_of_day, station_id, libelle_parametre, resultat, symbole_unite,
         code_remarque, CAST(sampled AS TIMESTAMP) + to_hours(sampled_hour) AS date_prelevement, collected_at
  FROM river JOIN stations USING (code_station)""",
    "station_id, date_prelevement, libelle_parametre", "FALSE"), "date_value date_prelevement")
put("fact_groundwater_load", GROUND, """
SELECT id, CAST(measured_at AS DATE) AS date_value, CAST(hour(measured_at) AS INTEGER) AS hour_of_day,
       groundwater_station_id, measured_at, groundwater_level_ngf_m, groundwater_depth_m
FROM ground JOIN ground_stations USING (code_bss)
QUALIFY row_number() OVER (PARTITION BY groundwater_station_id, measured_at ORDER BY id) = 1""", "date_value measured_at")

# Anomalies ----------------------------------------------------------------------------------------------------

_FIELD_COLUMN = {"aqi": "aqi_index", "pm2_5": "pm25"}
_RULE_FIELDS = ("temperature", "feels_like", "humidity", "pressure", "wind_speed", "aqi", "pm2_5", "pm10")


def _rule(field: str) -> str:
    low, high, unit = RULES[field]
    v = f"CAST({_FIELD_COLUMN.get(field, field)} AS DOUBLE)"
    text = f"'{field} = ' || {number(v)} || ' {unit} est hors limites physiques [{low}, {high}]'"
    return (f"SELECT city_id, lake_hour, captured_at, 'business_rule' AS anomaly_type, 'critical' AS severity, "
            f"'{field}' AS field_name, {v} AS actual_value, {low}::DOUBLE AS expected_range_min, "
            f"{high}::DOUBLE AS expected_range_max, CAST(NULL AS DOUBLE) AS anomaly_score, {text} AS description, "
            f"'rejected' AS action_taken FROM measures WHERE {v} < {low} OR {v} > {high}")


def _z(field: str) -> str:
    v = f"CAST({_FIELD_COLUMN.get(field, field)} AS DOUBLE)"
    steps = " ".join(f"WHEN z >= {step} THEN '{name}'" for name, step in Z_STEPS)
    return f"""
SELECT city_id, lake_hour, captured_at, 'statistical' AS anomaly_type, severity, '{field}' AS field_name, v AS actual_value,
       round(mu - 3 * sd, 4) AS expected_range_min, round(mu + 3 * sd, 4) AS expected_range_max, round(z, 4) AS anomaly_score,
       CAST(NULL AS VARCHAR) AS description,
       CASE WHEN severity IN ('low', 'medium') THEN 'flagged' ELSE 'rejected' END AS action_taken
FROM (SELECT *, CASE {steps} END AS severity FROM (
        SELECT m.city_id, lake_hour, captured_at, {v} AS v, mean_{field} AS mu, std_{field} AS sd,
               abs(({v} - mean_{field}) / nullif(std_{field}, 0)) AS z
        FROM measures m JOIN stats s ON m.city_id = s.city_id))
WHERE severity IS NOT NULL"""


RULE_HITS = " UNION ALL ".join(_rule(f) for f in _RULE_FIELDS)
Z_HITS = " UNION ALL ".join(_z(f) for f in Z_FIELDS)
HITS = STATS + f""",
hits AS ({RULE_HITS} UNION ALL {Z_HITS}),
summary AS (
  SELECT city_id, lake_hour, count(*) AS n_hits, max(anomaly_score) FILTER (anomaly_score <> 0) AS top,
         bool_or(severity = 'critical') AS bad, count(*) FILTER (severity = 'critical') AS n_critical
  FROM hits GROUP BY ALL
)"""

put("business_rules", MEASURES, f"SELECT * EXCLUDE (anomaly_score) FROM ({RULE_HITS})", "lake_hour captured_at")
put("zscore_anomalies", STATS, f"SELECT * EXCLUDE (description) FROM ({Z_HITS})", "lake_hour captured_at")
put("combine_anomalies", HITS, """
SELECT m.city_id, m.lake_hour, CAST(coalesce(n_hits, 0) AS INTEGER) AS n_hits, n_hits IS NOT NULL AS is_anomaly,
       CASE WHEN n_hits IS NOT NULL THEN coalesce(top, 0) END AS anomaly_score, coalesce(bad, FALSE) AS is_rejected
FROM measures m LEFT JOIN summary s ON m.city_id = s.city_id AND m.lake_hour = s.lake_hour""", "lake_hour")
put("reject_or_load", HITS, """
SELECT m.city_id, m.lake_hour, CASE WHEN bad THEN 'rejected' ELSE 'loaded' END AS outcome,
       coalesce(CASE WHEN bad THEN n_critical ELSE n_hits END, 0) AS stored_hits
FROM measures m LEFT JOIN summary s ON m.city_id = s.city_id AND m.lake_hour = s.lake_hour""", "lake_hour")
put("measure_anomalies_format", HITS + "," + _DIMS, """
SELECT h.city_id, city_name, captured_at, anomaly_type, severity, field_name, actual_value, expected_range_min,
       expected_range_max, anomaly_score, description, action_taken
FROM hits h JOIN summary s ON h.city_id = s.city_id AND h.lake_hour = s.lake_hour
JOIN dim_city c ON h.city_id = c.city_id
WHERE NOT bad OR severity = 'critical'""", "captured_at")
# The forest: 100 trees of 256 rows at most, 8 levels, contamination 5 %, seed 42.
_PRIME, _TREES, _SAMPLE, _UNIT = 9007199254740881, 100, 256, 1000000


def _hex(digest: str, first: int, digits: int) -> str:
    return f"CAST('0x' || substr({digest}, {first}, {digits}) AS BIGINT)"


def _usual(n: str) -> str:
    return (f"CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1.0::DOUBLE) / {n} "
            f"WHEN {n} = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END")


_X = "[" + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in ("temperature", "humidity", "pressure", "aqi_index", "pm25", "pm10")) + "]"
FOREST = MEASURES + f""",
bad AS (SELECT DISTINCT city_id, lake_hour FROM ({RULE_HITS})),
usable AS (
  SELECT {_MEASURE_ID} AS measure_id, m.*, {_X} AS x FROM measures m ANTI JOIN bad b ON m.city_id = b.city_id AND m.lake_hour = b.lake_hour
  WHERE temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL AND aqi_index IS NOT NULL
),
halves AS (
  SELECT measure_id, x, {_hex("h", 1, 15)} % {_PRIME} AS h1, {_hex("h", 17, 15)} % {_PRIME} AS h2
  FROM (SELECT measure_id, x, md5('42|' || measure_id) AS h FROM usable)
),
sampled AS (
  SELECT tree, x FROM halves, range(1, {_TREES} + 1) t(tree)
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (h1 + tree * h2) % {_PRIME}, measure_id) <= {_SAMPLE}
),
l0 AS (SELECT tree, x, count(*) OVER (PARTITION BY tree) AS size, 1 AS node, FALSE AS done FROM sampled),""" + ",".join(f"""
g{k} AS (
  SELECT *, count(*) OVER w AS n, {"[" + ", ".join(f"min(x[{i}]) OVER w" for i in range(1, 7)) + "]"} AS lo,
         {"[" + ", ".join(f"max(x[{i}]) OVER w" for i in range(1, 7)) + "]"} AS hi, md5('42|' || tree || '|' || node) AS h
  FROM l{k} WHERE NOT done WINDOW w AS (PARTITION BY tree, node)
),
s{k} AS (
  SELECT *, CASE WHEN n > 1 AND len(wide) > 0 AND {k} < ceil(log2(greatest(size, 2)))
                 THEN wide[{_hex("h", 1, 8)} % len(wide) + 1] ELSE -1 END AS feature
  FROM (SELECT *, [i FOR i IN [0, 1, 2, 3, 4, 5] IF hi[i + 1] > lo[i + 1]] AS wide FROM g{k})
),
c{k} AS (
  SELECT *, CASE WHEN feature >= 0 THEN CASE WHEN drawn >= hi[feature + 1] THEN lo[feature + 1] ELSE drawn END END AS cut
  FROM (SELECT *, CASE WHEN feature >= 0 THEN lo[feature + 1] + (hi[feature + 1] - lo[feature + 1])
                                              * ({_hex("h", 9, 8)} / 4294967296.0::DOUBLE) END AS drawn FROM s{k})
),
l{k + 1} AS (SELECT tree, x, size, CASE WHEN feature < 0 THEN node WHEN x[feature + 1] <= cut THEN 2 * node ELSE 2 * node + 1 END AS node,
             feature < 0 AS done FROM c{k}),
n{k} AS (SELECT DISTINCT tree, node, feature, cut, n, CAST(round({_UNIT} * ({k} + {_usual("n")})) AS BIGINT) AS path FROM c{k})""" for k in range(9)) + """,
nodes AS MATERIALIZED (""" + " UNION ALL ".join(f"SELECT * FROM n{k}" for k in range(9)) + """),"""


def _walk(rows: str, name: str) -> str:
    """Rows with the score of their walks, one step per level."""
    steps = "".join(f""",
{name}{k + 1} AS (
  SELECT p.* REPLACE (CASE WHEN feature < 0 THEN p.node WHEN x[feature + 1] <= cut THEN 2 * p.node ELSE 2 * p.node + 1 END AS node)
  FROM {name}{k} p JOIN nodes ON p.tree = nodes.tree AND p.node = nodes.node)""" for k in range(8))
    sample = f"(SELECT least({_SAMPLE}, count(*)) FROM usable)"
    return f"""
{name}0 AS (SELECT measure_id, x, tree, 1 AS node FROM {rows}, range(1, {_TREES} + 1) t(tree)){steps},
{name} AS (
  SELECT measure_id, round(-pow(2.0::DOUBLE, -(CAST(sum(path) AS DOUBLE) / {_TREES * _UNIT}.0::DOUBLE) / ({_usual(sample)})), 6) AS score
  FROM {name}8 p JOIN nodes ON p.tree = nodes.tree AND p.node = nodes.node GROUP BY measure_id)"""


_THRESHOLD = """,
bar AS (
  SELECT min(score) AS threshold
  FROM (SELECT score, sum(count(*)) OVER (ORDER BY score) AS upto, sum(count(*)) OVER () AS total FROM trained GROUP BY score)
  WHERE upto >= total * 0.05::DOUBLE)"""
put("iforest_train", FOREST + _walk("usable", "trained") + _THRESHOLD, """
SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature, round(cut, 6) AS cut, n, path, threshold
FROM nodes CROSS JOIN bar WHERE (SELECT count(*) FROM usable) >= 100""")
put("iforest_score", FOREST + _walk("usable", "trained") + _THRESHOLD + f""",
everything AS (SELECT {_MEASURE_ID} AS measure_id, m.*, {_X} AS x FROM measures m),""" + _walk("everything", "judged"), """
SELECT city_id, lake_hour, captured_at, severity, 'multivariate' AS field_name, score AS anomaly_score,
       CASE WHEN severity IN ('low', 'medium') THEN 'flagged' ELSE 'rejected' END AS action_taken
FROM (SELECT *, CASE WHEN score < -0.8 THEN 'critical' WHEN score < -0.6 THEN 'high' WHEN score < -0.4 THEN 'medium' ELSE 'low' END AS severity
      FROM everything JOIN judged USING (measure_id) CROSS JOIN bar WHERE score < threshold AND (SELECT count(*) FROM usable) >= 100)""",
    "lake_hour captured_at")

put("rolling_zscore_30d", FACTS, """
SELECT city_id, captured_at, temperature,
       CASE WHEN temperature IS NOT NULL THEN
         round((temperature - avg(temperature) OVER w) / nullif(stddev_samp(temperature) OVER w, 0), 4) END AS z
FROM facts
WINDOW w AS (PARTITION BY city_id ORDER BY captured_at RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)""",
    "captured_at")
put("groundwater_trend_7d", GROUND, f"""
SELECT id, code_bss, {mean("groundwater_level_ngf_m", 2, 4, "OVER w")} AS mean_7d FROM ground
WINDOW w AS (PARTITION BY code_bss ORDER BY measured_at RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""")

# Quality ------------------------------------------------------------------------------------------------------------


def _union(hours: int, as_of: str = AS_OF) -> str:
    start = f"{as_of} - INTERVAL {hours} HOUR"
    day = f"CAST({start} AS DATE)"
    null = "CAST(NULL AS DOUBLE)"
    hour = "CAST(date_value AS TIMESTAMP) + to_hours(hour_of_day)"
    measured = ("temperature, pressure, humidity, wind_speed, clouds, visibility, aqi_index, pm25, pm10, no2, o3, so2, co")
    nulls = ", ".join(null for _ in measured.split(", "))
    return ALL_FACTS + "," + TRAFFIC[len(LAKE) + 1:] + f""",
u AS (
  SELECT 'fact_measures' AS table_source, city_id, captured_at, capture_date, created_at, {measured},
         {null} AS vitesse_actuelle_kmph, {null} AS congestion_ratio, {null} AS speed_ratio, {null} AS incident_severity_score
  FROM facts WHERE captured_at >= {start}
  UNION ALL
  SELECT 'fact_traffic_flow_hourly', city_id, {hour}, date_value, NULL, {nulls}, vitesse_actuelle_kmph, congestion_ratio,
         speed_ratio, {null} FROM flow_facts WHERE date_value >= {day}
  UNION ALL
  SELECT 'fact_traffic_incident_hourly', city_id, {hour}, date_value, NULL, {nulls}, {null}, {null}, {null},
         incident_severity_score FROM incident_facts WHERE date_value >= {day}
)"""


U = _union(960)

put("dq_union_facts", _union(72), """
SELECT table_source, city_id, captured_at, capture_date, temperature, speed_ratio, incident_severity_score FROM u""",
    "captured_at capture_date")
_MISSING = """
SELECT 'critical' AS severity, 'data_missing' AS category,
       'Aucune donnée trouvée dans les {h} dernières heures' AS message, CAST(NULL AS VARCHAR) AS details WHERE (SELECT count(*) FROM u) = 0"""
_ALL_HOURS = 24 * 365 * 200
put("dq_missing", _union(_ALL_HOURS), """,
days AS (SELECT CAST(range AS DATE) AS d FROM range((SELECT date_trunc('day', min(captured_at)) FROM u),
         (SELECT date_trunc('day', max(captured_at)) FROM u) + INTERVAL 2 DAY, INTERVAL 1 DAY))
SELECT CAST(d AS TIMESTAMP) AS window_start, 'critical' AS severity, 'data_missing' AS category,
       'Aucune donnée trouvée dans les 24 dernières heures' AS message
FROM days WHERE d NOT IN (SELECT CAST(captured_at AS DATE) FROM u)""", "window_start")
put("dq_nulls", MEASURES, """,
n AS (SELECT count(*) AS total, count(*) FILTER (raw_weather_id IS NULL) AS w, count(*) FILTER (raw_aqi_id IS NULL) AS a FROM measures)
SELECT 'critical' AS severity, 'null_values' AS category, nulls || ' mesures avec ' || field || ' NULL sur ' || total AS message
FROM (SELECT 'city_id' AS field, w AS nulls, total FROM n UNION ALL SELECT 'capture_date', w, total FROM n
      UNION ALL SELECT 'captured_at', a, total FROM n) WHERE nulls > 0""")
put("dq_duplicates", ENTRIES, """
SELECT 'fact_measures' AS table_source, city_id, lake_hour AS captured_at, count(*) AS copies FROM weather
GROUP BY ALL HAVING count(*) > 1""", "captured_at")
put("dq_temporal", U, f"""
SELECT count(*) FILTER (created_at < captured_at) AS created_before,
       count(*) FILTER (created_at IS NOT NULL AND captured_at > {AS_OF}) AS in_future FROM u""")
_GAPS = """
SELECT city_id, gap_start, captured_at AS gap_end,
       round((epoch_us(captured_at) - epoch_us(gap_start)) / 3600000000.0::DOUBLE, 4) AS gap_hours
FROM (SELECT city_id, captured_at, lag(captured_at) OVER (PARTITION BY city_id ORDER BY captured_at) AS gap_start FROM u)
WHERE captured_at - gap_start > INTERVAL 2 HOUR"""
put("dq_gaps", U, _GAPS, "gap_start gap_end")


def _limit(field: str) -> str:
    low, high = LIMITS[field]
    col = "aqi_index" if field == "aqi" else field
    return (f"SELECT '{field}' AS field, table_source, city_id, captured_at, CAST({col} AS DOUBLE) AS value, "
            f"'[{low}, {high}]' AS limits FROM u WHERE {col} < {low} OR {col} > {high}")


_VIOLATIONS = " UNION ALL ".join(_limit(f) for f in LIMITS if f != "uvi")
put("dq_limits", U, f"""
SELECT field, count(*) OVER (PARTITION BY field) AS violations,
       CAST(row_number() OVER w AS INTEGER) AS rank, city_id, captured_at, round(value, 4) AS value, limits
FROM ({_VIOLATIONS})
WINDOW w AS (PARTITION BY field ORDER BY captured_at, city_id, value, table_source)
QUALIFY row_number() OVER w <= 3""", "captured_at")


def _listed(key: str, rows: str) -> str:
    item = f"{key} || '=' || n"
    return f"(SELECT string_agg({item}, ';' ORDER BY {item}) FROM ({rows}))"


def _coverage(rows: str) -> str:
    low = f"SELECT city_id, n FROM (SELECT *, avg(n) OVER () AS mean FROM (SELECT city_id, count(*) AS n FROM ({rows}) GROUP BY city_id)) WHERE n < mean * 0.5"
    return f"""
SELECT 'warning' AS severity, 'data_coverage' AS category,
       count(*) || ' villes sans données : ' || string_agg(city_name, ', ' ORDER BY city_id) AS message, NULL AS details
FROM dim_city WHERE city_id NOT IN (SELECT city_id FROM ({rows})) HAVING count(*) > 0
UNION ALL
SELECT 'info', 'data_coverage', count(*) || ' villes avec couverture faible', {_listed("city_id", low)}
FROM ({low}) HAVING count(*) > 0"""


put("dq_coverage", _union(_ALL_HOURS), """,
g AS (SELECT DISTINCT table_source, capture_date FROM u),
n AS (SELECT table_source, capture_date, city_id, count(*) AS n FROM u GROUP BY ALL)
SELECT g.table_source, g.capture_date, 'warning' AS severity, 'data_coverage' AS category,
       count(*) || ' villes sans données : ' || string_agg(city_name, ', ' ORDER BY c.city_id) AS message
FROM g CROSS JOIN dim_city c
WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.table_source = g.table_source AND n.capture_date = g.capture_date AND n.city_id = c.city_id)
GROUP BY g.table_source, g.capture_date
UNION ALL
SELECT table_source, capture_date, 'info', 'data_coverage', count(*) || ' villes avec couverture faible'
FROM (SELECT *, avg(n) OVER (PARTITION BY table_source, capture_date) AS mean FROM n)
WHERE n < mean * 0.5 GROUP BY table_source, capture_date""", "capture_date")


def _outlier(field: str) -> str:
    col = "aqi_index" if field == "aqi" else field
    return f"""
SELECT '{field}' AS field, count(*) FILTER (z > 3) AS outliers, round(count(*) FILTER (z > 3) * 100.0::DOUBLE / count(*), 4) AS percentage,
       round(max(mu), 4) AS mean, round(max(sd), 4) AS std, round(max(z), 4) AS max_z_score
FROM (SELECT *, abs({col} - mu) / nullif(sd, 0) AS z FROM
        (SELECT {col}, avg({col}) OVER () AS mu, stddev_pop({col}) OVER () AS sd FROM u WHERE {col} IS NOT NULL))
HAVING count(*) >= 10 AND count(*) FILTER (z > 3) > 0"""


_OUTLIERS = " UNION ALL ".join(
    _outlier(f) for f in ("temperature", "humidity", "pressure", "aqi", "pm25", "pm10"))
put("dq_outliers", U, _OUTLIERS)

_ISSUES = f"""
{_MISSING.format(h=960)}
UNION ALL SELECT 'warning', 'temporal_coherence', n || ' mesures avec created_at < captured_at', NULL
  FROM (SELECT count(*) AS n FROM u WHERE created_at < captured_at) WHERE n > 0
UNION ALL SELECT 'critical', 'temporal_coherence', n || ' mesures avec captured_at dans le futur', NULL
  FROM (SELECT count(*) AS n FROM u WHERE created_at IS NOT NULL AND captured_at > {AS_OF}) WHERE n > 0
UNION ALL SELECT 'critical', 'duplicates', n || ' doublons détectés (même city_id + captured_at)', NULL
  FROM (SELECT sum(c - 1) AS n FROM (SELECT count(*) AS c FROM dup GROUP BY t, city_id, captured_at, p)) WHERE n > 0
UNION ALL SELECT 'warning', 'temporal_gaps', count(*) || ' gaps temporels détectés dans ' || count(DISTINCT city_id) || ' villes',
  {_listed("city_id", f"SELECT city_id, count(*) AS n FROM ({_GAPS}) GROUP BY city_id")}
  FROM ({_GAPS}) HAVING count(*) > 0
UNION ALL SELECT 'critical', 'business_rules', count(*) || ' violations de limites physiques',
  {_listed("field", f"SELECT field, count(*) AS n FROM ({_VIOLATIONS}) GROUP BY field")} FROM ({_VIOLATIONS}) HAVING count(*) > 0
UNION ALL {_coverage("SELECT * FROM u")}
UNION ALL SELECT 'info', 'statistical_outliers', CAST(sum(outliers) AS BIGINT) || ' outliers statistiques détectés (>3σ)',
  {_listed("field", f"SELECT field, outliers AS n FROM ({_OUTLIERS})")}
  FROM ({_OUTLIERS}) HAVING count(*) > 0"""
ISSUES = U.replace("\nu AS (", "\nu AS MATERIALIZED (") + f""",
dup AS (
  SELECT 'm' AS t, city_id, captured_at, CAST(NULL AS INTEGER) AS p FROM facts
  UNION ALL SELECT 'f', city_id, date_value + to_hours(hour_of_day), traffic_point_id FROM flow_facts
  UNION ALL SELECT 'i', city_id, date_value + to_hours(hour_of_day), incident_category_id FROM incident_facts
),
issues AS ({_ISSUES})"""
put("dq_issue_rows", ISSUES, f"""
SELECT 'run-1' AS validation_run_id, severity, category, message, details, {AS_OF} AS detected_at, 960 AS validation_period_hours
FROM issues""", "detected_at")
put("dq_report", ISSUES, """
SELECT count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning,
       count(*) FILTER (severity = 'info') AS info,
       CASE WHEN count(*) FILTER (severity IN ('critical', 'warning')) > 0 THEN 'failed' ELSE 'ok' END AS status FROM issues""")

CLEAN = ENTRIES + """,
ranked AS (SELECT id AS measure_id, city_id, lake_hour AS captured_at,
  row_number() OVER (PARTITION BY city_id, lake_hour ORDER BY collected_at DESC, id DESC) AS r FROM weather)"""
put("cleanup_duplicates", CLEAN, "SELECT measure_id, city_id, captured_at FROM ranked WHERE r > 1", "captured_at")
put("cleanup_future", CLEAN, f"SELECT measure_id, captured_at FROM ranked WHERE captured_at > {AS_OF}", "captured_at")
put("cleanup_report", CLEAN, f"""
SELECT *, duplicates + future_dates AS total_deleted FROM (
  SELECT count(*) FILTER (r > 1) AS duplicates, count(*) FILTER (r = 1 AND captured_at > {AS_OF}) AS future_dates, FALSE AS dry_run FROM ranked
  UNION ALL SELECT count(*) FILTER (r > 1), count(*) FILTER (captured_at > {AS_OF}), TRUE FROM ranked)""")

# Dimensions as data -----------------------------------------------------------------------------------------------------

put("dim_date_build", "", f"""
SELECT {_DATE_COLUMNS} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
WHERE d NOT BETWEEN DATE '2024-01-01' AND DATE '2027-12-31'""", "date_value")


def _used(dim: str, key: str, columns: str) -> str:
    return (f"SELECT {columns}, coalesce(used, 0) AS used FROM {dim} d "
            f"LEFT JOIN (SELECT {key} AS key, count(*) AS used FROM facts GROUP BY ALL) f ON d.{key} = f.key")


put("dim_aqi_seed", FACTS, _used("dim_aqi", "aqi_level_id", "d.*"))
put("dim_weather_seed", FACTS, _used("dim_weather", "weather_condition_id", "d.*"))
put("dim_city_seed", FACTS, _used(
    "dim_city", "city_id",
    "city_id, city_name, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, 'France' AS country"))

# Reports ------------------------------------------------------------------------------------------------------------------

_T, _H = mean("temperature"), mean("humidity", 0)
_Q = mean("aqi_index", 0, 0)
_DATE = "JOIN dim_date d ON f.capture_date = d.date_value"
_CITY = "JOIN dim_city c ON f.city_id = c.city_id"

put("fact_star_view", FACTS, f"""
SELECT f.measure_id, f.captured_at, c.city_name, d.month_name, d.season
FROM (SELECT * FROM facts ORDER BY measure_id LIMIT 100) f LEFT {_DATE} LEFT {_CITY}""", "captured_at")
put("q01_monthly_city", FACTS, f"""
SELECT city_name, year, month, month_name, {_T} AS temp_moyenne, {_H} AS humidite_moyenne, count(*) AS nb_mesures
FROM facts f {_DATE} {_CITY} WHERE year IN (2025, 2026) GROUP BY city_name, year, month, month_name""")
put("q02_hourly_profile", FACTS, f"""
SELECT capture_hour, {_T} AS temp_moyenne, min(temperature) AS temp_min, max(temperature) AS temp_max
FROM facts f {_DATE} GROUP BY capture_hour""")
put("q03_weekend_vs_week", FACTS, f"""
SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Semaine' END AS periode, {_Q} AS aqi_moyen, count(*) AS nb_mesures
FROM facts f {_DATE} WHERE aqi_index IS NOT NULL GROUP BY is_weekend""")
put("q04_city_air_ranking", FACTS, f"""
SELECT city_name, CAST(NULL AS VARCHAR) AS region, {_Q} AS aqi_moyen, {mean("pm25")} AS pm25_moyen,
       {mean("pm10")} AS pm10_moyen, count(*) AS nb_mesures
FROM facts f {_CITY} WHERE aqi_index IS NOT NULL GROUP BY city_name""")
put("q05_hottest_coldest", FACTS, f"""
SELECT * FROM (SELECT 'Plus chaude' AS type, city_name, max(temperature) AS temperature FROM facts f {_CITY}
               WHERE temperature IS NOT NULL GROUP BY city_name ORDER BY temperature DESC, city_name LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'Plus froide' AS type, city_name, min(temperature) AS temperature FROM facts f {_CITY}
               WHERE temperature IS NOT NULL GROUP BY city_name ORDER BY temperature, city_name LIMIT 1)""")
put("q06_weather_distribution", FACTS, f"""
SELECT category, main, occurrences, {share("occurrences", "sum(occurrences) OVER ()")} AS pourcentage
FROM (SELECT w.category, w.main, count(*) AS occurrences FROM facts f
      JOIN dim_weather w ON f.weather_condition_id = w.weather_condition_id GROUP BY ALL)""")
put("q07_temp_by_weather", FACTS, f"""
SELECT w.category, {_T} AS temp_moyenne, {_H} AS humidite_moyenne, {mean("wind_speed")} AS vent_moyen
FROM facts f JOIN dim_weather w ON f.weather_condition_id = w.weather_condition_id GROUP BY w.category""")
put("q08_aqi_level_share", FACTS, f"""
SELECT level_name, health_concern, nb_mesures, {share("nb_mesures", "sum(nb_mesures) OVER ()")} AS pourcentage
FROM (SELECT level_name, health_concern, count(*) AS nb_mesures FROM facts f
      JOIN dim_aqi a ON f.aqi_level_id = a.aqi_level_id GROUP BY ALL)""")
put("q09_pollution_alerts", FACTS, f"""
SELECT city_name, level_name, count(*) AS nb_alertes, min(date_value) AS premiere_alerte, max(date_value) AS derniere_alerte
FROM facts f {_CITY} {_DATE} JOIN dim_aqi a ON f.aqi_level_id = a.aqi_level_id
WHERE aqi_min > 100 GROUP BY city_name, level_name""", "premiere_alerte derniere_alerte")
put("q10_cube", FACTS, f"""
SELECT city_name, month_name, level_name, count(*) AS nb_mesures, {_Q} AS aqi_moyen
FROM facts f {_CITY} {_DATE} JOIN dim_aqi a ON f.aqi_level_id = a.aqi_level_id
WHERE year = 2025 GROUP BY CUBE (city_name, month, month_name, level_name)""")
put("q11_aqi_by_temp_band", FACTS, f"""
SELECT city_name, {mean("CASE WHEN temperature < 10 THEN aqi_index END", 0, 0)} AS aqi_froid,
       {mean("CASE WHEN temperature BETWEEN 10 AND 20 THEN aqi_index END", 0, 0)} AS aqi_tempere,
       {mean("CASE WHEN temperature > 20 THEN aqi_index END", 0, 0)} AS aqi_chaud
FROM facts f {_CITY} WHERE aqi_index IS NOT NULL GROUP BY city_name""")
put("q12_season_pollution", FACTS, f"""
SELECT season, {mean("pm25")} AS pm25_moyen, {mean("pm10")} AS pm10_moyen, {mean("no2")} AS no2_moyen, count(*) AS nb_mesures
FROM facts f {_DATE} WHERE pm25 IS NOT NULL GROUP BY season""")
put("q13_kpi_24h", FACTS, f""",
l AS (SELECT f.* FROM facts f {_DATE} WHERE CAST(date_value AS TIMESTAMP) >= {NOW} - INTERVAL 24 HOUR)
SELECT 'Température moyenne' AS kpi, printf('%.2f', {_T}) AS valeur, '°C' AS unite FROM l
UNION ALL SELECT 'AQI moyen', CAST(CAST({_Q} AS BIGINT) AS VARCHAR), 'index' FROM l
UNION ALL (SELECT 'Ville la plus polluée', city_name, CAST(CAST({_Q} AS BIGINT) AS VARCHAR) FROM l f {_CITY}
           GROUP BY city_name ORDER BY {mean("aqi_index", 0, 6)} DESC NULLS FIRST, city_name LIMIT 1)""")
put("q14_top5_now", FACTS, f"""
SELECT city_name, CAST(sign(temperature) * ((2 * abs(CAST(round(temperature * 100) AS BIGINT)) + 10) // 20) AS DOUBLE) / 10 AS temperature,
       w.description AS meteo, aqi_index
FROM facts f {_CITY} LEFT JOIN dim_weather w ON f.weather_condition_id = w.weather_condition_id
WHERE capture_date = (SELECT max(date_value) FROM dim_date WHERE CAST(date_value AS TIMESTAMP) <= {NOW})
ORDER BY f.temperature DESC NULLS FIRST, measure_id LIMIT 5""")
put("q15_monthly_mv", FACTS, f"""
SELECT f.city_id, city_name, year, month, month_name, {_T} AS temp_avg, {_H} AS humidity_avg, {_Q} AS aqi_avg,
       count(*) AS measure_count
FROM facts f {_CITY} {_DATE} GROUP BY f.city_id, city_name, year, month, month_name""")
put("q16_dim_date_stats", "", """
SELECT 'dim_date' AS table_name, count(*) AS total_days, min(d) AS first_date, max(d) AS last_date,
       count(*) FILTER (dayofweek(d) IN (0, 6)) AS weekend_days, count(*) FILTER (dayofweek(d) NOT IN (0, 6)) AS weekdays
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""", "first_date last_date")
put("q17_daily_measures", FACTS, f"""
SELECT date_value, day_name, month_name, is_weekend, count(measure_id) AS nb_measures, {mean("temperature", 2, 1)} AS avg_temp
FROM facts f JOIN dim_date d ON CAST(captured_at AS DATE) = date_value
GROUP BY date_value, day_name, month_name, is_weekend ORDER BY date_value DESC LIMIT 10""", "date_value")

_ISSUE_HISTORY = LAKE + """,
hist_issues AS (
  SELECT 'run-' || hour(collected_at) AS run, (['critical', 'warning', 'info'])[k % 3 + 1] AS severity,
         'category_' || (k % 5) AS category, collected_at
  FROM lake WHERE event_type = 'error'
)"""
put("q18_anomalies_daily", _ISSUE_HISTORY, """
SELECT CAST(collected_at AS DATE) AS date, severity, category, count(*) AS count, count(DISTINCT run) AS validation_runs
FROM hist_issues GROUP BY ALL""", "date")
put("q19_anomalies_summary", _ISSUE_HISTORY, """
SELECT count(*) AS total_anomalies, count(DISTINCT run) AS unique_runs, count(DISTINCT severity) AS severity_levels,
       count(DISTINCT category) AS categories FROM hist_issues""")

# Streaming ------------------------------------------------------------------------------------------------------------------

put("stream_transform", FACTS_NOW, """
SELECT city_id, lake_hour, captured_at, capture_date, weather_condition_id, aqi_level_id, temperature,
       CAST(humidity AS INTEGER) AS humidity, aqi_index, pm25, rain_1h, raw_weather_id, raw_aqi_id FROM facts""",
    "lake_hour captured_at capture_date")
put("stream_drain", LAKE, """
SELECT id, CASE WHEN source IN ('hubeau_eau_potable', 'hubeau_cd_observations')
                 AND CAST(collected_at AS DATE) - k % 5 < DATE '2024-01-01' THEN 'date_out_of_range' ELSE 'processed' END AS outcome
FROM lake
UNION ALL
SELECT id + 4294967296,
       CASE WHEN k % 40 = 35 THEN 'unknown_source' WHEN k % 4 IN (0, 3) THEN 'bad_payload'
            WHEN k % 4 = 1 THEN CASE WHEN source IN ('tomtom_flow', 'hubeau_cd_observations') THEN 'missing_key' ELSE 'processed' END
            ELSE CASE source WHEN 'openweather' THEN 'numeric_overflow' WHEN 'aqicn' THEN 'numeric_overflow'
                             WHEN 'tomtom_incidents' THEN 'negative_delay' WHEN 'hubeau_eau_potable' THEN 'bad_date' ELSE 'processed' END END
FROM lake WHERE k % 5 = 0""")
put("stream_hourly_dedup", LAKE, """
SELECT lake_hour, city_id, source, max(id) AS id, arg_max(collected_at, id) AS collected_at
FROM lake WHERE source IN ('openweather', 'aqicn') GROUP BY ALL""", "lake_hour collected_at")
put("stream_incidents_hourly", TRAFFIC, """
SELECT date_value, hour_of_day, city_id, icon_category AS categorie_incident, traffic_model_id, nombre_incidents,
       retard_total_s, retard_moyen_s, longueur_moyenne_m, incident_severity_score
FROM incident_facts JOIN categories USING (incident_category_id)""", "date_value")
