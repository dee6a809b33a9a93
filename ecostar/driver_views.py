"""The warehouse domain seen in the test tables.

Events become lake entries with real JSON payloads, suppliers become cities and
river stations. The lake is written as a table, as the warehouse finds it; the other
views are projections.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ecostar import schemas
from ecostar.operators import anomalies, measures as m
from ecostar.session import folder_exists, shared_folder
from ecostar.sources import reference

AS_OF = dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc)
LATE = dt.datetime(2027, 12, 31, tzinfo=dt.timezone.utc)


def as_of() -> Column:
    return F.lit(AS_OF)


def late() -> Column:
    return F.lit(LATE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _json(*parts: str) -> str:
    """SQL that joins quoted text and values; a NULL value prints as null."""
    return "concat(" + ", ".join(
        p if p.startswith("'") else f"coalesce(string({p}), 'null')" for p in parts
    ) + ")"


def _choice(items, index: str) -> str:
    return "element_at(array(" + ", ".join(repr(i) for i in items) + f"), {index})"


_CITY = "int(user_id % 10 + 1)"
_SOURCE = f"""CASE event_type WHEN 'view' THEN '{schemas.WEATHER}' WHEN 'click' THEN '{schemas.AIR}'
  WHEN 'purchase' THEN '{schemas.FLOW}' WHEN 'error' THEN '{schemas.INCIDENTS}'
  ELSE CASE WHEN user_id % 2 = 0 THEN '{schemas.DRINKING_WATER}' ELSE '{schemas.RIVER_OBSERVATIONS}' END END"""


def events(spark: SparkSession, sf_dir: str, months: bool = False) -> DataFrame:
    """``months`` moves each user's events by up to 23 months, for seasons and years."""
    shift = " + make_ym_interval(0, int(user_id % 24))" if months else ""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS id",
        f"{_CITY} AS city_id",
        f"{_choice([c[1] for c in reference.CITIES], _CITY)} AS city_name",
        "user_id",
        "event_type",
        "value",
        "int(get_json_object(props, '$.k')) AS k",
        f"timestamp(ts){shift} AS collected_at",
        f"{_SOURCE} AS source",
    )


_ISO = "concat(date_format(collected_at, \"yyyy-MM-dd'T'HH:mm:ss\"), '+00:00')"
_TEMP = "round(value / 3 - 10, 2)"
_CODES = [c[0] for c in reference.WEATHER_CODES] + [999]

WEATHER_JSON = _json(
    "'{\"dt\":'", "unix_timestamp(collected_at)", "',\"main\":{\"temp\":'", _TEMP, "',\"feels_like\":'",
    f"round({_TEMP} - 2, 2)", "',\"pressure\":'", "960 + k", "',\"humidity\":'", "k", "'},\"wind\":{\"speed\":'",
    "k / 5D", "',\"deg\":'", "k * 3", "',\"gust\":'", "k / 4D", "'},\"clouds\":{\"all\":'", "k",
    "'},\"visibility\":'", "k * 100", "',\"weather\":[{\"id\":'", _choice(_CODES, "k % 37 + 1"),
    "',\"main\":\"M'", "k % 5", "'\",\"description\":\"D'", "k % 7", "'\"}]'",
    "CASE WHEN k % 4 = 0 THEN concat(',\"rain\":{\"1h\":', k / 10D, '}') ELSE '' END", "'}'",
)

# AQI "-" now and then, PM10 as an object or a bare number, both kinds of attribution and time.
AIR_JSON = _json(
    "'{\"status\":\"ok\",\"data\":{\"aqi\":'", "CASE WHEN k % 10 = 0 THEN '\"-\"' ELSE string(floor(value * 2)) END",
    "',\"iaqi\":{\"pm25\":{\"v\":'", "value", "'},\"pm10\":'",
    "CASE WHEN k % 8 = 1 THEN string(k) ELSE concat('{\"v\":', k, '}') END", "',\"no2\":{\"v\":'", "k / 2D", "'}},'",
    "CASE WHEN k % 3 = 0 THEN concat('\"city\":{\"name\":\"', city_name, '\"}') "
    "ELSE concat('\"attributions\":[{\"name\":\"Station ', user_id % 3, '\"}]') END", "','",
    f"CASE WHEN k % 2 = 0 THEN concat('\"time\":{{\"iso\":\"', {_ISO}, '\"}}') "
    "ELSE concat('\"time\":{\"s\":\"', date_format(collected_at, 'yyyy-MM-dd HH:mm:ss'), '\",\"tz\":\"01:00\",\"v\":0}') END",
    "'}}'",
)

_FREE_SPEED = "50 + (k % 3) * 20"
FLOW_JSON = _json(
    "'{\"code_point\":\"P'", "user_id % 3", "'\",\"latitude\":'", "40D + city_id", "',\"longitude\":'",
    "double(user_id % 3)", "',\"traffic_model_id\":\"model-'", "k",
    "'-with-a-rather-long-identifier\",\"vitesse_actuelle_kmph\":'", "k", "',\"vitesse_fluide_kmph\":'", _FREE_SPEED,
    "',\"temps_trajet_actuel_s\":'", "value", "',\"temps_trajet_fluide_s\":30,\"indice_confiance\":'", "k / 100D",
    "',\"congestion_ratio\":'", "nullif(value, 0D) / 30", "',\"speed_ratio\":'",
    f"nullif(double(k), 0D) / ({_FREE_SPEED})", "'}'",
)

INCIDENT_JSON = _json(
    "'{\"incident_id\":\"I'", "id", "'\",\"categorie_incident\":'", "k % 12",
    "',\"libelle_categorie\":\"Unknown\",\"gravite_retard\":'", "k % 5", "',\"retard_s\":'", "floor(value * 10)",
    "',\"longueur_m\":'", "k * 10", "',\"traffic_model_id\":\"model-'", "k", "'\"}'",
)

_DAY = "string(date_sub(to_date(collected_at), k % 5))"
DRINKING_JSON = _json(
    "'{\"nom_commune\":\"Commune '", "user_id % 20", "'\",\"code_commune\":'",
    "CASE WHEN k % 25 <> 0 THEN concat('\"', 75000 + user_id % 20, '\"') END", "',\"date_prelevement\":\"'",
    f"concat({_DAY}, CASE WHEN k % 2 = 0 THEN '' ELSE 'T00:00:00Z' END)", "'\",\"libelle_parametre\":\"P'", "k % 5",
    "'\",\"resultat_numerique\":'", "value", "',\"libelle_unite\":\"mg/L\",\"conclusion_conformite_prelevement\":\"C'",
    "k % 2", "'\"}'",
)

# The sampling hour, where there is one, stands in the record or in its raw copy.
RIVER_JSON = _json(
    "'{\"code_station\":\"S'", "user_id % 15", "'\",'",
    "CASE WHEN k % 4 = 0 THEN concat('\"heure_prelevement\":\"', date_format(collected_at, 'HH'), ':00:00\",') "
    "WHEN k % 2 = 0 THEN concat('\"donnees_brutes\":{\"heure_prelevement\":\"', date_format(collected_at, 'HH'), "
    "':00:00\"},') ELSE '' END", "'\"date_prelevement\":\"'", _DAY, "'\",\"libelle_parametre\":\"P'", "k % 5",
    "'\",\"resultat\":'", "value", "',\"symbole_unite\":\"mg/L\",\"code_remarque\":\"'", "k % 3", "'\"}'",
)


def lake_entries(spark: SparkSession, sf_dir: str, months: bool = False) -> DataFrame:
    raw = f"""CASE source WHEN '{schemas.WEATHER}' THEN {WEATHER_JSON} WHEN '{schemas.AIR}' THEN {AIR_JSON}
      WHEN '{schemas.FLOW}' THEN {FLOW_JSON} WHEN '{schemas.INCIDENTS}' THEN {INCIDENT_JSON}
      WHEN '{schemas.DRINKING_WATER}' THEN {DRINKING_JSON} ELSE {RIVER_JSON} END"""
    return events(spark, sf_dir, months).selectExpr(
        "id", "city_id", "city_name", "source", f"{raw} AS raw_data", "collected_at", "k < 30 AS processed",
        "timestamp(NULL) AS processed_at",
    )


def broken_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Further entries that fail: cut-off payloads, empty ones, values beyond their columns, unreadable and far dates."""
    raw = """CASE k % 4 WHEN 0 THEN '{"code_point": "P1", "vitesse' WHEN 1 THEN '{}'
      WHEN 2 THEN '{"main": {"temp": 123456}, "data": {"aqi": 1, "iaqi": {"pm25": {"v": 123456789}}}, "retard_s": -7, "date_prelevement": "soon", "code_point": "P1", "code_station": "S1"}' END"""
    shifted = "CASE WHEN k % 8 = 3 THEN collected_at - INTERVAL 5 YEARS ELSE collected_at END"
    return events(spark, sf_dir).filter("k % 5 = 0").selectExpr(
        "id + 4294967296 AS id", "city_id", "city_name", "CASE WHEN k % 40 = 35 THEN 'unheard_of' ELSE source END AS source", f"{raw} AS raw_data",
        f"{shifted} AS collected_at", "FALSE AS processed", "timestamp(NULL) AS processed_at",
    )


_LAKES: dict[tuple, str] = {}


def _stored(entries: DataFrame, *key) -> DataFrame:
    """Lake entries as a stored table, by source; written once per application and key."""
    spark = entries.sparkSession
    key = (spark.sparkContext.applicationId, *key)
    if key not in _LAKES or not folder_exists(spark, _LAKES[key]):
        path = shared_folder(spark, "lake")
        entries.hint("rebalance", "source").write.partitionBy("source").parquet(path)
        _LAKES[key] = path
    return spark.read.schema(schemas.LAKE).parquet(_LAKES[key])


def lake(spark: SparkSession, sf_dir: str, months: bool = False) -> DataFrame:
    return _stored(lake_entries(spark, sf_dir, months), "lake", sf_dir, months)


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that a run has dealt with; those of a high value were rejected."""
    return events(spark, sf_dir).selectExpr(
        "id", "CASE WHEN value > 60 THEN 'rejected' ELSE 'processed' END AS outcome", "value"
    )


# Answers of the source APIs, one per event of the source ---------------------------


def _answers(spark, sf_dir, source: str, raw: str) -> DataFrame:
    return events(spark, sf_dir).filter(F.col("source") == source).selectExpr(
        "id", "city_id", "collected_at", f"{raw} AS raw_data"
    )


def flow_answers(spark, sf_dir) -> DataFrame:
    segment = _json(
        "'{\"flowSegmentData\":{\"currentSpeed\":'", "k", "',\"freeFlowSpeed\":'", _FREE_SPEED,
        "',\"currentTravelTime\":'", "value", "',\"freeFlowTravelTime\":30,\"confidence\":'", "k / 100D",
        "CASE WHEN k % 9 = 0 THEN ',\"roadClosure\":true' ELSE '' END", "',\"frc\":\"FRC'", "k % 4", "'\"}}'",
    )
    raw = f"CASE WHEN k % 17 = 0 THEN '{{\"error\":\"quota\"}}' ELSE {segment} END"
    return _answers(spark, sf_dir, schemas.FLOW, raw)


def incident_answers(spark, sf_dir) -> DataFrame:
    """Answers with no, one or two incidents; the second one lacks delay, length and reports."""
    full = _json(
        "'{\"type\":\"Feature\",\"geometry\":{\"type\":\"LineString\"},\"properties\":{\"id\":\"A'", "id",
        "'\",\"iconCategory\":'", "k % 12", "',\"magnitudeOfDelay\":'", "k % 5", "',\"delay\":'", "floor(value * 10)",
        "',\"length\":'", "k * 10", "',\"startTime\":\"'", _ISO, "'\",\"numberOfReports\":'", "k % 6", "'}}'",
    )
    bare = _json(
        "',{\"type\":\"Feature\",\"geometry\":{\"type\":\"Point\"},\"properties\":{\"id\":\"B'", "id",
        "'\",\"iconCategory\":'", "k % 7", "'}}'",
    )
    raw = _json(
        "'{\"incidents\":['", f"CASE WHEN k % 3 > 0 THEN {full} ELSE '' END",
        f"CASE WHEN k % 3 > 1 THEN {bare} ELSE '' END", "']}'",
    )
    return _answers(spark, sf_dir, schemas.INCIDENTS, raw)


def drinking_answers(spark, sf_dir) -> DataFrame:
    raw = _json("'{\"count\":1,\"data\":['", DRINKING_JSON, "']}'")
    return _answers(spark, sf_dir, schemas.DRINKING_WATER, raw)


def river_obs_answers(spark, sf_dir) -> DataFrame:
    return _answers(spark, sf_dir, schemas.RIVER_OBSERVATIONS, _json("'{\"data\":['", RIVER_JSON, "']}'"))


STATION_JSON = _json(
    "'{\"code_station\":\"S'", "s_suppkey", "'\",\"libelle_station\":\"'", "s_name", "'\",\"latitude\":'",
    "s_nationkey + 30.5D", "',\"longitude\":'", "s_nationkey / 2D", "',\"code_commune\":\"'", "75000 + s_nationkey",
    "'\",\"libelle_commune\":\"N'", "s_nationkey", "'\"}'",
)


def station_answers(spark, sf_dir) -> DataFrame:
    raw = _json("'{\"data\":['", STATION_JSON, "']}'")
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", f"{raw} AS raw_data")


def station_lake(spark, sf_dir) -> DataFrame:
    """Station entries; their ids stand before those of all events."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey - 1099511627776 AS id", "1 AS city_id", "'Paris' AS city_name",
        f"'{schemas.RIVER_STATIONS}' AS source", f"{STATION_JSON} AS raw_data",
        "TIMESTAMP '2024-01-01 00:00:00' AS collected_at", "FALSE AS processed", "timestamp(NULL) AS processed_at",
    )


GROUNDWATER_JSON = _json(
    "'{\"bss_id\":\"B'", "user_id % 40", "'\",\"code_bss\":\"'", "user_id % 40", "'X/F\",'",
    f"CASE WHEN k % 2 = 0 THEN concat('\"date_mesure_utc\":\"', {_ISO}, '\"') "
    "ELSE concat('\"date_mesure\":\"', date_format(collected_at, 'yyyy-MM-dd'), '\"') END",
    "',\"timestamp_mesure\":'", "unix_timestamp(collected_at)", "',\"groundwater_level_ngf_m\":'", "value",
    "',\"groundwater_depth_m\":'", "k / 4D", "'}'",
)


def groundwater_answers(spark, sf_dir) -> DataFrame:
    raw = _json("'{\"data\":['", GROUNDWATER_JSON, "']}'")
    return events(spark, sf_dir).selectExpr("id", "city_id", "collected_at", f"{raw} AS raw_data")


def groundwater_lake(spark, sf_dir) -> DataFrame:
    entries = events(spark, sf_dir).selectExpr(
        "id", "city_id", "city_name", "'hubeau_chroniques_tr' AS source", f"{GROUNDWATER_JSON} AS raw_data",
        "collected_at", "FALSE AS processed", "timestamp(NULL) AS processed_at",
    )
    return _stored(entries, "groundwater", sf_dir)


# Cities and stations ------------------------------------------------------------------


def supplier_cities(spark, sf_dir) -> DataFrame:
    """Suppliers as cities; some lack a station, one in eleven a place."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "int(s_suppkey + 1) AS id",
        "s_name AS name",
        "CASE WHEN s_suppkey % 11 <> 5 THEN s_nationkey + 30.5D ELSE 0D END AS latitude",
        "s_nationkey / 4D + 1 AS longitude",
        "CASE s_suppkey % 3 WHEN 0 THEN concat('/st-', s_suppkey, '/') WHEN 1 THEN '' END AS aqi_station",
    )


def customer_reference(spark, sf_dir) -> DataFrame:
    """A station reference: by id for even keys, by name for all customers."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CASE WHEN c_custkey % 2 = 0 THEN int(c_custkey + 1) END AS id",
        "replace(c_name, 'Customer', 'Supplier') AS name",
        "CASE WHEN c_custkey % 5 <> 4 THEN concat('ref-', c_custkey) END AS aqi_station",
    )


# Facts ----------------------------------------------------------------------------------


def measures(spark, sf_dir, months: bool = False) -> DataFrame:
    return m.combine(lake(spark, sf_dir, months))


def as_facts(spark, rows: DataFrame) -> DataFrame:
    """Fact rows; the creation time lies some minutes off the capture, earlier for city 1."""
    return m.to_facts(
        rows,
        reference.dim_weather_condition(spark),
        late(),
        F.expr("captured_at + make_dt_interval(0, 0, city_id - 2)"),
    )


_FACTS: dict[tuple, str] = {}


def facts(spark, sf_dir, months: bool = True) -> DataFrame:
    """Measures within the physical limits as a stored fact table, a folder per capture date and ordered by city.

    Written once per application, as the transform leaves it; reports prune its folders.
    """
    judged = anomalies.judge(measures(spark, sf_dir, months))
    rows = as_facts(spark, judged.filter(~F.col("is_rejected")))
    key = (spark.sparkContext.applicationId, sf_dir, months)
    if key not in _FACTS or not folder_exists(spark, _FACTS[key]):
        path = shared_folder(spark, "facts")
        rows.hint("rebalance", "capture_date").sortWithinPartitions("capture_date", "city_id").write.partitionBy("capture_date").parquet(path)
        _FACTS[key] = path
    return spark.read.schema(rows.schema).parquet(_FACTS[key])
