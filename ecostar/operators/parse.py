"""Lake entries to typed rows, one operator per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ecostar import schemas
from ecostar.functions import payload as p

_KEYS = ("id", "city_id", "city_name", "collected_at")


def _of(lake: DataFrame, *sources: str) -> DataFrame:
    return lake.filter(F.col("source").isin(*sources))


def parse_weather(lake: DataFrame) -> DataFrame:
    parsed = _of(lake, schemas.WEATHER).withColumn("w", p.weather_struct(F.col("raw_data")))
    return parsed.selectExpr(*_KEYS, *p.fields(p.WEATHER_FIELDS))


def weather_timestamps(lake: DataFrame) -> DataFrame:
    return _of(lake, schemas.WEATHER).select(*_KEYS, p.weather_timestamp(F.col("raw_data")).alias("api_time"))


def parse_air_quality(lake: DataFrame) -> DataFrame:
    raw = F.col("raw_data")
    parsed = _of(lake, schemas.AIR).withColumns(
        {"a": p.air_struct(raw), "bare": p.bare_air_struct(raw), "station_attribution": p.air_attribution(raw)}
    )
    return parsed.selectExpr(*_KEYS, *p.fields(p.AIR_FIELDS), "station_attribution")


def air_attributions(lake: DataFrame) -> DataFrame:
    return _of(lake, schemas.AIR).select(*_KEYS, p.air_attribution(F.col("raw_data")).alias("station_attribution"))


def air_timestamps(lake: DataFrame) -> DataFrame:
    return _of(lake, schemas.AIR).select(*_KEYS, p.air_timestamp(F.col("raw_data")).alias("api_time"))


# API answers -> contract records ------------------------------------------------


def flatten_flow(answers: DataFrame, raw: str = "raw_data") -> DataFrame:
    """Flow answers to records with their two ratios; answers without a segment are dropped."""
    seg = F.col("api.flowSegmentData")
    return (
        answers.withColumn("api", F.from_json(raw, schemas.FLOW_API, p.JSON))
        .filter(seg.isNotNull())
        .withColumns(
            {
                "vitesse_actuelle_kmph": seg["currentSpeed"],
                "vitesse_fluide_kmph": seg["freeFlowSpeed"],
                "temps_trajet_actuel_s": seg["currentTravelTime"],
                "temps_trajet_fluide_s": seg["freeFlowTravelTime"],
                "indice_confiance": seg["confidence"],
                "route_fermee": F.coalesce(seg["roadClosure"], F.lit(False)),
                "frc": seg["frc"],
                "congestion_ratio": p.ratio(seg["currentTravelTime"], seg["freeFlowTravelTime"]),
                "speed_ratio": p.ratio(seg["currentSpeed"], seg["freeFlowSpeed"]),
            }
        )
        .drop("api", raw)
    )


def explode_incidents(answers: DataFrame, raw: str = "raw_data") -> DataFrame:
    """One record per incident of an incidents answer."""
    props = F.col("incident.properties")
    return (
        answers.withColumn("incident", F.explode(F.from_json(raw, schemas.INCIDENTS_API, p.JSON)["incidents"]))
        .withColumns(
            {
                "incident_id": props["id"],
                "categorie_incident": props["iconCategory"],
                "libelle_categorie": F.lit("Unknown"),
                "gravite_retard": props["magnitudeOfDelay"],
                "retard_s": F.coalesce(props["delay"], F.lit(0.0)),
                "longueur_m": F.coalesce(props["length"], F.lit(0.0)),
                "debut_incident_utc": props["startTime"],
                "fin_incident_utc": props["endTime"],
                "nombre_signalements": F.coalesce(props["numberOfReports"], F.lit(0)),
                "geometrie_type": F.col("incident.geometry.type"),
            }
        )
        .drop("incident", raw)
    )


def _flatten_list(answers: DataFrame, raw: str, fields: str) -> DataFrame:
    items = F.from_json(raw, f"data ARRAY<STRUCT<{_as_struct(fields)}>>", p.JSON)["data"]
    return answers.withColumn("item", F.explode(items)).select(
        *[c for c in answers.columns if c != raw], "item.*"
    )


def _as_struct(fields: str) -> str:
    return ", ".join(": ".join(f.split(" ", 1)) for f in fields.split(", "))


def flatten_drinking_water(answers: DataFrame, raw: str = "raw_data") -> DataFrame:
    return _flatten_list(answers, raw, schemas.DRINKING_WATER_FIELDS)


def flatten_stations(answers: DataFrame, raw: str = "raw_data") -> DataFrame:
    return _flatten_list(answers, raw, schemas.RIVER_STATION_FIELDS)


def flatten_river_obs(answers: DataFrame, raw: str = "raw_data") -> DataFrame:
    return _flatten_list(answers, raw, schemas.RIVER_OBSERVATION_FIELDS)


def flatten_groundwater(answers: DataFrame, raw: str = "raw_data") -> DataFrame:
    """Level above sea and depth stay two values in their own units."""
    rows = _flatten_list(answers, raw, schemas.GROUNDWATER_FIELDS)
    return rows.withColumn(
        "measured_at",
        F.coalesce(
            p.iso_instant(F.col("date_mesure_utc")),
            p.iso_instant(F.col("date_mesure")),
            F.timestamp_seconds("timestamp_mesure"),
        ),
    )


# Contract records in the lake -> typed rows --------------------------------------


def _records(lake: DataFrame, source: str, schema: str) -> DataFrame:
    rec = F.from_json(p.payload_text(F.col("raw_data")), schema, p.JSON)
    return _of(lake, source).withColumn("rec", rec).select(*_KEYS, "raw_data", "rec.*")


def flow_records(lake: DataFrame) -> DataFrame:
    return _records(lake, schemas.FLOW, schemas.FLOW_RECORD).drop("raw_data")


def incident_records(lake: DataFrame) -> DataFrame:
    """An absent category counts as 0, a null one stays null."""
    rows = _records(lake, schemas.INCIDENTS, schemas.INCIDENT_RECORD)
    present = F.array_contains(F.json_object_keys(p.payload_text(F.col("raw_data"))), "categorie_incident")
    return rows.withColumns(
        {
            "categorie_incident": F.when(~present, 0).otherwise(F.col("categorie_incident")),
            "libelle_categorie": F.coalesce("libelle_categorie", F.lit("Unknown")),
            "longueur_m": F.coalesce("longueur_m", F.lit(0.0)),
        }
    ).drop("raw_data")


def drinking_water_records(lake: DataFrame) -> DataFrame:
    return _records(lake, schemas.DRINKING_WATER, schemas.DRINKING_WATER_FIELDS).drop("raw_data")


def river_station_records(lake: DataFrame) -> DataFrame:
    return _records(lake, schemas.RIVER_STATIONS, schemas.RIVER_STATION_FIELDS).drop("raw_data")


def river_obs_records(lake: DataFrame) -> DataFrame:
    """The hour stands in the record or only in its raw copy."""
    rows = _records(lake, schemas.RIVER_OBSERVATIONS, schemas.RIVER_OBSERVATION_RECORD)
    return rows.withColumn(
        "heure_prelevement", F.coalesce("heure_prelevement", "donnees_brutes.heure_prelevement")
    ).drop("raw_data", "donnees_brutes")


def groundwater_records(lake: DataFrame) -> DataFrame:
    rec = F.from_json(p.payload_text(F.col("raw_data")), schemas.GROUNDWATER_FIELDS, p.JSON)
    return (
        _of(lake, *schemas.GROUNDWATER)
        .withColumn("rec", rec)
        .select(*_KEYS, "rec.*")
        .withColumn(
            "measured_at",
            F.coalesce(
                p.iso_instant(F.col("date_mesure_utc")),
                p.iso_instant(F.col("date_mesure")),
                F.timestamp_seconds("timestamp_mesure"),
            ),
        )
    )
