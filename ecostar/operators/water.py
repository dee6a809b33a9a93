"""Drinking-water, river and groundwater facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ecostar.functions.payload import iso_instant
from ecostar.operators.loading import keep_first

DRINKING_KEY = ["code_commune", "date_prelevement", "libelle_parametre"]
DRINKING_FACT = (
    "date_value DATE, hour_of_day INT, city_id INT, code_commune STRING, libelle_parametre STRING, "
    "resultat_numerique DOUBLE, libelle_unite STRING, conclusion_conformite STRING, date_prelevement TIMESTAMP"
)
RIVER_KEY = ["station_id", "date_prelevement", "libelle_parametre"]
RIVER_FACT = (
    "date_value DATE, hour_of_day INT, station_id INT, libelle_parametre STRING, resultat DOUBLE, "
    "symbole_unite STRING, code_remarque STRING, date_prelevement TIMESTAMP"
)
GROUNDWATER_KEY = ["groundwater_station_id", "measured_at"]


def _dated(df: DataFrame, at: Column) -> DataFrame:
    return df.withColumns({"date_value": F.to_date(at), "hour_of_day": F.hour(at)})


def drinking_rows(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): a sampling date that is given but unreadable rejects the row."""
    given = F.length("date_prelevement") > 0
    sampled = iso_instant(F.col("date_prelevement"))
    rows = _dated(
        records.withColumns({"_bad": given & sampled.isNull(), "date_prelevement": F.when(given, sampled)}),
        F.coalesce("date_prelevement", "collected_at"),
    )
    rejects = rows.filter("_bad").select("id", F.lit("bad_date").alias("reason"))
    good = rows.filter(~F.coalesce("_bad", F.lit(False))).select(
        "id",
        "date_value",
        "hour_of_day",
        "city_id",
        "code_commune",
        "libelle_parametre",
        "resultat_numerique",
        "libelle_unite",
        F.col("conclusion_conformite_prelevement").alias("conclusion_conformite"),
        "date_prelevement",
    )
    return good, rejects


def load_drinking_water(old: DataFrame, records: DataFrame) -> DataFrame:
    return keep_first(old, drinking_rows(records)[0], DRINKING_KEY)


def river_instant(day: Column, hour: Column) -> Column:
    """Day and hour, a bare day at midnight, or an ISO instant; NULL where unreadable."""
    with_hour = F.try_to_timestamp(F.concat(day, F.lit("T"), hour), F.lit("yyyy-M-d'T'H:m:s"))
    bare = F.try_to_timestamp(day, F.lit("yyyy-MM-dd"))
    return (
        F.when(F.length(hour) > 0, with_hour)
        .when(F.length(day) == 10, bare)
        .otherwise(iso_instant(day))
    )


def river_rows(observations: DataFrame, dim_stations: DataFrame) -> DataFrame:
    """Date and hour fall back to the collection time where the sampling time is unreadable."""
    at = river_instant(F.col("date_prelevement"), F.col("heure_prelevement"))
    keyed = observations.withColumn("date_prelevement", at).join(
        dim_stations.select("code_station", "station_id"), "code_station"
    )
    return _dated(keyed, F.coalesce("date_prelevement", "collected_at")).select(
        "id",
        "date_value",
        "hour_of_day",
        "station_id",
        "libelle_parametre",
        "resultat",
        "symbole_unite",
        "code_remarque",
        "date_prelevement",
    )


def load_river(old: DataFrame, observations: DataFrame, dim_stations: DataFrame) -> DataFrame:
    return keep_first(old, river_rows(observations, dim_stations), RIVER_KEY)


def groundwater_rows(readings: DataFrame, dim_stations: DataFrame) -> DataFrame:
    keyed = readings.join(dim_stations.select("code_bss", "groundwater_station_id"), "code_bss")
    return _dated(keyed, F.coalesce("measured_at", "collected_at")).select(
        "id",
        "date_value",
        "hour_of_day",
        "groundwater_station_id",
        "measured_at",
        "groundwater_level_ngf_m",
        "groundwater_depth_m",
    )


def load_groundwater(old: DataFrame, readings: DataFrame, dim_stations: DataFrame) -> DataFrame:
    return keep_first(old, groundwater_rows(readings, dim_stations), GROUNDWATER_KEY)
