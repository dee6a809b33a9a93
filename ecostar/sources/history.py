"""Historical air-quality CSV files to lake entries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ecostar import schemas

# Species names of the files and their names in the payload.
SPECIES = {
    "pm25": "pm25",
    "pm10": "pm10",
    "no2": "no2",
    "o3": "o3",
    "so2": "so2",
    "co": "co",
    "humidity": "h",
    "pressure": "p",
    "temperature": "t",
    "dew": "dew",
    "wind": "w",
}

AQI_SPECIES = ("pm25", "pm10", "no2", "o3")


def read_history(
    spark: SparkSession, path: str, start: dt.date, end: dt.date, cities: DataFrame
) -> DataFrame:
    """Usable CSV rows: known city, valid day in range, a species, a numeric median.

    ``position`` orders rows as they stand in the files, whatever the splits.
    """
    raw = spark.read.csv(path, header=True, comment="#", mode="PERMISSIVE")
    rows = raw.select(
        F.lower(F.trim("City")).alias("city_key"),
        F.try_to_date(F.trim("Date"), "yyyy-M-d").alias("day"),
        F.lower(F.trim("Specie")).alias("specie"),
        F.col("median").try_cast("double").alias("median"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("position"),
    )
    names = cities.select(F.lower("city_name").alias("city_key"), "city_id", "city_name")
    return (
        rows.filter(
            F.col("day").between(F.lit(start), F.lit(end))
            & (F.length("specie") > 0)
            & F.col("median").isNotNull()
        )
        .join(names, "city_key")
        .select("city_id", "city_name", "day", "specie", "median", "position")
    )


def last_median(rows: DataFrame) -> DataFrame:
    """One median per city, day and species: the one that stands last."""
    return rows.groupBy("city_id", "city_name", "day", "specie").agg(
        F.max_by("median", "position").alias("median"),
        F.max("position").alias("position"),
    )


def history_records(species: DataFrame, cities: DataFrame) -> DataFrame:
    """One air payload per city and day, at midnight UTC."""
    mapping = F.create_map(*[F.lit(x) for pair in SPECIES.items() for x in pair])
    named = species.withColumn("name", F.coalesce(F.try_element_at(mapping, F.col("specie")), F.col("specie")))

    def of(specie: str):
        return F.max(F.when(F.col("specie") == specie, F.col("median")))

    # Two species may share a payload name; the later one stays.
    per_name = named.groupBy("city_id", "city_name", "day", "name").agg(
        F.max_by("median", "position").alias("value"),
        *[of(s).alias(s) for s in AQI_SPECIES],
    )
    per_day = per_name.groupBy("city_id", "city_name", "day").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("name", F.struct(F.col("value").alias("v")))))
        ).alias("iaqi"),
        *[F.max(s).alias(s) for s in AQI_SPECIES],
    )
    at = F.col("day").cast("timestamp")
    aqi = F.coalesce(F.bround(F.greatest(*AQI_SPECIES), 0).cast("int"), F.lit(0))
    station = cities.select(
        "city_id", "latitude", "longitude", F.coalesce("aqi_station", F.lower("city_name")).alias("station")
    )
    text_time = F.date_format(at, "yyyy-MM-dd HH:mm:ss")
    payload = F.to_json(
        F.struct(
            F.lit("ok").alias("status"),
            F.struct(
                aqi.alias("aqi"),
                F.col("city_id").alias("idx"),
                F.struct(
                    F.concat("city_name", F.lit(", France")).alias("name"),
                    F.array("latitude", "longitude").alias("geo"),
                    F.concat(F.lit("https://aqicn.org/city/"), "station").alias("url"),
                ).alias("city"),
                F.col("iaqi"),
                F.struct(
                    text_time.alias("s"),
                    F.unix_timestamp(at).alias("v"),
                    F.lit("+00:00").alias("tz"),
                    F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("iso"),
                ).alias("time"),
                F.array(
                    F.struct(
                        F.lit("AQICN Historical Data").alias("name"),
                        F.lit("https://aqicn.org/data-platform/").alias("url"),
                    )
                ).alias("attributions"),
            ).alias("data"),
        )
    )
    return per_day.join(station, "city_id", "left").select(
        "city_id",
        "city_name",
        F.lit(schemas.AIR).alias("source"),
        payload.alias("raw_data"),
        at.alias("collected_at"),
        F.lit(False).alias("processed"),
        F.lit(None).cast("timestamp").alias("processed_at"),
        aqi.alias("aqi"),
        F.size("iaqi").alias("n_species"),
    )


def _lake_days(lake: DataFrame) -> DataFrame:
    return (
        lake.filter((F.col("source") == schemas.AIR) & F.col("city_name").isNotNull())
        .select("city_name", F.to_date("collected_at").alias("day"))
        .distinct()
    )


def missing_records(records: DataFrame, lake: DataFrame, all_days: bool = False) -> DataFrame:
    """Records of city-days that the lake does not hold yet."""
    if all_days:
        return records
    return (
        records.withColumn("day", F.to_date("collected_at"))
        .join(_lake_days(lake), ["city_name", "day"], "left_anti")
        .drop("day")
    )


def skipped_records(records: DataFrame, lake: DataFrame) -> DataFrame:
    """Records of city-days that the lake holds already."""
    return (
        records.withColumn("day", F.to_date("collected_at"))
        .join(_lake_days(lake), ["city_name", "day"], "left_semi")
        .drop("day")
    )
