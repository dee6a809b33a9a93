"""Reference data: cities, weather codes, air-quality levels, the calendar."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

# The ten cities (id, name, latitude, longitude, AQI station).
CITIES = [
    (1, "Paris", 48.8566, 2.3522, "paris"),
    (2, "Marseille", 43.2965, 5.3698, "marseille"),
    (3, "Lyon", 45.7640, 4.8357, "france/rhonealpes/rhone/lyon-centre"),
    (4, "Toulouse", 43.6047, 1.4442, "toulouse"),
    (5, "Nice", 43.7102, 7.2620, "nice"),
    (6, "Nantes", 47.2184, -1.5536, "nantes"),
    (7, "Montpellier", 43.6108, 3.8767, "montpellier"),
    (8, "Strasbourg", 48.5734, 7.7521, "strasbourg"),
    (9, "Bordeaux", 44.8378, -0.5792, "bordeaux"),
    (10, "Lille", 50.6292, 3.0573, "roubaix"),
]

# AQI levels (min, max, name, concern, colour, advice), ids 1-6 in this order.
AQI_LEVELS = [
    (0, 50, "Good", "Air quality is satisfactory", "green", "No health implications"),
    (51, 100, "Moderate", "Acceptable for most people", "yellow",
     "Unusually sensitive people should consider limiting prolonged outdoor exertion"),
    (101, 150, "Unhealthy for Sensitive Groups", "Members of sensitive groups may experience health effects", "orange",
     "Children, active adults, and people with respiratory disease should limit prolonged outdoor exertion"),
    (151, 200, "Unhealthy", "Everyone may begin to experience health effects", "red",
     "Everyone should limit prolonged outdoor exertion"),
    (201, 300, "Very Unhealthy", "Health alert: everyone may experience more serious health effects", "purple",
     "Everyone should avoid prolonged outdoor exertion"),
    (301, 500, "Hazardous", "Health warnings of emergency conditions", "maroon",
     "Everyone should avoid any outdoor exertion"),
]

# Weather codes (code, main, description, category, icon), ids 1-36 in this order.
WEATHER_CODES = [
    (800, "Clear", "clear sky", "sunny", "01d"),
    (801, "Clouds", "few clouds", "cloudy", "02d"),
    (802, "Clouds", "scattered clouds", "cloudy", "03d"),
    (803, "Clouds", "broken clouds", "cloudy", "04d"),
    (804, "Clouds", "overcast clouds", "cloudy", "04d"),
    (500, "Rain", "light rain", "rainy", "10d"),
    (501, "Rain", "moderate rain", "rainy", "10d"),
    (502, "Rain", "heavy intensity rain", "rainy", "10d"),
    (503, "Rain", "very heavy rain", "rainy", "10d"),
    (504, "Rain", "extreme rain", "rainy", "10d"),
    (511, "Rain", "freezing rain", "rainy", "13d"),
    (520, "Rain", "light intensity shower rain", "rainy", "09d"),
    (521, "Rain", "shower rain", "rainy", "09d"),
    (522, "Rain", "heavy intensity shower rain", "rainy", "09d"),
    (300, "Drizzle", "light intensity drizzle", "rainy", "09d"),
    (301, "Drizzle", "drizzle", "rainy", "09d"),
    (302, "Drizzle", "heavy intensity drizzle", "rainy", "09d"),
    (200, "Thunderstorm", "thunderstorm with light rain", "stormy", "11d"),
    (201, "Thunderstorm", "thunderstorm with rain", "stormy", "11d"),
    (202, "Thunderstorm", "thunderstorm with heavy rain", "stormy", "11d"),
    (210, "Thunderstorm", "light thunderstorm", "stormy", "11d"),
    (211, "Thunderstorm", "thunderstorm", "stormy", "11d"),
    (212, "Thunderstorm", "heavy thunderstorm", "stormy", "11d"),
    (600, "Snow", "light snow", "snowy", "13d"),
    (601, "Snow", "snow", "snowy", "13d"),
    (602, "Snow", "heavy snow", "snowy", "13d"),
    (701, "Mist", "mist", "foggy", "50d"),
    (711, "Smoke", "smoke", "foggy", "50d"),
    (721, "Haze", "haze", "foggy", "50d"),
    (731, "Dust", "dust", "foggy", "50d"),
    (741, "Fog", "fog", "foggy", "50d"),
    (751, "Sand", "sand", "foggy", "50d"),
    (761, "Dust", "dust", "foggy", "50d"),
    (762, "Ash", "volcanic ash", "foggy", "50d"),
    (771, "Squall", "squalls", "stormy", "50d"),
    (781, "Tornado", "tornado", "stormy", "50d"),
]

# Season by month and the order of the seasons in reports.
SEASONS = {"Hiver": (12, 1, 2), "Printemps": (3, 4, 5), "Été": (6, 7, 8), "Automne": (9, 10, 11)}


def fixed_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a local relation, whose true size the planner knows."""

    def literal(x) -> str:
        if x is None:
            return "NULL"
        return "'" + x.replace("'", "\\'") + "'" if isinstance(x, str) else repr(x)

    body = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    fields = [f.split(" ", 1) for f in re.split(r",\s+", schema)]
    columns = ", ".join(f"CAST(c{n} AS {type_}) AS {name}" for n, (name, type_) in enumerate(fields))
    names = ", ".join(f"c{n}" for n in range(len(fields)))
    return spark.sql(f"SELECT {columns} FROM VALUES {body} AS t({names})")


def dim_city(spark: SparkSession) -> DataFrame:
    rows = [(i, name, lat, lon, "Europe/Paris", None, "France", None, None) for i, name, lat, lon, _ in CITIES]
    return fixed_table(
        spark,
        rows,
        "city_id INT, city_name STRING, latitude DECIMAL(9,6), longitude DECIMAL(9,6), timezone STRING, "
        "region STRING, country STRING, population INT, altitude DECIMAL(7,2)",
    )


def city_reference(spark: SparkSession) -> DataFrame:
    return fixed_table(
        spark, CITIES, "city_id INT, city_name STRING, latitude DOUBLE, longitude DOUBLE, aqi_station STRING"
    )


def dim_air_quality_level(spark: SparkSession) -> DataFrame:
    return fixed_table(
        spark,
        [(n, *row) for n, row in enumerate(AQI_LEVELS, 1)],
        "aqi_level_id INT, aqi_min INT, aqi_max INT, level_name STRING, health_concern STRING, "
        "color_code STRING, health_advice STRING",
    )


def dim_weather_condition(spark: SparkSession) -> DataFrame:
    return fixed_table(
        spark,
        [(n, *row) for n, row in enumerate(WEATHER_CODES, 1)],
        "weather_condition_id INT, weather_id INT, main STRING, description STRING, category STRING, icon STRING",
    )


_SEASON = (
    "CASE "
    + " ".join(f"WHEN month(date_value) IN {months} THEN '{name}'" for name, months in SEASONS.items())
    + " END"
)

DATE_COLUMNS = (
    "date_value",
    "dayofmonth(date_value) AS day_of_month",
    "dayofweek(date_value) - 1 AS day_of_week",
    "date_format(date_value, 'EEEE') AS day_name",
    "dayofyear(date_value) AS day_of_year",
    "weekofyear(date_value) AS week_of_year",
    "CAST(ceil(dayofmonth(date_value) / 7) AS INT) AS week_of_month",
    "month(date_value) AS month",
    "date_format(date_value, 'MMMM') AS month_name",
    "quarter(date_value) AS quarter",
    "concat('Q', quarter(date_value)) AS quarter_name",
    "year(date_value) AS year",
    "dayofweek(date_value) IN (1, 7) AS is_weekend",
    "FALSE AS is_holiday",
    f"{_SEASON} AS season",
)


def date_attributes(days: DataFrame) -> DataFrame:
    """The calendar columns of a one-column frame ``date_value``."""
    return days.selectExpr(*DATE_COLUMNS)


def dim_date(
    spark: SparkSession,
    start: dt.date = dt.date(2024, 1, 1),
    end: dt.date = dt.date(2027, 12, 31),
) -> DataFrame:
    days = spark.sql(f"SELECT explode(sequence(DATE '{start}', DATE '{end}')) AS date_value")
    return date_attributes(days)


def extend_dim_date(existing: DataFrame, days: DataFrame) -> DataFrame:
    """Rows for the days that ``existing`` lacks; present rows stay as they are."""
    return date_attributes(
        days.select("date_value").distinct().join(existing, "date_value", "left_anti")
    )


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """City reference file: a JSON array (one document) of city objects."""
    return (
        spark.read.option("multiLine", True)
        .schema("id INT, name STRING, latitude DOUBLE, longitude DOUBLE, aqi_station STRING")
        .json(path)
    )


def resolve_stations(cities: DataFrame, reference: DataFrame, order: str | None = None) -> DataFrame:
    """A city's own station, else the reference's by id, else the reference's by name.

    Of reference rows with one id or name the last counts: by column ``order``, else by
    their place in the file.
    """
    place = F.col(order) if order else F.monotonically_increasing_id()
    ref = reference.withColumn("_place", place).filter(F.length("aqi_station") > 0)
    last = F.max_by("aqi_station", "_place")
    by_id = ref.groupBy(F.col("id").alias("id")).agg(last.alias("station_by_id"))
    by_name = ref.groupBy(F.col("name").alias("name")).agg(last.alias("station_by_name"))
    own = F.when(F.length("aqi_station") > 0, F.col("aqi_station"))
    return (
        cities.join(by_id, "id", "left")
        .join(by_name, "name", "left")
        .withColumn("aqi_station", F.coalesce(own, "station_by_id", "station_by_name"))
        .drop("station_by_id", "station_by_name")
    )


def _box(half: float):
    lon, lat = F.col("longitude"), F.col("latitude")
    corners = (lon - half, lat - half, lon + half, lat + half)
    return F.concat_ws(",", *(F.format_string("%.6f", c) for c in corners))


def collection_targets(cities: DataFrame) -> DataFrame:
    """Per city the boxes, station names and, one row each, the three flow points."""

    def point(suffix: str, shift: float):
        return F.struct(
            F.concat(F.upper(F.substring("name", 1, 3)), F.lit("_" + suffix)).alias("code_point"),
            F.col("latitude").alias("latitude"),
            F.round(F.col("longitude") + shift, 6).alias("longitude"),
        )

    def trimmed(col):
        return F.btrim(F.btrim(col), F.lit("/"))

    city = trimmed(F.col("name"))
    names = F.array_distinct(
        F.filter(
            F.array(trimmed(F.col("aqi_station")), city, F.lower(city)),
            lambda s: F.length(s) > 0,
        )
    )
    located = (F.col("latitude") != 0) & (F.col("longitude") != 0)
    return (
        cities.select(
            "id",
            "name",
            F.when(located, _box(0.05)).alias("incident_box"),
            F.when(located, _box(0.1)).alias("water_box"),
            names.alias("station_names"),
            F.explode_outer(
                F.when(located, F.array(point("C", 0.0), point("E", 0.02), point("W", -0.02)))
            ).alias("point"),
        )
        .select("id", "name", "incident_box", "water_box", "station_names", "point.*")
    )
