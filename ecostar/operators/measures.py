"""Weather and air entries to hourly measures and to fact rows."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ecostar import schemas
from ecostar.functions import expr, payload as p
from ecostar.sources import reference
from ecostar.sources.warehouse import number_rows

MEASURE_FIELDS = (*schemas.WEATHER_COLUMNS, *schemas.AIR_COLUMNS)


def source_hour_winners(lake: DataFrame) -> DataFrame:
    """The largest lake id per city, UTC hour and source."""
    return (
        lake.filter(F.col("source").isin(schemas.WEATHER, schemas.AIR))
        .groupBy("city_id", expr.hour_of(F.col("collected_at")).alias("lake_hour"), "source")
        .agg(F.max("id").alias("id"))
    )


def marked_duplicates(lake: DataFrame) -> DataFrame:
    """Weather and air entries with ``kept``: whether each is the winner of its city, hour and source.

    Only ids meet per hour; the entries join back on their unique id, so a hot
    hour or source never lands in one task.
    """
    entries = lake.filter(F.col("source").isin(schemas.WEATHER, schemas.AIR))
    winners = source_hour_winners(lake).select("id", F.lit(True).alias("kept"))
    return entries.join(winners, "id", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


def dedup(lake: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, discarded) entries."""
    marked = marked_duplicates(lake)
    return marked.filter("kept").drop("kept"), marked.filter("NOT kept").drop("kept")


def readings(lake: DataFrame) -> DataFrame:
    """Weather and air entries with their values, in one scan; ``ok`` is whether an object was read."""
    raw, source = F.col("raw_data"), F.col("source")
    is_weather, is_air = source == schemas.WEATHER, source == schemas.AIR
    text = p.payload_text(raw)
    entries = (
        lake.filter(is_weather | is_air)
        .select(
            "id",
            "city_id",
            "collected_at",
            expr.hour_of(F.col("collected_at")).alias("lake_hour"),
            F.when(is_weather, F.col("id")).alias("wid"),
            F.when(is_air, F.col("id")).alias("aid"),
            p.is_object(text).alias("ok"),
            F.when(is_weather, p.weather_struct(raw)).alias("w"),
            F.when(is_air, p.air_struct(raw)).alias("a"),
            F.when(is_air, p.bare_air_struct(raw)).alias("bare"),
        )
    )
    weather = dict(p.WEATHER_FIELDS)
    # Rain and snow default to 0 only where a weather object was read.
    for name in ("rain_1h", "snow_1h"):
        weather[name] = f"CASE WHEN ok AND wid IS NOT NULL THEN {weather[name]} END"
    return entries.selectExpr(
        "city_id",
        "collected_at",
        "lake_hour",
        "wid",
        "aid",
        "ok",
        *(f"{weather[c]} AS {c}" for c in schemas.WEATHER_COLUMNS),
        *(f"{p.AIR_FIELDS[c]} AS {c}" for c in schemas.AIR_COLUMNS),
    )


def reading_rejects(readings: DataFrame, dim_date: DataFrame, as_of: Column) -> DataFrame:
    """(id, reason) of entries whose day the calendar lacks or whose values don't fit the warehouse.

    Each entry is judged by itself, so the outcome doesn't depend on how entries were cut
    into batches, nor on whether a later twin of its hour replaces it.
    """
    days = dim_date.select(F.col("date_value").alias("day"), F.lit(True).alias("known"))
    dated = readings.withColumn("day", F.to_date(expr.clamp_to(F.col("collected_at"), as_of))).join(days, "day", "left")
    reason = F.when(F.col("known").isNull(), "date_out_of_range").when(~fits_warehouse(), "numeric_overflow")
    return dated.select(F.coalesce("wid", "aid").alias("id"), reason.alias("reason")).filter("reason IS NOT NULL")


def combine(lake: DataFrame) -> DataFrame:
    """One measure per city and UTC hour from its weather and/or air entry.

    Both sources are parsed in one scan, then one aggregation picks per field the
    value of the largest weather id and of the largest air id. This is the
    per-source deduplication and the full outer join of the two sources at the
    price of a single shuffle of partially aggregated numbers.
    """
    picks = [
        "coalesce(max_by(collected_at, wid), max_by(collected_at, aid)) AS captured_at",
        "max(wid) AS weather_lake_id",
        "max(aid) AS air_lake_id",
        "max_by(collected_at, wid) AS weather_at",
        "max_by(collected_at, aid) AS air_at",
        "max_by(CASE WHEN ok THEN wid END, wid) AS raw_weather_id",
        "max_by(CASE WHEN ok THEN aid END, aid) AS raw_aqi_id",
        *(f"max_by({c}, wid) AS {c}" for c in schemas.WEATHER_COLUMNS),
        *(f"max_by({c}, aid) AS {c}" for c in schemas.AIR_COLUMNS),
    ]
    return readings(lake).groupBy("city_id", "lake_hour").agg(*map(F.expr, picks))


def incomplete(measures: DataFrame, as_of: Column) -> DataFrame:
    """City-hours with one source only: the missing side and the age of the other."""
    present = F.coalesce("weather_at", "air_at")
    return measures.filter(F.col("weather_lake_id").isNull() | F.col("air_lake_id").isNull()).select(
        "city_id",
        "lake_hour",
        F.when(F.col("weather_lake_id").isNull(), "weather").otherwise("aqi").alias("missing"),
        ((F.unix_micros(as_of) - F.unix_micros(present)) / 3600000000.0).alias("age_hours"),
    )


def clamp_future(df: DataFrame, as_of: Column, ts: str = "captured_at") -> DataFrame:
    clamped = expr.clamp_to(F.col(ts), as_of)
    return df.withColumn(ts, clamped).withColumn("capture_date", F.to_date(ts))


def recent(df: DataFrame, as_of: Column, hours: int = 24, ts: str = "captured_at") -> DataFrame:
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(hours=F.lit(hours)))


def recent_days(df: DataFrame, as_of: Column, hours: int = 24, day: str = "date_value") -> DataFrame:
    """Daily-keyed rows from the day on which the window starts."""
    return df.filter(F.col(day) >= F.to_date(as_of - F.make_dt_interval(hours=F.lit(hours))))


def date_gate(df: DataFrame, dim_date: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose day the calendar knows, the others with a reason)."""
    days = dim_date.select(F.col("date_value").alias(day))
    ok = df.join(days, day, "left_semi")
    rejects = df.join(days, day, "left_anti").withColumn("reason", F.lit("date_out_of_range"))
    return ok, rejects


def with_condition(df: DataFrame, dim_weather: DataFrame) -> DataFrame:
    codes = dim_weather.select("weather_id", "weather_condition_id").filter(F.col("weather_id").isNotNull())
    return df.join(codes, "weather_id", "left")


def with_aqi_level(df: DataFrame, dim_aqi: DataFrame) -> DataFrame:
    """The range lookup as an equi-join: the levels are spelled out per AQI value."""
    by_value = (
        dim_aqi.select(F.explode(F.sequence("aqi_min", "aqi_max")).alias("aqi_index"), "aqi_level_id")
        .groupBy("aqi_index")
        .agg(F.min("aqi_level_id").alias("aqi_level_id"))
    )
    return df.join(by_value, "aqi_index", "left")


_LEVEL = (
    "CASE "
    + " ".join(
        f"WHEN {{0}} BETWEEN {low} AND {high} THEN {n}"
        for n, (low, high, *_) in enumerate(reference.AQI_LEVELS, 1)
    )
    + " END"
)


def aqi_level_id(column: str) -> Column:
    """The lookup against the standard levels as one expression, without a join."""
    return F.expr(_LEVEL.format(column))


def _warehouse_value(name: str, type_: str) -> str:
    return f"try_cast({f'round({name})' if type_ == 'INT' else name} AS {type_})"


def _bound(name: str, type_: str) -> str:
    """Whether a value rounds half up to less than the column's limit: half a unit of its last digit below it, without rounding."""
    if type_ == "INT":
        return f"abs({name}) < 2147483647.5D"
    precision, scale = map(int, re.findall(r"\d+", type_))
    return f"abs({name}) < {10 ** (precision - scale) - Decimal(5).scaleb(-scale - 1)}D"


def fits_warehouse() -> Column:
    """False where a value does not fit its column; such a row cannot be loaded.

    Written with bounds and not with the casts of the load: the optimizer would
    try every mix of a cast and the column that holds it.
    """
    return F.expr(
        " AND ".join(f"coalesce({_bound(n, t)}, TRUE)" for n, t in schemas.MEASURE_TYPES.items())
    )


def split_overflow(measures: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        measures.filter(fits_warehouse()),
        measures.filter(~fits_warehouse()).withColumn("reason", F.lit("numeric_overflow")),
    )


def measure_id() -> Column:
    """One fact row per city and lake hour: the key packs the hour and the city."""
    hour = F.floor(F.unix_timestamp("lake_hour") / 3600)
    return hour * F.lit(1 << 24) + F.col("city_id")


def to_facts(
    measures: DataFrame, dim_weather: DataFrame, as_of: Column, created_at: Column, keep: tuple = ()
) -> DataFrame:
    """Measures (with or without anomaly columns) as rows of ``fact_measures``."""
    df = with_condition(clamp_future(measures, as_of), dim_weather)
    flag = F.coalesce("is_anomaly", F.lit(False)) if "is_anomaly" in df.columns else F.lit(False)
    score = F.col("anomaly_score") if "anomaly_score" in df.columns else F.lit(None).cast("double")
    values = {n: _warehouse_value(n, t) for n, t in schemas.MEASURE_TYPES.items()}
    for name in ("rain_1h", "snow_1h"):
        values[name] = f"coalesce({values[name]}, CAST(0 AS {schemas.MEASURE_TYPES[name]}))"
    return df.select(
        measure_id().alias("measure_id"),
        "city_id",
        "lake_hour",
        "captured_at",
        "capture_date",
        F.hour("captured_at").alias("capture_hour"),
        "weather_condition_id",
        aqi_level_id("aqi_index").alias("aqi_level_id"),
        *(F.expr(f"{sql} AS {n}") for n, sql in values.items()),
        flag.alias("is_anomaly"),
        score.alias("anomaly_score"),
        "raw_weather_id",
        "raw_aqi_id",
        created_at.alias("created_at"),
        *keep,
    )


FACT_VALUES = (
    "capture_date", "capture_hour", "weather_condition_id", "aqi_level_id",
    *schemas.MEASURE_TYPES, "is_anomaly", "anomaly_score", "raw_weather_id", "raw_aqi_id",
)


def upsert_measures(old: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """Merge on (city, captured_at): non-null new values win, nulls never erase.

    Several new rows of a key apply in ``order``. Of several old rows of a key the
    one with the highest id takes the values. New keys are numbered after the old.
    """
    values = [c for c in FACT_VALUES if c in new.columns and c in old.columns]
    folded = new.groupBy("city_id", "captured_at").agg(
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"new_{c}") for c in values),
        F.max(order).alias("_order"),
    )
    target = old.groupBy("city_id", "captured_at").agg(F.max("measure_id").alias("measure_id"))
    matched = folded.join(target, ["city_id", "captured_at"], "left")
    updates = matched.filter(F.col("measure_id").isNotNull()).select(
        "measure_id", *(f"new_{c}" for c in values)
    )
    merged = old.join(updates, "measure_id", "left").select(
        "measure_id",
        "city_id",
        "captured_at",
        *(F.coalesce(f"new_{c}", c).alias(c) for c in values),
    )
    created = number_rows(
        matched.filter(F.col("measure_id").isNull()).drop("measure_id"),
        "_order",
        "measure_id",
        old.agg(F.max("measure_id")).scalar(),
    ).select("measure_id", "city_id", "captured_at", *(F.col(f"new_{c}").alias(c) for c in values))
    return merged.unionByName(created)


def latest_measures(facts: DataFrame, city_id: int | None = None, n: int = 10) -> DataFrame:
    """The last ``n`` measures of a city, or of every city; the larger id comes first among equal instants."""
    rows = facts if city_id is None else facts.filter(F.col("city_id") == city_id)
    newest = W.partitionBy("city_id").orderBy(F.desc("captured_at"), F.desc("measure_id"))
    return rows.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)
