"""The catalogue of analytical reports over the star schema.

Means are exact decimal means rounded half up, as a NUMERIC column gives them.
Facts are aggregated before they meet a dimension wherever the grouping allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ecostar.functions.expr import mean_2, share_of_total
from ecostar.sources.reference import SEASONS


def _dated(facts: DataFrame, dim_date: DataFrame, *attributes: str) -> DataFrame:
    days = dim_date.select(F.col("date_value").alias("capture_date"), *attributes)
    return facts.join(days, "capture_date")


def _of_years(facts: DataFrame, *years: int) -> DataFrame:
    """Facts of the span of some years; literals, so that a table by date is read in part only."""
    first, last = f"{min(years)}-01-01", f"{max(years)}-12-31"
    return facts.filter(F.col("capture_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def _in_city(facts: DataFrame, dim_city: DataFrame, *attributes: str) -> DataFrame:
    return facts.join(dim_city.select("city_id", *attributes), "city_id")


def star_view(facts: DataFrame, dim_city: DataFrame, dim_date: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` facts with their city and date rows embedded."""
    city = dim_city.select("city_id", F.struct(*dim_city.columns).alias("dim_city"))
    day = dim_date.select(
        F.col("date_value").alias("capture_date"), F.struct(*dim_date.columns).alias("dim_date")
    )
    first = facts.orderBy("measure_id").limit(n)
    return first.join(city, "city_id", "left").join(day, "capture_date", "left")


def monthly_city(facts, dim_date, dim_city, years=(2025, 2026)) -> DataFrame:
    df = _in_city(_dated(_of_years(facts, *years), dim_date, "year", "month", "month_name"), dim_city, "city_name")
    return (
        df.filter(F.col("year").isin(*years))
        .groupBy("city_name", "year", "month", "month_name")
        .agg(
            mean_2(F.col("temperature")).alias("temp_moyenne"),
            mean_2(F.col("humidity")).alias("humidite_moyenne"),
            F.count("*").alias("nb_mesures"),
        )
        .orderBy("city_name", "year", "month")
    )


def hourly_profile(facts, dim_date) -> DataFrame:
    t = F.col("temperature")
    return (
        _dated(facts, dim_date)
        .groupBy("capture_hour")
        .agg(
            mean_2(t).alias("temp_moyenne"),
            F.min(t).cast("double").alias("temp_min"),
            F.max(t).cast("double").alias("temp_max"),
        )
        .orderBy("capture_hour")
    )


def weekend_vs_week(facts, dim_date) -> DataFrame:
    return (
        _dated(facts.filter(F.col("aqi_index").isNotNull()), dim_date, "is_weekend")
        .groupBy(F.when(F.col("is_weekend"), "Weekend").otherwise("Semaine").alias("periode"))
        .agg(mean_2(F.col("aqi_index"), 0).alias("aqi_moyen"), F.count("*").alias("nb_mesures"))
    )


def city_air_ranking(facts, dim_city) -> DataFrame:
    return (
        _in_city(facts.filter(F.col("aqi_index").isNotNull()), dim_city, "city_name", "region")
        .groupBy("city_name", "region")
        .agg(
            mean_2(F.col("aqi_index"), 0).alias("aqi_moyen"),
            mean_2(F.col("pm25")).alias("pm25_moyen"),
            mean_2(F.col("pm10")).alias("pm10_moyen"),
            F.count("*").alias("nb_mesures"),
        )
        .orderBy("aqi_moyen", "city_name")
    )


def hottest_coldest(facts, dim_city) -> DataFrame:
    per_city = (
        _in_city(facts.filter(F.col("temperature").isNotNull()), dim_city, "city_name")
        .groupBy("city_name")
        .agg(F.max("temperature").alias("hot"), F.min("temperature").alias("cold"))
    )

    def one(label: str, col: str, order: Column) -> DataFrame:
        return per_city.orderBy(order, "city_name").limit(1).select(
            F.lit(label).alias("type"), "city_name", F.col(col).cast("double").alias("temperature")
        )

    return one("Plus chaude", "hot", F.desc("hot")).unionAll(one("Plus froide", "cold", F.asc("cold")))


def _with_share(counts: DataFrame, n: str, share: str) -> DataFrame:
    """The window runs over the groups, whose number a dimension bounds."""
    return counts.withColumn(share, share_of_total(F.col(n), F.sum(n).over(W.partitionBy())))


def weather_distribution(facts, dim_weather) -> DataFrame:
    by_code = facts.groupBy("weather_condition_id").agg(F.count("*").alias("c"))
    counts = (
        by_code.join(dim_weather.select("weather_condition_id", "category", "main"), "weather_condition_id")
        .groupBy("category", "main")
        .agg(F.sum("c").alias("occurrences"))
    )
    return _with_share(counts, "occurrences", "pourcentage").orderBy(F.desc("occurrences"), "category", "main")


def temp_by_weather(facts, dim_weather) -> DataFrame:
    df = facts.join(dim_weather.select("weather_condition_id", "category"), "weather_condition_id")
    return (
        df.groupBy("category")
        .agg(
            mean_2(F.col("temperature")).alias("temp_moyenne"),
            mean_2(F.col("humidity")).alias("humidite_moyenne"),
            mean_2(F.col("wind_speed")).alias("vent_moyen"),
        )
        .orderBy(F.desc("temp_moyenne"))
    )


def aqi_level_share(facts, dim_aqi) -> DataFrame:
    counts = (
        facts.groupBy("aqi_level_id")
        .agg(F.count("*").alias("nb_mesures"))
        .join(dim_aqi.select("aqi_level_id", "level_name", "health_concern"), "aqi_level_id")
    )
    return _with_share(counts, "nb_mesures", "pourcentage").orderBy("aqi_level_id").drop("aqi_level_id")


def pollution_alerts(facts, dim_city, dim_aqi, dim_date) -> DataFrame:
    bad = dim_aqi.filter(F.col("aqi_min") > 100).select("aqi_level_id", "level_name")
    df = _in_city(_dated(facts, dim_date), dim_city, "city_name").join(bad, "aqi_level_id")
    return (
        df.groupBy("city_name", "level_name")
        .agg(
            F.count("*").alias("nb_alertes"),
            F.min("capture_date").alias("premiere_alerte"),
            F.max("capture_date").alias("derniere_alerte"),
        )
        .orderBy(F.desc("nb_alertes"))
    )


def cube(facts, dim_city, dim_date, dim_aqi, year: int = 2026) -> DataFrame:
    """Sixteen grouping sets: month and month name are two dimensions.

    The facts are summed per finest cell before the cube, so the cube expands cells
    and not facts.
    """
    df = _in_city(_dated(_of_years(facts, year), dim_date, "year", "month", "month_name"), dim_city, "city_name")
    cells = (
        df.filter(F.col("year") == year)
        .join(dim_aqi.select("aqi_level_id", "level_name"), "aqi_level_id")
        .groupBy("city_name", "month", "month_name", "level_name")
        .agg(
            F.count("*").alias("n"),
            F.sum("aqi_index").alias("aqi_sum"),
            F.count("aqi_index").alias("aqi_n"),
        )
    )
    total = F.sum("aqi_sum").cast("decimal(26,2)")
    return (
        cells.cube("city_name", "month", "month_name", "level_name")
        .agg(
            F.sum("n").alias("nb_mesures"),
            F.round(total / F.sum("aqi_n").cast("decimal(20,0)"), 0).cast("double").alias("aqi_moyen"),
        )
        .orderBy(F.asc_nulls_first("city_name"), F.asc_nulls_first("month"), F.asc_nulls_first("level_name"))
        .drop("month")
    )


def aqi_by_temp_band(facts, dim_city) -> DataFrame:
    t, aqi = F.col("temperature"), F.col("aqi_index")
    return (
        _in_city(facts.filter(aqi.isNotNull()), dim_city, "city_name")
        .groupBy("city_name")
        .agg(
            mean_2(F.when(t < 10, aqi), 0).alias("aqi_froid"),
            mean_2(F.when(t.between(10, 20), aqi), 0).alias("aqi_tempere"),
            mean_2(F.when(t > 20, aqi), 0).alias("aqi_chaud"),
        )
        .orderBy("city_name")
    )


def season_pollution(facts, dim_date) -> DataFrame:
    rank = F.array_position(F.array(*(F.lit(s) for s in SEASONS)), F.col("season"))
    return (
        _dated(facts.filter(F.col("pm25").isNotNull()), dim_date, "season")
        .groupBy("season")
        .agg(
            mean_2(F.col("pm25")).alias("pm25_moyen"),
            mean_2(F.col("pm10")).alias("pm10_moyen"),
            mean_2(F.col("no2")).alias("no2_moyen"),
            F.count("*").alias("nb_mesures"),
        )
        .orderBy(rank)
    )


def kpi_24h(facts, dim_city, dim_date, as_of: Column) -> DataFrame:
    """Three lines of text: mean temperature, mean AQI, most polluted city; from one scan of the days that count."""
    start = as_of - F.make_dt_interval(hours=F.lit(24))
    recent = facts.filter(F.col("capture_date").cast("timestamp") >= start)
    last = _dated(recent, dim_date).join(dim_city.select("city_id", "city_name"), "city_id", "left")
    per_city = last.groupBy("city_name").agg(
        F.sum("temperature").cast("decimal(26,2)").alias("ts"), F.count("temperature").alias("tn"),
        F.sum("aqi_index").cast("decimal(26,2)").alias("qs"), F.count("aqi_index").alias("qn"),
    )

    def mean(total: Column, n: Column, digits: int) -> Column:
        return F.round(F.try_divide(total.cast("decimal(26,2)"), n.cast("decimal(20,0)")), digits)

    exact = mean(F.col("qs"), F.col("qn"), 6)
    # the first in the order of: no value first, then the highest mean, then the name
    place = F.when(F.col("city_name").isNotNull(), F.struct(exact.isNotNull(), -F.coalesce(exact, F.lit(0)), F.col("city_name")))
    one = per_city.agg(
        F.sum("ts").alias("ts"), F.sum("tn").alias("tn"), F.sum("qs").alias("qs"), F.sum("qn").alias("qn"),
        F.min_by(F.struct("city_name", mean(F.col("qs"), F.col("qn"), 0).cast("bigint").cast("string").alias("a")), place).alias("worst"),
    )

    def line(kpi: str, value: Column, unit: Column) -> Column:
        return F.struct(F.lit(kpi).alias("kpi"), value.alias("valeur"), unit.alias("unite"))

    def overall(total: str, n: str, digits: int, kind: str) -> Column:
        return mean(F.col(total), F.col(n), digits).cast(kind).cast("string")

    lines = F.array(
        line("Température moyenne", overall("ts", "tn", 2, "decimal(10,2)"), F.lit("°C")),
        line("AQI moyen", overall("qs", "qn", 0, "bigint"), F.lit("index")),
        line("Ville la plus polluée", F.col("worst.city_name"), F.col("worst.a")),
    )
    # without any fact there is no most polluted city
    found = F.filter(lines, lambda x: (x["kpi"] != "Ville la plus polluée") | F.col("worst").isNotNull())
    return one.select(F.explode(found).alias("l")).select("l.*")


def top5_now(facts, dim_city, dim_weather, dim_date, as_of: Column, n: int = 5) -> DataFrame:
    """The highest temperatures of the latest calendar day up to now."""
    today = dim_date.filter(F.col("date_value").cast("timestamp") <= as_of).agg(F.max("date_value")).scalar()
    df = _in_city(facts.filter(F.col("capture_date") == today), dim_city, "city_name")
    named = df.join(
        dim_weather.select("weather_condition_id", F.col("description").alias("meteo")),
        "weather_condition_id",
        "left",
    )
    return (
        named.orderBy(F.desc_nulls_first("temperature"), "measure_id")
        .limit(n)
        .select("city_name", F.round("temperature", 1).cast("double").alias("temperature"), "meteo", "aqi_index")
    )


#: What the months' averages are made of, per day of the lake; such parts add up in any order.
MONTHLY_STATE = (
    "city_id INT, month DATE, n BIGINT, n_temperature BIGINT, sum_temperature DECIMAL(26,2), n_humidity BIGINT, "
    "sum_humidity DECIMAL(26,2), n_aqi_index BIGINT, sum_aqi_index DECIMAL(26,2), lake_date DATE"
)
_AVERAGED = ("temperature", "humidity", "aqi_index")


def monthly_states(judged) -> DataFrame:
    """Counts and sums of the accepted measures per city and month, for each day of the lake.

    A day without accepted measures keeps its rows, with counts of 0, so that they replace older ones.
    """
    ok = F.col("reject_reason").isNull()
    sums = [
        part
        for c in _AVERAGED
        for part in (F.count(F.when(ok, F.col(c))).alias(f"n_{c}"), F.sum(F.when(ok, F.col(c))).cast("decimal(26,2)").alias(f"sum_{c}"))
    ]
    month = F.trunc("capture_date", "month").alias("month")
    states = judged.groupBy("city_id", month, "lake_date").agg(F.count_if(ok).alias("n"), *sums)
    return states.select("city_id", "month", "n", *(f"{kind}_{c}" for c in _AVERAGED for kind in ("n", "sum")), "lake_date")


def monthly_averages(states, dim_city, dim_date) -> DataFrame:
    """The view ``mv_monthly_avg``, merged from the days' parts."""
    whole = states.groupBy("city_id", F.col("month").alias("capture_date")).agg(
        F.sum("n").alias("measure_count"), *(F.sum(f"{kind}_{c}").alias(f"{kind}_{c}") for c in _AVERAGED for kind in ("n", "sum"))
    ).filter("measure_count > 0")

    def mean(c: str, digits: int = 2) -> Column:
        exact = F.try_divide(F.col(f"sum_{c}").cast("decimal(26,2)"), F.col(f"n_{c}").cast("decimal(20,0)"))
        return F.round(exact, digits).cast("double")

    df = _in_city(_dated(whole, dim_date, "year", F.col("month").alias("month_"), "month_name"), dim_city, "city_name")
    return df.select(
        "city_id", "city_name", "year", F.col("month_").alias("month"), "month_name", mean("temperature").alias("temp_avg"),
        mean("humidity").alias("humidity_avg"), mean("aqi_index", 0).alias("aqi_avg"), "measure_count",
    )


def dim_date_stats(dim_date) -> DataFrame:
    return dim_date.agg(
        F.count("*").alias("total_days"),
        F.min("date_value").alias("first_date"),
        F.max("date_value").alias("last_date"),
        F.count_if(F.col("is_weekend")).alias("weekend_days"),
        F.count_if(~F.col("is_weekend")).alias("weekdays"),
    ).select(F.lit("dim_date").alias("table_name"), "*")


def daily_measures(facts, dim_date, n: int = 10) -> DataFrame:
    per_day = facts.groupBy(F.to_date("captured_at").alias("date_value")).agg(
        F.count("measure_id").alias("nb_measures"), mean_2(F.col("temperature"), 1).alias("avg_temp")
    )
    days = dim_date.select("date_value", "day_name", "month_name", "is_weekend")
    return days.join(per_day, "date_value").orderBy(F.desc("date_value")).limit(n)


def issues_daily(issues) -> DataFrame:
    return (
        issues.groupBy(F.to_date("detected_at").alias("date"), "severity", "category")
        .agg(F.count("*").alias("count"), F.countDistinct("validation_run_id").alias("validation_runs"))
        .orderBy(F.desc("date"), "severity", F.desc("count"))
    )


def issues_summary(issues) -> DataFrame:
    return issues.agg(
        F.count("*").alias("total_anomalies"),
        F.countDistinct("validation_run_id").alias("unique_runs"),
        F.countDistinct("severity").alias("severity_levels"),
        F.countDistinct("category").alias("categories"),
    )
