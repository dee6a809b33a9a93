"""Limits, z-scores and the verdict on each measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ecostar.functions.expr import plain_number

# Physical limits per field (min, max, unit).
RULES = {
    "temperature": (-50, 60, "°C"),
    "feels_like": (-60, 70, "°C"),
    "pressure": (800, 1100, "hPa"),
    "humidity": (0, 100, "%"),
    "wind_speed": (0, 200, "km/h"),
    "wind_gust": (0, 300, "km/h"),
    "clouds": (0, 100, "%"),
    "visibility": (0, 50000, "m"),
    "uvi": (0, 15, "index"),
    "aqi": (0, 500, "index"),
    "pm2_5": (0, 1000, "µg/m³"),
    "pm10": (0, 2000, "µg/m³"),
    "no2": (0, 500, "µg/m³"),
    "o3": (0, 800, "µg/m³"),
    "so2": (0, 500, "µg/m³"),
    "co": (0, 50000, "µg/m³"),
}

# The fields that the transform hands to the checks.
DEFAULT_FIELDS = (
    "temperature", "feels_like", "humidity", "pressure", "wind_speed", "aqi", "pm2_5", "pm10",
)

# Names of the checks that differ from the measure columns.
COLUMN_OF = {"aqi": "aqi_index", "pm2_5": "pm25"}

# Z-score steps, most severe first.
Z_STEPS = (("critical", 4.0), ("high", 3.0), ("medium", 2.5), ("low", 2.0))
Z_FIELDS = ("temperature", "humidity", "pressure", "aqi")

KEY = ("city_id", "lake_hour", "captured_at")

HIT = (
    "anomaly_type", "severity", "field_name", "actual_value", "expected_range_min",
    "expected_range_max", "anomaly_score", "description", "action_taken",
)


def value_of(field: str) -> Column:
    return F.col(COLUMN_OF.get(field, field)).cast("double")


def _value_sql(field: str) -> str:
    return f"CAST({COLUMN_OF.get(field, field)} AS DOUBLE)"


def _hit(when: str, **columns: str) -> Column:
    """A hit as a struct where the condition holds, else NULL; all parts are SQL text."""
    doubles = ("actual_value", "expected_range_min", "expected_range_max", "anomaly_score")
    parts = ", ".join(
        f"'{c}', {f'CAST({columns[c]} AS DOUBLE)' if c in doubles else columns[c]}" for c in HIT
    )
    return F.expr(f"CASE WHEN {when} THEN named_struct({parts}) END")


def _found(hits: list[Column]) -> Column:
    return F.filter(F.array(*hits), lambda h: h.isNotNull())


def exploded(df: DataFrame, hits: Column) -> DataFrame:
    """One row per hit; measures without one vanish before the explode."""
    return df.select(*KEY, F.explode(hits).alias("hit")).select(*KEY, "hit.*")


def _rule_hits(columns: list[str], rules: dict, fields) -> list[Column]:
    hits = []
    for field in fields:
        if COLUMN_OF.get(field, field) not in columns:
            continue
        low, high, unit = rules[field]
        value = _value_sql(field)
        hits.append(
            _hit(
                f"{value} < {low} OR {value} > {high}",
                anomaly_type="'business_rule'",
                severity="'critical'",
                field_name=f"'{field}'",
                actual_value=value,
                expected_range_min=str(low),
                expected_range_max=str(high),
                anomaly_score="NULL",
                description=f"concat('{field} = ', {plain_number(value)}, "
                f"' {unit} est hors limites physiques [{low}, {high}]')",
                action_taken="'rejected'",
            )
        )
    return hits


def rule_hits(measures: DataFrame, rules: dict = RULES, fields=DEFAULT_FIELDS) -> DataFrame:
    """One critical hit per value strictly outside its limits."""
    return exploded(measures, _found(_rule_hits(measures.columns, rules, fields)))


def city_stats(facts: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Mean and sample deviation per city over the days before ``as_of``."""
    window = facts.filter(
        (F.col("captured_at") >= as_of - F.make_dt_interval(days=F.lit(days)))
        & (F.col("captured_at") < as_of)
    )
    return window.groupBy("city_id").agg(
        *(F.avg(value_of(f)).alias(f"mean_{f}") for f in Z_FIELDS),
        *(F.stddev_samp(value_of(f)).alias(f"std_{f}") for f in Z_FIELDS),
    )


def with_city_stats(measures: DataFrame, stats: DataFrame) -> DataFrame:
    return measures.join(stats, "city_id", "left")


def _steps(value: str, steps, op: str, otherwise: str = "NULL") -> str:
    cases = " ".join(f"WHEN {value} {op} {limit} THEN '{name}'" for name, limit in steps)
    return f"CASE {cases} ELSE {otherwise} END"


def _action(severity: str) -> str:
    return f"CASE WHEN {severity} IN ('low', 'medium') THEN 'flagged' ELSE 'rejected' END"


def _z_hits() -> list[Column]:
    hits = []
    for f in Z_FIELDS:
        value, mean, std = _value_sql(f), f"mean_{f}", f"std_{f}"
        z = f"abs(({value} - {mean}) / nullif({std}, 0D))"
        severity = _steps(z, Z_STEPS, ">=")
        hits.append(
            _hit(
                f"{z} >= {Z_STEPS[-1][1]}",
                anomaly_type="'statistical'",
                severity=severity,
                field_name=f"'{f}'",
                actual_value=value,
                expected_range_min=f"{mean} - 3 * {std}",
                expected_range_max=f"{mean} + 3 * {std}",
                anomaly_score=z,
                description=f"format_string('{f} = %.1f s\\'écarte de %.2f écarts-types (μ=%.1f, σ=%.1f)', "
                f"{value}, {z}, {mean}, {std})",
                action_taken=_action(severity),
            )
        )
    return hits


def zscore_hits(measures: DataFrame, stats: DataFrame) -> DataFrame:
    return exploded(with_city_stats(measures, stats), _found(_z_hits()))


FOREST_SCORE = "forest_score"


# Severity of a forest score, most severe first.
FOREST_STEPS = (("critical", -0.8), ("high", -0.6), ("medium", -0.4))


def forest_hit(threshold: float) -> Column:
    """The hit of a measure whose ``forest_score`` lies below the threshold."""
    severity = _steps(FOREST_SCORE, FOREST_STEPS, "<", "'low'")
    return _hit(
        f"{FOREST_SCORE} < CAST({threshold!r} AS DOUBLE)",
        anomaly_type="'ml_isolation_forest'",
        severity=severity,
        field_name="'multivariate'",
        actual_value="NULL",
        expected_range_min="NULL",
        expected_range_max="NULL",
        anomaly_score=FOREST_SCORE,
        description=f"format_string('Anomalie multivariée détectée (score=%.3f)', {FOREST_SCORE})",
        action_taken=_action(severity),
    )


def judge(
    measures: DataFrame,
    stats: DataFrame | None = None,
    threshold: float | None = None,
    rules: dict = RULES,
    fields=DEFAULT_FIELDS,
) -> DataFrame:
    """Each measure with its ``hits`` and the verdict, all within the row.

    ``is_anomaly`` is any hit, ``anomaly_score`` the largest non-zero score (0 if the
    hits carry none, NULL without hits), ``is_rejected`` any critical hit. Forest hits
    need ``forest_score`` and its threshold.
    """
    hits = _rule_hits(measures.columns, rules, fields)
    df = measures
    if stats is not None:
        df = with_city_stats(df, stats)
        hits += _z_hits()
    if threshold is not None:
        hits.append(forest_hit(threshold))
    return (
        df.withColumn("hits", _found(hits))
        .select(*measures.columns, "hits")
        .withColumns(
            {
                "is_anomaly": F.expr("size(hits) > 0"),
                "anomaly_score": F.expr(
                    "CASE WHEN size(hits) > 0 THEN "
                    "coalesce(array_max(filter(hits.anomaly_score, s -> s <> 0)), 0D) END"
                ),
                "is_rejected": F.expr("exists(hits, h -> h.severity = 'critical')"),
            }
        )
    )


def stored_hits(judged: DataFrame) -> DataFrame:
    """A rejected measure stores only its critical hits; the others have no critical one."""
    critical = F.filter("hits", lambda h: h["severity"] == "critical")
    return exploded(judged, F.when(F.col("is_rejected"), critical).otherwise(F.col("hits")))


def split_critical(judged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(measures to load, rejected measures, hits to store)."""
    return (
        judged.filter(~F.col("is_rejected")),
        judged.filter("is_rejected"),
        stored_hits(judged),
    )


def format_hits(hits: DataFrame, cities: DataFrame) -> DataFrame:
    """The 12 columns of the measure-anomaly table."""
    return hits.join(cities.select("city_id", "city_name"), "city_id", "left").select(
        "city_id", "city_name", "captured_at", *HIT
    )
