"""Data-quality checks over the facts of the last hours, and their report."""

from __future__ import annotations

from math import isfinite

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ecostar.operators.measures import recent, recent_days
from ecostar.sources.warehouse import stage

# Limits per field of the validation (stricter on pressure than the transform).
LIMITS = {
    "temperature": (-50, 60),
    "pressure": (870, 1084),
    "humidity": (0, 100),
    "wind_speed": (0, 200),
    "clouds": (0, 100),
    "visibility": (0, 50000),
    "uvi": (0, 15),
    "aqi": (0, 500),
    "pm25": (0, 1000),
    "pm10": (0, 2000),
    "no2": (0, 500),
    "o3": (0, 800),
    "so2": (0, 500),
    "co": (0, 50000),
    "vitesse_actuelle_kmph": (0, 200),
    "congestion_ratio": (0, 20),
    "speed_ratio": (0, 5),
    "incident_severity_score": (0, 1000),
}

OUTLIER_FIELDS = ("temperature", "humidity", "pressure", "aqi", "pm25", "pm10")
REQUIRED_COLUMNS = ("city_id", "capture_date", "captured_at")
DUPLICATE_KEY = ["table_source", "city_id", "captured_at", "traffic_point_id", "incident_category_id"]
MIN_OUTLIER_VALUES = 10

MEASURES, FLOWS, INCIDENTS = "fact_measures", "fact_traffic_flow_hourly", "fact_traffic_incident_hourly"

CHECK = "severity STRING, category STRING, message STRING, details STRING"


def _column(field: str) -> str:
    return "aqi_index" if field == "aqi" else field


def _hour_start() -> Column:
    return F.to_timestamp("date_value") + F.make_dt_interval(hours=F.col("hour_of_day"))


def union_facts(
    measures: DataFrame, flows: DataFrame, incidents: DataFrame, as_of: Column, hours: int = 24,
    water: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Recent rows of the fact tables in one frame; ``water`` adds further hourly tables."""
    parts = [recent(measures, as_of, hours).withColumn("table_source", F.lit(MEASURES))]
    hourly = {FLOWS: flows, INCIDENTS: incidents, **(water or {})}
    for name, df in hourly.items():
        parts.append(
            recent_days(df, as_of, hours).withColumns(
                {
                    "captured_at": _hour_start(),
                    "capture_date": F.col("date_value"),
                    "table_source": F.lit(name),
                }
            )
        )
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def _check(
    df: DataFrame, severity: str, category: str, message: Column, details: Column | None = None, by: list[str] = []  # noqa: B006
) -> DataFrame:
    return df.select(
        *by,
        F.lit(severity).alias("severity"),
        F.lit(category).alias("category"),
        message.alias("message"),
        (F.lit(None).cast("string") if details is None else details).alias("details"),
    )


def _text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def _missing(none: DataFrame, hours: int) -> DataFrame:
    return _check(none, "critical", "data_missing", F.lit(f"Aucune donnée trouvée dans les {hours} dernières heures"))


def check_missing(df: DataFrame, hours: int = 24) -> DataFrame:
    return _missing(df.agg(F.count("*").alias("total")).filter("total = 0"), hours)


def check_missing_windows(df: DataFrame, hours: int = 24) -> DataFrame:
    """``check_missing`` for every window of ``hours`` from the first fact's to the one after the last fact's.

    Windows follow one another from the epoch on, ``window_start`` is theirs; without any fact a single one is missing.
    """
    slot = F.floor(F.unix_timestamp("captured_at") / (hours * 3600)).alias("slot")
    seen = df.filter(F.col("captured_at").isNotNull()).select(slot).distinct()
    first, last = F.coalesce(F.min("slot"), F.lit(0)), F.coalesce(F.max("slot") + 1, F.lit(0))
    windows = seen.agg(F.sequence(first, last).alias("slots")).select(F.explode("slots").alias("slot"))
    empty = windows.join(seen, "slot", "left_anti").withColumn("window_start", F.timestamp_seconds(F.col("slot") * (hours * 3600)))
    text = F.lit(f"Aucune donnée trouvée dans les {hours} dernières heures")
    return _check(empty, "critical", "data_missing", text, by=["window_start"])


def null_columns() -> list[Column]:
    return [F.count("*").alias("total"), *(F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED_COLUMNS)]


def _nulls(counts: DataFrame) -> DataFrame:
    found = counts.unpivot("total", list(REQUIRED_COLUMNS), "field", "nulls").filter(F.col("nulls") > 0)
    message = _text(F.col("nulls"), " mesures avec ", F.col("field"), " NULL sur ", F.col("total"))
    return _check(found, "critical", "null_values", message)


def check_nulls(df: DataFrame) -> DataFrame:
    return _nulls(df.agg(*null_columns()))


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Keys that occur more than once, NULLs taken as equal, with their count."""
    return key_counts(df).filter(F.col("copies") > 1)


def key_counts(df: DataFrame) -> DataFrame:
    """One row per key with its ``copies``: what duplicates, gaps and coverage need of the facts."""
    keys = [c if c in df.columns else F.lit(None).cast("int").alias(c) for c in DUPLICATE_KEY]
    return df.select(*keys).groupBy(*DUPLICATE_KEY).agg(F.count("*").alias("copies"))


def check_duplicates(groups: DataFrame) -> DataFrame:
    """From the groups of equal keys."""
    extra = groups.agg(F.sum(F.col("copies") - 1).alias("n")).filter(F.col("n") > 0)
    return _check(
        extra, "critical", "duplicates", _text(F.col("n"), " doublons détectés (même city_id + captured_at)")
    )


def temporal_columns(as_of: Column) -> list[Column]:
    both = F.col("created_at").isNotNull() & F.col("captured_at").isNotNull()
    return [
        F.count_if(both & (F.col("created_at") < F.col("captured_at"))).alias("created_before"),
        F.count_if(both & (F.col("captured_at") > as_of)).alias("in_future"),
    ]


def temporal_counts(df: DataFrame, as_of: Column) -> DataFrame:
    return df.agg(*temporal_columns(as_of))


def _temporal(counts: DataFrame) -> DataFrame:
    before = _check(
        counts.filter("created_before > 0"), "warning", "temporal_coherence",
        _text(F.col("created_before"), " mesures avec created_at < captured_at"),
    )
    future = _check(
        counts.filter("in_future > 0"), "critical", "temporal_coherence",
        _text(F.col("in_future"), " mesures avec captured_at dans le futur"),
    )
    return before.unionByName(future)


def gaps(df: DataFrame, max_hours: int = 2) -> DataFrame:
    """(city, start, end, hours) of every silence longer than ``max_hours``.

    A silence longer than a slot of ``max_hours`` cannot lie inside one slot, so
    the first and last instant per city and slot suffice. The window then runs
    over slots, whose number follows the time span and not the number of rows.
    """
    slot = F.floor(F.unix_timestamp("captured_at") / F.lit(max_hours * 3600))
    slots = (
        df.filter((F.col("city_id") != 0) & F.col("captured_at").isNotNull())
        .groupBy("city_id", slot.alias("slot"))
        .agg(F.min("captured_at").alias("first_at"), F.max("captured_at").alias("last_at"))
    )
    previous = F.lag("last_at").over(W.partitionBy("city_id").orderBy("slot"))
    silence = F.unix_micros("gap_end") - F.unix_micros("gap_start")
    return (
        slots.select("city_id", previous.alias("gap_start"), F.col("first_at").alias("gap_end"))
        .filter(silence > max_hours * 3600 * 1000000)
        .withColumn("gap_hours", silence / 3600000000.0)
    )


def check_gaps(silences: DataFrame) -> DataFrame:
    """One warning from the rows of ``gaps``, which are kept beside it; the details give count and longest silence per city."""
    per_city = silences.groupBy("city_id").agg(
        F.count("*").alias("n"), F.max("gap_hours").alias("longest")
    )
    total = per_city.agg(
        F.sum("n").alias("n"),
        F.count("*").alias("cities"),
        F.to_json(
            F.struct(F.array_sort(F.collect_list(F.struct("city_id", "n", "longest"))).alias("gaps"))
        ).alias("details"),
    ).filter(F.col("n") > 0)
    message = _text(F.col("n"), " gaps temporels détectés dans ", F.col("cities"), " villes")
    return _check(total, "warning", "temporal_gaps", message, F.col("details"))


def limit_violations(df: DataFrame, limits: dict = LIMITS) -> DataFrame:
    """One row per value strictly outside its limits."""
    found = []
    for field, (low, high) in limits.items():
        if _column(field) not in df.columns:
            continue
        value = F.col(_column(field)).cast("double")
        row = F.struct(
            F.lit(field).alias("field"),
            value.alias("value"),
            F.lit(f"[{low}, {high}]").alias("limits"),
        )
        found.append(F.when((value < low) | (value > high), row))
    hits = F.filter(F.array(*found), lambda h: h.isNotNull())
    return df.select("table_source", "city_id", "captured_at", F.explode(hits).alias("hit")).select(
        "table_source", "city_id", "captured_at", "hit.*"
    )


def limit_counts(df: DataFrame, limits: dict = LIMITS, examples: int = 3) -> DataFrame:
    """(field, violations, examples): at most three examples per field, earliest first."""
    return counted_violations(limit_violations(df, limits), examples)


def counted_violations(found: DataFrame, examples: int = 3) -> DataFrame:
    counts = found.groupBy("field").agg(F.count("*").alias("violations"))
    order = ["captured_at", "city_id", "value", "table_source"]
    first = W.partitionBy("field").orderBy(*order)
    shown = (
        found.withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= examples)
        .groupBy("field")
        .agg(
            F.array_sort(F.collect_list(F.struct("rank", "city_id", "captured_at", "value", "limits"))).alias(
                "examples"
            )
        )
    )
    return counts.join(shown, "field")


def check_limits(per_field: DataFrame) -> DataFrame:
    """From the counts per field."""
    total = per_field.agg(
        F.sum("violations").alias("n"),
        F.to_json(
            F.struct(
                F.array_sort(F.collect_list(F.struct("field", "violations", "examples"))).alias("violations")
            )
        ).alias("details"),
    ).filter(F.col("n") > 0)
    return _check(
        total, "critical", "business_rules", _text(F.col("n"), " violations de limites physiques"), F.col("details")
    )


def city_counts(df: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Facts per city; rows of ``key_counts`` count with their copies."""
    return (
        df.filter(~F.col("city_id").isin(0, -1))
        .groupBy(*by, "city_id")
        .agg((F.sum("copies") if "copies" in df.columns else F.count("*")).alias("n"))
    )


def low_coverage(df: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Cities with less than half of the mean count (of their group of ``by``), with that mean."""
    counts = city_counts(df, by).withColumn("average", F.avg("n").over(W.partitionBy(*by)))
    return counts.filter(F.col("n") < F.col("average") * 0.5)


def check_coverage(df: DataFrame, cities: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Cities without facts and cities with few, over all facts or in each group of ``by`` that has facts.

    What a group collects is bounded by the cities of the reference table.
    """
    expected = cities.agg(F.array_sort(F.collect_list(F.struct("city_id", "city_name"))).alias("e")).scalar()
    known = city_counts(df, by).join(cities.select("city_id"), "city_id", "left_semi")
    seen = known.groupBy(*by).agg(F.collect_list("city_id").alias("seen"))
    if by:
        seen = df.select(*by).distinct().join(seen, by, "left")
    lost = F.filter("expected", lambda c: ~F.array_contains(F.coalesce("seen", F.array().cast("array<int>")), c["city_id"]))
    absent = seen.withColumn("expected", expected).withColumn("lost", lost).filter(F.size("lost") > 0)
    names = F.concat_ws(", ", F.transform("lost", lambda c: c["city_name"]))
    name = F.coalesce("city_name", F.concat(F.lit("ID "), F.col("city_id").cast("string")))
    low = low_coverage(df, by).join(cities.select("city_id", "city_name"), "city_id", "left").groupBy(*by).agg(
        F.count("*").alias("n"),
        F.to_json(
            F.struct(
                F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("city_id").cast("string").alias("city_id"), F.struct(name.alias("name"), "n").alias("v"))))).alias("cities"),
                F.max("average").alias("average"),
            )
        ).alias("details"),
    ).filter(F.col("n") > 0)
    return _check(
        absent, "warning", "data_coverage", _text(F.size("lost"), " villes sans données : ", names), by=by
    ).unionByName(
        _check(low, "info", "data_coverage", _text(F.col("n"), " villes avec couverture faible"), F.col("details"), by)
    )


def outlier_bounds(df: DataFrame, fields=OUTLIER_FIELDS) -> list[Column]:
    """Aggregates per field: number, mean and population deviation of its values."""
    out = []
    for f in fields:
        if _column(f) in df.columns:
            value = F.col(_column(f)).cast("double")
            out += [F.count(value).alias(f"n_{f}"), F.avg(value).alias(f"mean_{f}"), F.stddev_pop(value).alias(f"std_{f}")]
    return out


_STRANGE = "named_struct('field', {field!r}, 'value', {value}, 'z', {z}, 'limits', {limits})"


def _strange_values(df: DataFrame, bounds: dict, limits: dict, z: float) -> DataFrame:
    """One row per value outside its limits (``limits`` given) or beyond ``z`` deviations (``z`` given), in one scan."""
    found = [F.expr("CAST(NULL AS STRUCT<field: STRING, value: DOUBLE, z: DOUBLE, limits: STRING>)")]
    for field, (low, high) in limits.items():
        if _column(field) in df.columns:
            value = f"CAST({_column(field)} AS DOUBLE)"
            row = _STRANGE.format(field=field, value=value, z="CAST(NULL AS DOUBLE)", limits=f"'[{low}, {high}]'")
            found.append(F.expr(f"CASE WHEN {value} < {low} OR {value} > {high} THEN {row} END"))
    for name, n in bounds.items():
        field = name.removeprefix("n_")
        if name.startswith("n_") and n >= MIN_OUTLIER_VALUES and bounds[f"std_{field}"] and isfinite(bounds[f"std_{field}"]):
            value = f"CAST({_column(field)} AS DOUBLE)"
            score = f"abs({value} - CAST({bounds[f'mean_{field}']!r} AS DOUBLE)) / CAST({bounds[f'std_{field}']!r} AS DOUBLE)"
            row = _STRANGE.format(field=field, value=value, z=score, limits="CAST(NULL AS STRING)")
            found.append(F.expr(f"CASE WHEN {score} > {z}D THEN {row} END"))
    hits = F.filter(F.array(*found), lambda h: h.isNotNull())
    base = [c if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (("table_source", "string"), ("city_id", "int"), ("captured_at", "timestamp"))]
    return df.select(*base, F.explode(hits).alias("hit")).select("table_source", "city_id", "captured_at", "hit.*")


def counted_outliers(found: DataFrame, bounds: dict) -> DataFrame:
    """(field, outliers, percentage, mean, std, max_z_score) from the values beyond their bounds; the largest is one of them."""
    counts = found.groupBy("field").agg(F.count("*").alias("outliers"), F.max("z").alias("max_z_score"))

    def of(kind: str) -> Column:
        pairs = [x for c, v in bounds.items() if c.startswith(kind) for x in (F.lit(c.removeprefix(kind)), F.lit(v).cast("double"))]
        return F.element_at(F.create_map(*pairs), F.col("field"))

    return counts.select("field", "outliers", (F.col("outliers") * 100.0 / of("n_")).alias("percentage"), of("mean_").alias("mean"), of("std_").alias("std"), "max_z_score")


def outliers(df: DataFrame, fields=OUTLIER_FIELDS, z: float = 3.0) -> DataFrame:
    """Per field with at least ten values the rows beyond ``z`` population deviations; two scans, of which one row returns first."""
    bounds = df.agg(*outlier_bounds(df, fields)).first().asDict()
    return counted_outliers(_strange_values(df, bounds, {}, z), bounds)


def check_outliers(found: DataFrame) -> DataFrame:
    """From the outliers per field."""
    total = found.agg(
        F.sum("outliers").alias("n"),
        F.to_json(
            F.struct(
                F.array_sort(
                    F.collect_list(F.struct("field", "outliers", "percentage", "mean", "std", "max_z_score"))
                ).alias("outliers")
            )
        ).alias("details"),
    ).filter(F.col("n") > 0)
    return _check(
        total, "info", "statistical_outliers", _text(F.col("n"), " outliers statistiques détectés (>3σ)"),
        F.col("details"),
    )


def all_checks(df: DataFrame, cities: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    return all_checks_and_gaps(df, cities, as_of, hours)[0]


def all_checks_and_gaps(df: DataFrame, cities: DataFrame, as_of: Column, hours: int = 24) -> tuple[DataFrame, DataFrame]:
    """The issues, and every single gap, from three scans of the facts.

    One scan counts nulls and wrong times and measures the fields, one counts the keys, from
    which duplicates, gaps and coverage follow, and one finds the few values outside their
    limits or bounds. Only the one row of the first returns to the driver.
    """
    wide = null_columns() + temporal_columns(as_of) + outlier_bounds(df)
    one = stage(df.agg(*wide), "fact-counts")
    bounds = {c: x for c, x in one.first().asDict().items() if c.startswith(("n_", "mean_", "std_"))}
    keys = stage(key_counts(df), "fact-keys")
    strange = stage(_strange_values(df, bounds, LIMITS, 3.0), "strange-values")
    silences = gaps(keys)
    checks = [
        _missing(one.filter("total = 0"), hours), _nulls(one), check_duplicates(keys.filter("copies > 1")), _temporal(one),
        check_gaps(silences), check_limits(counted_violations(strange.filter("limits IS NOT NULL"))), check_coverage(keys, cities),
        check_outliers(counted_outliers(strange.filter("z IS NOT NULL"), bounds)),
    ]
    out = checks[0]
    for more in checks[1:]:
        out = out.unionByName(more)
    return out, silences


def issue_rows(checks: DataFrame, run_id: Column, as_of: Column, hours: int = 24) -> DataFrame:
    return checks.select(
        run_id.alias("validation_run_id"),
        "severity",
        "category",
        "message",
        "details",
        as_of.alias("detected_at"),
        F.lit(hours).alias("validation_period_hours"),
    )


def report(issues: DataFrame, strict: bool = False) -> DataFrame:
    """Counts per severity and the verdict in one row."""
    counts = issues.agg(
        *(F.count_if(F.col("severity") == s).alias(s) for s in ("critical", "warning", "info"))
    )
    failed = F.col("critical") > 0
    if strict:
        failed = failed | (F.col("warning") > 0)
    return counts.withColumn("status", F.when(failed, "failed").otherwise("ok"))


# Cleanup of fact_measures -----------------------------------------------------------


def find_duplicates(facts: DataFrame) -> DataFrame:
    """Rows to delete: all of a (city, instant) but the one created last.

    The survivor is found by a partial aggregation and the rows join back on their
    unique id, so a hot key is never gathered.
    """
    kept = (
        facts.groupBy("city_id", "captured_at")
        .agg(F.max(F.struct("created_at", "measure_id")).alias("kept"))
        .select(F.col("kept.measure_id").alias("measure_id"))
    )
    return facts.join(kept, "measure_id", "left_anti")


def find_future(facts: DataFrame, as_of: Column) -> DataFrame:
    return facts.filter(F.col("captured_at") > as_of)


def cleanup_counts(facts: DataFrame, as_of: Column, dry_run: bool = False) -> DataFrame:
    """Duplicates, future dates and their sum, from the number of facts per city and instant.

    A dry run deletes nothing in between, so a row that is both counts twice.
    """
    groups = facts.groupBy("city_id", "captured_at").agg(F.count("*").alias("n"))
    left = F.col("n") if dry_run else F.lit(1)
    counts = groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col("captured_at") > as_of, left)), F.lit(0)).cast("bigint").alias("future_dates"),
    )
    return counts.withColumn("total_deleted", F.col("duplicates") + F.col("future_dates"))
