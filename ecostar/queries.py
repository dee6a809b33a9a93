"""One named query per operator, over the views of the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ecostar import driver_views as v, schemas
from ecostar.functions import expr
from ecostar.operators import (
    anomalies, dimensions, forest, measures as m, parse, quality, rolling, traffic, water,
)
from ecostar.plans import imports, olap, transform
from ecostar.session import shared_folder, use_utc
from ecostar.sources import done, history, lake as lake_io, reference, warehouse
from ecostar.streaming import jobs

QUERIES = {}


def presented(df: DataFrame) -> DataFrame:
    """Dates and instants as text, decimals as doubles: the same values in any engine."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DateType, T.TimestampType)):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(fn(use_utc(spark), sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


_empty = warehouse.empty_table


def _staged(df: DataFrame) -> DataFrame:
    """Records that a query reads more than once, parsed once."""
    return warehouse.stage(df, "records")


def _r(col, digits=6):
    return F.round(F.col(col) if isinstance(col, str) else col, digits)


# Sources and sinks -------------------------------------------------------------------


@query
def lake_read_json(spark, sf):
    path = shared_folder(spark, "lake-json")
    lake_io.export_entries(v.lake(spark, sf), path)
    return lake_io.read_lake(spark, path).select(
        "id", "city_id", "city_name", "source", "collected_at", "processed",
        F.get_json_object("raw_data", "$.main.temp").cast("double").alias("temp"),
        F.get_json_object("raw_data", "$.code_point").alias("code_point"),
    )


@query
def lake_append(spark, sf):
    path = shared_folder(spark, "lake")
    entries = v.lake(spark, sf)
    timed = entries.withColumn("collected_at", F.when(~F.col("processed"), F.col("collected_at")))
    lake_io.append_lake(timed, path, ingested_at=v.as_of())
    return lake_io.load_lake(spark, path).select("id", "source", "collected_at", "collected_date", "processed")


@query
def lake_export_city(spark, sf):
    path = shared_folder(spark, "export")
    lake_io.export_city(v.lake(spark, sf), "Paris", path)
    return lake_io.read_lake(spark, path).select("id", "city_name", "source", "collected_at")


@query
def lake_unprocessed(spark, sf):
    ranges = warehouse.stage(done.ranges_of(v.outcomes(spark, sf).filter(F.col("value") < 20)), "ranges")
    return lake_io.unprocessed(v.lake(spark, sf), ranges, 1000).select("id", "source", "collected_at")


@query
def lake_mark_processed(spark, sf):
    path = shared_folder(spark, "outcomes")
    lake_io.mark_processed(v.outcomes(spark, sf), v.as_of(), F.col("outcome"), path)
    return spark.read.parquet(path)


@query
def lake_latest_by_source(spark, sf):
    return lake_io.latest_raw(v.lake(spark, sf), n=10).select("id", "city_id", "source", "rank")


@query
def lake_pending_by_source(spark, sf):
    return lake_io.pending_by_source(v.lake(spark, sf))


@query
def latest_measures(spark, sf):
    """The last ten of every city."""
    return m.latest_measures(v.facts(spark, sf)).select(
        "city_id", "rank", "captured_at", "temperature", "aqi_index", "pm25"
    )


def _cities(spark, sf):
    return reference.resolve_stations(v.supplier_cities(spark, sf), v.customer_reference(spark, sf))


@query
def cities_source(spark, sf):
    return _cities(spark, sf).select("id", "name", "latitude", "longitude", "aqi_station")


@query
def collection_targets(spark, sf):
    return reference.collection_targets(_cities(spark, sf)).withColumn(
        "station_names", F.concat_ws("|", "station_names")
    )


@query
def source_caps(spark, sf):
    lake = v.lake(spark, sf)

    def capped(df, name):
        return df.select("id", "city_id", F.lit(name).alias("source"))

    def of(source):
        return lake.filter(F.col("source") == source)

    out = capped(lake_io.cap_stations(parse.river_obs_records(lake)), schemas.RIVER_OBSERVATIONS)
    for source, n in lake_io.SOURCE_CAPS.items():
        out = out.unionByName(capped(lake_io.cap_per_city(of(source), n), source))
    return out


HISTORY_START, HISTORY_END = dt.date(2024, 1, 5), dt.date(2024, 1, 25)


def _history_csv(spark, sf) -> str:
    """CSV files whose order of rows is the order of event ids."""
    k, name = F.col("k"), F.col("city_name")
    species = F.array(*(F.lit(s) for s in (*history.SPECIES, "uvi")))
    day = F.date_format("collected_at", "yyyy-MM-dd")
    path = shared_folder(spark, "history")
    (
        v.events(spark, sf)
        .repartitionByRange(4, "id")
        .sortWithinPartitions("id")
        .select(
            F.when(k % 13 == 0, F.concat(F.lit("#"), day)).when(k % 17 == 0, "n.d.").otherwise(day).alias("Date"),
            F.lit("FR").alias("Country"),
            F.when(k % 2 == 0, F.upper(name)).when(k % 3 == 0, F.concat(F.lit(" "), name, F.lit(" ")))
            .when(k % 5 == 0, "Atlantis").otherwise(name).alias("City"),
            F.when(k % 19 == 0, " ").otherwise(F.element_at(species, k % 12 + 1)).alias("Specie"),
            F.lit(24).alias("count"),
            F.when(k % 11 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("median"),
        )
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _history_rows(spark, sf):
    return history.read_history(
        spark, _history_csv(spark, sf), HISTORY_START, HISTORY_END, reference.dim_city(spark)
    )


@query
def aqicn_history_csv(spark, sf):
    return _history_rows(spark, sf).drop("position")


@query
def history_last_value(spark, sf):
    return history.last_median(_history_rows(spark, sf)).drop("position")


def _history_records(spark, sf):
    cities = reference.city_reference(spark)
    return history.history_records(history.last_median(_history_rows(spark, sf)), cities)


@query
def aqicn_history_records(spark, sf):
    """The lake's entries after an import of the history, and one that finds nothing left to add."""
    def at(path):
        return F.get_json_object("raw_data", path)

    path, csv = shared_folder(spark, "lake"), _history_csv(spark, sf)
    for _ in range(2):
        imports.import_history(spark, csv, path, HISTORY_START, HISTORY_END)
    return lake_io.load_lake(spark, path).select(
        "id", "city_id", "city_name", "collected_at", at("$.data.aqi").cast("int").alias("aqi"),
        F.size(F.json_object_keys(at("$.data.iaqi"))).alias("n_species"),
        at("$.data.iaqi.t.v").cast("double").alias("t"),
        at("$.data.iaqi.uvi.v").cast("double").alias("uvi"),
        at("$.data.city.name").alias("station"),
        at("$.data.city.url").alias("url"),
        at("$.data.time.iso").alias("iso"),
        at("$.data.time.v").cast("bigint").alias("epoch"),
    )


@query
def aqicn_history_missing(spark, sf):
    records = _history_records(spark, sf)
    lake = v.lake(spark, sf).filter(F.col("processed"))
    kept = history.missing_records(records, lake).select("city_id", "collected_at", F.lit(True).alias("missing"))
    skipped = history.skipped_records(records, lake).select(
        "city_id", "collected_at", F.lit(False).alias("missing")
    )
    return kept.unionByName(skipped)


@query
def etl_log(spark, sf):
    ok = v.outcomes(spark, sf).select((F.col("outcome") == "processed").alias("ok"))
    return lake_io.run_log(ok, "transform", v.as_of(), F.lit(0)).drop("city_id")


@query
def table_footprint(spark, sf):
    facts = {
        "fact_measures": v.facts(spark, sf, months=False),
        "fact_traffic_flow_hourly": _flow_facts(spark, sf),
    }
    return lake_io.footprint(v.lake(spark, sf), facts).withColumn("mb", _r("mb"))


@query
def retention_purge(spark, sf):
    """What a purge of the lake leaves, per source and day."""
    path = shared_folder(spark, "lake")
    lake_io.append_lake(v.lake(spark, sf), path)
    lake_io.purge(spark, path, 30, dt.date(2024, 2, 14))
    return lake_io.load_lake(spark, path).groupBy("source", "collected_date").agg(F.count("*").alias("entries"))


# JSON to columns -----------------------------------------------------------------------


@query
def parse_weather(spark, sf):
    return parse.parse_weather(v.lake(spark, sf)).drop("city_name", "collected_at")


@query
def weather_timestamp(spark, sf):
    return parse.weather_timestamps(v.lake(spark, sf)).select("id", "api_time")


@query
def parse_air_quality(spark, sf):
    return parse.parse_air_quality(v.lake(spark, sf)).drop("city_name", "collected_at")


@query
def aqi_attribution(spark, sf):
    return parse.air_attributions(v.lake(spark, sf)).select("id", "station_attribution")


@query
def aqi_timestamp(spark, sf):
    return parse.air_timestamps(v.lake(spark, sf)).select("id", "api_time")


@query
def flow_flatten(spark, sf):
    return parse.flatten_flow(v.flow_answers(spark, sf)).withColumns(
        {"congestion_ratio": _r("congestion_ratio"), "speed_ratio": _r("speed_ratio")}
    ).drop("collected_at")


@query
def incidents_explode(spark, sf):
    return parse.explode_incidents(v.incident_answers(spark, sf)).select(
        "id", "incident_id", "categorie_incident", "libelle_categorie", "gravite_retard", "retard_s", "longueur_m",
        "debut_incident_utc", "nombre_signalements", "geometrie_type",
    )


@query
def drinking_water_flatten(spark, sf):
    return parse.flatten_drinking_water(v.drinking_answers(spark, sf)).drop("collected_at", "city_id")


@query
def river_stations_flatten(spark, sf):
    return parse.flatten_stations(v.station_answers(spark, sf))


@query
def river_obs_flatten(spark, sf):
    return parse.flatten_river_obs(v.river_obs_answers(spark, sf)).drop("collected_at", "city_id")


@query
def groundwater_flatten(spark, sf):
    return parse.flatten_groundwater(v.groundwater_answers(spark, sf)).select(
        "id", "bss_id", "code_bss", "measured_at", "groundwater_level_ngf_m", "groundwater_depth_m"
    )


# Filters and routing ---------------------------------------------------------------------


@query
def route_sources(spark, sf):
    foreign = v.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source")
    entries = v.lake(spark, sf).select("id", "source").unionByName(foreign)
    return lake_io.routed(entries).select("id", "source", "family")


def _drinking_rows(spark, sf):
    return water.drinking_rows(parse.drinking_water_records(v.lake(spark, sf)))[0]


@query
def date_gate(spark, sf):
    ok, rejects = m.date_gate(_drinking_rows(spark, sf), reference.dim_date(spark), "date_value")
    ok = ok.withColumn("reason", F.lit(None).cast("string"))
    return ok.unionByName(rejects).select("id", "date_value", "hour_of_day", "reason")


@query
def clamp_future(spark, sf):
    return m.clamp_future(v.measures(spark, sf), v.as_of()).select(
        "city_id", "lake_hour", "captured_at", "capture_date"
    )


@query
def time_window_filter(spark, sf):
    return m.recent(v.measures(spark, sf), v.as_of(), 24).select("city_id", "lake_hour", "captured_at")


# Joins and dimensions --------------------------------------------------------------------


@query
def combine_weather_air(spark, sf):
    return v.measures(spark, sf).select(
        "city_id", "lake_hour", "captured_at", "raw_weather_id", "raw_aqi_id", *m.MEASURE_FIELDS
    )


@query
def weather_condition_lookup(spark, sf):
    return m.with_condition(v.measures(spark, sf), reference.dim_weather_condition(spark)).select(
        "city_id", "lake_hour", "weather_id", "weather_condition_id"
    )


@query
def aqi_level_lookup(spark, sf):
    rows = v.measures(spark, sf).select("city_id", "lake_hour", "aqi_index")
    return m.with_aqi_level(rows, reference.dim_air_quality_level(spark)).withColumn(
        "by_expression", m.aqi_level_id("aqi_index")
    )


def _flows(spark, sf):
    return _staged(parse.flow_records(v.lake(spark, sf)))


def _points(spark, flows):
    """The points of the first day exist; the others are created."""
    early = flows.filter(F.col("collected_at") < "2024-01-02")
    known = dimensions.traffic_points(_empty(spark, dimensions.TRAFFIC_POINT), early)
    return warehouse.stage(dimensions.traffic_points(warehouse.stage(known, "points"), flows), "points")


@query
def dim_traffic_point_upsert(spark, sf):
    return _points(spark, _flows(spark, sf))


@query
def dim_incident_category_upsert(spark, sf):
    return dimensions.incident_categories(
        _empty(spark, dimensions.INCIDENT_CATEGORY), parse.incident_records(v.lake(spark, sf)), use_labels=True
    )


@query
def dim_commune_upsert(spark, sf):
    return dimensions.communes(
        _empty(spark, dimensions.COMMUNE), parse.drinking_water_records(v.lake(spark, sf))
    )


def _stations(spark, sf, observations):
    stations = dimensions.stations(
        _empty(spark, dimensions.STATION), parse.river_station_records(v.station_lake(spark, sf)), observations
    )
    return warehouse.stage(stations, "stations")


@query
def dim_station_upsert(spark, sf):
    return _stations(spark, sf, parse.river_obs_records(v.lake(spark, sf)))


def _stats(spark, sf):
    return warehouse.stage(anomalies.city_stats(v.measures(spark, sf), v.as_of()), "city-stats")


@query
def city_stats_join(spark, sf):
    joined = anomalies.with_city_stats(v.measures(spark, sf), _stats(spark, sf))
    return joined.select(
        "city_id", "lake_hour", "temperature", _r("mean_temperature").alias("mean_temperature"),
        _r("std_temperature").alias("std_temperature"),
    )


@query
def expected_cities_missing(spark, sf):
    end = F.lit(dt.datetime(2024, 1, 30, 23, tzinfo=dt.timezone.utc))
    return dimensions.missing_cities(m.recent(v.measures(spark, sf), end, 1), reference.dim_city(spark))


# Deduplication and loading -----------------------------------------------------------------


@query
def dedup_source_hour(spark, sf):
    return m.marked_duplicates(v.lake(spark, sf)).select("id", "city_id", "source", "kept")


@query
def incomplete_measures(spark, sf):
    return m.incomplete(v.measures(spark, sf), v.as_of()).withColumn("age_hours", _r("age_hours", 4))


@query
def fact_measures_upsert(spark, sf):
    lake = v.lake(spark, sf)
    old = parse.parse_weather(lake).select(
        F.col("id").alias("measure_id"), "city_id", expr.hour_of(F.col("collected_at")).alias("captured_at"),
        "temperature", "humidity", F.lit(None).cast("int").alias("aqi_index"), F.lit(None).cast("double").alias("pm25"),
        F.lit(False).alias("is_anomaly"),
    )
    new = parse.parse_air_quality(lake).select(
        "id", "city_id", expr.hour_of(F.col("collected_at")).alias("captured_at"),
        F.when(F.col("pm25") > 50, F.col("pm25")).alias("temperature"),
        "aqi_index", "pm25", F.lit(True).alias("is_anomaly"),
    )
    return m.upsert_measures(old.drop("humidity"), new, "id")


def _early(df):
    return df.filter(F.col("collected_at") < "2024-01-10")


def _flow_facts(spark, sf):
    flows = _flows(spark, sf)
    return traffic.load_flow(_empty(spark, traffic.FLOW_FACT), flows, _points(spark, flows))


@query
def fact_flow_load(spark, sf):
    flows = _flows(spark, sf)
    points = _points(spark, flows)
    old = warehouse.stage(traffic.load_flow(_empty(spark, traffic.FLOW_FACT), _early(flows), points), "flow")
    return traffic.load_flow(old, flows, points).withColumns(
        {"congestion_ratio": _r("congestion_ratio"), "speed_ratio": _r("speed_ratio")}
    )


@query
def incident_severity(spark, sf):
    scored, _ = traffic.scored_incidents(parse.incident_records(v.lake(spark, sf)))
    return scored.select("id", "categorie_incident", "gravite_retard", "retard_s", "incident_severity_score")


def _incident_facts(spark, sf):
    incidents = _staged(parse.incident_records(v.lake(spark, sf)))
    categories = dimensions.incident_categories(_empty(spark, dimensions.INCIDENT_CATEGORY), incidents)
    return traffic.load_incidents(incidents, warehouse.stage(categories, "categories"))


@query
def fact_incident_load(spark, sf):
    return _incident_facts(spark, sf).withColumn("retard_moyen_s", _r("retard_moyen_s", 4))


@query
def fact_drinking_water_load(spark, sf):
    records = _staged(parse.drinking_water_records(v.lake(spark, sf)))
    old = warehouse.stage(water.load_drinking_water(_empty(spark, water.DRINKING_FACT), _early(records)), "water")
    return water.load_drinking_water(old, records)


@query
def fact_river_load(spark, sf):
    observations = _staged(parse.river_obs_records(v.lake(spark, sf)))
    stations = _stations(spark, sf, observations)
    old = warehouse.stage(water.load_river(_empty(spark, water.RIVER_FACT), _early(observations), stations), "river")
    return water.load_river(old, observations, stations)


@query
def fact_groundwater_load(spark, sf):
    readings = _staged(parse.groundwater_records(v.groundwater_lake(spark, sf)))
    stations = warehouse.stage(
        dimensions.groundwater_stations(_empty(spark, dimensions.GROUNDWATER_STATION), readings), "stations"
    )
    old = _empty(spark, "groundwater_station_id INT, measured_at TIMESTAMP")
    return water.load_groundwater(old, readings, stations)


# Anomalies -----------------------------------------------------------------------------------


@query
def business_rules(spark, sf):
    return anomalies.rule_hits(v.measures(spark, sf)).drop("anomaly_score")


@query
def city_stats(spark, sf):
    stats = _stats(spark, sf)
    return stats.select("city_id", *(_r(c).alias(c) for c in stats.columns if c != "city_id"))


_HIT_NUMBERS = ("expected_range_min", "expected_range_max", "anomaly_score")


@query
def zscore_anomalies(spark, sf):
    hits = anomalies.zscore_hits(v.measures(spark, sf), _stats(spark, sf))
    return hits.drop("description").withColumns({c: _r(c, 4) for c in _HIT_NUMBERS})


def _forest(spark, sf):
    judged = anomalies.judge(v.measures(spark, sf)).withColumn(
        "measure_id", m.measure_id()
    )
    return judged, forest.train_forest(judged)


@query
def iforest_train(spark, sf):
    """The nodes of a forest trained on the whole history, and its threshold."""
    _, model = _forest(spark, sf)
    if model is None:
        return _empty(spark, f"{forest.NODES}, threshold DOUBLE")
    return model.nodes.withColumns({"cut": _r("cut"), "threshold": F.lit(model.threshold)})


@query
def iforest_score(spark, sf):
    judged, model = _forest(spark, sf)
    hits = anomalies.rule_hits(judged).limit(0) if model is None else forest.forest_hits(judged, model)
    return hits.select("city_id", "lake_hour", "captured_at", "severity", "field_name", "anomaly_score", "action_taken")


def _judged(spark, sf):
    return anomalies.judge(v.measures(spark, sf), _stats(spark, sf))


@query
def combine_anomalies(spark, sf):
    return _judged(spark, sf).select(
        "city_id", "lake_hour", F.size("hits").alias("n_hits"), "is_anomaly",
        _r("anomaly_score", 4).alias("anomaly_score"), "is_rejected",
    )


@query
def reject_or_load(spark, sf):
    loaded, rejected, stored = anomalies.split_critical(_judged(spark, sf))
    verdict = loaded.select("city_id", "lake_hour", F.lit("loaded").alias("outcome")).unionByName(
        rejected.select("city_id", "lake_hour", F.lit("rejected").alias("outcome"))
    )
    n = stored.groupBy("city_id", "lake_hour").agg(F.count("*").alias("stored_hits"))
    return verdict.join(n, ["city_id", "lake_hour"], "left").fillna(0, ["stored_hits"])


@query
def measure_anomalies_format(spark, sf):
    stored = anomalies.stored_hits(_judged(spark, sf))
    rows = anomalies.format_hits(stored, reference.dim_city(spark))
    text = F.when(F.col("anomaly_type") == "business_rule", F.col("description"))
    return rows.withColumns({"description": text, **{c: _r(c, 4) for c in _HIT_NUMBERS}})


@query
def rolling_zscore_30d(spark, sf):
    rows = _staged(v.facts(spark, sf).select("measure_id", "city_id", "captured_at", "temperature"))
    scored = rolling.rolling_z(rows, "city_id", "captured_at", "temperature", 30)
    return scored.select("city_id", "captured_at", "temperature", _r("temperature_z_30d", 4).alias("z"))


@query
def groundwater_trend_7d(spark, sf):
    readings = _staged(
        parse.groundwater_records(v.groundwater_lake(spark, sf)).select(
            "id", "code_bss", "measured_at", "groundwater_level_ngf_m"
        )
    )
    trend = rolling.rolling_mean(readings, "code_bss", "measured_at", "groundwater_level_ngf_m", 7)
    return trend.select("id", "code_bss", _r("groundwater_level_ngf_m_mean_7d", 4).alias("mean_7d"))


# Quality -----------------------------------------------------------------------------------------


#: A window that leaves out no fact.
ALL_HOURS = 24 * 365 * 200


def _union(spark, sf, hours=24 * 40, as_of=None):
    """Fact rows of all measures, those outside the physical limits included."""
    at = v.as_of() if as_of is None else as_of
    measures = v.as_facts(spark, v.measures(spark, sf))
    union = quality.union_facts(measures, _flow_facts(spark, sf), _incident_facts(spark, sf), at, hours)
    return warehouse.stage(union, "facts")


@query
def dq_union_facts(spark, sf):
    return _union(spark, sf, 72).select(
        "table_source", "city_id", "captured_at", "capture_date", "temperature", "speed_ratio",
        "incident_severity_score",
    ).withColumn("speed_ratio", _r("speed_ratio"))


@query
def dq_missing(spark, sf):
    """One issue per empty day, from the first fact's to the one after the last fact's."""
    return quality.check_missing_windows(_union(spark, sf, ALL_HOURS), 24).drop("details")


@query
def dq_nulls(spark, sf):
    """Measures without air data have no AQI time; the lake's second source is optional."""
    rows = v.measures(spark, sf).select(
        F.when(F.col("weather_lake_id").isNotNull(), F.col("city_id")).alias("city_id"),
        F.to_date("weather_at").alias("capture_date"),
        F.col("air_at").alias("captured_at"),
    )
    return quality.check_nulls(rows).drop("details")


def _entry_facts(spark, sf):
    """Weather entries as facts on their full hour, so that hours repeat."""
    rows = v.lake(spark, sf).filter(F.col("source") == schemas.WEATHER)
    return rows.select(
        F.col("id").alias("measure_id"), "city_id", expr.hour_of(F.col("collected_at")).alias("captured_at"),
        F.col("collected_at").alias("created_at"), F.lit("fact_measures").alias("table_source"),
    )


@query
def dq_duplicates(spark, sf):
    return quality.duplicate_groups(_entry_facts(spark, sf)).select(
        "table_source", "city_id", "captured_at", "copies"
    )


@query
def dq_temporal(spark, sf):
    return quality.temporal_counts(_union(spark, sf), v.as_of())


@query
def dq_gaps(spark, sf):
    return quality.gaps(_union(spark, sf)).withColumn("gap_hours", _r("gap_hours", 4))


@query
def dq_limits(spark, sf):
    counts = quality.limit_counts(_union(spark, sf))
    return counts.select("field", "violations", F.explode("examples").alias("e")).select(
        "field", "violations", "e.rank", "e.city_id", "e.captured_at", _r(F.col("e.value"), 4).alias("value"),
        "e.limits",
    )


@query
def dq_coverage(spark, sf):
    """Cities without or with few facts, per table and day; over all facts no city is short of any."""
    facts = _union(spark, sf, ALL_HOURS)
    return quality.check_coverage(facts, reference.dim_city(spark), ["table_source", "capture_date"]).drop("details")


@query
def dq_outliers(spark, sf):
    found = quality.outliers(_union(spark, sf))
    return found.select(
        "field", "outliers", *(_r(c, 4).alias(c) for c in ("percentage", "mean", "std", "max_z_score"))
    )


def _issues(spark, sf):
    checks = quality.all_checks(_union(spark, sf), reference.dim_city(spark), v.as_of(), 960)
    return quality.issue_rows(checks, F.lit("run-1"), v.as_of(), 960)


def _counts_text():
    """What the details of an issue count, as ``key=n`` in order."""

    def text(fields, items, key, n):
        found = F.from_json("details", fields)[items]
        each = F.transform(found, lambda x: F.concat(x[key].cast("string"), F.lit("="), x[n].cast("string")))
        return F.when(found.isNotNull(), F.concat_ws(";", F.array_sort(each)))

    low = F.from_json("details", "cities MAP<STRING, STRUCT<n: BIGINT>>")["cities"]
    cities = F.transform(F.map_entries(low), lambda x: F.concat(x["key"], F.lit("="), x["value"]["n"].cast("string")))
    return F.coalesce(
        text("gaps ARRAY<STRUCT<city_id: INT, n: BIGINT>>", "gaps", "city_id", "n"),
        text("violations ARRAY<STRUCT<field: STRING, violations: BIGINT>>", "violations", "field", "violations"),
        text("outliers ARRAY<STRUCT<field: STRING, outliers: BIGINT>>", "outliers", "field", "outliers"),
        F.when(low.isNotNull(), F.concat_ws(";", F.array_sort(cities))),
    )


@query
def dq_issue_rows(spark, sf):
    return _issues(spark, sf).withColumn("details", _counts_text())


@query
def dq_report(spark, sf):
    return quality.report(_issues(spark, sf), strict=True)


@query
def cleanup_duplicates(spark, sf):
    return quality.find_duplicates(_entry_facts(spark, sf)).select("measure_id", "city_id", "captured_at")


@query
def cleanup_future(spark, sf):
    return quality.find_future(_entry_facts(spark, sf), v.as_of()).select("measure_id", "captured_at")


@query
def cleanup_report(spark, sf):
    facts = _entry_facts(spark, sf)
    real = quality.cleanup_counts(facts, v.as_of()).withColumn("dry_run", F.lit(False))
    return real.unionByName(quality.cleanup_counts(facts, v.as_of(), True).withColumn("dry_run", F.lit(True)))


# Dimensions as data ---------------------------------------------------------------------------


def _order_days(spark, sf):
    return v.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_value"))


@query
def dim_date_build(spark, sf):
    return reference.extend_dim_date(reference.dim_date(spark), _order_days(spark, sf))


def _used(dim, facts, key):
    used = facts.groupBy(key).agg(F.count("*").alias("used"))
    return dim.join(used, key, "left").fillna(0, ["used"])


@query
def dim_aqi_seed(spark, sf):
    return _used(reference.dim_air_quality_level(spark), v.facts(spark, sf), "aqi_level_id")


@query
def dim_weather_seed(spark, sf):
    return _used(reference.dim_weather_condition(spark), v.facts(spark, sf), "weather_condition_id")


@query
def dim_city_seed(spark, sf):
    return _used(reference.dim_city(spark), v.facts(spark, sf), "city_id").select(
        "city_id", "city_name", "latitude", "longitude", "country", "used"
    )


# Reports ---------------------------------------------------------------------------------------


def _dims(spark):
    return (
        reference.dim_city(spark),
        reference.dim_date(spark),
        reference.dim_weather_condition(spark),
        reference.dim_air_quality_level(spark),
    )


NOW = dt.datetime(2025, 3, 15, 12, tzinfo=dt.timezone.utc)


@query
def fact_star_view(spark, sf):
    city, date, _, _ = _dims(spark)
    return olap.star_view(v.facts(spark, sf), city, date).select(
        "measure_id", "captured_at", "dim_city.city_name", "dim_date.month_name", "dim_date.season"
    )


@query
def q01_monthly_city(spark, sf):
    city, date, _, _ = _dims(spark)
    return olap.monthly_city(v.facts(spark, sf), date, city)


@query
def q02_hourly_profile(spark, sf):
    return olap.hourly_profile(v.facts(spark, sf), reference.dim_date(spark))


@query
def q03_weekend_vs_week(spark, sf):
    return olap.weekend_vs_week(v.facts(spark, sf), reference.dim_date(spark))


@query
def q04_city_air_ranking(spark, sf):
    return olap.city_air_ranking(v.facts(spark, sf), reference.dim_city(spark))


@query
def q05_hottest_coldest(spark, sf):
    return olap.hottest_coldest(v.facts(spark, sf), reference.dim_city(spark))


@query
def q06_weather_distribution(spark, sf):
    return olap.weather_distribution(v.facts(spark, sf), reference.dim_weather_condition(spark))


@query
def q07_temp_by_weather(spark, sf):
    return olap.temp_by_weather(v.facts(spark, sf), reference.dim_weather_condition(spark))


@query
def q08_aqi_level_share(spark, sf):
    return olap.aqi_level_share(v.facts(spark, sf), reference.dim_air_quality_level(spark))


@query
def q09_pollution_alerts(spark, sf):
    city, date, _, aqi = _dims(spark)
    return olap.pollution_alerts(v.facts(spark, sf), city, aqi, date)


@query
def q10_cube(spark, sf):
    city, date, _, aqi = _dims(spark)
    return olap.cube(v.facts(spark, sf), city, date, aqi, 2025)


@query
def q11_aqi_by_temp_band(spark, sf):
    return olap.aqi_by_temp_band(v.facts(spark, sf), reference.dim_city(spark))


@query
def q12_season_pollution(spark, sf):
    return olap.season_pollution(v.facts(spark, sf), reference.dim_date(spark))


@query
def q13_kpi_24h(spark, sf):
    city, date, _, _ = _dims(spark)
    return olap.kpi_24h(v.facts(spark, sf), city, date, F.lit(NOW))


@query
def q14_top5_now(spark, sf):
    city, date, weather, _ = _dims(spark)
    return olap.top5_now(v.facts(spark, sf), city, weather, date, F.lit(NOW))


@query
def q15_monthly_mv(spark, sf):
    """The view that the transform keeps, after a first run and one over entries that came late."""
    path, root = shared_folder(spark, "lake"), shared_folder(spark, "warehouse")
    entries = v.lake(spark, sf, months=True).filter(F.col("source").isin(schemas.WEATHER, schemas.AIR))
    late = F.pmod(F.xxhash64("id"), F.lit(10)) == 0
    for part in (~late, late):
        lake_io.append_lake(entries.filter(part), path)
        transform.run_transform(spark, path, root, v.LATE)
    return transform.monthly_averages(spark, root)


@query
def q16_dim_date_stats(spark, sf):
    days = reference.date_attributes(_order_days(spark, sf).distinct())
    return olap.dim_date_stats(days)


@query
def q17_daily_measures(spark, sf):
    return olap.daily_measures(v.facts(spark, sf), reference.dim_date(spark))


def _issue_history(spark, sf):
    """Incidents of the lake as issues of daily validation runs."""
    ev = v.events(spark, sf).filter(F.col("event_type") == "error")
    severity = F.element_at(F.array(*(F.lit(s) for s in ("critical", "warning", "info"))), F.col("k") % 3 + 1)
    return ev.select(
        F.concat(F.lit("run-"), F.hour("collected_at")).alias("validation_run_id"),
        severity.alias("severity"),
        F.concat(F.lit("category_"), F.col("k") % 5).alias("category"),
        F.col("collected_at").alias("detected_at"),
    )


@query
def q18_anomalies_daily(spark, sf):
    return olap.issues_daily(_issue_history(spark, sf))


@query
def q19_anomalies_summary(spark, sf):
    return olap.issues_summary(_issue_history(spark, sf))


# Streaming ---------------------------------------------------------------------------------------


def _lake_files(spark, sf) -> str:
    path = shared_folder(spark, "lake")
    lake_io.append_lake(v.lake(spark, sf), path)
    return path


@query
def stream_transform(spark, sf):
    path, root = _lake_files(spark, sf), shared_folder(spark, "warehouse")
    jobs.stream_transform(
        spark, path, root, shared_folder(spark, "offsets"), clock=lambda: v.LATE, files_per_batch=100,
        trigger={"availableNow": True},
    ).awaitTermination()
    return transform.fact_measures(spark, root).select(
        "city_id", "lake_hour", "captured_at", "capture_date", "weather_condition_id", "aqi_level_id", "temperature",
        "humidity", "aqi_index", "pm25", "rain_1h", "raw_weather_id", "raw_aqi_id",
    )


@query
def stream_drain(spark, sf):
    """Outcomes of all entries, some of which cannot be read, lack a key or don't fit."""
    path, root = _lake_files(spark, sf), shared_folder(spark, "warehouse")
    lake_io.append_lake(v.broken_entries(spark, sf), path)
    jobs.stream_drain(spark, path, root, shared_folder(spark, "offsets"), clock=lambda: v.LATE)
    return warehouse.read_table(spark, root, "lake_processed", transform.PROCESSED).select("id", "outcome")


@query
def stream_hourly_dedup(spark, sf):
    path, root = _lake_files(spark, sf), shared_folder(spark, "warehouse")
    jobs.stream_hours(spark, path, root, "hourly", jobs.WINNERS, shared_folder(spark, "offsets"), files_per_batch=100).awaitTermination()
    return jobs.read_hours(spark, root, "hourly", jobs.WINNERS).select("lake_hour", "city_id", "source", "id", "collected_at")


@query
def stream_incidents_hourly(spark, sf):
    path, root = _lake_files(spark, sf), shared_folder(spark, "warehouse")
    jobs.stream_hours(spark, path, root, "incidents", jobs.INCIDENTS, shared_folder(spark, "offsets"), files_per_batch=100).awaitTermination()
    return jobs.read_hours(spark, root, "incidents", jobs.INCIDENTS).select(
        F.col("lake_date").alias("date_value"), F.hour("lake_hour").alias("hour_of_day"), "city_id", "categorie_incident",
        "traffic_model_id", "nombre_incidents", "retard_total_s", _r("retard_moyen_s", 4).alias("retard_moyen_s"),
        "longueur_moyenne_m", "incident_severity_score",
    )
