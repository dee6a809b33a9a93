"""The transform job: lake entries to facts, dimensions, anomalies and outcomes."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ecostar import schemas
from ecostar.functions import expr, payload
from ecostar.operators import anomalies, dimensions, forest as iforest, measures as m, parse, traffic, water
from ecostar.plans import olap
from ecostar.sources import done, lake as lake_io, reference
from ecostar.sources.warehouse import Batch, read_table, recover, stage, staged_days, staging

HITS = (
    "ARRAY<STRUCT<anomaly_type: STRING, severity: STRING, field_name: STRING, actual_value: DOUBLE, "
    "expected_range_min: DOUBLE, expected_range_max: DOUBLE, anomaly_score: DOUBLE, description: STRING, "
    "action_taken: STRING>>"
)

# Every judged city-hour is one row, the rejected ones included, so recomputing an
# hour always replaces its row. ``fact_measures`` is the part that was not rejected.
JUDGED = (
    "measure_id BIGINT, city_id INT, lake_hour TIMESTAMP, captured_at TIMESTAMP, capture_date DATE, "
    "capture_hour INT, weather_condition_id INT, aqi_level_id INT, "
    + ", ".join(f"{n} {t}" for n, t in schemas.MEASURE_TYPES.items())
    + ", is_anomaly BOOLEAN, anomaly_score DOUBLE, raw_weather_id BIGINT, raw_aqi_id BIGINT, "
    f"created_at TIMESTAMP, hits {HITS}, reject_reason STRING, lake_date DATE"
)
PROCESSED = "id BIGINT, processed_at TIMESTAMP, outcome STRING"


def judged_measures(
    lake: DataFrame, as_of: Column, stats: DataFrame | None = None, forest: iforest.Forest | None = None
) -> DataFrame:
    """Lake entries to judged measures: combined, checked and scored."""
    combined = m.combine(lake)
    if forest is not None:
        combined = iforest.scored_measures(combined, forest)
    return anomalies.judge(combined, stats, forest.threshold if forest else None)


def judged_rows(
    judged: DataFrame, dim_weather: DataFrame, dim_date: DataFrame, as_of: Column
) -> DataFrame:
    """Rows of the judged table, with the reason where a row is not a fact."""
    reason = F.when(F.col("is_rejected"), "critical_anomaly").when(~m.fits_warehouse(), "numeric_overflow")
    keyed = judged.withColumn("reject_reason", reason)
    facts = m.to_facts(keyed, dim_weather, as_of, as_of, keep=("hits", "reject_reason"))
    days = dim_date.select(F.col("date_value").alias("capture_date"), F.lit(True).alias("_known"))
    return (
        facts.join(days, "capture_date", "left")
        .withColumn(
            "reject_reason",
            F.coalesce("reject_reason", F.when(F.col("_known").isNull(), F.lit("date_out_of_range"))),
        )
        .withColumn("lake_date", F.to_date("lake_hour"))
        .drop("_known")
    )


def facts_of(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reject_reason").isNull()).drop("hits", "reject_reason")


def fact_measures(spark: SparkSession, root: str, since: Column | None = None) -> DataFrame:
    """The fact table; ``since`` prunes partitions whose captures all lie before that instant.

    A capture never lies after its lake hour, so the lake date bounds it.
    """
    judged = read_table(spark, root, "judged_measures", JUDGED)
    if since is not None:
        judged = judged.filter(F.col("lake_date") >= F.to_date(since))
    return facts_of(judged)


def measure_anomalies(spark: SparkSession, root: str) -> DataFrame:
    judged = read_table(spark, root, "judged_measures", JUDGED).withColumn(
        "is_rejected", F.coalesce(F.col("reject_reason") == "critical_anomaly", F.lit(False))
    )
    return anomalies.format_hits(anomalies.stored_hits(judged), reference.dim_city(spark))


def write_judged(writes: Batch, days: DataFrame) -> None:
    """Whole days of judged measures, and the parts of the monthly averages that come from them."""
    written = writes.write(days, "judged_measures", "lake_date", replace=True)
    writes.write(olap.monthly_states(written), "monthly_state", "lake_date", replace=True)


def monthly_averages(spark: SparkSession, root: str) -> DataFrame:
    """The monthly view, as of the last batch: only the days' parts are read, no facts."""
    states = read_table(spark, root, "monthly_state", olap.MONTHLY_STATE)
    return olap.monthly_averages(states, reference.dim_city(spark), reference.dim_date(spark))


def touched(batch: DataFrame, *sources: str) -> DataFrame:
    """The city-hours of a batch's entries."""
    return (
        batch.filter(F.col("source").isin(*sources))
        .select(
            "city_id",
            expr.hour_of(F.col("collected_at")).alias("lake_hour"),
            F.to_date("collected_at").alias("collected_date"),
        )
        .distinct()
    )


def affected(lake: DataFrame, hours: DataFrame, *sources: str) -> DataFrame:
    """All lake entries of the touched city-hours; the date prunes lake folders."""
    return (
        lake.filter(F.col("source").isin(*sources))
        .withColumn("lake_hour", expr.hour_of(F.col("collected_at")))
        .join(hours, ["collected_date", "city_id", "lake_hour"], "left_semi")
        .drop("lake_hour")
    )


def deciding(lake: DataFrame, hours: DataFrame, *sources: str) -> DataFrame:
    """Of the touched city-hours, the entries with the largest id per source: only their payloads need to be parsed.

    Ids meet without payloads first. Where no entry of an hour has an id, all of them stay.
    """
    keys = ["collected_date", "city_id", "lake_hour", "source"]
    hour = expr.hour_of(F.col("collected_at"))
    entries = affected(lake, hours, *sources).withColumn("lake_hour", hour)
    winners = staged_days(entries.groupBy(*keys).agg(F.max("id").alias("winner")), "collected_date")
    found = lake.filter(F.col("source").isin(*sources)).withColumn("lake_hour", hour).alias("e").join(
        winners.alias("w"),
        [*(F.col(f"e.{k}") == F.col(f"w.{k}") for k in keys), F.col("e.id").eqNullSafe(F.col("w.winner"))],
        "left_semi",
    )
    return found.drop("lake_hour")


def readable(entries: DataFrame) -> DataFrame:
    """Entries whose payload is a whole JSON object."""
    return entries.filter(payload.is_readable(payload.payload_text(F.col("raw_data"))))


def staged_batch(entries: DataFrame) -> DataFrame:
    """The entries that ``run_batch`` works on, written once with ``readable``: whether the payload is a whole JSON object.

    A file of the lake holds one source, and sources differ in their work. So the entries
    are dealt out by id, and every source is spread over all tasks; within a file they are
    ordered by source, so that a step that wants one source skips the pages of the others.
    """
    is_whole = payload.is_readable(payload.payload_text(F.col("raw_data")))
    dealt = entries.hint("rebalance", "id").withColumn("readable", is_whole)
    return stage(dealt.sortWithinPartitions("source"), "batch")


def run_batch(
    spark: SparkSession,
    batch: DataFrame,
    lake: DataFrame,
    root: str,
    as_of: dt.datetime,
    forest: iforest.Forest | None = None,
    stats: DataFrame | None = None,
    stream: str | None = None,
    epoch: int = 0,
) -> None:
    """Transform one batch of lake entries, as ``staged_batch`` wrote it, into the warehouse under ``root``.

    Touched city-hours are computed anew from the whole lake and replace their
    rows, so with fixed ``stats`` the result does not depend on how the entries were
    cut into batches. Without, the statistics are those of the facts before the batch.
    Records that feed both a dimension and a fact are parsed once and staged. So are
    the touched hours and the city statistics: from their real size the planner sees
    whether it may broadcast them, and a broadcast prunes the partitions to read.

    All tables are written through the ledger (``warehouse.Batch``): a batch that is cut
    off at any point and run again leaves the same tables. Every entry gets an outcome,
    ``processed`` or why it failed.
    """
    with staging(spark):
        writes = Batch(spark, root, stream, epoch)
        if not writes.published:
            _run_batch(spark, batch, lake, root, as_of, forest, stats, writes)
            writes.commit()


def _run_batch(spark, batch, lake, root, as_of, forest, stats, writes) -> None:
    begun, at = time.monotonic(), F.lit(as_of)
    dim_date, dim_weather = reference.dim_date(spark), reference.dim_weather_condition(spark)
    known = [s for family in schemas.FAMILIES.values() for s in family]
    present = {r["source"] for r in batch.filter(F.col("source").isin(*known)).select("source").distinct().collect()}
    contract = batch.filter("readable")
    unreadable = batch.filter(F.col("source").isin(*known) & ~F.col("readable"))
    rejects = [
        lake_io.rejected_sources(batch).select("id", "reason"),
        unreadable.select("id", F.lit("bad_payload").alias("reason")),
    ]

    def lacking(records: DataFrame, key: str) -> DataFrame:
        return records.filter(F.col(key).isNull()).select("id", F.lit("missing_key").alias("reason"))

    def dated(rows: DataFrame) -> DataFrame:
        """Rows of known days; the others are rejects."""
        ok, no_date = m.date_gate(rows, dim_date, "date_value")
        rejects.append(no_date.select("id", "reason"))
        return ok

    if present & {schemas.WEATHER, schemas.AIR}:
        city_hours = staged_days(touched(batch, schemas.WEATHER, schemas.AIR), "collected_date")
        old = read_table(spark, root, "judged_measures", JUDGED)
        if stats is None:
            month = fact_measures(spark, root, at - F.make_dt_interval(days=F.lit(30)))
            stats = stage(anomalies.city_stats(month, at, 30), "city-stats")
        judged = judged_measures(deciding(lake, city_hours, schemas.WEATHER, schemas.AIR), at, stats, forest)
        fresh = judged_rows(judged, dim_weather, dim_date, at)
        keys = city_hours.select("city_id", "lake_hour")
        same_days = old.join(
            city_hours.select(F.col("collected_date").alias("lake_date")).distinct(), "lake_date", "left_semi"
        )
        kept = same_days.join(keys, ["city_id", "lake_hour"], "left_anti")
        write_judged(writes, kept.unionByName(fresh))
        rejects.append(m.reading_rejects(m.readings(batch), dim_date, at))

    if schemas.FLOW in present:
        flows = stage(parse.flow_records(contract), "flow-records").withColumn("date_value", F.to_date("collected_at"))
        rejects.append(lacking(flows, "code_point"))
        flows = dated(flows).drop("date_value")
        points = _grow_dimension(
            writes, "dim_traffic_point", dimensions.TRAFFIC_POINT,
            lambda dim: dimensions.traffic_points(dim, flows), ["city_id", "code_point"],
        )
        old_flow = read_table(spark, root, "fact_traffic_flow_hourly", traffic.FLOW_FACT)
        new_flow = traffic.load_flow(old_flow, flows, points, within="date_value").drop("id")
        writes.write(new_flow, "fact_traffic_flow_hourly", "date_value")

    if schemas.INCIDENTS in present:
        hours = staged_days(touched(batch, schemas.INCIDENTS), "collected_date")
        incidents = stage(parse.incident_records(readable(affected(lake, hours, schemas.INCIDENTS))), "incident-records")
        incidents = dated(incidents.withColumn("date_value", F.to_date("collected_at")))
        rejects += [lacking(incidents, "categorie_incident"), traffic.scored_incidents(incidents)[1].select("id", "reason")]
        categories = _grow_dimension(
            writes, "dim_incident_category", dimensions.INCIDENT_CATEGORY,
            lambda dim: dimensions.incident_categories(dim, incidents), ["icon_category"],
        )
        new_incidents = traffic.load_incidents(incidents.drop("date_value"), categories)
        old_incidents = read_table(spark, root, "fact_traffic_incident_hourly", traffic.INCIDENT_FACT)
        hour_keys = hours.select(
            "city_id", F.col("collected_date").alias("date_value"), F.hour("lake_hour").alias("hour_of_day")
        )
        kept = old_incidents.join(
            hour_keys.select("date_value").distinct(), "date_value", "left_semi"
        ).join(hour_keys, ["date_value", "hour_of_day", "city_id"], "left_anti")
        writes.write(kept.unionByName(new_incidents), "fact_traffic_incident_hourly", "date_value", replace=True)

    if schemas.DRINKING_WATER in present:
        drinking = stage(parse.drinking_water_records(contract), "water-records")
        _grow_dimension(
            writes, "dim_eau_potable_commune", dimensions.COMMUNE,
            lambda dim: dimensions.communes(dim, drinking), ["code_commune"],
        )
        rows, bad = water.drinking_rows(drinking)
        rejects.append(bad)
        old_water = read_table(spark, root, "fact_eau_potable", water.DRINKING_FACT)
        fresh_water = water.keep_first(old_water, dated(rows), water.DRINKING_KEY, within="date_value").drop("id")
        writes.write(fresh_water, "fact_eau_potable", "date_value")

    if present & {schemas.RIVER_STATIONS, schemas.RIVER_OBSERVATIONS}:
        observations = stage(parse.river_obs_records(contract), "river-records")
        described = parse.river_station_records(contract)
        rejects += [lacking(observations, "code_station"), lacking(described, "code_station")]
        stations = _grow_dimension(
            writes, "dim_cours_deau_station", dimensions.STATION,
            lambda dim: dimensions.stations(dim, described, observations), ["code_station"],
        )
        old_river = read_table(spark, root, "fact_cours_deau_observation", water.RIVER_FACT)
        rows = dated(water.river_rows(observations, stations))
        fresh_river = water.keep_first(old_river, rows, water.RIVER_KEY, within="date_value").drop("id")
        writes.write(fresh_river, "fact_cours_deau_observation", "date_value")

    # Outcomes: failed entries with their reason, all others as processed.
    reasons = rejects[0]
    for more in rejects[1:]:
        reasons = reasons.unionByName(more)
    reasons = reasons.groupBy("id").agg(F.min("reason").alias("reason"))
    outcome = batch.select("id").join(reasons, "id", "left").select(
        "id", at.alias("processed_at"), F.coalesce("reason", F.lit("processed")).alias("outcome")
    )
    told = writes.write(outcome, "lake_processed")
    ranges = read_table(spark, root, "done_ranges", done.RANGES)
    writes.write(done.with_ids(ranges, told.select("id")), "done_ranges", "span", replace=True)
    ok = told.select((F.col("outcome") == "processed").alias("ok"))
    writes.write(lake_io.run_log(ok, "transform", at, F.lit(time.monotonic() - begun)), "etl_log")


def _grow_dimension(writes: Batch, name: str, schema: str, grow, keys: list[str]) -> DataFrame:
    """The dimension with its new rows, which the batch will append."""
    dim = read_table(writes.spark, writes.root, name, schema)
    new = writes.write(grow(dim).join(dim.select(*keys), keys, "left_anti").select(*dim.columns), name)
    return dim.unionByName(new)


def run_transform(
    spark: SparkSession, lake_path: str, root: str, as_of: dt.datetime, batch_size: int | None = None,
    forest: iforest.Forest | None = None, stats: DataFrame | None = None, train: bool = False, train_rows: int | None = None,
) -> None:
    """Process the lowest unprocessed ids of the lake, all of them or at most ``batch_size``.

    ``train`` first grows a forest from the facts so far, the latest ``train_rows`` or all;
    with too few of them no forest is used.
    """
    recover(spark, root)
    lake = lake_io.load_lake(spark, lake_path)
    ranges = read_table(spark, root, "done_ranges", done.RANGES)
    with staging(spark):
        if train and forest is None:
            forest = iforest.train_forest(fact_measures(spark, root), train_rows)
        batch = staged_batch(lake_io.unprocessed(lake, ranges, batch_size))
        run_batch(spark, batch, lake, root, as_of, forest, stats)
