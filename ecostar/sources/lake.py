"""The raw lake: append-only entries, their outcomes and simple reads."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ecostar import schemas
from ecostar.session import delete_folder, list_folders
from ecostar.sources import done
from ecostar.sources.warehouse import number_rows, read_table, stage


def read_lake(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """Lake entries from JSON; nested ``raw_data`` is kept as text.

    JSON lines split over tasks. ``array_file`` reads exports that hold one
    JSON array per file.
    """
    return spark.read.schema(schemas.LAKE).option("multiLine", array_file).json(path)


def as_entries(df: DataFrame, ingested_at: Column) -> DataFrame:
    """Entries ready to append: API time, else ingestion time; not yet processed."""
    return df.select(
        "id",
        "city_id",
        "city_name",
        "source",
        "raw_data",
        F.coalesce("collected_at", ingested_at).alias("collected_at"),
        F.lit(False).alias("processed"),
        F.lit(None).cast("timestamp").alias("processed_at"),
    )


def with_ids(df: DataFrame, path: str, order: str | None = None) -> DataFrame:
    """Entries without an ``id``, numbered above the lake's largest one, in the order of a unique integer column if given."""
    spark = df.sparkSession
    root, _, name = path.rstrip("/").rpartition("/")
    largest = read_table(spark, root, name, schemas.LAKE + ", collected_date DATE").agg(F.max("id")).scalar()
    if order is None:  # written first, as these numbers change when a partition is computed again
        df, order = stage(df.withColumn("_place", F.monotonically_increasing_id()), "new-entries"), "_place"
    return number_rows(df, order, "id", largest).drop("_place")


def append_lake(df: DataFrame, path: str, ingested_at: Column | None = None) -> None:
    """Append entries, partitioned by source and day; entries without an ``id`` column get ids above all others.

    The rebalance hint lets the runtime split a hot (source, day) over several
    files and join small ones.
    """
    if "id" not in df.columns:
        df = with_ids(df, path)
    entries = as_entries(df, F.current_timestamp() if ingested_at is None else ingested_at)
    (
        entries.withColumn("collected_date", F.to_date("collected_at"))
        .hint("rebalance", "source", "collected_date")
        .write.mode("append")
        .partitionBy("source", "collected_date")
        .parquet(path)
    )


def load_lake(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LAKE + ", collected_date DATE").parquet(path)


# Microseconds survive a round trip through JSON only with an explicit format.
_JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def export_entries(entries: DataFrame, path: str) -> None:
    """Entries as JSON lines with the payload as an object, or as text where it is no JSON."""
    as_text = F.try_parse_json(F.to_json(F.struct(F.col("raw_data").alias("text"))))
    payload = F.coalesce(F.try_parse_json("raw_data"), F.try_variant_get(as_text, "$.text", "variant"))
    (
        entries.withColumn("raw_data", payload)
        .write.mode("overwrite")
        .option("timestampFormat", _JSON_TIME)
        .json(path)
    )


def export_city(lake: DataFrame, city_name: str, path: str) -> None:
    """One city's entries, newest first."""
    city = lake.filter(F.col("city_name") == city_name)
    export_entries(city.orderBy(F.desc("collected_at"), F.desc("id")), path)


def unprocessed(lake: DataFrame, ranges: DataFrame, n: int | None = 1000) -> DataFrame:
    """Entries whose id lies in none of the ``ranges`` of done ones, lowest ids first, at most ``n``.

    The ids are chosen without their payloads; the entries are then looked up by id
    and lake partition, so other partitions are not read.
    """
    keys = [c for c in ("source", "collected_date", "id") if c in lake.columns]
    open_ = done.pending(lake.filter(~F.coalesce("processed", F.lit(False))).select(*keys), ranges)
    if n is not None:
        open_ = open_.orderBy("id").limit(n)
    return lake.join(open_, keys, "left_semi")


def outcomes(df: DataFrame, at: Column, outcome: Column) -> DataFrame:
    """Rows for the outcome table, which stands in for an update of the lake."""
    return df.select("id", at.alias("processed_at"), outcome.alias("outcome"))


def mark_processed(df: DataFrame, at: Column, outcome: Column, path: str) -> None:
    outcomes(df, at, outcome).write.mode("append").parquet(path)


def latest_raw(lake: DataFrame, city_id: int | None = None, n: int = 10) -> DataFrame:
    """The last ``n`` weather and air entries of a city, or of every city."""
    rows = lake.filter(F.col("source").isin(schemas.WEATHER, schemas.AIR))
    if city_id is not None:
        rows = rows.filter(F.col("city_id") == city_id)
    newest = W.partitionBy("city_id", "source").orderBy(F.desc("collected_at"), F.desc("id"))
    return rows.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)


def pending_by_source(lake: DataFrame) -> DataFrame:
    return (
        lake.filter(~F.col("processed")).groupBy("source").agg(F.count("*").alias("pending"))
    )


def family_of(source: Column) -> Column:
    family = F.lit(None).cast("string")
    for name, sources in schemas.FAMILIES.items():
        family = F.when(source.isin(*sources), F.lit(name)).otherwise(family)
    return family


def routed(lake: DataFrame) -> DataFrame:
    """Entries with their ``family``, ``rejects`` for unknown sources; a sink splits them by that column."""
    return lake.withColumn("family", F.coalesce(family_of(F.col("source")), F.lit("rejects")))


def rejected_sources(lake: DataFrame) -> DataFrame:
    return routed(lake).filter("family = 'rejects'").withColumn("reason", F.lit("unknown_source"))


# Rows kept per city and pull.
SOURCE_CAPS = {schemas.INCIDENTS: 30, schemas.DRINKING_WATER: 20}


def cap_per_city(df: DataFrame, n: int, order: str = "id", pull: str = "hour") -> DataFrame:
    """The first ``n`` rows per city and pull, the collection rule of a source."""
    pull = W.partitionBy("city_id", F.date_trunc(pull, "collected_at")).orderBy(order)
    return df.withColumn("rank", F.row_number().over(pull)).filter(F.col("rank") <= n).drop("rank")


def cap_stations(
    observations: DataFrame, station: str = "code_station", order: str = "id", pull: str = "hour"
) -> DataFrame:
    """Observations of the first station only, per city and pull."""
    pulls = observations.withColumn("pull", F.date_trunc(pull, "collected_at"))
    first = pulls.groupBy("city_id", "pull").agg(F.min_by(station, order).alias(station))
    return pulls.join(first, ["city_id", "pull", station], "left_semi").drop("pull")


def run_status(errors: Column, successes: Column) -> Column:
    return F.when(errors == 0, "success").when(successes > 0, "warning").otherwise("error")


#: The log table that jobs append to.
RUN_LOG = (
    "execution_time TIMESTAMP, status STRING, source STRING, city_id INT, records_inserted BIGINT, "
    "error_message STRING, execution_duration_seconds DOUBLE"
)


def run_log(outcome: DataFrame, source: str, at: Column, seconds: Column) -> DataFrame:
    """One log row from a frame with a boolean column ``ok`` per unit of work."""
    counts = outcome.agg(
        F.count_if(F.col("ok")).alias("records_inserted"),
        F.count_if(~F.coalesce("ok", F.lit(False))).alias("errors"),
    )
    return counts.select(
        at.alias("execution_time"),
        run_status(F.col("errors"), F.col("records_inserted")).alias("status"),
        F.lit(source).alias("source"),
        F.lit(None).cast("int").alias("city_id"),
        "records_inserted",
        F.when(F.col("errors") > 0, F.concat(F.col("errors").cast("string"), F.lit(" échecs"))).alias("error_message"),
        seconds.cast("double").alias("execution_duration_seconds"),
    )


# Estimated bytes per row.
LAKE_ROW_BYTES = 2000
FACT_ROW_BYTES = 200


def footprint(lake: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """Row count and estimated MB per table."""

    def line(df: DataFrame, name: str, size: int) -> DataFrame:
        n = F.count("*")
        return df.agg(n.alias("row_count"), (n * size / 1048576.0).alias("mb")).select(
            F.lit(name).alias("table_name"), "row_count", "mb"
        )

    lines = line(lake, "raw_data_lake", LAKE_ROW_BYTES)
    for name, df in facts.items():
        lines = lines.unionByName(line(df, name, FACT_ROW_BYTES))
    return lines


def purge(spark: SparkSession, path: str, days: int, as_of: dt.date, dry_run: bool = False) -> list[tuple[str, str]]:
    """Drop the lake's days older than ``days`` before ``as_of``; returns their (source, day), a dry run only that.

    A day is a folder per source, so whole folders go and no entry is read. What was cut
    off is finished by the next run; entries without a time stay.
    """
    oldest, doomed = as_of - dt.timedelta(days=days), []
    for source in list_folders(spark, path):
        for day in list_folders(spark, f"{path}/{source}") if "=" in source else ():
            text = day.partition("=")[2]
            if re.fullmatch(r"\d{4}-\d\d-\d\d", text) and dt.date.fromisoformat(text) < oldest:
                doomed.append((source.partition("=")[2], text))
                if not dry_run:
                    delete_folder(spark, f"{path}/{source}/{day}")
    return doomed
