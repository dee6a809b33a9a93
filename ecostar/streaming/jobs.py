"""The lake as a stream: the same transform and hourly tables per micro-batch."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ecostar import schemas
from ecostar.functions import expr
from ecostar.operators import parse
from ecostar.plans.transform import run_batch, staged_batch
from ecostar.sources import done, lake as lake_io, reference
from ecostar.sources.warehouse import Batch, empty_table, read_table, stage, staged_days, staging


def lake_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.LAKE + ", collected_date DATE")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _stream_name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def stream_transform(
    spark: SparkSession,
    lake_path: str,
    root: str,
    checkpoint: str,
    clock: Callable[[], dt.datetime] = _now,
    files_per_batch: int | None = None,
    trigger: dict | None = None,
    forest=None,
    stats: DataFrame | None = None,
) -> StreamingQuery:
    """New lake files through the transform; the checkpoint stands in for a processed flag.

    A micro-batch is published once: the ledger knows it by the checkpoint and its number.
    Entries that have an outcome already, from another job, are left out.
    """

    def each(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        if Batch(session, root, stream, epoch).published:
            return
        with staging(session):
            ranges = read_table(session, root, "done_ranges", done.RANGES)
            entries = staged_batch(done.pending(batch, ranges))
            run_batch(session, entries, lake_io.load_lake(session, lake_path), root, clock(), forest, stats, stream, epoch)

    stream = _stream_name(checkpoint)
    return (
        lake_stream(spark, lake_path, files_per_batch)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 hour"}))
        .start()
    )


def stream_drain(spark: SparkSession, lake_path: str, root: str, checkpoint: str, **options) -> None:
    """Process the whole backlog, then stop."""
    stream_transform(
        spark, lake_path, root, checkpoint, trigger={"availableNow": True}, **options
    ).awaitTermination()


class Hours(NamedTuple):
    """What an hourly table keeps: totals of entries, and how totals of the same hour add up to totals."""

    totals: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    sources: tuple[str, ...]


def hourly_winners(entries: DataFrame) -> DataFrame:
    """Per hour, city and source the largest lake id and its payload."""
    rows = entries.filter(F.col("source").isin(schemas.WEATHER, schemas.AIR))
    return merge_winners(rows.withColumn("lake_hour", expr.hour_of(F.col("collected_at"))))


def merge_winners(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lake_hour", "city_id", "source").agg(
        F.max("id").alias("id"),
        F.max_by("collected_at", "id").alias("collected_at"),
        F.max_by("raw_data", "id").alias("raw_data"),
    )


def hourly_incidents(entries: DataFrame) -> DataFrame:
    """Totals of incidents of known days per hour, city and category; model id and length of the first of them."""
    score = expr.incident_severity(F.col("gravite_retard"), F.col("retard_s"), F.col("categorie_incident"))
    delay_s = F.coalesce("retard_s", F.lit(0.0))
    days = reference.dim_date(entries.sparkSession).select("date_value")
    rows = parse.incident_records(entries).withColumn("date_value", F.to_date("collected_at")).join(days, "date_value", "left_semi")
    return merge_incidents(
        rows.filter(delay_s > -1).select(
            expr.hour_of(F.col("collected_at")).alias("lake_hour"), "city_id", "categorie_incident", F.col("id").alias("first_id"),
            "traffic_model_id", F.lit(1).cast("bigint").alias("nombre_incidents"), delay_s.alias("retard_total_s"),
            F.col("longueur_m").alias("longueur_moyenne_m"), score.alias("incident_severity_score"),
        )
    )


def merge_incidents(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("lake_hour", "city_id", "categorie_incident")
        .agg(
            F.min("first_id").alias("first_id"),
            F.min_by("traffic_model_id", "first_id").alias("traffic_model_id"),
            F.sum("nombre_incidents").alias("nombre_incidents"),
            F.sum("retard_total_s").alias("retard_total_s"),
            F.min_by("longueur_moyenne_m", "first_id").alias("longueur_moyenne_m"),
            F.max("incident_severity_score").alias("incident_severity_score"),
        )
        .withColumn("retard_moyen_s", F.col("retard_total_s") / F.col("nombre_incidents"))
    )


WINNERS = Hours(hourly_winners, merge_winners, (schemas.WEATHER, schemas.AIR))
INCIDENTS = Hours(hourly_incidents, merge_incidents, (schemas.INCIDENTS,))


def read_hours(spark: SparkSession, root: str, name: str, hours: Hours) -> DataFrame:
    """The table that ``stream_hours`` keeps."""
    shape = hours.totals(empty_table(spark, schemas.LAKE)).schema
    return read_table(spark, root, name, shape.add("lake_date", "date"))


def stream_hours(
    spark: SparkSession,
    lake_path: str,
    root: str,
    name: str,
    hours: Hours,
    checkpoint: str,
    files_per_batch: int | None = None,
    **trigger,
) -> StreamingQuery:
    """A table of totals per hour and city, kept up with the lake.

    The totals of a micro-batch's entries are added to those kept for the same hours; the
    lake is not read again, and hours without new entries are not touched but for their
    day's files. The ledger publishes each micro-batch once, so nothing counts twice, and
    entries count however late they come, in any order: the table itself is the state,
    and needs no watermark. A table belongs to the checkpoint that began it.
    """
    stream = f"{name}-{_stream_name(checkpoint)}"

    def each(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        writes = Batch(session, root, stream, epoch)
        if writes.published:
            return
        with staging(session):
            old = read_hours(session, root, name, hours)
            if not writes.resumed and not old.isEmpty():
                raise ValueError(f"the table {name} was begun with another checkpoint")
            new = stage(hours.totals(batch.filter(F.col("source").isin(*hours.sources))).withColumn("lake_date", F.to_date("lake_hour")), "new-hours")
            days = staged_days(new.select("lake_date").distinct(), "lake_date")
            both = old.join(days, "lake_date", "left_semi").unionByName(new)
            merged = hours.merge(both).withColumn("lake_date", F.to_date("lake_hour"))
            writes.write(merged.select(*old.columns), name, "lake_date", replace=True)
            writes.commit()

    return (
        lake_stream(spark, lake_path, files_per_batch)
        .writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
