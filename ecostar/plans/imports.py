"""The history import job: CSV medians to lake entries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ecostar import schemas
from ecostar.sources import history, lake as lake_io, reference
from ecostar.sources.warehouse import read_table, stage


def import_history(
    spark: SparkSession, csv: str, lake_path: str, start: dt.date, end: dt.date, cities: list[str] | None = None,
    all_days: bool = False, dry_run: bool = False,
) -> DataFrame:
    """Append one air entry per city and day that the lake lacks; returns (city_name, inserted, skipped).

    Ids follow the lake's largest one in the order of day and city. Only the lake's folders
    of the period are read, and a run that is repeated finds nothing left to add.
    ``all_days`` adds days that the lake has, too; a dry run only counts.
    """
    if end < start:
        raise ValueError("the end lies before the start")
    known = reference.city_reference(spark)
    if cities is not None:
        unknown = set(cities) - {r["city_name"] for r in known.filter(F.col("city_name").isin(*cities)).collect()}
        if unknown:
            raise ValueError(f"unknown cities: {', '.join(sorted(unknown))}")
    names = reference.dim_city(spark)
    if cities is not None:
        names = names.filter(F.col("city_name").isin(*cities))
    rows = history.read_history(spark, csv, start, end, names)
    records = stage(history.history_records(history.last_median(rows), known), "history-records")
    root, _, name = lake_path.rstrip("/").rpartition("/")
    lake = read_table(spark, root, name, schemas.LAKE + ", collected_date DATE")
    period = lake.filter(F.col("collected_date").between(F.lit(start), F.lit(end)))
    kept = stage(history.missing_records(records, period, all_days), "history-missing")
    if not dry_run:
        order = F.datediff("collected_at", F.lit("1970-01-01").cast("date")).cast("bigint") * F.lit(1 << 20) + F.col("city_id")
        lake_io.append_lake(lake_io.with_ids(kept.withColumn("_order", order), lake_path, "_order"), lake_path)
    counts = records.groupBy("city_name").agg(F.count("*").alias("total"))
    added = kept.groupBy("city_name").agg(F.count("*").alias("inserted"))
    inserted = F.coalesce("inserted", F.lit(0))
    return counts.join(added, "city_name", "left").select("city_name", inserted.alias("inserted"), (F.col("total") - inserted).alias("skipped"))
