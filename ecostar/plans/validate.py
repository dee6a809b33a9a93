"""The validation and cleanup jobs over warehouse tables."""

from __future__ import annotations

import datetime as dt
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ecostar.operators import quality, traffic
from ecostar.plans.transform import JUDGED, fact_measures, write_judged
from ecostar.sources import lake as lake_io, reference
from ecostar.sources.warehouse import Batch, read_table, stage, staged_days, staging


def run_validation(
    spark: SparkSession, root: str, as_of: dt.datetime, hours: int = 24, strict: bool = False,
    run_id: str | None = None,
) -> DataFrame:
    """Check the last hours, append the issues and every gap between facts, and return the report row."""
    begun, at = time.monotonic(), F.lit(as_of)
    facts = quality.union_facts(
        fact_measures(spark, root, at - F.make_dt_interval(hours=F.lit(hours))),
        read_table(spark, root, "fact_traffic_flow_hourly", traffic.FLOW_FACT),
        read_table(spark, root, "fact_traffic_incident_hourly", traffic.INCIDENT_FACT),
        at,
        hours,
    )
    checks, gaps = quality.all_checks_and_gaps(facts, reference.dim_city(spark), at, hours)
    writes, run = Batch(spark, root), F.lit(run_id or str(uuid.uuid4()))
    issues = writes.write(quality.issue_rows(checks, run, at, hours), "quality_issues")
    writes.write(gaps.withColumn("validation_run_id", run), "quality_gaps")
    found = stage(quality.report(issues, strict), "report")
    ok = issues.select((F.col("severity") != "critical").alias("ok"))
    writes.write(lake_io.run_log(ok, "validation", at, F.lit(time.monotonic() - begun)), "etl_log")
    writes.commit()
    return found


def run_cleanup(spark: SparkSession, root: str, as_of: dt.datetime, dry_run: bool = False) -> DataFrame:
    """Delete duplicate and future facts; a dry run only counts them.

    The doomed rows are found once, with their day; only days that hold some are rewritten.
    """
    begun, at = time.monotonic(), F.lit(as_of)
    facts = fact_measures(spark, root)
    counts = stage(quality.cleanup_counts(facts, at, dry_run), "cleanup")
    if not dry_run:
        with staging(spark):
            writes, key = Batch(spark, root), ["lake_date", "measure_id"]
            doomed = quality.find_duplicates(facts).unionByName(quality.find_future(facts, at)).select(*key)
            doomed = stage(doomed.distinct().withColumn("_gone", F.lit(True)), "doomed")
            days = staged_days(doomed.select("lake_date").distinct(), "lake_date")
            marked = read_table(spark, root, "judged_measures", JUDGED).join(days, "lake_date", "left_semi").join(doomed, key, "left")
            rewritten = marked.withColumn("reject_reason", F.when(F.col("_gone"), F.lit("cleaned")).otherwise(F.col("reject_reason")))
            write_judged(writes, rewritten.drop("_gone"))
            ok = doomed.select(F.lit(True).alias("ok"))
            writes.write(lake_io.run_log(ok, "cleanup", at, F.lit(time.monotonic() - begun)), "etl_log")
            writes.commit()
    return counts
