"""Seconds per headline query; prints one JSON line.

The lake table is derived from ``events`` once and timed as ``lake_build``. Every
query then runs from Parquet to its full result (written to the ``noop`` sink).
"""

from __future__ import annotations

import json
import os
import time

from ecostar import driver_views
from ecostar.queries import QUERIES
from ecostar.session import build_session

HEADLINE = (
    "lake_append", "lake_latest_by_source", "source_caps", "aqicn_history_records", "parse_weather",
    "parse_air_quality", "flow_flatten", "incidents_explode", "route_sources", "combine_weather_air",
    "dedup_source_hour", "dim_traffic_point_upsert", "dim_station_upsert", "fact_measures_upsert", "fact_flow_load",
    "fact_incident_load", "fact_drinking_water_load", "fact_river_load", "business_rules", "zscore_anomalies",
    "reject_or_load", "iforest_train", "iforest_score", "rolling_zscore_30d", "groundwater_trend_7d", "dq_gaps",
    "dq_limits", "dq_report", "cleanup_report", "q01_monthly_city", "q04_city_air_ranking", "q06_weather_distribution",
    "q09_pollution_alerts", "q10_cube", "q12_season_pollution", "q13_kpi_24h", "q15_monthly_mv", "q18_anomalies_daily",
    "stream_hourly_dedup", "stream_incidents_hourly", "stream_drain",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def timed(run) -> float:
        start = time.perf_counter()
        run()
        return round(time.perf_counter() - start, 3)

    def lakes() -> None:
        driver_views.lake(spark, sf_dir)
        driver_views.lake(spark, sf_dir, months=True)
        driver_views.groundwater_lake(spark, sf_dir)
        driver_views.facts(spark, sf_dir)

    seconds = {"lake_build": timed(lakes)}
    for name in HEADLINE:
        seconds[name] = timed(
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
