import datetime as dt

from helpers import rows
from pyspark.sql import functions as F

from ecostar.sources import history, reference


def test_dim_date(spark):
    dim = reference.dim_date(spark)
    assert dim.count() == 1461
    row = dim.filter("date_value = DATE '2024-12-30'").first()
    assert (row.week_of_year, row.day_of_week, row.day_name, row.week_of_month, row.quarter_name, row.season, row.is_weekend) == (
        1, 1, "Monday", 5, "Q4", "Hiver", False)
    assert dim.filter("date_value = DATE '2026-08-02'").first().is_weekend


def test_seeds(spark):
    assert reference.dim_weather_condition(spark).count() == 36
    assert rows(reference.dim_air_quality_level(spark).filter("aqi_level_id = 6"), "aqi_min", "aqi_max") == [(301, 500)]
    assert reference.dim_city(spark).count() == 10


def test_stations_and_targets(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '[{"id":1,"name":"Lyon ","latitude":45.5,"longitude":4.0},{"id":2,"name":"Nice","latitude":43.0,"longitude":7.0,"aqi_station":"/n/"},'
        '{"id":3,"name":"Nowhere"}]'
    )
    cities = reference.read_cities(spark, str(tmp_path / "c.json"))
    ref = spark.createDataFrame([(9, "Lyon ", "by-name"), (1, "other", "by-id")], "id INT, name STRING, aqi_station STRING")
    got = reference.resolve_stations(cities, ref)
    twice = spark.createDataFrame([(1, "x", "zzz", 1), (1, "x", "aaa", 2)], "id INT, name STRING, aqi_station STRING, at INT")
    assert reference.resolve_stations(cities, twice, "at").filter("id = 1").first().aqi_station == "aaa"
    assert reference.resolve_stations(cities, twice.coalesce(1)).filter("id = 1").first().aqi_station == "aaa"
    assert sorted(rows(got, "id", "aqi_station")) == [(1, "by-id"), (2, "/n/"), (3, None)]
    targets = {(r.id, r.code_point): r for r in reference.collection_targets(got).collect()}
    assert set(targets) == {(1, "LYO_C"), (1, "LYO_E"), (1, "LYO_W"), (2, "NIC_C"), (2, "NIC_E"), (2, "NIC_W"), (3, None)}
    assert targets[2, "NIC_E"].longitude == 7.02 and targets[2, "NIC_E"].station_names == ["n", "Nice", "nice"]
    assert targets[1, "LYO_C"].incident_box == "3.950000,45.450000,4.050000,45.550000"


CSV = """# comment
Date,Country,City,Specie,count,min,max,median,variance
2026-03-26,FR,PARIS,pm25,1,1,1,10.5,0
2026-03-26,FR, Paris ,pm25,1,1,1,12.5,0
2026-03-26,FR,Paris,humidity,1,1,1,80,0
2026-03-26,FR,Paris,newone,1,1,1,1,0
2026-03-27,FR,Paris,temperature,1,1,1,9,0
2026-03-28,FR,Paris,pm25,1,1,1,-,0
# 2026-03-28,FR,Paris,pm25,1,1,1,5,0
2026-13-01,FR,Paris,pm25,1,1,1,5,0
2026-03-25,FR,Paris,pm25,1,1,1,5,0
2026-03-29,FR,Oslo,pm25,1,1,1,5,0
2026-04-01,FR,Lyon,o3,1,1,1,13.5,0
"""


def test_history(spark, tmp_path):
    (tmp_path / "h.csv").write_text(CSV)
    cities = reference.city_reference(spark)
    found = history.read_history(spark, str(tmp_path / "h.csv"), dt.date(2026, 3, 26), dt.date(2026, 4, 1), cities)
    last = history.last_median(found)
    assert sorted(rows(last, "city_name", "day", "specie", "median")) == [
        ("Lyon", dt.date(2026, 4, 1), "o3", 13.5),
        ("Paris", dt.date(2026, 3, 26), "humidity", 80.0),
        ("Paris", dt.date(2026, 3, 26), "newone", 1.0),
        ("Paris", dt.date(2026, 3, 26), "pm25", 12.5),
        ("Paris", dt.date(2026, 3, 27), "temperature", 9.0),
    ]
    records = history.history_records(last, cities)
    got = {(r.city_id, str(r.collected_at)): r for r in records.collect()}
    first = got[1, "2026-03-26 00:00:00"]
    assert first.aqi == 12 and '"iaqi":{"h":{"v":80.0},"newone":{"v":1.0},"pm25":{"v":12.5}}' in first.raw_data
    assert '"iso":"2026-03-26T00:00:00+00:00"' in first.raw_data and '"geo":[48.8566,2.3522]' in first.raw_data
    assert got[1, "2026-03-27 00:00:00"].aqi == 0 and got[3, "2026-04-01 00:00:00"].aqi == 14
    lake = spark.sql("SELECT 'aqicn' AS source, 'Paris' AS city_name, TIMESTAMP '2026-03-26 17:00:00' AS collected_at")
    assert history.missing_records(records, lake).count() == 2
    assert history.skipped_records(records, lake).count() == 1
    assert history.missing_records(records, lake, all_days=True).count() == 3
