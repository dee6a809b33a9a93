import json

from helpers import entry, lake, naive, rows, utc
from pyspark.sql import functions as F

from ecostar import schemas
from ecostar.functions import payload
from ecostar.operators import measures as m, parse

AT = utc(2026, 1, 20, 15, 11)


def air(data):
    return {"status": "ok", "data": data}


def parsed_air(spark, raw):
    row = parse.parse_air_quality(lake(spark, [entry(1, "aqicn", raw, AT)])).first()
    return row.asDict()


def test_air_numbers_only(spark):
    out = parsed_air(spark, air({"aqi": "-", "iaqi": {"pm25": {"v": 3.5}, "pm10": {"v": "7"}, "o3": {"v": ""}}}))
    assert (out["aqi_index"], out["pm25"], out["pm10"], out["o3"]) == (None, 3.5, None, None)
    out = parsed_air(spark, air({"aqi": "59", "iaqi": {"no2": {"v": 1}}}))
    assert (out["aqi_index"], out["no2"]) == (None, 1.0)
    assert parsed_air(spark, air({"aqi": 59.9}))["aqi_index"] == 59


def test_air_bare_numbers_beside_objects(spark):
    out = parsed_air(spark, air({"aqi": 5, "iaqi": {"pm25": 4.5, "pm10": {"v": 6}, "o3": "8"}}))
    assert (out["pm25"], out["pm10"], out["o3"]) == (4.5, 6.0, None)


def test_air_without_data_object(spark):
    out = parsed_air(spark, {"status": "error", "data": "Unknown station"})
    assert all(out[c] is None for c in schemas.AIR_COLUMNS)
    assert all(parsed_air(spark, "no json")[c] is None for c in schemas.AIR_COLUMNS)


def test_payload_as_string_inside_json(spark):
    assert parsed_air(spark, json.dumps(json.dumps(air({"aqi": 12}))))["aqi_index"] == 12


def test_attribution(spark):
    cases = [
        (air({"attributions": [{"name": "A"}], "city": {"name": "C"}}), "A"),
        (air({"attributions": [{"url": "x"}], "city": {"name": "C"}}), None),
        (air({"attributions": [], "city": {"name": "C"}}), "C"),
        (air({"attributions": ["text"], "city": "Plain"}), "Plain"),
        (air({}), None),
    ]
    df = lake(spark, [entry(i, "aqicn", raw, AT) for i, (raw, _) in enumerate(cases)])
    assert sorted(rows(parse.air_attributions(df), "id", "station_attribution")) == [
        (i, want) for i, (_, want) in enumerate(cases)
    ]


def test_air_time_fallbacks(spark):
    cases = [
        ({"iso": "2026-01-20T13:00:00+01:00"}, naive(2026, 1, 20, 12)),
        ({"iso": "2026-01-20T13:00:00Z"}, naive(2026, 1, 20, 13)),
        ({"iso": "2026-01-20T13:00:00"}, naive(2026, 1, 20, 13)),
        ({"iso": "later", "s": "2026-01-20 13:00:00", "tz": "+01:00"}, naive(2026, 1, 20, 12)),
        ({"s": "2026-01-20 13:00:00", "tz": "01:00"}, naive(2026, 1, 20, 12)),
        ({"s": "2026-01-20 13:00:00"}, naive(2026, 1, 20, 13)),
        ({"s": "bad", "v": 1768914000}, naive(2026, 1, 20, 13)),
        ({"v": "soon"}, None),
        ({}, None),
    ]
    df = lake(spark, [entry(i, "aqicn", air({"time": t}), AT) for i, (t, _) in enumerate(cases)])
    assert sorted(rows(parse.air_timestamps(df), "id", "api_time")) == [(i, w) for i, (_, w) in enumerate(cases)]


def test_weather_nodes(spark):
    cases = [
        {"main": {"temp": 9.09}, "weather": [{"id": 803}, {"id": 1}]},
        {"main": "x", "wind": {"speed": 3}, "rain": [], "weather": []},
        {"main": {"temp": 1}, "rain": {"1h": None}, "snow": {"1h": 0.4}},
    ]
    df = parse.parse_weather(lake(spark, [entry(i, "openweather", c, AT) for i, c in enumerate(cases)]))
    got = sorted(rows(df, "id", "temperature", "wind_speed", "rain_1h", "snow_1h", "weather_id"))
    assert got == [(0, 9.09, None, 0.0, 0.0, 803), (1, None, 3.0, 0.0, 0.0, None), (2, 1.0, None, 0.0, 0.4, None)]


def test_weather_time(spark):
    cases = [({"dt": 1768921508}, naive(2026, 1, 20, 15, 5, 8)), ({"dt": "soon"}, None), ({}, None), ({"dt": 1e30}, None)]
    df = lake(spark, [entry(i, "openweather", c, AT) for i, (c, _) in enumerate(cases)])
    assert sorted(rows(parse.weather_timestamps(df), "id", "api_time")) == [(i, w) for i, (_, w) in enumerate(cases)]


def test_flow_ratios(spark):
    def answer(**seg):
        return json.dumps({"flowSegmentData": seg})

    raws = [
        answer(currentSpeed=41, freeFlowSpeed=70, currentTravelTime=153, freeFlowTravelTime=90),
        answer(currentSpeed=0, freeFlowSpeed=70, currentTravelTime=10, freeFlowTravelTime=0, roadClosure=True),
        json.dumps({"error": 1}),
    ]
    df = spark.createDataFrame(list(enumerate(raws)), "id INT, raw_data STRING")
    got = sorted(rows(parse.flatten_flow(df), "id", "speed_ratio", "congestion_ratio", "route_fermee"))
    assert got == [(0, 41 / 70, 1.7, False), (1, None, None, True)]


def test_incidents(spark):
    raw = json.dumps(
        {
            "incidents": [
                {"properties": {"id": "a", "iconCategory": 8, "magnitudeOfDelay": 4, "delay": 420, "length": 850}},
                {"properties": {"id": "b"}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
            ]
        }
    )
    df = spark.createDataFrame([(raw,), ('{"incidents":[]}',), ("{}",)], "raw_data STRING")
    got = rows(parse.explode_incidents(df), "incident_id", "categorie_incident", "retard_s", "longueur_m", "nombre_signalements")
    assert got == [("a", 8, 420.0, 850.0, 0), ("b", None, 0.0, 0.0, 0)]


def test_incident_category_default_only_if_absent(spark):
    df = lake(spark, [entry(1, "tomtom_incidents", {"retard_s": 1}, AT), entry(2, "tomtom_incidents", {"categorie_incident": None}, AT),
                      entry(3, "tomtom_incidents", json.dumps(json.dumps({"retard_s": 1})), AT)])
    assert sorted(rows(parse.incident_records(df), "id", "categorie_incident"), key=lambda r: r[0]) == [(1, 0), (2, None), (3, 0)]


def test_aqi_levels(spark):
    df = spark.createDataFrame([(v,) for v in (0, 50, 51, 500, 501, -1, None)], "aqi_index INT")
    got = [r[0] for r in df.select(m.aqi_level_id("aqi_index")).collect()]
    assert got == [1, 1, 2, 6, None, None, None]
    from ecostar.sources import reference

    joined = m.with_aqi_level(df, reference.dim_air_quality_level(spark))
    assert {(r.aqi_index, r.aqi_level_id) for r in joined.collect()} == {
        (0, 1), (50, 1), (51, 2), (500, 6), (501, None), (-1, None), (None, None)
    }


def test_river_hour_from_raw_copy(spark):
    from ecostar.operators import water

    obs = [
        {"code_station": "S", "date_prelevement": "2026-01-02", "heure_prelevement": "10:30:00"},
        {"code_station": "S", "date_prelevement": "2026-01-02", "donnees_brutes": {"heure_prelevement": "11:00:00"}},
        {"code_station": "S", "date_prelevement": "2026-01-02"},
        {"code_station": "S", "date_prelevement": "2026-01-02T08:00:00Z"},
        {"code_station": "S", "date_prelevement": "not a day"},
    ]
    df = parse.river_obs_records(lake(spark, [entry(i, "hubeau_cd_observations", o, AT) for i, o in enumerate(obs)]))
    stations = spark.sql("SELECT 'S' AS code_station, 7 AS station_id")
    got = sorted(rows(water.river_rows(df, stations), "id", "date_prelevement", "hour_of_day"), key=lambda r: r[0])
    assert got == [
        (0, naive(2026, 1, 2, 10, 30), 10), (1, naive(2026, 1, 2, 11), 11), (2, naive(2026, 1, 2), 0),
        (3, naive(2026, 1, 2, 8), 8), (4, None, 15),
    ]


def test_severity(spark):
    from ecostar.functions.expr import incident_severity
    from ecostar.operators import traffic

    df = spark.sql("SELECT * FROM VALUES (4D, 420D, 8), (NULL, NULL, 1), (0D, 0D, 99) AS t(g, d, c)")
    got = [r[0] for r in df.select(incident_severity(F.col("g"), F.col("d"), F.col("c"))).collect()]
    assert got == [4.81, 0.8, 0.4]
    bad = spark.sql("SELECT 1 AS id, 1D AS gravite_retard, -1D AS retard_s, 1 AS categorie_incident")
    ok, rejects = traffic.scored_incidents(bad)
    assert ok.count() == 0 and rejects.first().reason == "negative_delay"


def test_texts_that_name_no_number_are_null(spark):
    raw = '{"status":"ok","data":{"iaqi":{"pm25":{"v":"NaN"},"pm10":{"v":"Infinity"},"no2":{"v":3.5}}}}'
    df = spark.createDataFrame([(raw,)], "raw string").select(payload.air_struct(F.col("raw"))["data"]["iaqi"].alias("i"))
    row = df.select("i.pm25.v", "i.pm10.v", "i.no2.v").first()
    assert tuple(row) == (None, None, 3.5)
