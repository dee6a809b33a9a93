import datetime as dt
import json

import pytest
from helpers import entry, lake, rows, utc
from pyspark.sql import functions as F

from ecostar import schemas
from ecostar.plans import imports, transform, validate
from ecostar.sources import lake as lake_io, warehouse
from ecostar.operators import dimensions, measures, traffic, water
from ecostar.streaming import jobs

AS_OF = utc(2026, 3, 1)
TABLES = {
    "fact_traffic_flow_hourly": (traffic.FLOW_FACT, "traffic_point_id"),
    "fact_traffic_incident_hourly": (traffic.INCIDENT_FACT, "incident_category_id"),
    "fact_eau_potable": (water.DRINKING_FACT, None),
    "fact_cours_deau_observation": (water.RIVER_FACT, "station_id"),
}


def entries():
    out = []
    for i in range(60):
        at = utc(2026, 2, 1 + i // 24, i % 24, 7)
        city, name = 1 + i % 2, ("Paris", "Marseille")[i % 2]

        def add(source, raw, shift=0):
            out.append(entry(len(out) + 1, source, raw, at + dt.timedelta(minutes=shift), city, name))

        add("openweather", {"main": {"temp": 5 + i % 9, "pressure": 1000}, "weather": [{"id": 800}]})
        add("aqicn", {"data": {"aqi": 40 + i, "iaqi": {"pm25": {"v": i}}}}, 5)
        if i % 5 == 0:  # a late twin with a larger id
            add("openweather", {"main": {"temp": 70 if i == 10 else 1.5, "pressure": 1000}}, 20)
        add("tomtom_flow", {"code_point": "PAR_C", "vitesse_actuelle_kmph": i})
        add("tomtom_flow", {"code_point": "PAR_C", "vitesse_actuelle_kmph": -1}, 9)
        add("tomtom_incidents", {"categorie_incident": i % 3, "retard_s": i, "gravite_retard": 1, "longueur_m": i})
        add("hubeau_eau_potable", {"code_commune": "75056" if i % 2 else None, "date_prelevement": "2026-01-05", "libelle_parametre": "pH"})
        add("hubeau_eau_potable", {"code_commune": "1", "date_prelevement": "2019-01-05", "libelle_parametre": "pH"})
        add("hubeau_cd_observations", {"code_station": f"S{i % 4}", "date_prelevement": "2026-01-06", "libelle_parametre": f"P{i % 7}"})
    out.append(entry(len(out) + 1, "mystery", "{}", utc(2026, 2, 1)))
    return out


def content(spark, root):
    facts = transform.fact_measures(spark, root).select(
        "city_id", "lake_hour", "captured_at", "temperature", "aqi_index", "aqi_level_id", "weather_condition_id"
    )
    hits = transform.measure_anomalies(spark, root).select("city_id", "captured_at", "field_name", "severity")
    out = {"facts": sorted(map(str, facts.collect())), "hits": sorted(map(str, hits.collect()))}
    for name, (schema, _) in TABLES.items():
        out[name] = sorted(map(str, warehouse.read_table(spark, root, name, schema).collect()))
    done = warehouse.read_table(spark, root, "lake_processed", transform.PROCESSED)
    out["done"] = sorted((r.id, r.outcome) for r in done.collect())
    return out


def snapshot(spark):
    """Statistics of one city, under which 70 degrees are critical and 12 or 13 stand out."""
    usual = {"temperature": (5, 3), "humidity": (50, 9), "pressure": (1000, 9), "aqi": (60, 40)}
    fields = ", ".join(f"{mean}D AS mean_{f}, {std}D AS std_{f}" for f, (mean, std) in usual.items())
    return spark.sql(f"SELECT 1 AS city_id, {fields}")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("wh")
    path, root = str(base / "lake"), str(base / "one")
    lake_io.append_lake(lake(spark, entries()), path)
    transform.run_transform(spark, path, root, AS_OF, batch_size=None, stats=snapshot(spark))
    return base, path, content(spark, root)


def test_one_batch(loaded):
    _, _, got = loaded
    assert len(got["facts"]) == 59  # 70 degrees are rejected, by rule and by z-score
    assert sum("critical" in h for h in got["hits"]) == 2 and any("'low'" in h for h in got["hits"])
    assert len(got["fact_traffic_flow_hourly"]) == 60
    assert all("vitesse_actuelle_kmph=-1" not in r for r in got["fact_traffic_flow_hourly"])
    assert len(got["fact_eau_potable"]) == 31  # one by its key, thirty without a commune
    outcomes = [o for _, o in got["done"]]
    assert outcomes.count("date_out_of_range") == 60 and outcomes.count("unknown_source") == 1
    assert len(outcomes) == len(entries())


def test_batches_and_reruns_agree(spark, loaded):
    base, path, want = loaded
    root = str(base / "many")
    for _ in range(3):
        transform.run_transform(spark, path, root, AS_OF, batch_size=200, stats=snapshot(spark))
    transform.run_transform(spark, path, root, AS_OF, batch_size=200, stats=snapshot(spark))
    got = content(spark, root)
    assert got == want


def test_drain_equals_batch(spark, loaded):
    base, path, want = loaded
    root = str(base / "stream")
    for _ in range(2):  # the second run finds nothing
        jobs.stream_drain(spark, path, root, str(base / "offsets"), clock=lambda: AS_OF, stats=snapshot(spark))
    got = content(spark, root)
    assert got == want


def test_validation_and_cleanup(spark, loaded):
    base, _, _ = loaded
    root = str(base / "one")
    report = validate.run_validation(spark, root, utc(2026, 2, 3), hours=72, run_id="r1").first()
    assert report.status == "failed" and report.warning >= 1
    dry = validate.run_cleanup(spark, root, utc(2026, 2, 2), dry_run=True).first()
    assert dry.future_dates > 0
    before = transform.fact_measures(spark, root).count()
    assert validate.run_cleanup(spark, root, utc(2026, 2, 2)).first().total_deleted == dry.total_deleted
    assert transform.fact_measures(spark, root).count() == before - dry.total_deleted
    log = warehouse.read_table(spark, root, "etl_log", lake_io.RUN_LOG)
    assert [(r.source, r.status) for r in log.collect() if r.source != "transform"].count(("cleanup", "success")) == 1
    assert log.filter("source = 'validation'").count() == 1 and log.filter("source = 'transform'").count() == 1


def hours(spark, path, root, name, kind, *columns, **options):
    jobs.stream_hours(spark, path, root, name, kind, f"{root}/offsets-{name}", **options).awaitTermination()
    return sorted(rows(jobs.read_hours(spark, root, name, kind), *columns))


def test_hourly_streams(spark, loaded, tmp_path):
    _, path, _ = loaded
    got = hours(spark, path, str(tmp_path), "hourly", jobs.WINNERS, "id", files_per_batch=2)
    best = {}
    for id_, city, _, source, _, at, *_ in entries():
        if source in jobs.WINNERS.sources:
            best[city, source, at.replace(minute=0)] = id_
    assert got == sorted((i,) for i in best.values())


def test_late_entries_count(spark, tmp_path):
    """Entries of any order and lateness, of an unknown day and with a delay that has no logarithm."""
    path, root = str(tmp_path / "lake"), str(tmp_path / "wh")

    def incident(id_, hour, day=1, year=2026, delay=10.0):
        raw = {"categorie_incident": 8, "retard_s": delay, "traffic_model_id": f"m{id_}"}
        return entry(id_, schemas.INCIDENTS, raw, utc(year, 1, day, hour, id_))

    for late in ([incident(2, 5)], [incident(3, 23, 9)], [incident(1, 5), incident(4, 5), incident(5, 5, delay=-1.0)], [incident(6, 5, year=2019)], []):
        if late:
            lake_io.append_lake(lake(spark, late), path)
        got = hours(spark, path, root, "incidents", jobs.INCIDENTS, "nombre_incidents", "traffic_model_id", "retard_total_s", "retard_moyen_s")
    assert got == [(1, "m3", 10.0, 10.0), (3, "m1", 30.0, 10.0)]
    with pytest.raises(Exception, match="another checkpoint"):
        jobs.stream_hours(spark, path, root, "incidents", jobs.INCIDENTS, f"{root}/others").awaitTermination()


def test_monthly_view_follows_late_entries_and_cleanup(spark, tmp_path):
    """The kept view equals the averages of all facts after every run, and reads no facts."""
    path, root = str(tmp_path / "lake"), str(tmp_path / "wh")
    raw = [e for e in entries() if e[3] in (schemas.WEATHER, schemas.AIR)]

    def facts():
        by = {}
        for r in transform.fact_measures(spark, root).collect():
            by.setdefault((r.city_id, r.capture_date.month), []).append(r)
        out = {}
        for key, group in by.items():
            t = [r.temperature for r in group if r.temperature is not None]
            out[key] = (len(group), round(float(sum(t)) / len(t), 2) if t else None)
        return out

    def view():
        return {(r.city_id, r.month): (r.measure_count, r.temp_avg) for r in transform.monthly_averages(spark, root).collect()}

    for part in (raw[::2], raw[1::2]):
        lake_io.append_lake(lake(spark, part), path)
        transform.run_transform(spark, path, root, AS_OF, stats=snapshot(spark))
        got, want = view(), facts()
        assert got.keys() == want.keys()
        assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=0.0051) for k in want)
    validate.run_cleanup(spark, root, utc(2026, 2, 2))
    assert {k: n for k, (n, _) in view().items()} == {k: n for k, (n, _) in facts().items()}
    assert "judged_measures" not in "".join(transform.monthly_averages(spark, root).inputFiles())


def test_history_import(spark, tmp_path):
    path, csv = str(tmp_path / "lake"), tmp_path / "history.csv"
    csv.write_text("Date,Country,City,Specie,count,median\n" + "\n".join(f"2026-01-{d:02d},FR,{c},pm25,1,{d}" for d in (3, 1, 2) for c in ("Paris", "Lyon")))
    there = entry(500, schemas.AIR, {"data": {}}, utc(2026, 1, 2, 9), 1, "Paris")
    lake_io.append_lake(lake(spark, [there]), path)

    def run(**options):
        got = imports.import_history(spark, str(csv), path, dt.date(2026, 1, 1), dt.date(2026, 1, 31), **options)
        return sorted(rows(got, "city_name", "inserted", "skipped"))

    assert run(dry_run=True) == [("Lyon", 3, 0), ("Paris", 2, 1)] and lake_io.load_lake(spark, path).count() == 1
    assert run(cities=["Lyon"]) == [("Lyon", 3, 0)]
    assert run() == [("Lyon", 0, 3), ("Paris", 2, 1)] and run() == [("Lyon", 0, 3), ("Paris", 0, 3)]
    got = sorted(rows(lake_io.load_lake(spark, path), "id", "city_name", "collected_date"))
    assert [i for i, *_ in got] == list(range(500, 506)) and [c for _, c, _ in got[1:]] == ["Lyon"] * 3 + ["Paris"] * 2
    for wrong in ({"cities": ["Atlantis"]}, {}):
        with pytest.raises(ValueError):
            end = dt.date(2026, 1, 31) if wrong else dt.date(2020, 1, 1)
            imports.import_history(spark, str(csv), path, dt.date(2026, 1, 1), end, **wrong)
    lake_io.append_lake(lake(spark, [there]).drop("id"), path)
    assert lake_io.load_lake(spark, path).filter("id = 506").count() == 1


def test_job_trains_its_forest(spark, tmp_path):
    path, root = str(tmp_path / "lake"), str(tmp_path / "wh")
    raw = [entry(2 * i + k, s, p, utc(2026, 1, 1 + i // 24, i % 24), 1) for i in range(150) for k, (s, p) in enumerate([
        (schemas.WEATHER, {"main": {"temp": 10 + i % 7, "humidity": 50 + i % 11, "pressure": 1000 + i % 5}}), (schemas.AIR, {"data": {"aqi": 40 + i % 13}})])]
    odd = [entry(1000, schemas.WEATHER, {"main": {"temp": 45, "humidity": 3, "pressure": 905}}, utc(2026, 2, 1)), entry(1001, schemas.AIR, {"data": {"aqi": 390}}, utc(2026, 2, 1))]
    for part in (raw, odd):
        lake_io.append_lake(lake(spark, part), path)
        transform.run_transform(spark, path, root, AS_OF, stats=snapshot(spark).limit(0), train=True)
    hits = transform.measure_anomalies(spark, root).filter("anomaly_type = 'ml_isolation_forest'")
    assert rows(hits, "field_name", "actual_value") == [("multivariate", None)]


def test_purge_drops_whole_days(spark, tmp_path):
    path = str(tmp_path / "lake")
    days = [utc(2026, 1, 1), utc(2026, 1, 2), utc(2026, 1, 3)]
    lake_io.append_lake(lake(spark, [entry(i, s, "{}", d) for i, (s, d) in enumerate([(s, d) for s in ("aqicn", "odd") for d in days])]), path)
    doomed = [(s, d) for s in ("aqicn", "odd") for d in ("2026-01-01", "2026-01-02")]
    assert lake_io.purge(spark, path, 7, dt.date(2026, 1, 10), dry_run=True) == doomed
    assert lake_io.load_lake(spark, path).count() == 6
    assert lake_io.purge(spark, path, 7, dt.date(2026, 1, 10)) == doomed
    assert sorted(rows(lake_io.load_lake(spark, path), "id")) == [(2,), (5,)]
    assert lake_io.purge(spark, path, 7, dt.date(2026, 1, 10)) == [] == lake_io.purge(spark, str(tmp_path / "none"), 7, dt.date(2026, 1, 10))


class Cut(Exception):
    pass


def broken_entries():
    at = utc(2026, 2, 1, 3)
    payloads = {
        schemas.WEATHER: ["{broken", {"main": {"temp": 123456.0}}, {"main": {"temp": 5}}],
        schemas.AIR: [None, {"data": {"aqi": 40, "iaqi": {"pm25": {"v": 1e9}}}}],
        schemas.FLOW: ["nothing", {"vitesse_actuelle_kmph": 3}, {"code_point": "P"}],
        schemas.INCIDENTS: ["[1]", {"categorie_incident": None}, {"retard_s": -5, "categorie_incident": 1}, {}],
        schemas.DRINKING_WATER: ["{", {"date_prelevement": "soon"}, {"libelle_parametre": "pH"}, {"libelle_parametre": "pH"}],
        schemas.RIVER_OBSERVATIONS: ["", {"date_prelevement": "2026-01-06"}, {"code_station": "S", "date_prelevement": "1999-01-06"}],
        schemas.RIVER_STATIONS: ['{"code_station": "S"', {"libelle_station": "x"}, {"code_station": "S"}],
    }
    sources = [(s, raw) for s, raws in payloads.items() for raw in raws] + [("mystery", {})]
    out = [entry(i, s, raw, at) for i, (s, raw) in enumerate(sources, 1)]
    return [*out, entry(99, schemas.WEATHER, {"main": {"temp": 5}}, utc(2019, 1, 1, 3))]


REASONS = [
    "bad_payload", "numeric_overflow", "processed", "bad_payload", "numeric_overflow", "bad_payload", "missing_key", "processed",
    "bad_payload", "missing_key", "negative_delay", "processed", "bad_payload", "bad_date", "processed", "processed",
    "bad_payload", "missing_key", "date_out_of_range", "bad_payload", "missing_key", "processed", "unknown_source", "date_out_of_range",
]


def everything(spark, root):
    dims = {"dim_traffic_point": dimensions.TRAFFIC_POINT, "dim_cours_deau_station": dimensions.STATION, "dim_incident_category": dimensions.INCIDENT_CATEGORY}
    out = content(spark, root)
    for name, schema in dims.items():
        out[name] = sorted(map(str, warehouse.read_table(spark, root, name, schema).collect()))
    log = warehouse.read_table(spark, root, "etl_log", lake_io.RUN_LOG).drop("execution_duration_seconds")
    out["log"] = sorted(map(str, log.collect()))
    return out


def test_failed_entries_and_batches_cut_anywhere(spark, tmp_path, monkeypatch):
    """A micro-batch that is cut off after any write, or at any move of a file, and comes again leaves what a whole one does."""
    path = str(tmp_path / "lake")
    lake_io.append_lake(lake(spark, broken_entries()), path)

    def drain(root):
        jobs.stream_drain(spark, path, str(root), f"{root}-offsets", clock=lambda: AS_OF, stats=snapshot(spark))
        return everything(spark, str(root))

    want = drain(tmp_path / "whole")
    assert [o for _, o in want["done"]] == REASONS
    assert len(want["fact_eau_potable"]) == 2  # without a commune, so each stands for itself
    assert len(want["log"]) == 1 and "records_inserted=6" in want["log"][0] and "18 échecs" in want["log"][0]

    write, move, steps = warehouse.Batch.write, warehouse.move_file, {"left": 0}

    def counted(real):
        def run(*args, **kw):
            out = real(*args, **kw)
            steps["left"] -= 1
            if steps["left"] == 0:
                raise Cut
            return out

        return run

    monkeypatch.setattr(warehouse.Batch, "write", counted(write))
    monkeypatch.setattr(warehouse, "move_file", counted(move))
    root, cuts = tmp_path / "cut", 0
    for step in (1, 2, 4, 6, 9, 11, 13, 14, 17):  # twelve writes, then moves; a batch with a manifest is finished first
        steps["left"] = step
        try:
            drain(root)
        except Exception as e:
            assert "Cut" in str(e)
            cuts += 1
    steps["left"] = 0
    assert drain(root) == want and cuts >= 6
    assert not [f for f in warehouse.list_folders(spark, f"{root}/_ledger") if not f.startswith("done-")]


def test_replayed_batch_changes_nothing(spark, loaded, tmp_path):
    _, path, want = loaded
    root = str(tmp_path / "wh")
    for offsets in ("a", "b"):  # new offsets: every batch comes again
        jobs.stream_drain(spark, path, root, str(tmp_path / offsets), clock=lambda: AS_OF, stats=snapshot(spark))
    assert content(spark, root) == want


def test_only_deciding_payloads_are_parsed(spark, tmp_path):
    """Of many twins of an hour one entry per source reaches the parser, and the measures are those of all entries."""
    path, at = str(tmp_path / "lake"), utc(2026, 2, 1, 3)
    raw = [entry(i, (schemas.WEATHER, schemas.AIR)[i % 2], {"main": {"temp": i}, "data": {"aqi": i}}, at + dt.timedelta(minutes=i % 50), 1 + i % 3) for i in range(600)]
    raw += [entry(None, schemas.AIR, {"data": {"aqi": 7}}, at, 1), entry(None, schemas.AIR, {"data": {"aqi": 7}}, at, 9), entry(700, schemas.FLOW, {}, at, 1)]
    lake_io.append_lake(lake(spark, raw), path)
    stored = lake_io.load_lake(spark, path)
    sources = (schemas.WEATHER, schemas.AIR)
    with warehouse.staging(spark):
        hours = warehouse.staged_days(transform.touched(stored, *sources), "collected_date")
        some = transform.deciding(stored, hours, *sources)
        assert sorted(rows(some.filter("id IS NOT NULL"), "id")) == [(i,) for i in range(594, 600)]
        assert rows(some.filter("id IS NULL"), "city_id") == [(9,)]
        want = measures.combine(transform.affected(stored, hours, *sources))
        assert sorted(map(str, measures.combine(some).collect())) == sorted(map(str, want.collect()))


def test_batch_is_spread_by_source(spark, tmp_path):
    """A source that lies in one file of the lake is worked on by all tasks."""
    text = "concat('{\"v\": \"', sha2(string(id), 512), sha2(string(-id), 512), sha2(string(id * 3), 512), '\"', if(id % 10 = 0, '', '}'))"
    source = "element_at(array('openweather', 'aqicn', 'tomtom_flow'), int(id % 3 + 1))"
    some = spark.range(24000).selectExpr("id", "1 AS city_id", "'Paris' AS city_name", f"{source} AS source", f"{text} AS raw_data", "TIMESTAMP '2026-02-01 03:00:00' AS collected_at", "FALSE AS processed", "timestamp(NULL) AS processed_at")
    some.repartition(1).write.partitionBy("source").parquet(str(tmp_path / "lake"))
    with warehouse.staging(spark):
        batch = transform.staged_batch(spark.read.schema(schemas.LAKE).parquet(str(tmp_path / "lake")))
        shares = batch.groupBy("source", F.input_file_name().alias("file")).count().collect()
        for name in ("openweather", "aqicn", "tomtom_flow"):
            counts = [r["count"] for r in shares if r.source == name]
            assert sum(counts) == 8000 and max(counts) < 4000
        assert batch.filter("NOT readable").count() == 2400


def test_bounds_are_those_of_rounded_values(spark):
    edges = [x * f for x in (999.995, 99999.995, 2147483647.5, 1000.0, 100000.0, 2147483647.0) for f in (1, -1, 1 - 2.0**-52, 1 + 2.0**-52, 1 - 1e-9)]
    df = spark.createDataFrame([(x,) for x in [*edges, None, 0.0, float("nan"), float("inf"), -float("inf")]], "x DOUBLE")
    for type_, rounded in (("INT", "abs(round(x)) <= 2147483647"), ("DECIMAL(5,2)", "abs(round(x, 2)) < 1000"), ("DECIMAL(7,2)", "abs(round(x, 2)) < 100000")):
        got = df.selectExpr("x", f"{measures._bound('x', type_)} AS got", f"{rounded} AS want", f"{measures._bound('x', type_).count('round')} AS rounds")
        assert all(r.got == r.want and r.rounds == 0 for r in got.collect())
