import io
import random
import threading
import time
from contextlib import redirect_stdout

from helpers import entry, lake, naive, rows, utc
from pyspark.sql import functions as F

from ecostar import queries
from ecostar.operators import dimensions, measures as m, traffic, water
from ecostar.operators.loading import keep_first
from ecostar.sources import done, lake as lake_io, reference, warehouse


def test_source_caps_hold_per_pull(spark, monkeypatch):
    """30 incidents and 20 drinking-water rows per city and pull, so that a day's later pulls stay."""
    sources = {"tomtom_incidents": 40, "hubeau_eau_potable": 25}
    raw = [entry(i, s, "{}", utc(2026, 1, 20, h)) for k, s in enumerate(sources) for h in (8, 9)
           for i in range(1000 * k + 100 * h, 1000 * k + 100 * h + sources[s])]
    monkeypatch.setattr(queries.v, "lake", lambda *_: lake(spark, raw))
    got = queries.QUERIES["source_caps"](spark, "").groupBy("source").count()
    assert sorted(rows(got, "source", "count")) == [("hubeau_eau_potable", 40), ("tomtom_incidents", 60)]


def test_larger_id_wins_over_later_time(spark):
    df = lake(
        spark,
        [
            entry(42, "aqicn", {"data": {"aqi": 1}}, utc(2026, 1, 20, 15, 50)),
            entry(44, "aqicn", {"data": {"aqi": 59}}, utc(2026, 1, 20, 15, 9)),
            entry(43, "openweather", {"main": {"temp": 9.09}}, utc(2026, 1, 20, 15, 11)),
            entry(45, "openweather", {"main": {"temp": 3}}, utc(2026, 1, 20, 16, 0)),
        ],
    )
    kept, discarded = m.dedup(df)
    assert sorted(rows(kept, "id")) == [(43,), (44,), (45,)] and rows(discarded, "id") == [(42,)]
    got = sorted(rows(m.combine(df), "lake_hour", "captured_at", "temperature", "aqi_index", "raw_aqi_id"))
    assert got == [
        (naive(2026, 1, 20, 15), naive(2026, 1, 20, 15, 11), 9.09, 59, 44),
        (naive(2026, 1, 20, 16), naive(2026, 1, 20, 16), 3.0, None, None),
    ]


def test_unreadable_weather_leaves_no_trace_id(spark):
    df = m.combine(lake(spark, [entry(1, "openweather", "broken", utc(2026, 1, 1))]))
    row = df.first()
    assert (row.weather_lake_id, row.raw_weather_id, row.rain_1h) == (1, None, None)


def test_null_in_unique_key_never_collides(spark):
    data = [(1, None, "p", 1), (2, None, "p", 2), (3, "c", "p", 3), (4, "c", "p", 4), (5, "d", "p", 5)]
    df = spark.createDataFrame(data, "id INT, a STRING, b STRING, v INT")
    old = spark.createDataFrame([("d", "p")], "a STRING, b STRING")
    got = sorted(rows(keep_first(old, df, ["a", "b"]), "id", "v"))
    assert got == [(1, 1), (2, 2), (3, 3)]


def test_hot_key_keeps_exactly_one(spark):
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    got = keep_first(spark.sql("SELECT 1 AS k WHERE FALSE"), df, ["k"])
    assert got.count() == 20001 and got.filter("k = 0").first().id == 0


def test_number_rows_is_dense_and_ordered(spark):
    random.seed(1)
    ids = random.sample(range(-10**12, 10**12), 500) + list(range(200000, 200700))
    df = spark.createDataFrame([(i,) for i in ids], "o BIGINT")
    got = sorted(rows(warehouse.number_rows(df, "o", "n", F.lit(10)), "o", "n"))
    assert got == [(o, n) for n, o in enumerate(sorted(ids), 11)]


def test_get_or_create_keeps_rows_and_takes_lowest_entry(spark):
    dim = spark.sql("SELECT 5 AS commune_id, 'A' AS code_commune, 'old' AS nom_commune")
    new = spark.createDataFrame([(9, "B", "late"), (3, "B", "early"), (4, "A", "new"), (1, None, "x"), (2, "", "y")],
                                "id BIGINT, code_commune STRING, nom_commune STRING")
    got = sorted(rows(dimensions.communes(dim, new), "commune_id", "code_commune", "nom_commune"))
    assert got == [(5, "A", "old"), (6, "B", "early")]


def test_bare_station_is_never_enriched(spark):
    stations = spark.sql("SELECT 9L AS id, 'S' AS code_station, 'full' AS libelle_station, 1D AS latitude, "
                         "2D AS longitude, 'c' AS code_commune, 'n' AS libelle_commune")
    obs = spark.sql("SELECT 2L AS id, 'S' AS code_station")
    got = dimensions.stations(warehouse.empty_table(spark, dimensions.STATION), stations, obs)
    assert rows(got, "station_id", "code_station", "libelle_station") == [(1, "S", None)]


def test_upsert_rules(spark):
    old = spark.createDataFrame(
        [(1, 1, naive(2026, 1, 1), 1.0, 10), (2, 1, naive(2026, 1, 1), 2.0, None)],
        "measure_id BIGINT, city_id INT, captured_at TIMESTAMP, temperature DOUBLE, aqi_index INT",
    )
    new = spark.createDataFrame(
        [(5, 1, naive(2026, 1, 1), None, 7), (6, 1, naive(2026, 1, 1), 8.0, None), (7, 2, naive(2026, 1, 1), 3.0, None)],
        "id BIGINT, city_id INT, captured_at TIMESTAMP, temperature DOUBLE, aqi_index INT",
    )
    got = sorted(rows(m.upsert_measures(old, new, "id"), "measure_id", "city_id", "temperature", "aqi_index"))
    assert got == [(1, 1, 1.0, 10), (2, 1, 8.0, 7), (3, 2, 3.0, None)]


def test_date_gate_and_clamp(spark):
    df = spark.createDataFrame([(naive(2023, 12, 31),), (naive(2024, 1, 1),), (naive(2027, 12, 31, 5),)], "captured_at TIMESTAMP")
    gated = m.clamp_future(df, F.lit(utc(2027, 1, 1, 0, 0, 3).replace(microsecond=70)))
    ok, bad = m.date_gate(gated, reference.dim_date(spark), "capture_date")
    assert sorted(rows(ok, "captured_at")) == [(naive(2024, 1, 1),), (naive(2027, 1, 1, 0, 0, 3),)]
    assert rows(bad, "captured_at", "reason") == [(naive(2023, 12, 31), "date_out_of_range")]


def test_overflow_is_rejected_not_nulled(spark):
    fields = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in m.MEASURE_FIELDS if c != "wind_gust")
    df = spark.sql(f"SELECT * FROM (SELECT {fields}) CROSS JOIN VALUES (999.99D), (1000D), (NULL) AS t(wind_gust)")
    ok, bad = m.split_overflow(df)
    assert sorted(rows(ok, "wind_gust"), key=str) == [(999.99,), (None,)]
    assert rows(bad, "wind_gust", "reason") == [(1000.0, "numeric_overflow")]


def test_incident_hour(spark):
    inc = spark.createDataFrame(
        [(3, 1, utc(2026, 1, 1, 5, 10), 8, 4.0, 420.0, 100.0, "m"), (2, 1, utc(2026, 1, 1, 5, 50), 8, 0.0, 0.0, 30.0, "x" * 40),
         (4, 1, utc(2026, 1, 1, 5, 55), 8, 0.0, -1.0, 30.0, "bad")],
        "id BIGINT, city_id INT, collected_at TIMESTAMP, categorie_incident INT, gravite_retard DOUBLE, retard_s DOUBLE, "
        "longueur_m DOUBLE, traffic_model_id STRING",
    )
    cats = spark.sql("SELECT 1 AS incident_category_id, 8 AS icon_category")
    row = traffic.load_incidents(inc, cats).first()
    assert (row.nombre_incidents, row.retard_total_s, row.retard_moyen_s, row.longueur_moyenne_m) == (2, 420.0, 210.0, 30.0)
    assert row.incident_severity_score == 4.81 and row.traffic_model_id == "x" * 40
    assert traffic.load_incidents(inc, cats, model_chars=30).first().traffic_model_id == "x" * 30


def test_water_dates(spark):
    rec = spark.createDataFrame(
        [(1, 1, utc(2026, 5, 1, 9), None, "c"), (2, 1, utc(2026, 5, 1, 9), "2026-04-30T06:00:00Z", "c"),
         (3, 1, utc(2026, 5, 1, 9), "nonsense", "c")],
        "id BIGINT, city_id INT, collected_at TIMESTAMP, date_prelevement STRING, code_commune STRING",
    ).withColumns({c: F.lit(None).cast("string") for c in ("libelle_parametre", "libelle_unite", "conclusion_conformite_prelevement")}
                  ).withColumn("resultat_numerique", F.lit(1.0))
    good, bad = water.drinking_rows(rec)
    assert sorted(rows(good, "id", "hour_of_day")) == [(1, 9), (2, 6)]
    assert rows(bad, "id", "reason") == [(3, "bad_date")]


def test_export_round_trip_and_array_files(spark, tmp_path):
    df = lake(
        spark,
        [entry(1, "aqicn", {"data": {"aqi": 3.5}}, utc(2026, 1, 20, 15, 11, 13)), entry(2, "aqicn", "not json", utc(2026, 1, 21)),
         entry(3, "aqicn", {}, utc(2026, 1, 22), 2, "Lyon")],
    )
    lake_io.export_city(df, "Paris", str(tmp_path / "out"))
    back = lake_io.read_lake(spark, str(tmp_path / "out"))
    assert rows(back, "id", "raw_data") == [(2, "not json"), (1, '{"data":{"aqi":3.5}}')]
    (tmp_path / "export.json").write_text(
        '[\n {"id": 43, "city_id": 1, "raw_data": {"dt": 1,\n "main": {}}, "collected_at": "2026-01-20T15:11:13.62398+00:00"},'
        '\n {"id": 44, "city_id": 1, "raw_data": null}\n]'
    )
    got = rows(lake_io.read_lake(spark, str(tmp_path / "export.json"), array_file=True), "id", "raw_data", "collected_at")
    assert got[0][0] == 43 and got[0][1].replace("\n", "").replace(" ", "") == '{"dt":1,"main":{}}'
    assert got[0][2] == naive(2026, 1, 20, 15, 11, 13, 623980) and got[1][1] is None


def test_routes_and_log(spark):
    df = lake(spark, [entry(i, s, "{}", utc(2026, 1, 1)) for i, s in enumerate(("aqicn", "tomtom_flow", "hubeau_cd_stations", "odd"))])
    assert sorted(rows(lake_io.routed(df), "id", "family")) == [(0, "weather_air"), (1, "traffic"), (2, "water"), (3, "rejects")]
    assert rows(lake_io.rejected_sources(df), "id", "reason") == [(3, "unknown_source")]
    for oks, want in (([True], "success"), ([True, False], "warning"), ([False], "error")):
        log = lake_io.run_log(spark.createDataFrame([(o,) for o in oks], "ok BOOLEAN"), "t", F.lit(utc(2026, 1, 1)), F.lit(1))
        assert log.first().status == want


def test_done_ranges_equal_sets(spark, tmp_path):
    """Islands over blocks and spans, grown batch by batch, against sets of ids."""
    random.seed(3)
    edge, far = 1 << done.BLOCK_BITS, 1 << done.SPAN_BITS
    whole = [*range(edge - 40, edge + 40), *range(-5, 9), *range(far - 3, far + 4), 10**12]
    seen, ranges = set(), warehouse.empty_table(spark, done.RANGES)
    everything = spark.createDataFrame([(i,) for i in [*whole, edge + 99, -9]] + [(None,)], "id BIGINT")
    for part in (whole[::3], random.sample(whole, 30), whole[1::3] + whole[2::3]):
        batch = spark.createDataFrame([(i,) for i in part] + [(None,)], "id BIGINT")
        new = done.with_ids(ranges, batch)
        kept = ranges.join(new.select("span").distinct(), "span", "left_anti").unionByName(new)
        ranges = warehouse.stage(kept.select("block", "lo", "hi", "span"), "ranges")
        seen |= set(part)
        got = {r.id for r in done.pending(everything, ranges).collect()}
        assert got == {i for i in [*whole, edge + 99, -9]} - seen | {None}
    # dense ids stay few rows: an island per block and gap
    assert sorted(rows(ranges, "lo", "hi")) == [
        (-5, -1), (0, 8), (edge - 40, edge - 1), (edge, edge + 39), (far - 3, far - 1), (far, far + 3), (10**12, 10**12)]
    assert done.first_island(ranges) == (-5, 8) and done.first_island(ranges.limit(0)) is None


def test_folders_of_a_batch_are_published_side_by_side(spark, tmp_path, monkeypatch):
    """Files of many folders, one of them replaced; moves overlap in time, files of an outer level and hidden ones are listed right."""
    root, together, most = str(tmp_path), [0], [0]
    move, lock = warehouse.move_file, threading.Lock()

    def slow(*args):
        with lock:
            together[0] += 1
            most[0] = max(most[0], together[0])
        time.sleep(0.05)
        move(*args)
        with lock:
            together[0] -= 1

    monkeypatch.setattr(warehouse, "move_file", slow)
    for rows_ in ("id % 12 AS d", "0L AS d"):
        batch = warehouse.Batch(spark, root)
        batch.write(spark.range(24).selectExpr("id", rows_), "t", "d", replace=True)
        batch.commit()
    kept = spark.read.schema("id BIGINT, d BIGINT").parquet(f"{root}/t")
    assert sorted(rows(kept, "id", "d")) == sorted([(i, i % 12) for i in range(24) if i % 12] + [(i, 0) for i in range(24)])
    assert most[0] > 1
    (tmp_path / "t" / "_mark").touch()
    (tmp_path / "t" / "plain").touch()
    found = warehouse.list_files(spark, f"{root}/t")
    assert len(found) == 13 and "plain" in found and warehouse.list_files(spark, f"{root}/none") == []


def test_pending_looks_up_one_row_per_entry(spark):
    """Every other id of a block is done; whole blocks, edges of words and gaps at the end of a span too."""
    block, span = 1 << done.BLOCK_BITS, 1 << done.SPAN_BITS
    dense = [(0, 5 * block + 2 * i, 5 * block + 2 * i, 0) for i in range(3000)]
    far = [((span >> done.BLOCK_BITS) - 1, span - 3, span - 1, 0), (span >> done.BLOCK_BITS, span + 100, span + 170, 1)]
    parts = [(-2, -2 * block, -block - 1, -1), (2, 2 * block, 3 * block - 1, 0), (4, 4 * block + 63, 4 * block + 64, 0), *((5, *r[1:]) for r in dense), *far]
    ranges = warehouse.stage(spark.createDataFrame(parts, done.RANGES), "ranges")
    probes = [x for _, lo, hi, _ in parts for x in (lo - 1, lo, hi, hi + 1)] + [2 * block + 777, -block - 700, span + 50, span + 128]
    entries = spark.createDataFrame([(x,) for x in probes], "id BIGINT").repartition(4)
    covered = {x for x in probes for _, lo, hi, _ in (*parts[:3], *far) if lo <= x <= hi} | {r[1] for r in dense}
    assert sorted(r.id for r in done.pending(entries, ranges).collect()) == sorted(x for x in probes if x not in covered)
    assert done.words(ranges.filter("block = 5")).count() == -(-6000 // 64)  # not one row per range, to be met by every id of the block
    only = spark.createDataFrame(far, done.RANGES)  # the first island ends with the span, as the next one begins later
    assert done.first_island(only) == (span - 3, span - 1)
    assert sorted(r.id for r in done.pending(spark.createDataFrame([(span - 1,), (span + 50,), (span + 100,)], "id BIGINT"), only).collect()) == [span + 50]


def test_pending_entries_skip_what_was_done_in_order(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake_io.append_lake(lake(spark, [entry(i, "aqicn", "{}", utc(2026, 1, 1 + i // 50)) for i in range(200)]), path)
    ranges = warehouse.stage(done.ranges_of(spark.range(150)), "ranges")
    found = lake_io.unprocessed(lake_io.load_lake(spark, path), ranges, None)
    assert sorted(r.id for r in found.collect()) == list(range(150, 200))
    out = io.StringIO()
    with redirect_stdout(out):
        found.explain("formatted")
    assert "GreaterThan(id,149)" in out.getvalue() and "LessThan(id,0)" in out.getvalue()
