import random
from decimal import Decimal
from fractions import Fraction

import pandas as pd
from helpers import naive, rows, utc
from pyspark.sql import functions as F

from ecostar import queries
from ecostar.operators import quality, rolling
from ecostar.sources import reference


def facts(spark, data):
    return spark.createDataFrame(data, "table_source STRING, city_id INT, captured_at TIMESTAMP")


def test_gap_bound_is_strict(spark):
    df = facts(spark, [("m", 1, utc(2026, 1, 1, 0)), ("m", 1, utc(2026, 1, 1, 2)), ("f", 1, utc(2026, 1, 1, 4, 0, 1)),
                       ("m", 0, utc(2026, 1, 1)), ("m", 0, utc(2026, 1, 9)), ("m", None, utc(2026, 1, 9))])
    assert rows(quality.gaps(df), "city_id", "gap_start", "gap_end") == [(1, naive(2026, 1, 1, 2), naive(2026, 1, 1, 4, 0, 1))]


def test_gaps_equal_brute_force(spark):
    random.seed(5)
    data = [(random.choice([1, 1, 1, 2, 3]), random.randint(0, 2_000_000)) for _ in range(600)]
    df = spark.createDataFrame(data, "city_id INT, s BIGINT").withColumn("captured_at", F.timestamp_seconds("s"))
    want = set()
    for city in (1, 2, 3):
        ts = sorted(s for c, s in data if c == city)
        want |= {(city, a, b) for a, b in zip(ts, ts[1:]) if b - a > 7200}
    got = quality.gaps(df).select("city_id", F.unix_timestamp("gap_start"), F.unix_timestamp("gap_end"))
    assert {tuple(r) for r in got.collect()} == want


def test_outliers_need_ten_values(spark):
    base = [(1.0,)] * 20 + [(2.0,)] * 20
    df = spark.createDataFrame(base + [(50.0,)], "temperature DOUBLE")
    row = quality.outliers(df).first()
    assert (row.field, row.outliers) == ("temperature", 1)
    assert quality.outliers(spark.createDataFrame([(1.0,)] * 8 + [(900.0,)], "temperature DOUBLE")).count() == 0


def test_checks_and_report(spark):
    cols = "table_source STRING, city_id INT, captured_at TIMESTAMP, capture_date DATE, created_at TIMESTAMP, temperature DOUBLE, " \
           "traffic_point_id INT, incident_category_id INT"
    t = naive(2026, 1, 2)
    d = t.date()
    data = [("m", 1, t, d, t, 99.0, None, None)] * 2 + [("m", None, t, d, naive(2026, 1, 1), 1.0, None, None)]
    df = spark.createDataFrame(data, cols)
    issues = quality.issue_rows(
        quality.all_checks(df, reference.dim_city(spark), F.lit(utc(2026, 1, 1, 12))), F.lit("r"), F.lit(utc(2026, 1, 1, 12))
    ).collect()
    found = {(r.severity, r.category): r.message for r in issues}
    assert found[("critical", "null_values")] == "1 mesures avec city_id NULL sur 3"
    assert found[("critical", "duplicates")].startswith("1 doublons")
    assert found[("warning", "temporal_coherence")].startswith("1 mesures avec created_at")
    assert found[("critical", "temporal_coherence")].startswith("3 mesures avec captured_at")
    assert found[("critical", "business_rules")].startswith("2 violations")
    assert found[("warning", "data_coverage")].startswith("9 villes sans données : Marseille, Lyon")
    empty = quality.all_checks(df.limit(0), reference.dim_city(spark), F.lit(utc(2026, 1, 1)))
    assert {r.category for r in empty.collect()} == {"data_missing", "data_coverage"}


def test_missing_query_looks_at_windows_of_the_facts(spark, monkeypatch):
    days = facts(spark, [("m", 1, utc(2026, 1, d, h)) for d, h in ((1, 23), (2, 0), (5, 12))] + [("m", 1, None)])
    monkeypatch.setattr(queries, "_union", lambda *_: days)
    assert len(queries.QUERIES["dq_missing"](spark, "").collect()) == 3  # 3, 4 and 6 January
    monkeypatch.setattr(queries, "_union", lambda *_: days.limit(0))
    assert rows(queries.QUERIES["dq_missing"](spark, ""), "severity", "category") == [("critical", "data_missing")]


def test_coverage_query_counts_all_facts(spark, monkeypatch):
    cities = [r.city_id for r in reference.dim_city(spark).orderBy("city_id").collect()]
    day, next_day = naive(2026, 1, 1).date(), naive(2026, 1, 2).date()
    data = [(c, day) for c in cities[:-1] for _ in range(1 if c == cities[0] else 10)]
    data += [(c, next_day) for c in cities] + [(0, naive(2026, 1, 3).date())]
    frame = spark.createDataFrame(data, "city_id INT, capture_date DATE").withColumn("table_source", F.lit("t"))
    monkeypatch.setattr(queries, "_union", lambda *_: frame)
    got = {(r.capture_date, r.severity): r.message for r in queries.QUERIES["dq_coverage"](spark, "").collect()}
    assert got[("2026-01-01", "warning")].startswith("1 villes sans") and got[("2026-01-01", "info")].startswith("1 villes avec")
    assert got[("2026-01-03", "warning")].startswith("10 villes sans") and len(got) == 3
    whole = {r.severity: r.message for r in quality.check_coverage(frame.limit(0), reference.dim_city(spark)).collect()}
    assert list(whole) == ["warning"] and whole["warning"].startswith("10 villes")


def test_report_strictness(spark):
    issues = spark.sql("SELECT 'warning' AS severity")
    assert quality.report(issues).first().status == "ok"
    assert quality.report(issues, strict=True).first().status == "failed"


def test_cleanup(spark):
    df = spark.createDataFrame(
        [(1, 1, utc(2026, 1, 1), utc(2026, 1, 1)), (2, 1, utc(2026, 1, 1), utc(2026, 1, 2)), (3, 1, utc(2026, 1, 1), utc(2026, 1, 2)),
         (4, 1, utc(2027, 1, 1), utc(2026, 1, 1)), (5, 1, utc(2027, 1, 1), utc(2026, 1, 2))],
        "measure_id BIGINT, city_id INT, captured_at TIMESTAMP, created_at TIMESTAMP",
    )
    at = F.lit(utc(2026, 6, 1))
    assert sorted(rows(quality.find_duplicates(df), "measure_id")) == [(1,), (2,), (4,)]
    assert tuple(quality.cleanup_counts(df, at).first()) == (3, 1, 4)
    assert tuple(quality.cleanup_counts(df, at, dry_run=True).first()) == (3, 2, 5)


def test_rolling_equals_pandas(spark):
    random.seed(7)
    data = [(random.choice("aab"), random.randint(0, 90 * 86400), round(random.uniform(-50, 60), 2)) for _ in range(400)]
    data += [("a", data[0][1], 1.25), ("a", 0, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "id INT, k STRING, s BIGINT, v DOUBLE").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    z = {r.id: r.v_z_30d for r in rolling.rolling_z(df, "k", "ts", "v", 30).collect()}
    mean = {r.id: r.v_mean_7d for r in rolling.rolling_mean(df, "k", "ts", "v", 7).collect()}
    pdf = pd.DataFrame([(i, *r) for i, r in enumerate(data)], columns=["id", "k", "s", "v"])
    for r in pdf.itertuples():
        if pd.isna(r.v):
            assert z[r.id] is None
            continue
        same = pdf[(pdf.k == r.k) & (pdf.s <= r.s)]
        w30, w7 = same[same.s >= r.s - 30 * 86400].v.dropna(), same[same.s >= r.s - 7 * 86400].v.dropna()
        assert abs(mean[r.id] - w7.mean()) < 1e-9
        sd = w30.std()
        if pd.isna(sd) or sd == 0:
            assert z[r.id] is None
        else:
            assert abs(z[r.id] - (r.v - w30.mean()) / sd) < 1e-6


def test_rolling_keeps_six_decimals(spark):
    """Values that differ in the sixth decimal only, beside a large level, many of them in one minute and some in one instant."""
    random.seed(11)
    data = [("a", 86_400_000_000 * 5 + random.randint(0, 59_999_999), random.randint(0, 99)) for _ in range(300)]
    data += [("a", random.randint(0, 40 * 86_400_000_000), random.randint(0, 99)) for _ in range(200)] + [("a", 7, 5), ("a", 7, 6)]
    data += [("b", 7, 1)]
    frame = spark.createDataFrame([(i, k, us, Decimal(1_234_567_000_000 + x) / 1_000_000) for i, (k, us, x) in enumerate(data)], "id INT, k STRING, us BIGINT, d DECIMAL(18,6)")
    frame = frame.withColumns({"ts": F.timestamp_micros("us"), "v": F.col("d").cast("double")})
    for col in ("v", "d"):
        mean = {r.id: r[f"{col}_mean_7d"] for r in rolling.rolling_mean(frame, "k", "ts", col, 7).collect()}
        z = {r.id: r[f"{col}_z_30d"] for r in rolling.rolling_z(frame, "k", "ts", col, 30).collect()}
        for i, (k, us, x) in enumerate(data):
            week = [y for c, u, y in data if c == k and us - 7 * 86_400_000_000 <= u <= us]
            month = [y for c, u, y in data if c == k and us - 30 * 86_400_000_000 <= u <= us]
            assert mean[i] == float(Fraction(1_234_567_000_000 * len(week) + sum(week), 1_000_000 * len(week)))
            n, s, ss = len(month), sum(month), sum(y * y for y in month)
            if n * ss == s * s:
                assert z[i] is None
            else:
                assert abs(z[i] - (x - s / n) / ((n * ss - s * s) / (n * (n - 1))) ** 0.5) < 1e-9
    odd = spark.sql("SELECT 1 AS id, 'k' AS k, TIMESTAMP '2026-01-01 00:00:00' AS ts, v FROM VALUES (double('NaN')), (double('Infinity')), (1D), (NULL) AS t(v)")
    assert {r.v_mean_7d for r in rolling.rolling_mean(odd, "k", "ts", "v").collect()} == {1.0}


def test_all_checks_scan_the_facts_three_times(spark, tmp_path):
    day = [(i % 7, utc(2026, 1, 1, i % 24), float(i % 50 if i else 400), float(i % 90)) for i in range(600)]
    df = spark.createDataFrame(day, "city_id INT, captured_at TIMESTAMP, temperature DOUBLE, humidity DOUBLE").withColumns(
        {"created_at": F.col("captured_at"), "capture_date": F.to_date("captured_at"), "table_source": F.lit("t")})
    df.write.parquet(str(tmp_path / "facts"))
    seen = spark.read.parquet(str(tmp_path / "facts"))
    scans = []
    real = quality.stage

    def counting(frame, name):
        scans.append(str(tmp_path) in "".join(frame.inputFiles()))
        return real(frame, name)

    quality.stage = counting
    try:
        checks, silences = quality.all_checks_and_gaps(seen, reference.dim_city(spark), F.lit(utc(2026, 1, 2)))
    finally:
        quality.stage = real
    assert scans == [True] * 3 and not any(str(tmp_path) in f for out in (checks, silences) for f in out.inputFiles())
    found = {(r.category, r.severity): r for r in checks.collect()}
    assert found["business_rules", "critical"].message.startswith("1 ") and "400" in found["business_rules", "critical"].details
    assert '"field":"temperature","outliers":1' in found["statistical_outliers", "info"].details
    assert found["duplicates", "critical"].message.startswith(str(600 - 7 * 24))
    assert {r.city_id for r in quality.gaps(seen).collect()} == {r.city_id for r in silences.collect()}
    assert quality.all_checks(seen.limit(0), reference.dim_city(spark), F.lit(utc(2026, 1, 2))).count() == 2
