import hashlib
import io
import re
from contextlib import redirect_stdout

import numpy as np
from helpers import naive, rows, utc
from pyspark.sql import functions as F

from ecostar.operators import anomalies, forest, measures as m

COLUMNS = "city_id INT, lake_hour TIMESTAMP, captured_at TIMESTAMP, temperature DOUBLE, humidity DOUBLE, pressure DOUBLE, " \
          "feels_like DOUBLE, wind_speed DOUBLE, aqi_index INT, pm25 DOUBLE, pm10 DOUBLE"
H = naive(2026, 1, 1)


def measure(city, temperature=None, aqi=None, **other):
    return (city, H, H, temperature, other.get("humidity"), other.get("pressure"), None, None, aqi, None, None)


def stats(spark, mean=0.0, std=10.0):
    fields = ", ".join(f"{mean}D AS mean_{f}, {std}D AS std_{f}" for f in anomalies.Z_FIELDS)
    return spark.sql(f"SELECT explode(sequence(1, 20)) AS city_id, {fields}")


def test_rules_are_strict(spark):
    df = spark.createDataFrame([measure(1, 60.0), measure(2, 60.01), measure(3, -50.0, 501)], COLUMNS)
    got = sorted(rows(anomalies.rule_hits(df), "city_id", "field_name", "description"))
    assert got == [
        (2, "temperature", "temperature = 60.01 °C est hors limites physiques [-50, 60]"),
        (3, "aqi", "aqi = 501 index est hors limites physiques [0, 500]"),
    ]


def test_z_ladder(spark):
    values = [19.9, 20.0, 25.0, 30.0, 40.0, -40.0]
    df = spark.createDataFrame([measure(i, v) for i, v in enumerate(values, 1)], COLUMNS)
    got = sorted(rows(anomalies.zscore_hits(df, stats(spark)), "city_id", "severity", "action_taken", "expected_range_max"))
    assert got == [
        (2, "low", "flagged", 30.0), (3, "medium", "flagged", 30.0), (4, "high", "rejected", 30.0),
        (5, "critical", "rejected", 30.0), (6, "critical", "rejected", 30.0),
    ]
    assert anomalies.zscore_hits(df, stats(spark, std=0.0)).count() == 0
    text = anomalies.zscore_hits(df, stats(spark)).filter("city_id = 3").first().description
    assert text == "temperature = 25.0 s'écarte de 2.50 écarts-types (μ=0.0, σ=10.0)"


def test_verdict_and_split(spark):
    df = spark.createDataFrame([measure(1, 1.0), measure(2, 22.0), measure(3, 61.0), measure(4, None, 600)], COLUMNS)
    judged = anomalies.judge(df, stats(spark, std=11.0))
    got = sorted(rows(judged, "city_id", "is_anomaly", "anomaly_score", "is_rejected"))
    assert got[0] == (1, False, None, False) and got[1] == (2, True, 2.0, False)
    assert got[2][:2] == (3, True) and got[2][3] and abs(got[2][2] - 61 / 11) < 1e-9
    rules_only = anomalies.judge(df).filter("city_id = 4").first()
    assert (rules_only.is_anomaly, rules_only.anomaly_score, rules_only.is_rejected) == (True, 0.0, True)
    loaded, rejected, stored = anomalies.split_critical(judged)
    assert sorted(rows(loaded, "city_id")) == [(1,), (2,)] and rejected.count() == 2
    assert set(rows(stored, "city_id", "severity")) == {(2, "low"), (3, "critical"), (4, "critical")}


def test_city_stats_window(spark):
    df = spark.createDataFrame(
        [(1, utc(2026, 1, 31), 10.0), (1, utc(2026, 1, 30), 20.0), (1, utc(2025, 12, 31), 99.0), (1, utc(2026, 1, 1), 30.0)],
        "city_id INT, captured_at TIMESTAMP, temperature DOUBLE",
    ).withColumns({c: F.lit(None).cast("double") for c in ("humidity", "pressure", "aqi_index")})
    row = anomalies.city_stats(df, F.lit(utc(2026, 1, 31))).first()
    assert row.mean_temperature == 25.0 and abs(row.std_temperature - 50**0.5) < 1e-9


def normal(spark, n=3000):
    rng = np.random.default_rng(3)
    data = [
        (i, 1, False, *map(float, rng.normal([12, 60, 1013, 50, 12, 20], [6, 10, 8, 15, 4, 6])), utc(2026, 1, 1))
        for i in range(n)
    ]
    return spark.createDataFrame(
        data,
        "measure_id BIGINT, city_id INT, is_anomaly BOOLEAN, temperature DOUBLE, humidity DOUBLE, pressure DOUBLE, "
        "aqi_index DOUBLE, pm25 DOUBLE, pm10 DOUBLE, captured_at TIMESTAMP",
    ).withColumn("lake_hour", F.col("captured_at"))


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def table(model):
    return sorted(map(tuple, model.nodes.collect()))


def test_forest_flags_its_share_and_a_planted_outlier(spark):
    facts = normal(spark).cache()
    model = forest.train_forest(facts)
    hits = forest.forest_hits(facts, model)
    share = hits.count() / facts.count()
    assert 0.03 < share <= 0.05
    assert not re.search("EvalPython|InPandas|InArrow", plan(hits))
    sizes = model.nodes.groupBy("tree").count().collect()
    assert len(sizes) == 100 and max(r["count"] for r in sizes) <= 511
    odd = facts.limit(1).withColumns({"temperature": F.lit(58.0), "pressure": F.lit(900.0), "aqi_index": F.lit(480.0)})
    hit = forest.forest_hits(odd, model).first()
    assert hit.severity in ("high", "critical") and hit.field_name == "multivariate"
    again = forest.train_forest(facts.repartition(7))
    assert again.threshold == model.threshold and table(again) == table(model)


def c(n):
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def test_trees_by_plain_recursion(spark):
    """Nodes, paths and scores against trees that are grown and walked row by row."""
    facts = normal(spark, 300)
    model = forest.train_forest(facts, trees=5, seed=9)
    data = {r.measure_id: [float(r[f]) for f in ("temperature", "humidity", "pressure", "aqi_index", "pm25", "pm10")] for r in facts.collect()}
    prime, want, leaf = forest.PRIME, [], {}

    def draw(i, tree):
        h = hashlib.md5(f"9|{i}".encode()).hexdigest()
        return (int(h[:15], 16) % prime + tree * (int(h[16:31], 16) % prime)) % prime

    def grow(tree, node, x, size):
        h = hashlib.md5(f"9|{tree}|{node}".encode()).hexdigest()
        depth = node.bit_length() - 1
        wide = [k for k in range(6) if max(v[k] for v in x) > min(v[k] for v in x)]
        path = round(1e6 * (depth + c(len(x))))
        if len(x) < 2 or not wide or depth >= np.ceil(np.log2(size)):
            want.append((tree, node, -1, None, len(x), path))
            leaf[tree, node] = path
            return
        k = wide[int(h[:8], 16) % len(wide)]
        low, high = min(v[k] for v in x), max(v[k] for v in x)
        cut = low + (high - low) * (int(h[8:16], 16) / 2**32)
        want.append((tree, node, k, cut, len(x), path))
        leaf[tree, node] = (k, cut)
        grow(tree, 2 * node, [v for v in x if v[k] <= cut], size)
        grow(tree, 2 * node + 1, [v for v in x if v[k] > cut], size)

    for tree in range(1, 6):
        chosen = sorted(data, key=lambda i: (draw(i, tree), i))[:256]
        grow(tree, 1, [data[i] for i in chosen], 256)
    assert table(model) == sorted(want, key=lambda r: r[:2])

    def score(x):
        total = 0
        for tree in range(1, 6):
            node = 1
            while isinstance(at := leaf[tree, node], tuple):
                node = 2 * node + (x[at[0]] > at[1])
            total += at
        return round(-(2 ** -(total / 5e6 / c(256))), 6)

    scored = forest.scored(forest.training_rows(facts), model, {f: F.col(f) for f in forest.FEATURES})
    assert all(abs(r.forest_score - score(data[r.measure_id])) < 2e-6 for r in scored.collect())
    assert model.threshold == sorted(score(x) for x in data.values())[14]


def test_forest_needs_rows_and_samples_stay_full(spark):
    assert forest.train_forest(normal(spark, 99)) is None
    rows_ = spark.range(20000).select(F.col("id").alias("measure_id"), *(F.rand(1).alias(f) for f in forest.FEATURES))
    sizes = forest.tree_samples(rows_, 100, 42).groupBy("tree").count().collect()
    assert len(sizes) == 100 and {r["count"] for r in sizes} == {forest.SAMPLE}


def test_forest_of_equal_rows_is_leaves(spark):
    same = normal(spark, 1).drop("measure_id").crossJoin(spark.range(150).withColumnRenamed("id", "measure_id"))
    model = forest.train_forest(same, trees=3)
    assert [r[1:3] for r in table(model)] == [(1, -1)] * 3 and forest.forest_hits(same, model).count() == 0


def test_measure_ids_are_unique(spark):
    df = spark.range(2000).selectExpr("int(id % 10 + 1) AS city_id", "timestamp_seconds(1700000000 - 1700000000 % 3600 + (id div 10) * 3600) AS lake_hour")
    assert df.select(m.measure_id().alias("i")).distinct().count() == 2000
