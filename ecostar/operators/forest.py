"""Isolation forest: sampled, grown and walked by DataFrame expressions alone.

All trees are one frame. A tree is grown level by level: its sampled rows stay in one
partition, every level is a window over their nodes, and all random numbers are digests
of the seed, the tree and the node, so a tree is the same wherever it is grown. Splits
lie between the extremes of a feature, so scaling the features would change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ecostar.operators.anomalies import FOREST_SCORE, exploded, forest_hit, value_of
from ecostar.sources.warehouse import stage

FEATURES = ("temperature", "humidity", "pressure", "aqi", "pm2_5", "pm10")
REQUIRED = ("temperature", "humidity", "pressure", "aqi")
SAMPLE, DEPTH = 256, 8
MIN_ROWS = 100
#: A prime below 2^53: the draws of a row for all trees are h1 + tree * h2 modulo it, so two trees draw independently.
PRIME = (1 << 53) - 111
#: Rows per tree that a draw lets through to the ranking, of which ``SAMPLE`` stay.
NEAR = 4 * SAMPLE
#: Paths are whole millionths, so that their sums don't depend on an order; scores have as many digits.
UNIT, DIGITS = 1_000_000, 6
EULER = 0.5772156649015329

NODES = "tree INT, node INT, feature INT, cut DOUBLE, n BIGINT, path BIGINT"


def mean_path(n: str) -> str:
    """SQL for the average path length of an unsuccessful search among ``n`` rows."""
    return (
        f"CASE WHEN {n} > 2 THEN 2D * (ln({n} - 1D) + {EULER}D) - 2D * ({n} - 1D) / {n} WHEN {n} = 2 THEN 1D ELSE 0D END"
    )


def _bits(digest: str, first: int, digits: int) -> str:
    return f"CAST(conv(substring({digest}, {first}, {digits}), 16, 10) AS BIGINT)"


def training_rows(facts: DataFrame, limit: int | None = None) -> DataFrame:
    """The latest normal measures; those with all required values, taken after the limit."""
    normal = facts.filter(~F.col("is_anomaly"))
    if limit is not None:
        normal = normal.orderBy(F.desc("captured_at"), F.desc("measure_id")).limit(limit)
    rows = normal.select("measure_id", *(value_of(f).alias(f) for f in FEATURES))
    return rows.dropna(subset=list(REQUIRED)).fillna(0.0, subset=list(FEATURES))


def tree_samples(rows: DataFrame, trees: int, seed: int) -> DataFrame:
    """(tree, measure_id, x): per tree the ``SAMPLE`` rows with the smallest draws, all rows where there are fewer.

    A row is sent only to the trees for which its draw is small enough to matter, NEAR rows
    a tree in expectation, so the history is not multiplied by the number of trees.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col("measure_id").cast("string")))
    halves = rows.select(
        "measure_id", F.array(*FEATURES).alias("x"), digest.alias("digest"), rows.agg(F.count("*")).scalar().alias("total")
    ).selectExpr(
        "measure_id", "x", f"{_bits('digest', 1, 15)} % {PRIME} AS h1", f"{_bits('digest', 17, 15)} % {PRIME} AS h2",
        f"CAST({PRIME} * least(1D, {NEAR}D / total) AS BIGINT) AS near",
    )
    drawn = halves.selectExpr(
        "measure_id", "x",
        f"explode(filter(transform(sequence(1, {trees}), t -> named_struct('tree', t, 'draw', (h1 + t * h2) % {PRIME})), d -> d.draw < near)) AS d",
    ).select("d.tree", "d.draw", "measure_id", "x")
    smallest = W.partitionBy("tree").orderBy("draw", "measure_id")
    return drawn.withColumn("rank", F.row_number().over(smallest)).filter(F.col("rank") <= SAMPLE).select("tree", "measure_id", "x")


def grow_trees(samples: DataFrame, seed: int) -> DataFrame:
    """Node table of the forest (``NODES``): node 1 is a root, 2i and 2i + 1 the children of i; a leaf has feature -1.

    One shuffle brings a tree's rows together; the windows of all levels need no other.
    """
    rows = samples.withColumns({"size": F.count("*").over(W.partitionBy("tree")), "node": F.lit(1), "seen": F.array()})
    k = range(len(FEATURES))
    for _ in range(DEPTH + 1):
        here = W.partitionBy("tree", "node")
        rows = rows.withColumns({
            "n": F.count("*").over(here),
            "lo": F.array(*(F.min(F.col("x")[i]).over(here) for i in k)),
            "hi": F.array(*(F.max(F.col("x")[i]).over(here) for i in k)),
        })
        rows = rows.selectExpr("*", f"filter(sequence(0, {len(FEATURES) - 1}), i -> hi[i] > lo[i]) AS wide", f"md5(concat('{seed}|', tree, '|', node)) AS digest")
        rows = rows.selectExpr(
            "*",
            "CASE WHEN n > 1 AND size(wide) > 0 AND floor(log2(node)) < ceil(log2(greatest(size, 2))) "
            f"THEN wide[CAST({_bits('digest', 1, 8)} % size(wide) AS INT)] ELSE -1 END AS feature",
        )
        rows = rows.selectExpr("*", f"CASE WHEN feature >= 0 THEN lo[feature] + (hi[feature] - lo[feature]) * ({_bits('digest', 9, 8)} / 4294967296D) END AS drawn")
        rows = rows.selectExpr("*", "CASE WHEN feature >= 0 THEN IF(drawn >= hi[feature], lo[feature], drawn) END AS cut")
        rows = rows.selectExpr(
            "tree", "x", "size", "CASE WHEN feature < 0 THEN node WHEN x[feature] <= cut THEN 2 * node ELSE 2 * node + 1 END AS node",
            "concat(seen, array(struct(node, feature, cut, n))) AS seen",
        )
    path = f"CAST(round({UNIT} * (floor(log2(node)) + {mean_path('n')})) AS BIGINT)"
    return rows.select("tree", F.explode("seen").alias("s")).select("tree", "s.*").distinct().selectExpr(
        "CAST(tree AS INT) AS tree", "CAST(node AS INT) AS node", "CAST(feature AS INT) AS feature", "cut", "n", f"{path} AS path"
    )


@dataclass
class Forest:
    """A trained model: a stored table of at most trees x 511 nodes, whatever it was trained on."""

    nodes: DataFrame
    trees: int
    sample: int
    threshold: float | None = None


def train_forest(
    facts: DataFrame, limit: int | None = None, trees: int = 100, contamination: float = 0.05, seed: int = 42,
) -> Forest | None:
    """A forest, or None with fewer than ``MIN_ROWS`` usable rows. Only its row count and threshold reach the driver."""
    rows = stage(training_rows(facts, limit), "forest-rows")
    total = rows.count()
    if total < MIN_ROWS:
        return None
    nodes = stage(grow_trees(tree_samples(rows, trees, seed), seed), "forest-nodes")
    forest = Forest(nodes, trees, min(SAMPLE, total))
    forest.threshold = threshold(scored(rows, forest, {f: F.col(f) for f in FEATURES}), contamination)
    return forest


def threshold(scores: DataFrame, contamination: float) -> float:
    """The score at the share ``contamination`` from below; counted per rounded score, so at most 10^DIGITS rows meet."""
    counts = scores.groupBy(FOREST_SCORE).agg(F.count("*").alias("n"))
    upto = W.orderBy(FOREST_SCORE).rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.select(FOREST_SCORE, F.sum("n").over(upto).alias("upto"), F.sum("n").over(W.partitionBy()).alias("total"))
    return ranked.filter(F.col("upto") >= F.col("total") * contamination).agg(F.min(FOREST_SCORE)).first()[0]


def _arrays(forest: Forest) -> Column:
    """The whole forest as one value: per tree the nodes in order; a right child follows its left one."""
    in_order = F.array_sort(F.collect_list(F.struct("node", "feature", "cut", "path"))).alias("a")
    trees = forest.nodes.groupBy("tree").agg(in_order).selectExpr(
        "transform(a, v -> v.feature) AS f", "transform(a, v -> v.cut) AS c", "transform(a, v -> v.path) AS p",
        "transform(a, v -> CAST(array_position(transform(a, u -> u.node), 2 * v.node) AS INT)) AS left",
    )
    return trees.agg(F.collect_list(F.struct("f", "c", "p", "left"))).scalar()


def scored(df: DataFrame, forest: Forest, features: dict[str, Column]) -> DataFrame:
    """``df`` with its ``forest_score`` in [-1, 0], lower is stranger; a missing value counts as 0."""
    values = F.array(*(F.coalesce(F.nanvl(features[f].cast("double"), F.lit(0.0)), F.lit(0.0)) for f in FEATURES))
    step = "IF(t.f[at] < 0, at, t.left[at] - IF(_x[t.f[at]] <= t.c[at], 1, 0))"
    walk = f"aggregate(sequence(1, {DEPTH}), 0, (at, _) -> {step})"
    total = f"aggregate(_forest, 0L, (sum, t) -> sum + t.p[{walk}])"
    usual = mean_path(str(forest.sample))
    return df.withColumns({"_forest": _arrays(forest), "_x": values}).withColumn(
        FOREST_SCORE, F.expr(f"round(-power(2D, -({total} / {forest.trees * UNIT}D) / ({usual})), {DIGITS})")
    ).drop("_forest", "_x")


def scored_measures(measures: DataFrame, forest: Forest) -> DataFrame:
    return scored(measures, forest, {f: value_of(f) for f in FEATURES})


def forest_hits(measures: DataFrame, forest: Forest) -> DataFrame:
    """One ``multivariate`` hit per measure that scores below the threshold."""
    hit = F.array_compact(F.array(forest_hit(forest.threshold)))
    return exploded(scored_measures(measures, forest), hit)
