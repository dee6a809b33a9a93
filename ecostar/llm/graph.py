"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ecostar.llm.common import drop_staged, spread_join, staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = spread_join(both, least, ["u"], ["v"]).filter("v > u AND v <> m")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = spread_join(edges, least, ["u"], ["v"]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b bigint); component is the least node reachable.

    Every round is written to the shared folder; the loop ends when a round changes
    nothing. Self links and nulls are ignored; no edges give no rows. Hub nodes are
    dealt over parts, so that a star with most nodes in it stays spread.
    """
    now = staged(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    seen = mark(now)
    while seen[0]:
        large = staged(_large_star(now), "large-star")
        after = staged(_small_star(large), "small-star")
        drop_staged(large)
        drop_staged(now)
        now, last, seen = after, seen, mark(after)
        if seen == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
