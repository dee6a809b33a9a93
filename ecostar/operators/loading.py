"""Keep-first loading against a unique key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ecostar.sources.warehouse import staged_days


def keep_first(
    old: DataFrame, rows: DataFrame, key: list[str], order: str = "id", within: str | None = None
) -> DataFrame:
    """New rows of ``rows``: the one with the lowest ``order`` per key absent from ``old``.

    A unique key with a NULL part never collides, so each such row is a group of its
    own. The pick is one aggregation with partial results: one scan, and a hot key
    costs no more than others. ``within`` names a partition column of the table that
    the key determines; only the partitions that the rows touch are then read.
    """
    if within:
        old = old.join(staged_days(rows.select(within).distinct(), within), within, "left_semi")
    incomplete = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    rest = [c for c in rows.columns if c not in key and c != order]
    first = (
        rows.withColumn("_alone", F.when(incomplete, F.col(order)))
        .groupBy(*key, "_alone")
        .agg(F.min(order).alias(order), *(F.min_by(c, order).alias(c) for c in rest))
    )
    return first.join(old.select(*key), key, "left_anti").select(*rows.columns)
