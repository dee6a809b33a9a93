"""Rolling statistics over a time range, without a window per whole series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

#: Decimals of a DOUBLE column that are told apart; a DECIMAL column has its own.
DIGITS = 6


def _digits(df: DataFrame, col: str) -> int:
    kind = df.schema[col].dataType
    return kind.scale if isinstance(kind, T.DecimalType) else DIGITS


def _whole(col: str, digits: int) -> Column:
    """The value as a whole number of its last decimals, read from its decimal text; NULL for NaN and what fits no long."""
    return (F.col(col).try_cast(f"decimal(38,{digits})") * F.lit(10**digits)).try_cast("bigint")


def _before(window) -> object:
    return window.rowsBetween(W.unboundedPreceding, -1)


def rolling_sums(df: DataFrame, key: str, ts: str, value: Column, days: int, squares: bool = False) -> DataFrame:
    """Count and sum of a whole-number ``value`` over ``[t - days, t]`` for each (key, t), squares on demand.

    Equal instants are summed first. Each instant t then asks for two running
    totals, up to t and before t - days; their difference is the window. A running total
    is that of the days before, of the minutes of the day before, and inside its minute.
    So a window holds at most the days of a key, the 1440 minutes of a day or the instants
    of a minute, never a day's or a series' rows. Whole numbers keep the difference exact.
    """
    sums = {"n": F.count("*"), "s": F.sum(value.cast("decimal(28,0)")).cast("decimal(38,0)")}
    if squares:
        wide = value.cast("decimal(19,0)")
        sums["ss"] = F.sum(wide * wide).cast("decimal(38,0)")
    cells = (
        df.filter(value.isNotNull() & F.col(ts).isNotNull())
        .groupBy(F.col(key).alias("key"), F.col(ts).alias("owner"))
        .agg(*(c.alias(name) for name, c in sums.items()))
    )
    # Per instant one question before its window (side 0) and one at itself (side 1).
    # A question about the time before ``at`` sorts ahead of the values at ``at``.
    start = F.col("owner") - F.make_dt_interval(days=F.lit(days))
    sides = F.array(
        F.struct(start.alias("at"), F.lit(0).alias("side")), F.struct(F.col("owner").alias("at"), F.lit(1).alias("side"))
    )
    events = (
        cells.withColumn("q", F.explode(sides))
        .select("key", "owner", "q.at", "q.side", F.date_trunc("minute", "q.at").alias("minute"), *sums)
        .withColumns({c: F.when(F.col("side") == 1, F.col(c)).otherwise(F.lit(0)) for c in sums})
    )

    def total(c: str) -> Column:
        return F.sum(c).cast("decimal(38,0)").alias(c)

    minutes = events.groupBy("key", "minute").agg(*map(total, sums)).withColumn("day", F.to_date("minute"))
    of_days = minutes.groupBy("key", "day").agg(*map(total, sums))
    zero = F.lit(0).cast("decimal(38,0)")
    earlier = _before(W.partitionBy("key").orderBy("day"))
    day_bases = of_days.select("key", "day", *(F.coalesce(F.sum(c).over(earlier), zero).alias(f"day_{c}") for c in sums))
    same_day = _before(W.partitionBy("key", "day").orderBy("minute"))
    bases = minutes.select("key", "day", "minute", *(F.coalesce(F.sum(c).over(same_day), zero).alias(f"min_{c}") for c in sums)).join(
        day_bases, ["key", "day"]
    ).select("key", "minute", *((F.col(f"day_{c}") + F.col(f"min_{c}")).alias(f"base_{c}") for c in sums))
    inside = W.partitionBy("key", "minute").orderBy("at", "side").rowsBetween(W.unboundedPreceding, 0)
    running = events.join(bases, ["key", "minute"]).select(
        "key", "owner", "side", *((F.col(f"base_{c}") + F.sum(c).over(inside)).cast("decimal(38,0)").alias(f"run_{c}") for c in sums)
    )

    def difference(c: str) -> Column:
        run = F.col(f"run_{c}")
        return F.sum(F.when(F.col("side") == 1, run).otherwise(-run)).cast("decimal(38,0)").alias(f"window_{c}")

    return running.groupBy(F.col("key").alias(key), F.col("owner").alias(ts)).agg(*(difference(c) for c in sums))


def rolling_mean(df: DataFrame, key: str, ts: str, col: str, days: int = 7) -> DataFrame:
    """Each row with the mean of its key over the last ``days`` days, itself included; exact in the column's decimals."""
    digits = _digits(df, col)
    sums = rolling_sums(df, key, ts, _whole(col, digits), days)
    parts = (F.col("window_n") * F.lit(10**digits)).cast("decimal(19,0)")
    mean = F.try_divide(F.col("window_s").cast("decimal(25,0)"), parts).cast("double")
    return df.join(sums, [key, ts], "left").withColumn(f"{col}_mean_{days}d", mean).drop("window_n", "window_s")


def rolling_z(df: DataFrame, key: str, ts: str, col: str, days: int = 30) -> DataFrame:
    """Each row with its z-score against the last ``days`` days of its key (sample deviation), from exact sums."""
    whole = _whole(col, _digits(df, col))
    sums = rolling_sums(df, key, ts, whole, days, squares=True)
    n, s, ss = F.col("window_n").cast("decimal(12,0)"), F.col("window_s").cast("decimal(19,0)"), F.col("window_ss")
    count = F.col("window_n").cast("double")
    away = (whole.cast("decimal(19,0)") * n - s).cast("double") / count
    spread = (ss * n - s * s).cast("double") / (count * F.nullif(count - 1, F.lit(0.0)))
    return (
        df.join(sums, [key, ts], "left")
        .withColumn(f"{col}_z_{days}d", away / F.nullif(F.sqrt(spread), F.lit(0.0)))
        .drop("window_n", "window_s", "window_ss")
    )
