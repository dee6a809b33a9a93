"""Scores, levels and exact report arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weight of an incident category in the severity score.
INCIDENT_WEIGHTS = {8: 5, 1: 4, 6: 3}
OTHER_INCIDENT_WEIGHT = 2


def incident_severity(gravity: Column, delay: Column, category: Column) -> Column:
    """0.5 gravity + 0.3 ln(1 + delay) + 0.2 weight; NULL where 1 + delay <= 0."""
    weight = F.lit(OTHER_INCIDENT_WEIGHT)
    for code, value in INCIDENT_WEIGHTS.items():
        weight = F.when(category == code, F.lit(value)).otherwise(weight)
    return F.round(
        0.5 * F.coalesce(gravity, F.lit(0.0))
        + 0.3 * F.log1p(F.coalesce(delay, F.lit(0.0)))
        + 0.2 * weight,
        2,
    )


def clamp_to(ts: Column, as_of: Column) -> Column:
    """An instant after ``as_of`` becomes ``as_of`` without its fraction of a second."""
    return F.when(ts > as_of, F.date_trunc("second", as_of)).otherwise(ts)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def mean_2(col: Column, digits: int = 2) -> Column:
    """Mean of a column with at most two decimals, rounded half up without binary error."""
    total = F.sum(col).cast("decimal(26,2)")
    return F.round(F.try_divide(total, F.count(col).cast("decimal(20,0)")), digits).cast("double")


def share_of_total(count: Column, total: Column) -> Column:
    """Per cent with two decimals, exact."""
    return F.round(
        count.cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)"), 2
    ).cast("double")


def plain_number(value: str) -> str:
    """SQL for the text of a number, without ``.0`` where it is whole."""
    return f"CASE WHEN {value} = floor({value}) THEN string(bigint({value})) ELSE string({value}) END"
