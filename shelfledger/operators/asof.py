"""Forward as-of join on days, for a tolerance of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.fixed_values import ARRIVAL_TOLERANCE_DAYS
from shelfledger.operators.joins import skew_safe_left_join

#: Up to so many days right days answer for each left day they can serve; beyond, the days of
#: both sides are put in order. Both ways give the same.
COPIED_DAYS = 7


def served_days(
    right: DataFrame, by: list[str], left_on: str, right_on: str, tolerance_days: int
) -> DataFrame:
    """(by, left_on, right_on): each right day turned around, for the ``tolerance_days + 1``
    left days it can serve, and the smallest answer per day kept."""
    served = F.sequence(F.date_sub(right_on, tolerance_days), F.col(right_on))
    return (
        right.select(*by, right_on)
        .dropna()
        .select(*by, right_on, F.explode(served).alias(left_on))
        .groupBy(*by, left_on)
        .agg(F.min(right_on).alias(right_on))
    )


def next_days(
    left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str,
    tolerance_days: int | None,
) -> DataFrame:
    """(by, left_on, right_on) for the left days that have an answer, by the days in order.

    Equal days combine before the shuffle, so a group is a row per calendar day at most when
    the window goes over it, however many rows it has; what moves does not hang on the
    tolerance. ``None`` is no limit.
    """
    asked = left.select(*by, F.col(left_on).alias("_day"), F.lit(True).alias("_asked"))
    given = right.select(*by, F.col(right_on).alias("_day"), F.lit(False).alias("_asked"))
    days = asked.union(given).dropna().groupBy(*by, "_day").agg(
        F.max("_asked").alias("_asked"), F.max(~F.col("_asked")).alias("_given")
    )
    ahead = Window.partitionBy(*by).orderBy("_day").rowsBetween(0, Window.unboundedFollowing)
    found = days.withColumn("_next", F.first(
        F.when(F.col("_given"), F.col("_day")), ignorenulls=True
    ).over(ahead)).where("_asked AND _next IS NOT NULL")
    if tolerance_days is not None:
        found = found.where(F.datediff("_next", "_day") <= tolerance_days)
    return found.select(*by, F.col("_day").alias(left_on), F.col("_next").alias(right_on))


def asof_forward(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_on: str,
    right_on: str,
    tolerance_days: int | None = ARRIVAL_TOLERANCE_DAYS,
) -> DataFrame:
    """Add to each left row the first ``right_on`` day in [left_on, left_on + tolerance].

    NULL where nothing is in reach, and for rows without a key or day. What remains is an
    equi-join on (by, day) that never multiplies the left side, so one group holding most rows
    is still spread over its days.
    """
    if tolerance_days is not None and tolerance_days <= COPIED_DAYS:
        answers = served_days(right, by, left_on, right_on, tolerance_days)
    else:
        answers = next_days(left, right, by, left_on, right_on, tolerance_days)
    return skew_safe_left_join(left, answers, [*by, left_on])
