"""Whole files are held back by error rate and by what else their day is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.fixed_values import ERROR_THRESHOLD_PERCENT
from shelfledger.functions.dates import file_day, named_day
from shelfledger.operators.joins import skew_safe_left_join

# Folders of the routes; "pass" stays where it is.
PASS = "pass"
MISSED = "missed_files"
OVER_THRESHOLD = "validation_threshold_error/required_files"
OVER_AND_MISSED = "validation_threshold_error/missed_files"

_UNIT = ["file_date", "table"]


def error_rates(counts: DataFrame, threshold: float = ERROR_THRESHOLD_PERCENT) -> DataFrame:
    """Error percentage per (file_date, table); NULL and not over where there are no rows."""
    sums = counts.groupBy(*_UNIT).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("error_row_count").alias("error_row_count"),
        F.sum("original_row_count").alias("original_row_count"),
    )
    rate = F.try_divide(F.col("error_row_count"), F.col("original_row_count")) * 100
    return sums.withColumn("error_percent", rate).withColumn(
        "over_threshold", F.coalesce(rate > threshold, F.lit(False))
    )


def quarantine_routes(
    counts: DataFrame, missing: DataFrame, threshold: float = ERROR_THRESHOLD_PERCENT
) -> DataFrame:
    """Route of every file; ``missing`` is (file_date, missing) with "None" for complete days.

    Days are compared as days, however they are spelled; a calendar entry that is no day stops
    the job, a file whose name states none belongs to no late day. Nothing is moved: later
    stages keep the files whose route is "pass".
    """
    rates = error_rates(counts, threshold).select(*_UNIT, "over_threshold")
    late = missing.filter(F.col("missing") != "None").select(
        file_day(F.col("file_date")).alias("day")
    ).distinct()
    rated = skew_safe_left_join(counts.select("uri", *_UNIT), rates, _UNIT)
    dated = skew_safe_left_join(
        rated.withColumn("day", named_day(F.col("file_date"))),
        late.withColumn("late", F.lit(True)), ["day"],
    )
    over = F.coalesce("over_threshold", F.lit(False))
    is_late = F.coalesce("late", F.lit(False))
    route = (
        F.when(is_late & over, OVER_AND_MISSED)
        .when(is_late, MISSED)
        .when(over, OVER_THRESHOLD)
        .otherwise(PASS)
    )
    return dated.select("uri", *_UNIT, route.alias("route"))
