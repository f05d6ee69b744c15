"""Which days to process: open days of the last run, requested days, and all between."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.fixed_values import CRITICAL, HOLIDAYS, INGESTION_COMPONENT
from shelfledger.functions.dates import DAY, file_day


def run_day(offset: int = 0, now: dt.date | None = None) -> str:
    """Day of a run: today for 0 and 1, days ahead beyond 1, days back below 0."""
    day = now or dt.date.today()
    return f"{day + dt.timedelta(offset - 1 if offset > 0 else offset):%Y%m%d}"


def latest_failures(
    run_log: DataFrame,
    component: str = INGESTION_COMPONENT,
    priorities: tuple[str, ...] = CRITICAL,
) -> DataFrame:
    """Run-log rows of the component with these priorities, at their latest run date."""
    rows = run_log.filter(
        (F.col("component") == component) & F.col("priority").isin(*priorities)
    ).withColumn("_run_day", file_day(F.col("run_date")))
    latest = rows.agg(F.max("_run_day").alias("_run_day"))
    return rows.join(F.broadcast(latest), "_run_day", "left_semi").drop("_run_day")


def fill_dates(logged: DataFrame, requested: DataFrame) -> DataFrame:
    """Both sets of days; where neither is empty, also every day from first to last.

    Days are yyyyMMdd or ddMMyyyy; anything else stops the job.
    """
    stated = logged.select("file_date", F.lit("logged").alias("origin")).union(
        requested.select("file_date", F.lit("requested").alias("origin"))
    ).withColumn("day", file_day(F.col("file_date")))
    span = stated.agg(
        F.count_distinct("origin").alias("origins"),
        F.min("day").alias("first"),
        F.max("day").alias("last"),
    ).filter("origins = 2")
    between = span.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day")
    )
    return stated.select("day").union(between).distinct()


def plan_dates(
    run_log: DataFrame,
    requested: DataFrame,
    today: str,
    holidays: tuple[str, ...] = HOLIDAYS,
    component: str = INGESTION_COMPONENT,
    priorities: tuple[str, ...] = CRITICAL,
) -> DataFrame:
    """Days (yyyyMMdd) to process in order: filled dates and today, without holidays."""
    open_days = latest_failures(run_log, component, priorities).select("file_date")
    days = fill_dates(open_days, requested)
    current = days.sparkSession.createDataFrame([(today,)], "file_date string").select(
        file_day(F.col("file_date")).alias("day")
    )
    return (
        days.union(current)
        .distinct()
        .select(F.date_format("day", DAY).alias("file_date"))
        .filter(~F.col("file_date").isin(*holidays))
        .orderBy("file_date")
    )
