"""Yearly physical counts: the audit-day flag and the counted units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.operators.facts import KEYS
from shelfledger.operators.joins import skew_safe_left_join


def audit_schedule(df: DataFrame) -> DataFrame:
    """One flag per (LOCATION, reconciliation DATE); several counts on a day flag it once."""
    return (
        df.select("LOCATION", "DATE").distinct().withColumn("YEAR_AUDIT_DAY_FLAG", F.lit(1))
    )


def audit_actuals(audits: DataFrame, schedule: DataFrame) -> DataFrame:
    """Counted units dated by the reconciliation day of their count; NULL if unscheduled."""
    dates = schedule.select("LOCATION", "AUDIT_DATE", "DATE").distinct()
    dated = skew_safe_left_join(
        audits.select("SKU", "LOCATION", "AUDIT_DATE", "AUDIT_UNITS"),
        dates,
        ["LOCATION", "AUDIT_DATE"],
    )
    return dated.select(*KEYS, "AUDIT_UNITS")
