"""Checks of a finished wide table, before it is merged."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfledger.functions.measures import ZERO_FILLED
from shelfledger.operators.facts import KEYS


def row_faults(columns: list[str]) -> dict[str, Column]:
    """The checks that a row fails or passes by itself, as counts over rows."""
    filled = [c for c in ZERO_FILLED if c in columns]
    delivered = (F.col("DSD_RECORDED") > 0) | (F.col("DSD_INVC_QTY_RCPT") > 0)
    closing = (
        F.col("IP_QTY_BOP_INV") - F.col("SALES_UNITS") + F.col("ADJ_QTY")
        + F.col("DSD_TRANSFERRED_UNITS")
    )
    return {
        "nulls_filled": F.sum(sum((F.col(c).isNull().cast("bigint") for c in filled), F.lit(0))),
        "price_units": F.count_if((F.col("SALES_UNIT_RETAIL") != 0) & (F.col("SALES_UNITS") == 0)),
        "delivery_balance": F.count_if(
            delivered & (F.abs(F.col("IP_QTY_EOP_INV") - closing) > 1e-6)),
    }


def denorm_checks(wide: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(check, failures): 0 everywhere means the table may be merged.

    duplicate_keys: rows beyond the first per key. row_count: difference to the snapshot.
    nulls_filled: NULLs in columns that must be zero-filled. price_units: a price without
    sold units. delivery_balance: rows with a delivery whose closing total is not opening
    total - sales + adjustments + DSD_TRANSFERRED_UNITS.
    """
    faults = row_faults(wide.columns)
    per_key = wide.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), faults["nulls_filled"].alias("nulls"),
        faults["price_units"].alias("price"), faults["delivery_balance"].alias("balance"),
    )
    totals = per_key.agg(
        F.sum(F.col("n") - 1).alias("duplicate_keys"),
        F.sum("n").alias("rows"),
        F.sum("nulls").alias("nulls_filled"),
        F.sum("price").alias("price_units"),
        F.sum("balance").alias("delivery_balance"),
    )
    expected = snapshot.agg(F.count(F.lit(1)).alias("expected"))
    stacked = totals.unionByName(expected, allowMissingColumns=True)
    both = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    checks = {
        "duplicate_keys": F.col("duplicate_keys"),
        "row_count": F.abs(F.coalesce(F.col("rows"), F.lit(0)) - F.col("expected")),
        "nulls_filled": F.col("nulls_filled"),
        "price_units": F.col("price_units"),
        "delivery_balance": F.col("delivery_balance"),
    }
    lines = [
        F.struct(F.lit(k).alias("check"), F.coalesce(v, F.lit(0)).cast("bigint").alias("failures"))
        for k, v in checks.items()
    ]
    return both.select(F.inline(F.array(*lines)))


def write_checked(wide: DataFrame, snapshot_rows: int, write: Callable[[DataFrame], None]) -> DataFrame:
    """Writes a wide table and counts its faults on the way: (check, failures) of all checks but
    duplicate keys, without reading the table again.

    ``write`` gets the table with an observation on it and must write it once.
    """
    faults = row_faults(wide.columns)
    seen = Observation("written")
    write(wide.observe(
        seen, F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in faults.items())
    ))
    try:
        counts = seen.get
    except Py4JJavaError:  # a table that Spark knows to be empty is not observed
        counts = {}
    found = {"row_count": abs((counts.get("rows") or 0) - snapshot_rows)} | {
        name: counts.get(name) or 0 for name in faults
    }
    lines = [F.struct(F.lit(k).alias("check"), F.lit(v).cast("bigint").alias("failures"))
             for k, v in found.items()]
    return wide.sparkSession.range(1).select(F.inline(F.array(*lines)))


def require_clean(checks: DataFrame) -> None:
    """Stop where any check fails; there are only as many rows as checks."""
    failed = {r["check"]: r["failures"] for r in checks.filter("failures > 0").collect()}
    if failed:
        raise ValueError(f"the wide table must not be merged: {failed}")
