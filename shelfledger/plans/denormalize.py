"""One wide row per (SKU, LOCATION, DATE) of the inventory snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfledger.functions.measures import ZERO_FILLED, derive_measures, fill_zero
from shelfledger.operators.audit import audit_schedule
from shelfledger.operators.carriers import rescheduled_rows
from shelfledger.operators.facts import KEYS, daily_facts
from shelfledger.operators.inventory import densify_inventory, inventory_snapshot
from shelfledger.operators.joins import skew_safe_left_join


def join_facts(
    tables: dict[str, DataFrame],
    historical: bool = False,
    arrivals: DataFrame | None = None,
    actuals: DataFrame | None = None,
) -> DataFrame:
    """Snapshot with all facts, the audit flag and the SKU attributes, zero-filled.

    ``arrivals`` (LOCATION, ACTUAL_ARRIVAL) adds DC_TRANSFERRED_UNITS by arrival day, and
    ``actuals`` adds AUDIT_UNITS, summed per key and NULL where nothing was counted; both are
    off by default. They are further rows of the one grouped sum, so neither adds rows.
    """
    base = tables["inventory_snapshot"]
    snapshot = densify_inventory(base) if historical else inventory_snapshot(base)
    extra = []
    if arrivals is not None:
        extra.append(rescheduled_rows(tables["store_transfers"], arrivals))
    if actuals is not None:
        extra.append(actuals.select(*KEYS, "AUDIT_UNITS"))
    wide = skew_safe_left_join(snapshot, daily_facts(tables, *extra), KEYS)
    wide = skew_safe_left_join(
        wide, audit_schedule(tables["yearly_audit_schedule"]), ["LOCATION", "DATE"]
    )
    wide = skew_safe_left_join(wide, tables["sku"], ["SKU"])
    filled = ZERO_FILLED + (("DC_TRANSFERRED_UNITS",) if arrivals is not None else ())
    return fill_zero(wide, filled)


def denormalize(
    tables: dict[str, DataFrame],
    historical: bool = False,
    arrivals: DataFrame | None = None,
    actuals: DataFrame | None = None,
) -> DataFrame:
    """The wide table with its derived measures, for all store groups in one plan."""
    return derive_measures(join_facts(tables, historical, arrivals, actuals))
