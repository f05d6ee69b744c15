"""Carrier arrivals, and warehouse transfers moved to the day the truck arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfledger.fixed_values import ARRIVAL_TOLERANCE_DAYS, DC_TRANSFER_CODE
from shelfledger.functions.dates import DAY_MONTH_NAME, parse_date
from shelfledger.operators.asof import asof_forward
from shelfledger.operators.facts import KEYS, sum_by

# Store ids are the five characters after this prefix.
STORE_PREFIX = "FD.FDS_"
_DAY_COLUMNS = [
    "ESTIMATED_ARRIVAL", "PLANNED_ARRIVAL", "ACTUAL_ARRIVAL", "START_TIME", "END_TIME",
]


def parse_carrier_days(df: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: parse_date(F.col(c), types[c], DAY_MONTH_NAME) for c in _DAY_COLUMNS
    })


def neighbour_arrivals(df: DataFrame) -> DataFrame:
    """Arrival at a stop, the one before and the one after, per (SHIPMENT_XID, STOP_NUM).

    Copies of a stop count once, with the latest arrival they state. A trip has tens of stops,
    so one window goes over it. Rows without a shipment id are of no trip and have no
    neighbours; they are left out here, however many there are.
    """
    stops = df.filter(F.col("SHIPMENT_XID").isNotNull()).groupBy("SHIPMENT_XID", "STOP_NUM").agg(
        F.max("ACTUAL_ARRIVAL").alias("arrival")
    )
    trip = Window.partitionBy("SHIPMENT_XID").orderBy("STOP_NUM")
    return stops.select(
        "SHIPMENT_XID", "STOP_NUM", "arrival",
        F.lag("arrival").over(trip).alias("arrival_before"),
        F.lead("arrival").over(trip).alias("arrival_after"),
    )


def resolved_arrivals(df: DataFrame) -> DataFrame:
    """Per carrier row the store and the best known arrival day.

    The row's own arrival, else the latest one stated for its stop, else the neighbours', else
    estimate, plan or end; an arrival before the start is replaced by the end. Rows that are
    not for a store get LOCATION 0.
    """
    rows = parse_carrier_days(df)
    near = neighbour_arrivals(rows).select(
        F.col("SHIPMENT_XID").alias("near_shipment"),
        F.col("STOP_NUM").alias("near_stop"),
        "arrival",
        "arrival_before",
        "arrival_after",
    )
    known = rows.join(
        near,
        (F.col("SHIPMENT_XID") == F.col("near_shipment"))
        & F.col("STOP_NUM").eqNullSafe(F.col("near_stop")),
        "left",
    )
    best = F.coalesce(
        "ACTUAL_ARRIVAL", "arrival", "arrival_before", "arrival_after",
        "ESTIMATED_ARRIVAL", "PLANNED_ARRIVAL", "END_TIME",
    )
    gid = F.col("LOCATION_GID")
    store = F.substring(gid, len(STORE_PREFIX) + 1, 5).try_cast("int")
    return known.select(
        "SHIPMENT_XID",
        "STOP_NUM",
        F.when(gid.contains(STORE_PREFIX), store).otherwise(0).alias("LOCATION"),
        F.when(best < F.col("START_TIME"), F.col("END_TIME")).otherwise(best)
        .alias("ACTUAL_ARRIVAL"),
    )


def carrier_arrivals(df: DataFrame) -> DataFrame:
    """Distinct (LOCATION, ACTUAL_ARRIVAL)."""
    return resolved_arrivals(df).select("LOCATION", "ACTUAL_ARRIVAL").distinct()


def rescheduled_rows(
    transfers: DataFrame, arrivals: DataFrame, tolerance_days: int = ARRIVAL_TOLERANCE_DAYS
) -> DataFrame:
    """Warehouse transfer rows dated by the next arrival in reach, else by their own day."""
    sent = transfers.filter(F.col("TRANSFER_CODE") == DC_TRANSFER_CODE).select(
        *KEYS, F.col("TRANSFER_UNITS").alias("DC_TRANSFERRED_UNITS")
    )
    dated = asof_forward(
        sent, arrivals, ["LOCATION"], "DATE", "ACTUAL_ARRIVAL", tolerance_days
    )
    return dated.select(
        "SKU", "LOCATION", F.coalesce("ACTUAL_ARRIVAL", "DATE").alias("DATE"),
        "DC_TRANSFERRED_UNITS",
    )


def reschedule_transfers(
    transfers: DataFrame, arrivals: DataFrame, tolerance_days: int = ARRIVAL_TOLERANCE_DAYS
) -> DataFrame:
    return sum_by(rescheduled_rows(transfers, arrivals, tolerance_days), KEYS)
