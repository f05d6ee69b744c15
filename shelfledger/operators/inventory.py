"""Inventory snapshot: daily balances, and the gap-free calendar form of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.functions.measures import closing_total, opening_total
from shelfledger.operators.facts import KEYS
from shelfledger.operators.joins import same_key

SERIES = ["SKU", "LOCATION"]
_OPENING = {"IP_QTY_BOP_INV": "IP_QTY_EOP_INV", "IP_QTY_BOP_INTRANS": "IP_QTY_EOP_INTRANS"}


def inventory_snapshot(df: DataFrame) -> DataFrame:
    """Snapshot rows with opening and closing totals (NULL where a part is NULL)."""
    return df.withColumns({
        "IP_QTY_EOP_INV": closing_total(),
        "IP_QTY_BOP_INV": opening_total(),
    })


def date_bounds(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES).agg(
        F.min("DATE").alias("MIN_DATE"), F.max("DATE").alias("MAX_DATE")
    )


def calendar_spine(df: DataFrame) -> DataFrame:
    """Every day from the first to the last one seen, per SKU and location."""
    day = F.explode(F.sequence("MIN_DATE", "MAX_DATE", F.expr("interval 1 day")))
    return date_bounds(df).select(*SERIES, day.alias("DATE"))


def _openings(df: DataFrame) -> DataFrame:
    return df.select(
        *KEYS,
        F.coalesce(opening_total(), F.lit(0.0)).alias("IP_QTY_BOP_INV"),
        F.coalesce(F.col("IP_QTY_BOP_INTRANS"), F.lit(0.0)).alias("IP_QTY_BOP_INTRANS"),
    )


def _days(df: DataFrame) -> DataFrame:
    """One row per series and day: its deliveries and opening, and the next such day's.

    Copies of a day combine before the shuffle, so a series is at most one row per calendar
    day when the window goes over it. A series with a missing key matches no delivery: its
    days count none and open with 0.
    """
    whole = F.col("SKU").isNotNull() & F.col("LOCATION").isNotNull()
    days = (
        df.select(*KEYS, opening_total().alias("IP_QTY_BOP_INV"), "IP_QTY_BOP_INTRANS")
        .filter("DATE IS NOT NULL").groupBy(*KEYS)
        .agg(
            F.count_if(whole).alias("deliveries"),
            *[F.max(F.when(whole, F.coalesce(c, F.lit(0.0)))).alias(c) for c in _OPENING],
        )
    )
    series = Window.partitionBy(*SERIES).orderBy("DATE")
    return days.select(
        *KEYS, "deliveries", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in _OPENING],
        F.lead("DATE").over(series).alias("next_date"),
        *[F.coalesce(F.lead(c).over(series), F.lit(0.0)).alias(f"next_{c}") for c in _OPENING],
    )


def _closing(day: Column) -> list[Column]:
    """Closings of a day: the openings of the next day of its series if that follows, else 0."""
    follows = F.date_add(day, 1) == F.col("next_date")
    return [
        F.when(follows, F.col(f"next_{a}")).otherwise(0.0).alias(b) for a, b in _OPENING.items()
    ]


def _single_rows(openings: DataFrame, days: DataFrame) -> DataFrame:
    """The rows of days delivered several times, each with its own opening and its day's
    closings."""
    day = days.filter("deliveries > 1").select(*KEYS, *_closing(F.col("DATE")))
    return openings.join(day, KEYS).select(*KEYS, *_OPENING, *_OPENING.values())


def closing_from_opening(df: DataFrame) -> DataFrame:
    """Closing total and in-transit of a day = opening of the next calendar day, else 0.

    A row without a key closes with 0.
    """
    openings, days = _openings(df), _days(df)
    once = days.filter("deliveries = 1").select(*KEYS, *_OPENING, *_closing(F.col("DATE")))
    keyless = openings.filter(
        F.col("SKU").isNull() | F.col("LOCATION").isNull() | F.col("DATE").isNull()
    ).withColumns({b: F.lit(0.0) for b in _OPENING.values()})
    return once.unionByName(_single_rows(openings, days)).unionByName(keyless)


def densify_inventory(df: DataFrame) -> DataFrame:
    """Snapshot with the missing days of each series filled in.

    A filled day opens with 0, and a day closes with the next day's opening, so the day
    before a gap closes with 0; the last day closes with 0. Snapshot rows without a date are
    left out, and every other row is kept.

    The gap after a day is laid out from the day itself, so there is no calendar to join. Only
    days delivered several times go back to the snapshot, for their single rows.
    """
    days = _days(df)
    own = F.struct(
        "DATE", "deliveries", *[F.col(a) for a in _OPENING], *_closing(F.col("DATE"))
    )
    gap = F.when(
        F.col("next_date") > F.date_add("DATE", 1),
        F.transform(
            F.sequence(F.date_add("DATE", 1), F.date_sub("next_date", 1)),
            lambda day: F.struct(
                day.alias("DATE"), F.lit(0).cast("bigint").alias("deliveries"),
                *[F.lit(0.0).alias(a) for a in _OPENING], *_closing(day),
            ),
        ),
    )
    filled = days.select(
        *SERIES, F.inline(F.concat(F.array(own), F.coalesce(gap, F.array())))
    ).filter("deliveries < 2").drop("deliveries")
    total_open, transit_open = F.col("IP_QTY_BOP_INV"), F.col("IP_QTY_BOP_INTRANS")
    total_close, transit_close = F.col("IP_QTY_EOP_INV"), F.col("IP_QTY_EOP_INTRANS")
    return filled.unionByName(_single_rows(_openings(df), days)).withColumns({
        "IP_QTY_BOP_SOH": total_open - transit_open,
        "IP_QTY_EOP_SOH": total_close - transit_close,
    })


@dataclass(frozen=True)
class DensifiedBatch:
    """``rows`` to put in place of those of the same keys, and the ``state`` for the next batch."""

    rows: DataFrame
    state: DataFrame


def last_days(df: DataFrame) -> DataFrame:
    """All snapshot rows of the last day of each series: what a later batch hangs on to."""
    last = df.filter("DATE IS NOT NULL").groupBy(*SERIES).agg(F.max("DATE").alias("DATE"))
    return df.alias("s").join(last.alias("l"), same_key("s", "l", KEYS), "left_semi")


def densify_batch(batch: DataFrame, state: DataFrame) -> DensifiedBatch:
    """``densify_inventory`` of a snapshot that comes in batches of later and later days.

    ``state`` holds the rows of each series' last day so far, as they were delivered. The days
    of the batch follow it: the last day gets its closing now that the next one is known, and the
    days between are filled. ``rows`` has these and the days of the batch, for series that the
    batch has; they replace rows of equal keys (``merge.merge_rows``). All batches together give
    what one densified whole gives. The batch may deliver a series' last day again, but a day
    before it stops the job, for what was closed then is not in the state.
    """
    ours = state.alias("s").join(
        batch.filter("DATE IS NOT NULL").select(*SERIES).distinct().alias("b"),
        same_key("s", "b", SERIES), "left_semi",
    )
    # one row per series on both sides, sorted: the state's files are too small a measure of it
    first = date_bounds(batch).alias("b")
    closed = date_bounds(state).hint("merge").alias("c")
    late = first.join(
        closed, same_key("b", "c", SERIES) & (F.col("b.MIN_DATE") < F.col("c.MAX_DATE"))
    ).select(*[f"b.{c}" for c in SERIES], "b.MIN_DATE").head(1)
    if late:
        raise ValueError(f"a day before the last one of its series: {tuple(late[0])}")
    columns = state.columns
    whole = ours.unionByName(batch.select(*columns))
    return DensifiedBatch(
        densify_inventory(whole), last_days(state.unionByName(batch.select(*columns)))
    )

