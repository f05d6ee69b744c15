"""Daily facts: every measure is a sum of a row-level expression.

Because of that, one table's fact is a projection followed by one grouped sum, and all facts
together are the union of the projections followed by one grouped sum (``daily_facts``).
Sums combine on the map side, so a hot (SKU, LOCATION, DATE) reaches the reducers as one row
per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger import fixed_values as fixed

KEYS = ["SKU", "LOCATION", "DATE"]


def _count_when(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


def adjustment_rows(
    df: DataFrame, reasons: dict[str, tuple[int, ...]] = fixed.REASONS
) -> DataFrame:
    quantity = F.col("ADJ_QTY")
    reason = F.coalesce(F.col("REASON"), F.lit(fixed.DEFAULT_REASON))
    splits = {
        name: F.when(reason.isin(*codes), quantity) if codes else quantity
        for name, codes in reasons.items()
    }
    return df.select(
        *KEYS,
        quantity.alias("ADJ_QTY"),
        _count_when(F.col("DATE").isNotNull()).alias("CC_INTRADAY_COUNT"),
        _count_when(quantity > 0).alias("POS_CC_INTRADAY_COUNT"),
        _count_when(quantity < 0).alias("NEG_CC_INTRADAY_COUNT"),
        F.when(quantity > 0, quantity).otherwise(0.0).alias("POS_CC_QTY"),
        F.when(quantity < 0, quantity).otherwise(0.0).alias("NEG_CC_QTY"),
        *[split.alias(name) for name, split in splits.items()],
    )


def sales_rows(df: DataFrame, bulk_over: float = fixed.BULK_OVER_UNITS) -> DataFrame:
    units = F.col("SALES_UNITS")
    return df.select(
        *KEYS,
        _count_when(F.col("DATE").isNotNull()).alias("SALES_COUNT"),
        F.when(units > bulk_over, units).otherwise(0.0).alias("BULK_SALES_UNITS"),
        units.alias("SALES_UNITS"),
        F.col("SALES_TOTAL_RETAIL"),
    )


def return_rows(df: DataFrame) -> DataFrame:
    return df.select(*KEYS, "RETURN_UNITS")


def invoice_rows(df: DataFrame) -> DataFrame:
    return df.select(*KEYS, "DSD_INVC_QTY_RCPT")


def transfer_rows(
    df: DataFrame,
    codes: dict[int, str] | None = None,
) -> DataFrame:
    """Warehouse and direct-delivery units side by side; other codes never leave the scan."""
    codes = codes or {
        fixed.DC_TRANSFER_CODE: "INTRANSIT_RECORDED",
        fixed.DSD_TRANSFER_CODE: "DSD_RECORDED",
    }
    code, units = F.col("TRANSFER_CODE"), F.col("TRANSFER_UNITS")
    return df.filter(code.isin(*codes)).select(
        *KEYS, *[F.when(code == value, units).alias(name) for value, name in codes.items()]
    )


def sum_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in df.columns if c not in keys])


def daily_adjustments(
    df: DataFrame, reasons: dict[str, tuple[int, ...]] = fixed.REASONS
) -> DataFrame:
    """Totals, signed counts and sums, and per-reason sums in a single aggregation."""
    return sum_by(adjustment_rows(df, reasons), KEYS)


def reason_quantity(df: DataFrame, codes: list[int], name: str) -> DataFrame:
    """Daily quantity of the given reasons only; all reasons where the list is empty."""
    reason = F.coalesce(F.col("REASON"), F.lit(fixed.DEFAULT_REASON))
    kept = df.filter(reason.isin(*codes)) if codes else df
    return sum_by(kept.select(*KEYS, F.col("ADJ_QTY").alias(name)), KEYS)


def daily_sales(df: DataFrame, bulk_over: float = fixed.BULK_OVER_UNITS) -> DataFrame:
    return sum_by(sales_rows(df, bulk_over), KEYS)


def daily_returns(df: DataFrame) -> DataFrame:
    return sum_by(return_rows(df), KEYS)


def daily_invoices(df: DataFrame) -> DataFrame:
    return sum_by(invoice_rows(df), KEYS)


def daily_transfers_by_code(df: DataFrame) -> DataFrame:
    keys = [*KEYS, "TRANSFER_CODE"]
    return sum_by(df.select(*keys, "TRANSFER_UNITS"), keys)


def daily_transfers(df: DataFrame, codes: dict[int, str] | None = None) -> DataFrame:
    return sum_by(transfer_rows(df, codes), KEYS)


FACT_ROWS = {
    "inventory_adjustment": adjustment_rows,
    "sales": sales_rows,
    "returns": return_rows,
    "store_transfers": transfer_rows,
    "store_invoice": invoice_rows,
}


def daily_facts(tables: dict[str, DataFrame], *extra_rows: DataFrame) -> DataFrame:
    """All daily facts in one shuffle: union of row-level measures, one grouped sum.

    Rows with a missing key match no snapshot row, so they are dropped before the shuffle.
    ``extra_rows`` are further frames of KEYS and summable measures.
    """
    rows = [make(tables[name]) for name, make in FACT_ROWS.items()] + list(extra_rows)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return sum_by(stacked.dropna(subset=KEYS), KEYS)
