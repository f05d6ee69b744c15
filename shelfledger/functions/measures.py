"""Row-level balances and derived measures of the wide table, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.fixed_values import STORES_PER_GROUP

# Columns that are zero instead of NULL after the joins.
ZERO_FILLED = (
    "ADJ_QTY", "DAMAGE_QTY", "STOREUSE_QTY", "EXPIRED_QTY", "SCANERR_QTY",
    "CC_INTRADAY_COUNT", "POS_CC_INTRADAY_COUNT", "NEG_CC_INTRADAY_COUNT",
    "POS_CC_QTY", "NEG_CC_QTY",
    "SALES_UNITS", "SALES_TOTAL_RETAIL", "SALES_COUNT", "BULK_SALES_UNITS",
    "RETURN_UNITS", "INTRANSIT_RECORDED", "DSD_RECORDED", "DSD_INVC_QTY_RCPT",
    "YEAR_AUDIT_DAY_FLAG", "SKU_WDTH", "SKU_HGT", "SKU_DPTH",
)


def location_group(location: Column, stores_per_group: int = STORES_PER_GROUP) -> Column:
    return F.round(location / F.lit(stores_per_group), 0)


def opening_total() -> Column:
    return F.col("IP_QTY_BOP_INTRANS") + F.col("IP_QTY_BOP_SOH")


def closing_total() -> Column:
    return F.col("IP_QTY_EOP_INTRANS") + F.col("IP_QTY_EOP_SOH")


def fill_zero(df: DataFrame, names: tuple[str, ...] = ZERO_FILLED) -> DataFrame:
    return df.na.fill(0, subset=[n for n in names if n in df.columns])


def unit_price(total: Column, units: Column) -> Column:
    """Price per unit to the cent; zero units give zero."""
    return F.coalesce(F.round(F.try_divide(total, units), 2), F.lit(0.0))


def derive_measures(df: DataFrame) -> DataFrame:
    """Measures in evaluation order: later ones use the rewritten DSD_RECORDED."""
    dsd, transit = F.col("DSD_RECORDED"), F.col("INTRANSIT_RECORDED")
    sold, adjusted = F.col("SALES_UNITS"), F.col("ADJ_QTY")
    direct = df.withColumns({
        "DSD_RECORDED": F.when(dsd > 0, dsd - transit).otherwise(dsd),
        "SALES_UNITS_WITHOUT_RETURN": sold - F.col("RETURN_UNITS"),
        "SALES_UNIT_RETAIL": unit_price(F.col("SALES_TOTAL_RETAIL"), sold),
        "AUDIT_ADJ_QTY": adjusted,
    })
    delivered = (F.col("DSD_RECORDED") > 0) | (F.col("DSD_INVC_QTY_RCPT") > 0)
    unexplained_total = F.col("IP_QTY_EOP_INV") + sold - adjusted - F.col("IP_QTY_BOP_INV")
    unexplained_shelf = F.col("IP_QTY_EOP_SOH") + sold - adjusted - F.col("IP_QTY_BOP_SOH")
    moved = direct.withColumns({
        "DSD_TRANSFERRED_UNITS": F.when(delivered, unexplained_total).otherwise(0.0),
        "ONHAND_RECORDED": F.when(unexplained_shelf > 0, unexplained_shelf).otherwise(0.0),
    })
    outflow, onhand = F.col("DSD_TRANSFERRED_UNITS"), F.col("ONHAND_RECORDED")
    return moved.withColumn(
        "ONHAND_RECORDED", F.when(outflow < 0, onhand + outflow).otherwise(onhand)
    )
