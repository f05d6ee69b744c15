import datetime as dt

import pytest

from conftest import rows
from shelfledger.functions import measures
from shelfledger.operators import facts

DAY = dt.date(2023, 1, 1)
BASE = "SKU int, LOCATION int, DATE date, "


def test_adjustments(spark):
    df = spark.createDataFrame(
        [(1, 1, DAY, 5.0, 4), (1, 1, DAY, -2.0, 11), (1, 1, DAY, -1.0, None),
         (1, 1, DAY, 3.0, 10), (1, 1, DAY, 0.0, 9), (1, 1, DAY, None, 14), (2, 1, DAY, 1.0, 99)],
        BASE + "ADJ_QTY double, REASON int",
    )
    found = {r.SKU: r.asDict() for r in facts.daily_adjustments(df).collect()}
    one = found[1]
    assert (one["ADJ_QTY"], one["CC_INTRADAY_COUNT"]) == (5.0, 6)
    assert (one["POS_CC_INTRADAY_COUNT"], one["NEG_CC_INTRADAY_COUNT"]) == (2, 2)
    assert (one["POS_CC_QTY"], one["NEG_CC_QTY"]) == (8.0, -3.0)
    assert (one["DAMAGE_QTY"], one["STOREUSE_QTY"]) == (3.0, 3.0)
    assert (one["SCANERR_QTY"], one["EXPIRED_QTY"]) == (0.0, None)
    assert found[2]["DAMAGE_QTY"] is None


def test_reason_splits_add_up(spark, small):
    from entry_queries.queries import one

    df = one(spark, small, "inventory_adjustment")
    splits = ["DAMAGE_QTY", "STOREUSE_QTY", "EXPIRED_QTY", "SCANERR_QTY"]
    daily = facts.daily_adjustments(df).na.fill(0.0, splits)
    total = daily.selectExpr(f"sum({' + '.join(splits)})").first()[0]
    assert total == df.filter("REASON IN (4, 9, 10, 11, 14)").selectExpr("sum(ADJ_QTY)").first()[0]


def test_date_count_is_zero_for_missing_date(spark):
    df = spark.createDataFrame([(1, 1, None, 4.0, 8.0)],
                               BASE + "SALES_UNITS double, SALES_TOTAL_RETAIL double")
    row = facts.daily_sales(df).first()
    assert row.SALES_COUNT == 0 and row.SALES_UNITS == 4.0


@pytest.mark.parametrize("units,bulk", [(3.0, 0.0), (4.0, 4.0), (None, 0.0)])
def test_bulk_sales(spark, units, bulk):
    df = spark.createDataFrame([(1, 1, DAY, units, 9.0)],
                               BASE + "SALES_UNITS double, SALES_TOTAL_RETAIL double")
    assert facts.daily_sales(df).first().BULK_SALES_UNITS == bulk


def test_transfers_by_code_side_by_side(spark):
    df = spark.createDataFrame(
        [(1, 1, DAY, 30, 2.0), (1, 1, DAY, 30, 3.0), (1, 1, DAY, 40, 9.0), (2, 1, DAY, 20, 7.0),
         (3, 1, DAY, 40, 1.0)],
        BASE + "TRANSFER_CODE int, TRANSFER_UNITS double",
    )
    assert rows(facts.daily_transfers(df), "SKU", "INTRANSIT_RECORDED", "DSD_RECORDED") == [
        (1, 5.0, None), (2, None, 7.0)
    ]


MEASURE_INPUT = dict(
    IP_QTY_BOP_INV=100.0, IP_QTY_EOP_INV=110.0, IP_QTY_BOP_SOH=90.0, IP_QTY_EOP_SOH=95.0,
    SALES_UNITS=10.0, SALES_TOTAL_RETAIL=25.0, RETURN_UNITS=2.0, ADJ_QTY=-2.0,
    DSD_RECORDED=7.0, INTRANSIT_RECORDED=4.0, DSD_INVC_QTY_RCPT=0.0,
)


@pytest.mark.parametrize("changes,expected", [
    ({}, dict(SALES_UNITS_WITHOUT_RETURN=8.0, DSD_RECORDED=3.0, DSD_TRANSFERRED_UNITS=22.0,
              SALES_UNIT_RETAIL=2.5, AUDIT_ADJ_QTY=-2.0, ONHAND_RECORDED=17.0)),
    (dict(SALES_UNITS=0.0, SALES_TOTAL_RETAIL=0.0), dict(SALES_UNIT_RETAIL=0.0)),
    (dict(IP_QTY_EOP_INV=80.0), dict(DSD_TRANSFERRED_UNITS=-8.0, ONHAND_RECORDED=9.0)),
    (dict(DSD_RECORDED=3.0), dict(DSD_RECORDED=-1.0, DSD_TRANSFERRED_UNITS=0.0)),
    (dict(DSD_RECORDED=0.0, DSD_INVC_QTY_RCPT=1.0), dict(DSD_TRANSFERRED_UNITS=22.0)),
    (dict(IP_QTY_EOP_SOH=None), dict(ONHAND_RECORDED=0.0)),
    (dict(IP_QTY_EOP_INV=None), dict(DSD_TRANSFERRED_UNITS=None, ONHAND_RECORDED=17.0)),
])
def test_measures(spark, changes, expected):
    values = {**MEASURE_INPUT, **changes}
    schema = ", ".join(f"{k} double" for k in values)
    row = measures.derive_measures(spark.createDataFrame([tuple(values.values())], schema)).first()
    assert {k: row[k] for k in expected} == expected


def test_location_group(spark):
    df = spark.createDataFrame([(25,), (75,), (124,), (7843,)], "LOCATION int")
    found = df.select(measures.location_group(df.LOCATION)).collect()
    assert [r[0] for r in found] == [1.0, 2.0, 2.0, 157.0]


def test_facts_are_shuffled_once(spark, small):
    from entry_queries.queries import QUERIES

    plan = QUERIES["daily_facts"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
