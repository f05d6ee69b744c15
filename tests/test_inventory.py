import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfledger.operators import inventory

SCHEMA = "SKU int, LOCATION int, DATE date, IP_QTY_BOP_INTRANS double, IP_QTY_BOP_SOH double"


def day(month, number):
    return dt.date(2023, month, number)


def test_filled_calendar(spark):
    df = spark.createDataFrame(
        [(1, 10, day(1, 1), 5.0, 100.0), (1, 10, day(1, 3), 2.0, 90.0),
         (1, 10, day(1, 4), 0.0, 80.0)],
        SCHEMA,
    )
    dense = inventory.densify_inventory(df)
    assert rows(
        dense, "DATE", "IP_QTY_BOP_INTRANS", "IP_QTY_BOP_SOH", "IP_QTY_BOP_INV",
        "IP_QTY_EOP_INV", "IP_QTY_EOP_INTRANS", "IP_QTY_EOP_SOH",
    ) == [
        (day(1, 1), 5, 100, 105, 0, 0, 0),
        (day(1, 2), 0, 0, 0, 92, 2, 90),
        (day(1, 3), 2, 90, 92, 80, 0, 80),
        (day(1, 4), 0, 80, 80, 0, 0, 0),
    ]


def brute_force(data):
    """The same by loops: spine per series, matching rows, next day's largest opening."""
    result = []
    series = {}
    for row in data:
        series.setdefault(row[:2], []).append(row)
    for (sku, location), found in series.items():
        dates = [r[2] for r in found if r[2]]
        if not dates:
            continue
        keyed = {}
        if sku is not None and location is not None:
            for r in found:
                if r[2]:
                    total = 0.0 if r[3] is None or r[4] is None else r[3] + r[4]
                    keyed.setdefault(r[2], []).append((total, r[3] or 0.0))
        current = min(dates)
        while current <= max(dates):
            following = keyed.get(current + dt.timedelta(1), [(0.0, 0.0)])
            close = (max(v[0] for v in following), max(v[1] for v in following))
            for total, transit in keyed.get(current, [(0.0, 0.0)]):
                result.append((sku, location, current, total, transit, *close,
                               total - transit, close[0] - close[1]))
            current += dt.timedelta(1)
    return sorted(result, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_densify_against_loops(spark):
    """Gaps, repeated days, missing balances and missing keys."""
    rng = random.Random(5)
    data = []
    for _ in range(400):
        data.append((
            rng.choice([1, 2, 3, None]), rng.choice([10, 20, None]),
            rng.choice([None] + [day(2, 1) + dt.timedelta(rng.randrange(60)) for _ in range(9)]),
            rng.choice([None, 0.0, float(rng.randrange(50))]),
            rng.choice([None, float(rng.randrange(90))]),
        ))
    data += [data[3]] * 25
    dense = inventory.densify_inventory(spark.createDataFrame(data, SCHEMA))
    assert rows(
        dense, "SKU", "LOCATION", "DATE", "IP_QTY_BOP_INV", "IP_QTY_BOP_INTRANS",
        "IP_QTY_EOP_INV", "IP_QTY_EOP_INTRANS", "IP_QTY_BOP_SOH", "IP_QTY_EOP_SOH",
    ) == brute_force(data)


def test_one_window_over_a_series(spark, small):
    from entry_queries.queries import conformed

    plan = inventory.densify_inventory(
        conformed(spark, small, "inventory_snapshot")["inventory_snapshot"]
    )._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 2 and plan.count("Join") == 1


def test_no_gaps(spark, small):
    from entry_queries.queries import QUERIES

    dense = QUERIES["densify_inventory"](spark, small)
    spans = dense.groupBy("SKU", "LOCATION").agg(
        F.count("*").alias("n"), (F.datediff(F.max("DATE"), F.min("DATE")) + 1).alias("days")
    )
    assert spans.filter("n <> days").isEmpty()


def test_missing_part_keeps_total_null(spark):
    df = spark.createDataFrame(
        [(1, 1, day(1, 1), None, 2.0, 3.0, 4.0)],
        "SKU int, LOCATION int, DATE date, IP_QTY_BOP_INTRANS double, IP_QTY_BOP_SOH double,"
        " IP_QTY_EOP_INTRANS double, IP_QTY_EOP_SOH double",
    )
    row = inventory.inventory_snapshot(df).first()
    assert row.IP_QTY_BOP_INV is None and row.IP_QTY_EOP_INV == 7.0


@pytest.mark.parametrize("copies", [1, 3])
def test_closing_from_opening(spark, copies):
    data = [(1, 1, day(1, 1), 0.0, 4.0), (1, 1, day(1, 2), 1.0, 5.0)] * copies
    closed = inventory.closing_from_opening(spark.createDataFrame(data, SCHEMA))
    assert rows(closed, "DATE", "IP_QTY_EOP_INV", "IP_QTY_EOP_INTRANS") == sorted(
        [(day(1, 1), 6.0, 1.0), (day(1, 2), 0.0, 0.0)] * copies
    )
