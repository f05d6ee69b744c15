import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfledger.operators import asof, joins, reconcile
from shelfledger.operators.asof import asof_forward
from shelfledger.operators.audit import audit_actuals, audit_schedule
from shelfledger.operators.joins import skew_safe_left_join

DAY = dt.date(2023, 1, 1)


def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    return lambda: [spark.conf.unset(n) for n in names]


def test_hot_key_is_split(spark):
    """A third of all rows on one key: adaptive execution cuts it into several tasks."""
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in sizes}
    restore = no_broadcast(spark)
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 300_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS v", "repeat('x', 20) AS text"
        )
        right = spark.range(300_000).selectExpr("id AS k", "id AS w").groupBy("k").agg({"w": "max"})
        joined = skew_safe_left_join(left, right, ["k"])
        assert joined.count() == 300_000
        joined.write.format("noop").mode("overwrite").save()
        query = joined._jdf.queryExecution()
        query.toRdd().count()
        plan = query.executedPlan().toString()
        assert "isSkewJoin=true" in plan or "skew=true" in plan
        assert "AQEShuffleRead skewed" in plan or "skewed" in plan
    finally:
        restore()
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_equal_rows_with_missing_keys_are_split(spark):
    """100,000 equal rows without a key: adaptive execution cuts their partition."""
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in sizes}
    restore = no_broadcast(spark)
    for key, value in sizes.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 100_000, 1, 8).selectExpr(
            "CAST(NULL AS BIGINT) AS k", "repeat('x', 20) AS text"
        ).union(spark.range(10_000).selectExpr("id AS k", "'y' AS text"))
        right = spark.range(10_000).selectExpr("id AS k", "id AS w").groupBy("k").agg({"w": "max"})
        joined = skew_safe_left_join(left, right.withColumnRenamed("max(w)", "w"), ["k"])
        query = joined._jdf.queryExecution()
        assert query.toRdd().count() == 110_000
        assert "skewed" in query.executedPlan().toString()
        assert joined.filter("k IS NULL AND w IS NOT NULL").isEmpty()
    finally:
        restore()
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_join_reads_only_what_is_selected(spark, tmp_path):
    path = str(tmp_path / "left")
    spark.range(10).selectExpr("id AS k", "id AS a", "id AS b").write.parquet(path)
    right = spark.range(5).selectExpr("id AS k", "id * 10 AS w")
    joined = skew_safe_left_join(spark.read.parquet(path), right, ["k"]).select("k", "w")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint>" in plan


def test_asof_golden(spark):
    d = dt.date
    left = spark.createDataFrame(
        [(1, d(2023, 1, 1)), (1, d(2023, 1, 5)), (1, d(2023, 2, 1)), (2, d(2023, 1, 1)),
         (1, d(2023, 1, 2)), (1, d(2022, 12, 29)), (1, d(2022, 12, 28)), (None, d(2023, 1, 1)),
         (1, None)],
        "LOCATION int, DATE date",
    )
    right = spark.createDataFrame(
        [(1, d(2023, 1, 5)), (1, d(2023, 1, 8)), (1, d(2023, 1, 9)), (1, d(2023, 1, 5)),
         (1, None), (None, d(2023, 1, 2))],
        "LOCATION int, ACTUAL_ARRIVAL date",
    )
    found = asof_forward(left, right, ["LOCATION"], "DATE", "ACTUAL_ARRIVAL")
    assert {tuple(r) for r in found.collect()} == {
        (1, d(2023, 1, 1), d(2023, 1, 5)), (1, d(2023, 1, 5), d(2023, 1, 5)),
        (1, d(2023, 2, 1), None), (2, d(2023, 1, 1), None), (1, d(2023, 1, 2), d(2023, 1, 5)),
        (1, d(2022, 12, 29), d(2023, 1, 5)), (1, d(2022, 12, 28), None),
        (None, d(2023, 1, 1), None), (1, None, None),
    }


def test_asof_against_loops(spark):
    rng = random.Random(11)
    start = dt.date(2023, 1, 1)
    left = [(rng.randrange(5), start + dt.timedelta(rng.randrange(200)), i) for i in range(500)]
    right = [(rng.randrange(5), start + dt.timedelta(rng.randrange(200))) for _ in range(60)]
    for tolerance in (0, 3, 7):
        found = asof_forward(
            spark.createDataFrame(left, "L int, D date, id int"),
            spark.createDataFrame(right, "L int, A date"), ["L"], "D", "A", tolerance,
        )
        expected = {
            i: min((a for k, a in right if k == loc and 0 <= (a - d).days <= tolerance),
                   default=None)
            for loc, d, i in left
        }
        assert {r.id: r.A for r in found.collect()} == expected


def test_schedule_is_flagged_once(spark):
    d = dt.date
    schedule = spark.createDataFrame(
        [(1, d(2023, 1, 1), d(2023, 1, 3)), (1, d(2023, 1, 2), d(2023, 1, 3))],
        "LOCATION int, AUDIT_DATE date, DATE date",
    )
    assert rows(audit_schedule(schedule)) == [(1, d(2023, 1, 3), 1)]
    audits = spark.createDataFrame(
        [(5, 1, d(2023, 1, 2), 4.0), (5, 1, d(2023, 1, 9), 6.0)],
        "SKU int, LOCATION int, AUDIT_DATE date, AUDIT_UNITS double",
    )
    assert rows(audit_actuals(audits, schedule)) == [(5, 1, d(2023, 1, 3), 4.0), (5, 1, None, 6.0)]


@pytest.mark.parametrize("tolerance", [0, 3, 7, 8, 40, 400, None])
def test_both_ways_of_asof_agree(spark, tolerance):
    rng = random.Random(11)

    def side(n, name):
        return spark.createDataFrame(
            [(rng.choice([1, 2, None]), DAY + dt.timedelta(rng.randrange(300))
              if rng.random() < 0.9 else None) for _ in range(n)], f"LOCATION int, {name} date")

    left, right = side(120, "DATE"), side(25, "ARRIVAL")
    found = rows(asof.asof_forward(left, right, ["LOCATION"], "DATE", "ARRIVAL", tolerance))
    given = [tuple(r) for r in right.collect()]
    expected = []
    for loc, day in (tuple(r) for r in left.collect()):
        later = [a for k, a in given if None not in (loc, day, k, a) and k == loc and a >= day
                 and (tolerance is None or (a - day).days <= tolerance)]
        expected.append((loc, day, min(later, default=None)))
    assert found == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))
    for answers in (asof.served_days(right, ["LOCATION"], "DATE", "ARRIVAL", tolerance or 300),
                    asof.next_days(left, right, ["LOCATION"], "DATE", "ARRIVAL", tolerance or 300)):
        joined = joins.skew_safe_left_join(left, answers, ["LOCATION", "DATE"])
        assert rows(joined) == (found if tolerance else rows(joined))


def test_asof_moves_no_more_for_a_year_than_for_a_week(spark):
    """Rows made on the way do not grow with the tolerance."""
    left = spark.range(2000).selectExpr(
        "CAST(id % 5 AS INT) AS LOCATION", "date_add(DATE '2023-01-01', CAST(id % 300 AS INT)) AS DATE")
    right = left.limit(200).withColumnRenamed("DATE", "ARRIVAL")
    plans = [asof.asof_forward(left, right, ["LOCATION"], "DATE", "ARRIVAL", t)
             ._jdf.queryExecution().executedPlan().toString() for t in (8, 365)]
    assert all("Generate" not in p for p in plans)
    assert plans[0].count("Exchange") == plans[1].count("Exchange")


def table_of(spark, data):
    return spark.createDataFrame(data, "SKU int, LOCATION int, DATE date, A double, B string")


def test_reconcile_names_the_partition_and_the_columns(spark):
    data = [(s, loc, DAY, float(s), f"b{s}") for s in range(20) for loc in (1, 2, 3, 4, 5, 6)]
    data += [(None, None, None, None, None)] * 2
    good = table_of(spark, data)

    def compare(other):
        return rows(reconcile.reconcile(good, table_of(spark, other), ["LOCATION"], ["A", "B"]))

    assert compare(list(reversed(data))) == []
    assert compare(data[1:]) == [(1, 20, 19, "rows lost", "")]
    assert compare(data + data[:1]) == [(1, 20, 21, "rows added", "")]
    assert compare(data[:-1]) == [(None, 2, 1, "rows lost", "")]
    assert compare([r for r in data if r[1] != 4]) == [(4, 20, 0, "rows lost", "")]
    assert compare(data + [(1, 9, DAY, 1.0, "x")]) == [(9, 0, 1, "rows added", "")]
    changed = [(s, loc, d, None if (s, loc) == (3, 2) else a, b) for s, loc, d, a, b in data]
    assert compare(changed) == [(2, 20, 20, "values changed", "A")]
    # two rows that exchange a value, and one row lost for another doubled
    swapped = [(s, loc, d, a, {("b1"): "b2", "b2": "b1"}.get(b, b) if loc == 5 else b)
               for s, loc, d, a, b in data]
    assert compare(swapped) == [(5, 20, 20, "values changed", "B")]
    replaced = data[6:] + data[6:7] + data[1:6]
    assert compare(replaced) == [(1, 20, 20, "values changed", "A,B")]


def test_checks_counted_while_writing(spark, tmp_path):
    from entry_queries.queries import conformed
    from conftest import SMALL
    from shelfledger.operators import checks
    from shelfledger.plans.denormalize import denormalize

    t = conformed(spark, SMALL)
    snapshot = t["inventory_snapshot"]
    wide = denormalize(t).withColumns({
        "SALES_UNITS": F.when(F.col("SKU") % 2 == 0, F.col("SALES_UNITS")),
        "IP_QTY_EOP_INV": F.col("IP_QTY_EOP_INV") + F.col("LOCATION") % 2})
    n, read = snapshot.count(), []

    def write(df):
        df.write.parquet(f"{tmp_path}/wide{len(read)}")
        read.append(df)

    found = {r.check: r.failures for r in checks.write_checked(wide, n - 1, write).collect()}
    whole = {r.check: r.failures for r in checks.denorm_checks(wide, snapshot).collect()}
    assert found == {**{k: v for k, v in whole.items() if k != "duplicate_keys"}, "row_count": 1}
    assert found["nulls_filled"] > 0 and found["delivery_balance"] > 0
    none = {r.check: r.failures for r in checks.write_checked(wide.limit(0), 4, write).collect()}
    assert none == {"row_count": 4, "nulls_filled": 0, "price_units": 0, "delivery_balance": 0}
