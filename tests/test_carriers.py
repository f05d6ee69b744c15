import datetime as dt
import random

from conftest import rows
from shelfledger.mapping import default_mapping
from shelfledger.operators import carriers, conform
from shelfledger.sources import csv

# The raw columns of a carrier file.
HEADER = (
    "SHIPMENT_XID,LOCATION_GID,DEST_LOCATION_GID,STOP_NUM,START_TIME,END_TIME,"
    "PLANNED_ARRIVAL,ESTIMATED_ARRIVAL,ACTUAL_ARRIVAL\n"
)


def test_dropped_file(spark, tmp_path):
    """A trip from a depot to three stores; two stops did not report their arrival."""
    trip = [
        "41,FD.9540,FD.FDS_00725,1,06-Sep-21,06-Sep-21,06-Sep-21,06-Sep-21,",
        "41,FD.FDS_00150,FD.FDS_00725,2,06-Sep-21,07-Sep-21,08-Sep-21,08-Sep-21,07-Sep-21",
        "41,FD.FDS_00475,FD.FDS_00725,3,06-Sep-21,07-Sep-21,09-Sep-21,09-Sep-21,",
        "41,FD.FDS_00725,FD.FDS_00725,4,11-Sep-21,12-Sep-21,10-Sep-21,10-Sep-21,10-Sep-21",
        "52,FD.FDS_00725,FD.FDS_00725,1,11-Sep-21,12-Sep-21,10-Sep-21,,",
    ]
    path = tmp_path / "FD_CARRIER_DETAILS-06092021-1.csv"
    path.write_text(HEADER + "\n".join(trip) + "\n")
    raw = csv.read_typed_csv(spark, str(path), default_mapping()["carrier_master"])
    df = conform.conform(raw, default_mapping(), "carrier_master")
    september = [dt.date(2021, 9, n) for n in range(1, 31)]
    assert rows(
        carriers.resolved_arrivals(df), "SHIPMENT_XID", "STOP_NUM", "LOCATION", "ACTUAL_ARRIVAL"
    ) == [
        (41, 1, 0, september[6]), (41, 2, 150, september[6]), (41, 3, 475, september[6]),
        (41, 4, 725, september[11]), (52, 1, 725, september[11]),
    ]
    assert carriers.carrier_arrivals(df).count() == 4


def test_neighbours_against_loops(spark):
    rng = random.Random(3)
    start = dt.date(2022, 3, 1)
    data = []
    for shipment in (1, 2, None):
        for stop in sorted(rng.sample(range(-5, 40), 20)):
            arrival = None if rng.random() < 0.4 else start + dt.timedelta(rng.randrange(30))
            data.append((shipment, stop, arrival))
    data.append((1, None, start))
    found = carriers.neighbour_arrivals(
        spark.createDataFrame(data, "SHIPMENT_XID int, STOP_NUM int, ACTUAL_ARRIVAL date")
    )
    expected = {}
    for shipment in (1, 2):
        own = sorted((r for r in data if r[0] == shipment),
                     key=lambda r: (r[1] is not None, r[1] or 0))
        for i, row in enumerate(own):
            before = own[i - 1][2] if i else None
            after = own[i + 1][2] if i + 1 < len(own) else None
            expected[row[:2]] = (row[2], before, after)
    assert {
        (r.SHIPMENT_XID, r.STOP_NUM): (r.arrival, r.arrival_before, r.arrival_after)
        for r in found.collect()
    } == expected


def test_copies_of_a_stop_count_once(spark):
    d = dt.date
    data = [(1, 1, d(2022, 1, 1))] * 3 + [(1, 2, None)] * 2 + [(1, 3, d(2022, 1, 9))]
    found = carriers.neighbour_arrivals(
        spark.createDataFrame(data, "SHIPMENT_XID int, STOP_NUM int, ACTUAL_ARRIVAL date")
    )
    assert rows(found, "STOP_NUM", "arrival_before", "arrival_after") == [
        (1, None, None), (2, d(2022, 1, 1), d(2022, 1, 9)), (3, None, None)
    ]


def test_own_stop_comes_before_neighbours(spark):
    """A stop listed twice, and rows without a shipment id."""
    days = ["02-May-21", "05-May-21", None, None, "09-May-21"]
    data = [(s, n, "FD.FDS_00012", a, "01-May-21", "30-May-21")
            for s, n, a in zip([1, 1, 1, None, None], [1, 2, 2, 7, 8], days, strict=True)]
    df = spark.createDataFrame(
        data, "SHIPMENT_XID int, STOP_NUM int, LOCATION_GID string, ACTUAL_ARRIVAL string,"
        " START_TIME string, END_TIME string",
    ).selectExpr("*", "CAST(NULL AS STRING) AS ESTIMATED_ARRIVAL",
                 "CAST(NULL AS STRING) AS PLANNED_ARRIVAL")
    may = [dt.date(2021, 5, n) for n in range(1, 32)]
    assert rows(carriers.resolved_arrivals(df), "SHIPMENT_XID", "STOP_NUM", "ACTUAL_ARRIVAL") == [
        (1, 1, may[1]), (1, 2, may[4]), (1, 2, may[4]), (None, 7, may[29]), (None, 8, may[8])
    ]


def test_start_after_arrival_takes_end(spark):
    data = [(1, 1, "FD.FDS_00012", "x", None, "18-Mar-22", "19-Mar-22", "20-Mar-22"),
            (2, 1, "FD.9540", "18-Mar-22", None, None, "17-Mar-22", "20-Mar-22")]
    df = spark.createDataFrame(
        data,
        "SHIPMENT_XID int, STOP_NUM int, LOCATION_GID string, ESTIMATED_ARRIVAL string,"
        " PLANNED_ARRIVAL string, ACTUAL_ARRIVAL string, START_TIME string, END_TIME string",
    )
    assert rows(carriers.carrier_arrivals(df)) == [
        (0, dt.date(2022, 3, 18)), (12, dt.date(2022, 3, 20))
    ]


def test_rescheduled_units_are_kept(spark, small):
    from entry_queries.queries import conformed

    t = conformed(spark, small, "store_transfers", "carrier_master")
    moved = carriers.reschedule_transfers(
        t["store_transfers"], carriers.carrier_arrivals(t["carrier_master"])
    )
    sent = t["store_transfers"].filter("TRANSFER_CODE = 30").selectExpr("sum(TRANSFER_UNITS)")
    assert moved.selectExpr("sum(DC_TRANSFERRED_UNITS)").first()[0] == sent.first()[0]


def test_few_shuffles(spark, small):
    """One aggregate, one window and one join back, before any reuse."""
    from entry_queries.queries import conformed

    df = conformed(spark, small, "carrier_master")["carrier_master"]
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        plan = carriers.resolved_arrivals(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert plan.count("Exchange hashpartitioning") <= 5 and plan.count("Window [") == 1
