"""Drops that come day by day: headers and lines judged file by file, a ledger of taken files,
row-level merges, and densifying in batches."""

import datetime as dt
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfledger.operators import inventory, ledger, merge, validate
from shelfledger.plans import jobs
from shelfledger.sources import csv, dropped
from shelfledger.sources.manifest import file_manifest

RULE = validate.ColumnRule
RULES = [RULE("SKU", ("int",), ("", "null", " ")), RULE("UNITS", ("double",), ("", "null", " ")),
         RULE("TRAN_DATE", (), ("", "null"), ("%Y-%m-%d",))]
REQUIRED = tuple(r.column for r in RULES)
HEADER = "SKU,UNITS,TRAN_DATE\n"


def write(path, text, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt") as file:
        file.write(text)
    return str(path)


def named(folder, day, number=1, end="csv"):
    return f"{folder}/FD_SALES/FD_SALES-{day}-{number}.{end}"


def listed(spark, *paths):
    return spark.createDataFrame([(f"file:{p}",) for p in paths], "path string")


def judged(spark, folder, files):
    found = validate.validate(
        dropped.dropped_rows(spark, f"{folder}/FD_SALES", files, REQUIRED), RULES)
    counts = {r.uri.rsplit("/", 1)[-1]: (r.error_row_count, r.original_row_count)
              for r in found.counts.collect()}
    return found, counts


# ---- headers and lines --------------------------------------------------------------------

def test_each_file_is_judged_by_its_own_header(spark, tmp_path):
    good = write(named(tmp_path, "01072023"), HEADER + "1,2,2023-07-01\n2,3,2023-07-01\n")
    swapped = write(named(tmp_path, "01072023", 2),
                    "﻿TRAN_DATE,\"UNITS\",MORE,SKU\n2023-07-01,5,x,7\nnever,6,y,8\n")
    short = write(named(tmp_path, "02072023", 1, "csv.gz"), "SKU,TRAN_DATE\n1,2023-07-02\n"
                  "2,2023-07-02\n3,2023-07-02\n", gzip.open)
    part = write(named(tmp_path, "02072023", 2), "SKU,UNITS_SOLD,TRAN_DATE\n1,2,2023-07-02\n")
    headless = write(named(tmp_path, "03072023"), "1,2,2023-07-03\n2,4,2023-07-03\n")
    empty = write(named(tmp_path, "03072023", 2), HEADER)
    found, counts = judged(
        spark, tmp_path, listed(spark, good, swapped, short, part, headless, empty))
    assert counts == {
        "FD_SALES-01072023-1.csv": (0, 2), "FD_SALES-01072023-2.csv": (1, 2),
        "FD_SALES-02072023-1.csv.gz": (3, 3), "FD_SALES-02072023-2.csv": (1, 1),
        "FD_SALES-03072023-1.csv": (1, 1),  # its first line is taken for a header
    }
    assert rows(found.valid, "SKU", "UNITS", "TRAN_DATE", "MORE") == [
        ("1", "2", "2023-07-01", None), ("2", "3", "2023-07-01", None),
        ("7", "5", "2023-07-01", "x")]
    unread = {r._line for r in found.invalid.collect() if r._line}
    assert unread == {"1,2023-07-02", "2,2023-07-02", "3,2023-07-02", "1,2,2023-07-02",
                      "2,4,2023-07-03"}
    report = {(r.file.rsplit("-", 2)[-2], r.file.rsplit("-", 1)[-1], r.column): r.data_type
              for r in found.report.collect() if r.data_type}
    assert report == {("02072023", "1.csv.gz", "UNITS"): 3, ("02072023", "2.csv", "UNITS"): 1,
                      ("03072023", "1.csv", "SKU"): 1}


def test_malformed_lines_are_invalid(spark, tmp_path):
    path = write(named(tmp_path, "01072023"), HEADER + "1,2,2023-07-01\n2,3\n"
                 "3,4,2023-07-01,extra\n\n\"4\",\"5\",2023-07-01\n,6,2023-07-01\n")
    found, counts = judged(spark, tmp_path, listed(spark, path))
    assert counts == {"FD_SALES-01072023-1.csv": (3, 5)}
    assert rows(found.valid, "SKU") == [("1",), ("4",)]
    assert sorted((r.SKU or "", r._line or "") for r in found.invalid.collect()) == [
        ("", ""), ("2", "2,3"), ("3", "3,4,2023-07-01,extra")]
    lines = [r for r in found.report.collect() if r.column == validate.MALFORMED]
    assert [(r.data_type, r.null_check, r.date_format) for r in lines] == [(2, 0, 0)]


def test_unwanted_files_are_never_opened(spark, tmp_path):
    """Files of other days, names and kinds would stop the scan if it opened them."""
    wanted = [write(named(tmp_path, "01072023", n), HEADER + f"{n},2,2023-07-01\n") for n in (1, 2)]
    also = write(named(tmp_path, "20230702"), HEADER + "3,2,2023-07-02\n")
    folder = f"{tmp_path}/FD_SALES"
    for name in ("FD_SALES-03072023-1.csv.gz", "FD_SALES-0107202399-1.csv.gz",
                 "FD_SALES_OLD-01072023-1.csv.gz"):
        write(f"{folder}/{name}", "this is no gzip")
    write(f"{folder}/notes.txt", "not,a,header\n" * 1000)
    files = listed(spark, *wanted, also)
    assert rows(dropped.dropped_rows(spark, folder, files, REQUIRED), "SKU") == [
        ("1",), ("2",), ("3",)]
    lines = dropped.wanted_lines(
        spark, folder, files.select(dropped.spelled(F.col("path")).alias("file")))
    lines.collect()
    plan, scans = lines._jdf.queryExecution().executedPlan(), []
    while plan.children().size():
        plan = plan.children().head()
    scans.append(plan.metrics().get("numFiles").get().value())
    assert scans == [3]
    # a wanted file that another of the same day and table stands beside
    assert rows(dropped.dropped_rows(spark, folder, listed(spark, wanted[1])), "SKU") == [("2",)]
    assert csv.header_of(spark, folder) == ("SKU", "UNITS", "TRAN_DATE")


def test_paths_are_found_or_named(spark, tmp_path):
    path = write(named(tmp_path, "01072023"), HEADER + "1,2,2023-07-01\n")
    for start in ("file:", "file://", "file:/"):
        files = spark.createDataFrame([(start + path,)], "path string")
        assert dropped.dropped_rows(spark, f"{tmp_path}/FD_SALES", files).count() == 1
    gone = listed(spark, path, named(tmp_path, "02072023"))
    with pytest.raises(ValueError, match="FD_SALES-02072023-1.csv"):
        dropped.dropped_rows(spark, f"{tmp_path}/FD_SALES", gone)


@pytest.mark.parametrize("header,names", [
    ("A,B", ("A", "B")), ('﻿"A","B,C"', ("A", "B,C")), ("A,A,", ("A", "A_1", "_2")),
    ("", ()),
])
def test_column_names(header, names):
    assert dropped.column_names(header) == names


def test_headers_are_found_without_sorting_lines(spark, tmp_path):
    """Nor does the order of lines with equal keys matter, which a sort that spills may change."""
    for n in range(200):
        write(named(tmp_path, "01072023", n), f"Z{n % 2},B\n" + "A,C\n" * 50)
    found = csv.file_headers(spark, [f"{tmp_path}/FD_SALES"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "ObjectHashAggregate" in plan
    assert rows(found.groupBy("header").count()) == [("Z0,B", 100), ("Z1,B", 100)]


def test_a_line_is_parsed_once(spark, tmp_path):
    """However many fields are taken from it or looked at by the filter of invalid rows."""
    path = write(named(tmp_path, "01072023"), HEADER + "1,2,2023-07-01\n1,,2023-07-01\n1,2\n")
    folder = f"{tmp_path}/FD_SALES"
    found = dropped.dropped_rows(spark, folder, listed(spark, path), REQUIRED)
    invalid = validate.validate(found, RULES).invalid
    for df in (invalid, csv.read_raw_csv(spark, folder, mixed_headers=True).filter("SKU = '1'")):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1
    assert rows(invalid, "SKU", "UNITS", dropped.LINE) == [("1", "2", "1,2"), ("1", None, None)]


# ---- ledger -------------------------------------------------------------------------------

NEEDED = ("FD_SALES", "FD_STORE_INV")


def versions(spark, *files):
    """Accepted files (table, day, number, time)."""
    return spark.createDataFrame(
        [(f"in/{t}-{d}-{n}.csv", 10, dt.datetime(2023, 7, time), t, d) for t, d, n, time in files],
        "path string, length bigint, modificationTime timestamp, `table` string, file_date string")


def names(df):
    return sorted(r.path.split("/")[-1] for r in df.collect())


def test_days_are_released_when_they_are_complete(spark, tmp_path):
    """Three runs over a folder that keeps everything; each file is taken once."""
    path, folder = f"{tmp_path}/ledger", []

    def run(name, *new):
        folder.extend(new)
        found = ledger.admit(versions(spark, *folder), ledger.read_ledger(spark, path), name, NEEDED)
        ledger.write_ledger(found.ledger, path)
        return names(found.taken), rows(found.missing)

    assert run("one", ("FD_SALES", "01072023", 1, 1), ("FD_STORE_INV", "20230701", 1, 1),
               ("FD_SALES", "20230702", 1, 1)) == (
        ["FD_SALES-01072023-1.csv", "FD_STORE_INV-20230701-1.csv"],
        [("20230701", "None"), ("20230702", "FD_STORE_INV")])
    assert rows(ledger.held_files(ledger.read_ledger(spark, path)), "name", "first_run") == [
        ("FD_SALES-20230702-1.csv", "one")]
    # a late file for a complete day; nothing for the other
    assert run("two", ("FD_RETURNS", "20230701", 1, 2)) == (
        ["FD_RETURNS-20230701-1.csv"], [("20230701", "None")])
    assert run("three", ("FD_STORE_INV", "20230702", 1, 3)) == (
        ["FD_SALES-20230702-1.csv", "FD_STORE_INV-20230702-1.csv"], [("20230702", "None")])
    assert run("four") == ([], [])
    # a file that comes again with another time is another version, and is taken again
    folder[0] = ("FD_SALES", "01072023", 1, 9)
    assert run("five") == (["FD_SALES-01072023-1.csv"], [("20230701", "None")])
    known = ledger.read_ledger(spark, path)
    assert known.count() == 5 and known.filter("taken_run IS NULL").isEmpty()


def test_a_run_repeated_takes_the_same_files(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    first = versions(spark, ("FD_SALES", "20230701", 1, 1))
    whole = versions(spark, ("FD_SALES", "20230701", 1, 1), ("FD_STORE_INV", "20230701", 1, 2))
    ledger.write_ledger(
        ledger.admit(first, ledger.read_ledger(spark, path), "one", NEEDED).ledger, path)
    states = []
    for _ in range(3):
        found = ledger.admit(whole, ledger.read_ledger(spark, path), "two", NEEDED)
        assert names(found.taken) == ["FD_SALES-20230701-1.csv", "FD_STORE_INV-20230701-1.csv"]
        ledger.write_ledger(found.ledger, path)
        states.append(rows(ledger.read_ledger(spark, path)))
    assert states[0] == states[1] == states[2]


def run(stage, **arguments):
    argv = [stage]
    for key, value in arguments.items():
        argv += [f"--{key}", value]
    jobs.main(argv)


def test_three_days_through_the_stages(spark, tmp_path):
    """A day waits for its inventory, and each file reaches the tables once; repeating a run
    changes neither the log nor the routes."""
    base, drop = str(tmp_path), f"{tmp_path}/drop"
    rules = write(f"{base}/rules.json", json.dumps({"FD_SALES": {"columns": [
        {"name": "SKU", "validations": [{"name": "data_type", "values": ["int"]}]},
        {"name": "UNITS", "validations": [{"name": "data_type", "values": ["double"]}]}]}}))
    sold = "SKU,LOCATION,TRAN_DATE,UNITS,TOTAL_RETAIL\n"
    stock = "SKU,LOCATION,DATE,IP_QTY_BOP_INTRANS,IP_QTY_EOP_SOH,IP_QTY_EOP_INTRANS,IP_QTY_BOP_SOH\n"

    def day(number):
        run("ingest", input_path=drop, error_path=f"{base}/err{number}",
            output_path=f"{base}/in{number}", log_path=f"{base}/log", run_date=f"2023070{number}",
            required_tables="FD_STORE_INV,FD_SALES", ledger_path=f"{base}/ledger")
        run("validate", missing_path=f"{base}/in{number}/missing", input_path=drop,
            routes_path=f"{base}/in{number}/routes", error_path=f"{base}/err{number}",
            report_path=f"{base}/report", json_path=rules)
        routes = spark.read.option("header", True).csv(f"{base}/err{number}/routes")
        return sorted((r.uri.rsplit("/", 1)[-1], r.route) for r in routes.collect())

    write(named(drop, "01072023"), sold + "1,10,2023-07-01,1,1\n")
    write(f"{drop}/FD_STORE_INV/FD_STORE_INV-01072023-1.csv", stock + "1,10,2023-07-01,0,8,1,10\n")
    write(named(drop, "02072023"), "LOCATION,SKU,TRAN_DATE,UNITS,TOTAL_RETAIL\n10,1,2023-07-02,2,2\n")
    assert day(1) == [("FD_SALES-01072023-1.csv", "pass"), ("FD_STORE_INV-01072023-1.csv", "pass")]
    assert day(2) == []  # nothing new
    write(f"{drop}/FD_STORE_INV/FD_STORE_INV-02072023-1.csv", stock + "1,10,2023-07-02,0,8,1,10\n")
    # a file of the same day that lacks a column holds back its table's files, and no others
    write(named(drop, "01072023", 2), "SKU,LOCATION\n1,10\n")
    expected = [("FD_SALES-01072023-2.csv", "validation_threshold_error/required_files"),
                ("FD_SALES-02072023-1.csv", "pass"), ("FD_STORE_INV-02072023-1.csv", "pass")]
    assert day(3) == expected
    log = rows(spark.read.option("header", True).csv(f"{base}/log").drop("run"))
    assert day(3) == expected
    assert rows(spark.read.option("header", True).csv(f"{base}/log").drop("run")) == log
    run("preprocess", input_path=drop, routes_path=f"{base}/err3/routes",
        output_path=f"{base}/tables", master_output_path=f"{base}/master")
    found = spark.read.parquet(f"{base}/tables/FD_SALES.parquet")
    assert rows(found, "SKU", "LOCATION", "UNITS") == [(1, 10, 2.0)]


# ---- merges -------------------------------------------------------------------------------

DAY = dt.date(2023, 1, 1)
WIDE = "SKU int, LOCATION int, DATE date, N double"


def wide(spark, *data):
    return spark.createDataFrame([(s, loc, DAY + dt.timedelta(d), n) for s, loc, d, n in data], WIDE)


def table(spark, path):
    return rows(spark.read.parquet(path), "SKU", "LOCATION", "DATE", "N")


def test_a_partial_delivery_keeps_the_other_rows(spark, tmp_path):
    path = f"{tmp_path}/all"
    merge.merge_rows(wide(spark, (1, 10, 0, 1.0), (2, 10, 0, 2.0), (3, 10, 1, 3.0),
                          (None, 10, 0, 4.0), (1, 60, 0, 5.0)), path)
    batch = wide(spark, (2, 10, 0, 20.0), (None, 10, 0, 40.0), (7, 10, 0, 7.0), (7, 10, 0, 8.0))
    for _ in range(2):
        merge.merge_rows(batch, path)
        assert table(spark, path) == sorted([
            (1, 10, DAY, 1.0), (2, 10, DAY, 20.0), (3, 10, DAY + dt.timedelta(1), 3.0),
            (None, 10, DAY, 40.0), (1, 60, DAY, 5.0), (7, 10, DAY, 7.0), (7, 10, DAY, 8.0),
        ], key=lambda r: tuple((v is None, str(v)) for v in r))
    merge.merge_rows(batch.limit(0), path)
    assert spark.read.parquet(path).count() == 7


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    path = f"{tmp_path}/all"
    merge.merge_rows(wide(spark, (1, 10, 0, 1.0), (3, 10, 1, 3.0)), path)

    def files(day):
        folder = f"{path}/LOCATION_GROUP=0.0/DATE={day}"
        return sorted(f for f in os.listdir(folder) if f.endswith("parquet"))

    before = files("2023-01-01"), files("2023-01-02")
    merge.merge_rows(wide(spark, (9, 10, 1, 9.0)), path)
    assert files("2023-01-01") == before[0] and files("2023-01-02") != before[1]


def test_a_merge_that_fails_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/all"
    merge.merge_rows(wide(spark, (1, 10, 0, 1.0), (2, 10, 0, 2.0)), path)
    before = table(spark, path), sorted(os.listdir(path))
    batch = wide(spark, (1, 10, 0, 100.0), (8, 10, 3, 1.0))

    def negative(staged):
        assert staged.count() == 3
        raise ValueError("not this one")

    with pytest.raises(ValueError, match="not this one"):
        merge.merge_rows(batch, path, check=negative)
    broken = batch.withColumn("N", F.when(F.col("SKU") < 8, F.col("N")).otherwise(
        F.raise_error(F.lit("lost in the middle")).cast("double")))
    with pytest.raises(Exception, match="lost in the middle"):
        merge.merge_rows(broken, path)
    assert (table(spark, path), sorted(os.listdir(path))) == before


def test_merge_stage_by_rows(spark, tmp_path):
    merge.merge_rows(wide(spark, (1, 10, 0, 1.0), (2, 10, 0, 2.0), (1, 60, 0, 3.0)),
                     f"{tmp_path}/all")
    merge.merge_rows(wide(spark, (1, 10, 0, 9.0), (1, 60, 0, 9.0)), f"{tmp_path}/batch")
    run("merge", source_path=f"{tmp_path}/batch", dest_path=f"{tmp_path}/all", by_rows="Y",
        location_group_list="0.0")
    assert [r[3] for r in table(spark, f"{tmp_path}/all")] == [9.0, 3.0, 2.0]


def plans_since(spark, start):
    """The final plans of the queries that ran since the session had run ``start``."""
    return [e.physicalPlanDescription() for e in kept_executions(spark) if e.executionId() >= start]


def executions(spark):
    return max((e.executionId() + 1 for e in kept_executions(spark)), default=0)


def kept_executions(spark):
    """The last 1,000 queries or so; the session forgets older ones."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = spark._jsparkSession.sharedState().statusStore().executionsList()
    return [found.apply(i) for i in range(found.size())]


@pytest.mark.parametrize("n", [1000, 150_000])
def test_the_keys_of_a_large_batch_are_not_sent_to_all_tasks(spark, tmp_path, n):
    """However well its files are compressed."""
    path = f"{tmp_path}/all"
    batch = spark.range(n).select(
        F.when(F.col("id") > 0, F.col("id")).cast("int").alias("SKU"), F.lit(10).alias("LOCATION"),
        F.lit(DAY).alias("DATE"), F.lit(1.0).alias("N"),
    )
    merge.merge_rows(batch.withColumn("SKU", F.col("SKU") * 2), path)
    start = executions(spark)
    merge.merge_rows(batch.withColumn("N", F.lit(2.0)), path)
    joins = [p for p in plans_since(spark, start) if "LeftAnti" in p]
    assert joins and all(("SortMergeJoin LeftAnti" in p) == (n > merge.SENT) for p in joins)
    found = spark.read.parquet(path).groupBy("N").count()
    assert rows(found) == [(1.0, n // 2), (2.0, n)]


# ---- densify in batches -------------------------------------------------------------------

BALANCES = ("IP_QTY_BOP_INTRANS", "IP_QTY_EOP_SOH", "IP_QTY_EOP_INTRANS", "IP_QTY_BOP_SOH")


def snapshot(spark, data):
    return spark.createDataFrame(
        data, "SKU int, LOCATION int, DATE date, " + ", ".join(f"{c} double" for c in BALANCES))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_the_whole(spark, tmp_path, seed):
    """Gaps across the border, days delivered several times, series that end or begin late."""
    rng = random.Random(seed)
    data = [(rng.choice([1, 2, 3, None]), rng.choice([10, None]), DAY + dt.timedelta(rng.randrange(60)),
             *(rng.choice([None, float(rng.randrange(9))]) for _ in BALANCES)) for _ in range(150)]
    data += data[:10] + [(9, 9, DAY + dt.timedelta(45), 1.0, 1.0, 1.0, 1.0),
                         (8, 9, DAY, 1.0, 1.0, 1.0, 1.0), (8, 9, None, 1.0, 1.0, 1.0, 1.0)]
    whole, path = snapshot(spark, data), f"{tmp_path}/densified"
    state = whole.limit(0)
    for low, high in ((0, 19), (20, 40), (41, 60)):
        part = whole.filter(F.col("DATE").isNull() & (F.lit(low) == 0) | F.col("DATE").between(
            DAY + dt.timedelta(low), DAY + dt.timedelta(high)))
        batch = inventory.densify_batch(part, state)
        merge.merge_rows(batch.rows, path, by=("DATE",))
        data_so_far = batch.state.collect()
        state = snapshot(spark, [tuple(r) for r in data_so_far])
    dense = inventory.densify_inventory(whole)
    assert rows(spark.read.parquet(path), *dense.columns) == rows(dense)


def test_a_batch_touches_only_the_last_day_and_the_gap(spark):
    first = snapshot(spark, [(1, 10, DAY + dt.timedelta(i), *[float(i)] * 4) for i in range(5)]
                     + [(2, 10, DAY, *[1.0] * 4)])
    start = inventory.densify_batch(first, first.limit(0))
    later = snapshot(spark, [(1, 10, DAY + dt.timedelta(7), *[7.0] * 4)])
    found = inventory.densify_batch(later, start.state)
    assert [r[2].day for r in rows(found.rows)] == [5, 6, 7, 8]
    assert rows(found.state, "SKU", "DATE") == [(1, DAY + dt.timedelta(7)), (2, DAY)]


def test_a_day_before_the_state_stops(spark):
    first = snapshot(spark, [(1, 10, DAY + dt.timedelta(3), *[1.0] * 4)])
    state = inventory.densify_batch(first, first.limit(0)).state
    with pytest.raises(ValueError, match="before the last"):
        inventory.densify_batch(snapshot(spark, [(1, 10, DAY, *[1.0] * 4)]), state)
    again = snapshot(spark, [(1, 10, DAY + dt.timedelta(3), *[2.0] * 4)])
    assert inventory.densify_batch(again, state).rows.count() == 2


def test_the_state_is_not_sent_to_all_tasks(spark):
    """It has a row per series; how many these are doesn't show in the size of its files."""
    state = snapshot(spark, [(i, 10, DAY, *[1.0] * 4) for i in range(50)])
    batch = snapshot(spark, [(i, 10, DAY + dt.timedelta(2), *[2.0] * 4) for i in range(50)])
    start = executions(spark)
    inventory.densify_batch(batch, state)
    plans = plans_since(spark, start)
    assert plans and not [p for p in plans if "BroadcastHashJoin" in p]
