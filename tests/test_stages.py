"""Sources, sinks and the stages end to end on small drops."""

import datetime as dt
import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from bench_shapes import wide_of
from conftest import rows
from shelfledger import session
from shelfledger.mapping import default_mapping, load_mapping
from shelfledger.operators import checks, conform, merge
from shelfledger.plans import jobs
from shelfledger.plans.denormalize import denormalize
from shelfledger.sources import csv, sinks, tables, workspace

MAPPING = default_mapping()


def write(path, text, opener=open):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with opener(path, "wt") as file:
        file.write(text)
    return str(path)


def test_mapping_file(spark, tmp_path):
    """The default mapping, written out in the form of a mapping file, reads back the same."""
    text = {
        t.name: {"source_table_name": t.source, "columns": {
            c.key: {"src": c.raw, "dest": c.output} for c in t.columns}}
        for t in MAPPING.tables.values()
    }
    path = write(f"{tmp_path}/mapping.json", json.dumps(text, indent=2))
    assert load_mapping(spark, path).tables == MAPPING.tables


def test_custom_mapping(spark, tmp_path):
    path = write(f"{tmp_path}/m.json", json.dumps({"returns": {
        "source_table_name": "BACK", "columns": {
            "sku": {"src": "ITEM", "dest": "SKU"},
            "return_units": {"src": "N", "dest": "BACK_N"}}}}))
    mapping = load_mapping(spark, path)
    df = spark.createDataFrame([(1, 2.0, "x")], "ITEM int, N double, extra string")
    found = conform.conform(df, mapping, "returns")
    assert found.columns == ["SKU", "RETURN_UNITS"]
    assert mapping.rename_output(found).columns == ["SKU", "BACK_N"]
    assert mapping.by_source("BACK").name == "returns"


def test_csv_plain_gzip_and_quotes(spark, tmp_path):
    a = write(f"{tmp_path}/a.csv", 'SKU,UNITS,TRAN_DATE\n1,2.5,2023-01-01\n"2"," ",\n')
    b = write(f"{tmp_path}/b.csv.gz", "SKU,UNITS,TRAN_DATE\n3.0,x,2023-01-02\n", gzip.open)
    raw = csv.read_raw_csv(spark, [a, b])
    assert rows(raw, "SKU", "UNITS", "TRAN_DATE") == [
        ("1", "2.5", "2023-01-01"), ("2", " ", None), ("3.0", "x", "2023-01-02")
    ]
    assert raw.select("file").distinct().count() == 2
    typed = csv.read_typed_csv(spark, [a, b], MAPPING["returns"])
    assert rows(typed, "SKU", "UNITS") == [(1, 2.5), (2, None), (3, None)]


def test_csv_with_other_header(spark, tmp_path):
    a = write(f"{tmp_path}/a b.csv", "SKU,UNITS\n1,2\n")
    b = write(f"{tmp_path}/b.csv", 'UNITS,SKU,"MORE"\n3,4,5\n')
    with pytest.raises(Exception, match="CSV header"):
        csv.read_raw_csv(spark, [a, b]).collect()
    mixed = csv.read_raw_csv(spark, [a, b], mixed_headers=True)
    assert rows(mixed, "SKU", "UNITS", "MORE") == [("1", "2", None), ("4", "3", "5")]


def test_historical_dates(spark):
    df = spark.createDataFrame([(1, "2023-01-31"), (2, "1/31/2023"), (3, "x")],
                               "SKU int, TRAN_DATE string")
    day = dt.date(2023, 1, 31)
    assert rows(conform.conform(df, MAPPING, "returns", True)) == [(1, day), (2, day), (3, None)]
    assert rows(conform.conform(df, MAPPING, "returns")) == [(1, day), (2, None), (3, None)]


def test_partition_pruning_and_replacement(spark, tmp_path):
    path = f"{tmp_path}/FD_SALES.parquet"
    df = spark.createDataFrame([(i, 25 * i, 1.0) for i in range(8)],
                               "SKU int, LOCATION int, UNITS double")
    sinks.write_partitioned(sinks.with_location_group(df), path)
    assert os.path.isdir(f"{path}/LOCATION_GROUP=2.0")
    read = tables.read_table(spark, str(tmp_path), MAPPING, "sales", [2.0])
    assert rows(read, "SKU", "LOCATION_GROUP") == [(3, 2.0), (4, 2.0)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "LOCATION_GROUP" in plan.split("PartitionFilters")[1]
    newer = sinks.with_location_group(df.filter("SKU = 3").withColumn("UNITS", F.lit(9.0)))
    sinks.write_partitioned(newer, path)
    again = tables.read_table(spark, str(tmp_path), MAPPING, "sales")
    assert again.count() == 7 and again.filter("LOCATION_GROUP = 2.0").count() == 1


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        df = spark.range(0, 200_000, 1, 8).selectExpr(
            "CASE WHEN id % 100 < 99 THEN 1.0D ELSE 2.0D END AS LOCATION_GROUP",
            "uuid() AS text")
        sinks.write_partitioned(df, f"{tmp_path}/hot")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = [f for f in os.listdir(f"{tmp_path}/hot/LOCATION_GROUP=1.0") if f.endswith("parquet")]
    assert len(files) > 1
    assert spark.read.parquet(f"{tmp_path}/hot").count() == 200_000


def test_merge_twice_is_the_same(spark, tmp_path):
    path, day = f"{tmp_path}/all", dt.date(2023, 1, 1)
    first = spark.createDataFrame([(1, 10, day, 1.0), (1, 60, day, 2.0)],
                                  "SKU int, LOCATION int, DATE date, N double")
    batch = first.filter("LOCATION = 60").withColumn("N", F.lit(5.0))
    for df in (first, batch, batch):
        merge.merge_partitions(df, path)
    assert rows(spark.read.parquet(path), "LOCATION", "N") == [(10, 1.0), (60, 5.0)]


def test_work_dir_is_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = workspace.work_dir(spark, "x"), workspace.work_dir(spark, "x")
    assert one.startswith(base) and two.startswith(base) and one != two
    assert rows(workspace.materialize(spark.range(3), "x")) == [(0,), (1,), (2,)]


def test_shuffle_partitions():
    assert session.shuffle_partitions(1) == 200
    assert session.shuffle_partitions(10**12) == 3726
    assert session.shuffle_partitions(100 * 10**12) > 300_000
    assert session.shuffle_partitions(100 * 10**12, most=50_000) == 50_000


def test_checks_find_faults(spark, small):
    from entry_queries.queries import conformed

    t = conformed(spark, small)
    snapshot = t["inventory_snapshot"]
    wide = denormalize(t)
    assert {r.failures for r in checks.denorm_checks(wide, snapshot).collect()} == {0}
    faulty = wide.union(wide.limit(1)).withColumn(
        "SALES_UNITS", F.when(F.col("SKU") > 0, F.col("SALES_UNITS")))
    found = {r.check: r.failures for r in checks.denorm_checks(faulty, snapshot).collect()}
    assert found["duplicate_keys"] == 1 and found["row_count"] == 1 and found["nulls_filled"] > 0


def test_repeated_snapshot_rows_are_kept(spark, small):
    from entry_queries.queries import conformed

    t = conformed(spark, small)
    once = denormalize(t).count()
    t["inventory_snapshot"] = t["inventory_snapshot"].union(t["inventory_snapshot"])
    assert denormalize(t).count() == 2 * once


def random_tables(spark, seed):
    """Small tables with missing keys and values and with repeated rows."""
    rng = random.Random(seed)

    def key():
        return (rng.choice([1, 2, 3, None]), rng.choice([10, 60, None]),
                rng.choice([None] + [dt.date(2023, 1, n) for n in range(1, 9)]))

    def number():
        return rng.choice([None, 0.0, float(rng.randrange(-9, 10)), float(rng.randrange(20))])

    def frame(columns, count, make):
        data = [make() for _ in range(count)]
        schema = "SKU int, LOCATION int, DATE date, " + columns
        return spark.createDataFrame(data + data[:5], schema)

    balances = ("IP_QTY_BOP_INTRANS", "IP_QTY_BOP_SOH", "IP_QTY_EOP_INTRANS", "IP_QTY_EOP_SOH")
    t = {
        "inventory_snapshot": frame(", ".join(f"{c} double" for c in balances), 90,
                                    lambda: key() + tuple(number() for _ in balances)),
        "inventory_adjustment": frame(
            "ADJ_QTY double, REASON int", 90,
            lambda: key() + (number(), rng.choice([None, 1, 4, 9, 10, 11, 14, 99]))),
        "sales": frame("SALES_UNITS double, SALES_TOTAL_RETAIL double", 90,
                       lambda: key() + (number(), number())),
        "returns": frame("RETURN_UNITS double", 90, lambda: key() + (number(),)),
        "store_transfers": frame("TRANSFER_CODE int, TRANSFER_UNITS double", 90,
                                 lambda: key() + (rng.choice([20, 30, 40, None]), number())),
        "store_invoice": frame("DSD_INVC_QTY_RCPT double", 90, lambda: key() + (number(),)),
    }
    t["yearly_audit_schedule"] = t["sales"].selectExpr("LOCATION", "DATE AS AUDIT_DATE", "DATE")
    t["sku"] = spark.createDataFrame(
        [(1, 2.0, None, 1.0), (3, None, 4.0, 1.0)],
        "SKU int, SKU_WDTH double, SKU_HGT double, SKU_DPTH double")
    return t


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_wide_table_against_single_joins(spark, seed):
    """One shuffle for all facts gives what one left join per fact gives."""
    t = random_tables(spark, seed)
    ours, stepwise = denormalize(t), wide_of(t)
    assert sorted(ours.columns) == sorted(stepwise.columns)
    assert rows(ours, *sorted(ours.columns)) == rows(stepwise, *sorted(ours.columns))
    assert ours.count() == t["inventory_snapshot"].count()


@pytest.fixture
def drop(tmp_path):
    """Two days, three stores in two groups, one file too bad to use."""
    root = f"{tmp_path}/ok"
    inv = "SKU,LOCATION,DATE,IP_QTY_BOP_INTRANS,IP_QTY_EOP_SOH,IP_QTY_EOP_INTRANS,IP_QTY_BOP_SOH\n"
    files = [
        write(f"{root}/FD_STORE_INV/FD_STORE_INV-01072023-1.csv",
              inv + "1,10,2023-07-01,0,8,1,10\n1,60,2023-07-01,1,5,0,5\n"),
        write(f"{root}/FD_STORE_INV/FD_STORE_INV-03072023-1.csv.gz",
              inv + "1,10,2023-07-03,0,7,0,8\n", gzip.open),
        write(f"{root}/FD_SALES/FD_SALES-01072023-1.csv",
              "SKU,LOCATION,TRAN_DATE,UNITS,TOTAL_RETAIL\n1,10,2023-07-01,2,5.0\n"
              "1,10,2023-07-01,4,10.5\n"),
        write(f"{root}/FD_SALES/FD_SALES-01072023-2.csv",
              "SKU,LOCATION,TRAN_DATE,UNITS,TOTAL_RETAIL\n1,60,never,2,5.0\n"),
        write(f"{root}/FD_SALES/FD_SALES-02072023-1.csv",
              "SKU,LOCATION,TRAN_DATE,UNITS,TOTAL_RETAIL\n"),
        write(f"{root}/FD_SKU_MASTER/FD_SKU_MASTER-01072023-1.csv",
              "SKU,SKU_WDTH,LOB\n1,2.5,7\n"),
    ]
    return f"{tmp_path}", root, files


def run(stage, **arguments):
    argv = [stage]
    for key, value in arguments.items():
        argv += [f"--{key}", value]
    jobs.main(argv)


RULES = {
    table: {"columns": [{"name": "SKU", "validations": [
        {"name": "data_type", "values": ["int"]},
        {"name": "null_check", "values": ["", "null", " "]}]}]
        + ([{"name": "TRAN_DATE", "validations": [
            {"name": "date_format", "values": ["%Y-%m-%d"]}]}] if table == "FD_SALES" else [])}
    for table in ("FD_STORE_INV", "FD_SALES")
}


def test_stages(spark, drop):
    """Each stage takes the tables the one before it wrote; a bad file and a late day, named in
    either spelling, do not reach the wide table."""
    base, root, _ = drop
    write(f"{root}/FD_SALES/FD_SALES-20230704-1.csv",
          "SKU,LOCATION,TRAN_DATE,UNITS,TOTAL_RETAIL\n1,10,2023-07-01,100,5.0\n")
    days = "{'20230701': 'None', '03072023': 'None', '04072023': 'FD_STORE_INV'}"
    run("ingest", date_missing_files=days, input_path=root, error_path=f"{base}/err",
        output_path=f"{base}/in", log_path=f"{base}/log", run_date="20230705")
    routed = spark.read.option("header", True).csv(f"{base}/in/routes")
    assert routed.count() == 7
    missing = spark.read.option("header", True).csv(f"{base}/in/missing")
    assert rows(missing) == [
        ("20230701", "None"), ("20230702", "FD_STORE_INV"), ("20230703", "None"),
        ("20230704", "FD_STORE_INV"),
    ]
    log = spark.read.option("header", True).csv(f"{base}/log")
    assert rows(log, "file_date", "status") == [
        ("03072023", "success"), ("04072023", "failed"), ("04072023", "success"),
        ("20230701", "success"),
    ]
    run("ingest", date_missing_files="{'20230701': 'None', '20230703': 'None'}",
        input_path=root, error_path=f"{base}/err2", output_path=f"{base}/in2",
        log_path=f"{base}/log2", run_date="20230705", earlier_log=f"{base}/log",
        holidays="20230704")
    log = spark.read.option("header", True).csv(f"{base}/log2")
    assert rows(log.filter("status = 'failed'"), "file_date", "error_code") == [
        ("20230702", "DATA_ING_ERR_001"), ("20230705", "DATA_ING_ERR_001")
    ]

    rules_path = write(f"{base}/rules.json", json.dumps(RULES))
    run("validate", missing_path=f"{base}/in/missing", input_path=root,
        routes_path=f"{base}/in/routes", error_path=f"{base}/err",
        report_path=f"{base}/report", json_path=rules_path)
    routes = {r.uri.rsplit("/", 1)[-1]: r.route for r in
              spark.read.option("header", True).csv(f"{base}/err/routes").collect()}
    assert routes == {
        "FD_STORE_INV-01072023-1.csv": "pass", "FD_STORE_INV-03072023-1.csv.gz": "pass",
        "FD_SALES-01072023-1.csv": "validation_threshold_error/required_files",
        "FD_SALES-01072023-2.csv": "validation_threshold_error/required_files",
        "FD_SALES-02072023-1.csv": "missed_files", "FD_SALES-20230704-1.csv": "missed_files",
        "FD_SKU_MASTER-01072023-1.csv": "pass",
    }
    invalid = spark.read.option("header", True).csv(f"{base}/err/invalid_rows/FD_SALES")
    assert rows(invalid, "LOCATION", "TRAN_DATE") == [("60", "never")]

    # the held-back day is delivered again without the bad file
    os.remove(f"{root}/FD_SALES/FD_SALES-01072023-2.csv")
    run("ingest", input_path=root, error_path=f"{base}/err3", output_path=f"{base}/in3",
        log_path=f"{base}/log3", run_date="20230705",
        required_tables="FD_STORE_INV")
    run("validate", missing_path=f"{base}/in3/missing", input_path=root,
        routes_path=f"{base}/in3/routes", error_path=f"{base}/err3",
        report_path=f"{base}/report", json_path=rules_path)
    run("preprocess", input_path=root, routes_path=f"{base}/err3/routes",
        output_path=f"{base}/tables", master_output_path=f"{base}/master")
    assert rows(tables.location_groups(spark, f"{base}/tables", MAPPING)) == [(0.0,), (1.0,)]
    sold = spark.read.parquet(f"{base}/tables/FD_SALES.parquet")
    assert rows(sold, "UNITS") == [(2.0,), (4.0,)]

    for mode, expected in (("N", 3), ("Y", 4)):
        run("denormalize", src_path=f"{base}/tables", master_src_path=f"{base}/master",
            dest_path=f"{base}/wide{mode}", historical_mode=mode, with_arrivals="Y",
            with_audits="Y", counts_path=f"{base}/counts{mode}")
        run("check", source_path=f"{base}/wide{mode}", src_path=f"{base}/tables",
            historical_mode=mode, counts_path=f"{base}/counts{mode}")
        wide = spark.read.parquet(f"{base}/wide{mode}")
        assert wide.count() == expected
        assert {"DC_TRANSFERRED_UNITS", "AUDIT_UNITS"} <= set(wide.columns)
        run("check", source_path=f"{base}/wide{mode}", src_path=f"{base}/tables",
            historical_mode=mode)
    first = spark.read.parquet(f"{base}/wideN").filter("LOCATION = 10 AND DATE = '2023-07-01'")
    row = first.first()
    assert (row.SALES_UNITS, row.SALES_UNIT_RETAIL, row.BULK_SALES_UNITS) == (6.0, 2.58, 4.0)
    assert (row.SKU_WDTH, row.LOB, row.ONHAND_RECORDED) == (2.5, 7, 4.0)

    run("denormalize", src_path=f"{base}/tables", master_src_path=f"{base}/master",
        dest_path=f"{base}/group", historical_mode="N", location_groups="1.0")
    assert rows(spark.read.parquet(f"{base}/group"), "LOCATION") == [(60,)]
    with pytest.raises(ValueError, match="row_count"):
        run("check", source_path=f"{base}/group", src_path=f"{base}/tables", historical_mode="N")
    run("merge", source_path=f"{base}/wideN", dest_path=f"{base}/all")
    run("merge", source_path=f"{base}/wideN", dest_path=f"{base}/all", location_group_list="1.0")
    assert spark.read.parquet(f"{base}/all").count() == 3

    # the next drop has no store of group 1: none of yesterday's is left
    run("preprocess", input_path=root, routes_path=f"{base}/err3/routes", dates="03072023",
        output_path=f"{base}/tables", master_output_path=f"{base}/master")
    assert rows(tables.location_groups(spark, f"{base}/tables", MAPPING)) == [(0.0,)]


def test_wide_table_with_options_is_clean(spark, small):
    """Two counts of one item on a day are one row with their sum."""
    from entry_queries.queries import conformed
    from shelfledger.operators import audit, carriers

    t = conformed(spark, small)
    actuals = audit.audit_actuals(t["yearly_audit"], t["yearly_audit_schedule"])
    wide = denormalize(t, arrivals=carriers.carrier_arrivals(t["carrier_master"]),
                       actuals=actuals.union(actuals))
    found = {r.check: r.failures
             for r in checks.denorm_checks(wide, t["inventory_snapshot"]).collect()}
    assert set(found.values()) == {0}


@pytest.mark.parametrize("text", ["2024-01-03", "20241301", "nope", ""])
def test_malformed_days_stop(spark, text):
    from shelfledger.operators import calendar

    empty = spark.createDataFrame([], "file_date string")
    asked = spark.createDataFrame([("20240104",), (text,)], "file_date string")
    with pytest.raises(Exception, match="not a day"):
        calendar.fill_dates(empty, asked).collect()


def test_days_in_either_spelling(spark):
    from shelfledger.functions.dates import file_day

    df = spark.createDataFrame([("20230701",), ("01072023",), (None,)], "t string")
    assert rows(df.select(file_day(F.col("t")).alias("d")).distinct()) == [
        (dt.date(2023, 7, 1),), (None,)
    ]
