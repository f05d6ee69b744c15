"""One query per operator; each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entry_queries import views
from shelfledger.functions import dates, measures, names
from shelfledger.mapping import default_mapping
from shelfledger.operators import (
    asof, audit, calendar, carriers, checks, conform, facts, inventory, ledger, merge, quarantine,
    reconcile, routing, runlog, validate,
)
from shelfledger.plans import preprocess, validation
from shelfledger.plans.denormalize import denormalize, join_facts
from shelfledger.sources import csv, dropped, manifest, sinks, tables
from shelfledger.sources.workspace import materialize, work_dir

Query = Callable[[SparkSession, str], DataFrame]

MAPPING = default_mapping()
QUERIES: dict[str, Query] = {}
HOLIDAYS = ("20240110", "20240116")
TODAY = "20240215"
TWO_REQUIRED = ("FD_STORE_INV", "FD_PHYSICAL_INV_ADJUSTMENTS")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def conformed(spark: SparkSession, sf_dir: str, *wanted: str) -> dict[str, DataFrame]:
    raw = views.raw_tables(spark, sf_dir)
    return {n: conform.conform(raw[n], MAPPING, n) for n in wanted or raw}


def one(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return conformed(spark, sf_dir, name)[name]


def rules() -> list[validate.ColumnRule]:
    rule, unfilled = validate.ColumnRule, ("", "null", " ")
    return [
        rule("SKU", ("int",), unfilled),
        rule("TRAN_DATE", ("string",), unfilled, ("%Y-%m-%d",)),
        rule("UNITS", ("double",), unfilled),
        rule("TOTAL_RETAIL", ("double",), unfilled),
    ]


# ---- projections -------------------------------------------------------------------------

@query
def conform_projection(spark, sf_dir):
    df = sinks.with_location_group(views.raw_tables(spark, sf_dir)["store_invoice"])
    return conform.select_conformed(
        conform.conform(df, MAPPING, "store_invoice"), MAPPING, "store_invoice"
    )


@query
def conform_text(spark, sf_dir):
    """Untyped rows: numbers cast, dates parsed, misfits NULL."""
    return conform.conform(views.text_rows(spark, sf_dir), MAPPING, "sales")


@query
def conform_historical(spark, sf_dir):
    """Dashed days are ISO, the others month/day/year; schedules are like 18-Mar-22."""
    mv = views.movements(spark, sf_dir)
    slashed = F.date_format("DATE", "M/d/yyyy")
    dashed = F.date_format("DATE", "yyyy-MM-dd")
    rows = mv.select(
        "SKU", "LOCATION", F.when(F.col("LS") == "O", slashed).otherwise(dashed).alias("TRAN_DATE"),
        "UNITS",
    )
    return conform.conform(rows, MAPPING, "returns", historical=True)


@query
def conform_schedule(spark, sf_dir):
    raw = views.raw_tables(spark, sf_dir)["yearly_audit_schedule"]
    text = raw.withColumns({
        c: F.date_format(c, "dd-MMM-yy") for c in ("INVENTORY_DATE", "RECONCILIATION_DATE")
    })
    return conform.conform(text, MAPPING, "yearly_audit_schedule", historical=True)


@query
def location_group_sizes(spark, sf_dir):
    return (
        sinks.with_location_group(views.movements(spark, sf_dir))
        .groupBy("LOCATION_GROUP").agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def date_format_check(spark, sf_dir):
    rows = views.text_rows(spark, sf_dir)
    return rows.select(
        "TRAN_DATE", dates.matches_any_format(F.col("TRAN_DATE"), ["%Y-%m-%d"]).alias("fits")
    )


# ---- daily facts -------------------------------------------------------------------------

@query
def daily_adjustments(spark, sf_dir):
    return facts.daily_adjustments(one(spark, sf_dir, "inventory_adjustment"))


@query
def reason_splits(spark, sf_dir):
    """Each reason set on its own, and all reasons for an empty set."""
    df = one(spark, sf_dir, "inventory_adjustment")
    sets = {"damage": [4, 11], "storeuse": [10], "expired": [14], "scanerr": [9], "all": []}
    parts = [
        facts.reason_quantity(df, codes, "QTY").withColumn("REASONS", F.lit(name))
        for name, codes in sets.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def daily_sales(spark, sf_dir):
    return facts.daily_sales(one(spark, sf_dir, "sales"))


@query
def daily_returns(spark, sf_dir):
    return facts.daily_returns(one(spark, sf_dir, "returns"))


@query
def daily_invoices(spark, sf_dir):
    return facts.daily_invoices(one(spark, sf_dir, "store_invoice"))


@query
def transfers_by_code(spark, sf_dir):
    return facts.daily_transfers_by_code(one(spark, sf_dir, "store_transfers"))


@query
def daily_transfers(spark, sf_dir):
    return facts.daily_transfers(one(spark, sf_dir, "store_transfers"))


@query
def daily_facts(spark, sf_dir):
    return facts.daily_facts(conformed(spark, sf_dir))


# ---- inventory ---------------------------------------------------------------------------

@query
def snapshot_balances(spark, sf_dir):
    return inventory.inventory_snapshot(one(spark, sf_dir, "inventory_snapshot"))


@query
def date_bounds(spark, sf_dir):
    return inventory.date_bounds(one(spark, sf_dir, "inventory_snapshot"))


@query
def calendar_spine(spark, sf_dir):
    return inventory.calendar_spine(one(spark, sf_dir, "inventory_snapshot"))


@query
def closing_from_opening(spark, sf_dir):
    return inventory.closing_from_opening(one(spark, sf_dir, "inventory_snapshot"))


@query
def densify_inventory(spark, sf_dir):
    return inventory.densify_inventory(one(spark, sf_dir, "inventory_snapshot"))


# ---- audits and carriers -----------------------------------------------------------------

@query
def audit_flag(spark, sf_dir):
    return audit.audit_schedule(one(spark, sf_dir, "yearly_audit_schedule"))


@query
def audit_actuals(spark, sf_dir):
    t = conformed(spark, sf_dir, "yearly_audit", "yearly_audit_schedule")
    return audit.audit_actuals(t["yearly_audit"], t["yearly_audit_schedule"])


@query
def carrier_rows(spark, sf_dir):
    return carriers.resolved_arrivals(one(spark, sf_dir, "carrier_master"))


@query
def carrier_arrivals(spark, sf_dir):
    return carriers.carrier_arrivals(one(spark, sf_dir, "carrier_master"))


@query
def asof_forward_7d(spark, sf_dir):
    t = conformed(spark, sf_dir, "sales", "carrier_master")
    return asof.asof_forward(
        t["sales"], carriers.carrier_arrivals(t["carrier_master"]),
        ["LOCATION"], "DATE", "ACTUAL_ARRIVAL",
    )


@query
def asof_forward_year(spark, sf_dir):
    """The same with a tolerance of a year, for the days in order."""
    t = conformed(spark, sf_dir, "sales", "carrier_master")
    return asof.asof_forward(
        t["sales"], carriers.carrier_arrivals(t["carrier_master"]),
        ["LOCATION"], "DATE", "ACTUAL_ARRIVAL", 365,
    )


@query
def transfers_rescheduled(spark, sf_dir):
    t = conformed(spark, sf_dir, "store_transfers", "carrier_master")
    return carriers.reschedule_transfers(
        t["store_transfers"], carriers.carrier_arrivals(t["carrier_master"])
    )


# ---- the wide table ----------------------------------------------------------------------

@query
def joined_facts(spark, sf_dir):
    return join_facts(conformed(spark, sf_dir))


@query
def denormalized(spark, sf_dir):
    return denormalize(conformed(spark, sf_dir))


@query
def denormalized_historical(spark, sf_dir):
    return denormalize(conformed(spark, sf_dir), historical=True)


@query
def denormalized_with_arrivals(spark, sf_dir):
    """With the optional arrival-dated transfers and audited units."""
    t = conformed(spark, sf_dir)
    return denormalize(
        t,
        arrivals=carriers.carrier_arrivals(t["carrier_master"]),
        actuals=audit.audit_actuals(t["yearly_audit"], t["yearly_audit_schedule"]),
    )


@query
def derived_measures(spark, sf_dir):
    """The measures on one row per line item."""
    mv = views.movements(spark, sf_dir)
    units, line = F.col("UNITS"), F.col("LN").cast("double")
    rows = mv.select(
        "ORD", "LN",
        units.alias("IP_QTY_BOP_INV"), (line * 7).alias("IP_QTY_EOP_INV"),
        (units - line).alias("IP_QTY_BOP_SOH"), (line * 6).alias("IP_QTY_EOP_SOH"),
        (line - 1).alias("SALES_UNITS"), F.col("CENTS").alias("SALES_TOTAL_RETAIL"),
        F.when(F.col("RF") == "R", 2.0).otherwise(0.0).alias("RETURN_UNITS"),
        F.when(F.col("RF") == "A", units - 25).otherwise(0.0).alias("ADJ_QTY"),
        F.when(F.col("LS") == "O", line).otherwise(0.0).alias("DSD_RECORDED"),
        F.lit(4.0).alias("INTRANSIT_RECORDED"),
        F.when(F.col("RF") == "N", 1.0).otherwise(0.0).alias("DSD_INVC_QTY_RCPT"),
    )
    return measures.derive_measures(rows)


@query
def post_denorm_checks(spark, sf_dir):
    t = conformed(spark, sf_dir)
    return checks.denorm_checks(denormalize(t), t["inventory_snapshot"])


@query
def faulty_denorm_checks(spark, sf_dir):
    """The checks on a wide table with faults worked in: every fifth item's rows twice, no
    sales units for every seventh item, closing totals off by one for every third store."""
    t = conformed(spark, sf_dir)
    wide = denormalize(t)
    faulty = wide.union(wide.filter("SKU % 5 = 0")).withColumns({
        "SALES_UNITS": F.when(F.col("SKU") % 7 != 0, F.col("SALES_UNITS")),
        "IP_QTY_EOP_INV": F.col("IP_QTY_EOP_INV")
        + F.when(F.col("LOCATION") % 3 == 0, 1.0).otherwise(0.0),
    })
    return checks.denorm_checks(faulty, t["inventory_snapshot"])


MEASURED = ["SALES_UNITS", "RETURN_UNITS", "ADJ_QTY"]


@query
def checks_while_writing(spark, sf_dir):
    """The checks of the wide table, counted while it is written."""
    t = conformed(spark, sf_dir)
    wide, path = denormalize(t), work_dir(spark, "checked")
    rows = t["inventory_snapshot"].count()
    return checks.write_checked(wide, rows, lambda df: sinks.write_master(df, path))


@query
def reconciled_partitions(spark, sf_dir):
    """Months and stores in which a consolidated table is not what was written: rows lost in one
    store, doubled in a second, changed in a third, and a key replaced in a fourth."""
    month = F.trunc("DATE", "month").alias("MONTH")
    sold = join_facts(conformed(spark, sf_dir)).select(*facts.KEYS, *MEASURED, month)
    store, sku = F.col("LOCATION"), F.col("SKU")
    twice = sold.filter("LOCATION = 50 AND SKU % 3 = 0")
    faulty = sold.filter("NOT (LOCATION = 25 AND SKU % 3 = 0)").union(twice).withColumns({
        "RETURN_UNITS": F.col("RETURN_UNITS") + F.when((store == 75) & (sku % 5 == 0), 1).otherwise(0),
        "ADJ_QTY": F.col("ADJ_QTY") - F.when((store == 75) & (sku % 7 == 0), 1).otherwise(0),
        "SKU": F.when((store == 100) & (sku % 11 == 3), -sku).otherwise(sku),
    })
    return reconcile.reconcile(sold, faulty, ["LOCATION", "MONTH"], MEASURED)


@query
def reconciled_facts(spark, sf_dir):
    """The daily facts against those of the wide table, which agree but for one item's sales."""
    t = conformed(spark, sf_dir)
    due = reconcile.facts_of_snapshot(facts.daily_facts(t), t["inventory_snapshot"], MEASURED)
    wide = join_facts(t).withColumn(
        "SALES_UNITS", F.col("SALES_UNITS") + F.when(F.col("SKU") == 3, 1.0).otherwise(0.0)
    )
    return reconcile.reconcile(due, wide, ["SKU"], MEASURED)


# ---- validation --------------------------------------------------------------------------

@query
def validation_report(spark, sf_dir):
    return validate.validate(views.text_rows(spark, sf_dir), rules()).report


@query
def invalid_rows(spark, sf_dir):
    return validate.validate(views.text_rows(spark, sf_dir), rules()).invalid


@query
def valid_rows(spark, sf_dir):
    return validate.validate(views.text_rows(spark, sf_dir), rules()).valid


@query
def file_error_counts(spark, sf_dir):
    return validate.validate(views.text_rows(spark, sf_dir), rules()).counts


@query
def file_error_rates(spark, sf_dir):
    return quarantine.error_rates(file_error_counts(spark, sf_dir))


@query
def quarantine_routes(spark, sf_dir):
    """A day counts as incomplete where no store had a return on it."""
    counts = file_error_counts(spark, sf_dir)
    dropped = counts.select(F.col("uri").alias("path"))
    missing = routing.missing_mandatory(dropped, ("FD_RETURNS", "FD_SALES"))
    return quarantine.quarantine_routes(counts, missing)


# ---- files, days and the run log -----------------------------------------------------------

@query
def route_files(spark, sf_dir):
    return routing.route_files(views.drop_manifest(spark, sf_dir))


@query
def received_by_date(spark, sf_dir):
    return routing.received_by_date(views.drop_manifest(spark, sf_dir))


@query
def missing_mandatory(spark, sf_dir):
    return routing.missing_mandatory(views.drop_manifest(spark, sf_dir), TWO_REQUIRED)


@query
def released_files(spark, sf_dir):
    """The files of three drops, each read by one run: a run takes the new files of complete
    days, and those that waited for a day it completes. Files that still wait have no run."""
    path = work_dir(spark, "ledger")
    number = F.regexp_extract("path", "-([0-9]+)[.]", 1).cast("bigint")
    files = routing.route_files(views.drop_manifest(spark, sf_dir)).filter("class = 'all_valid'")
    drop = files.withColumns({
        "length": F.length("path").cast("bigint"),
        "modificationTime": F.timestamp_seconds(number), "part": number % 3,
    })
    for part in range(3):
        # a drop folder keeps what came before
        admission = ledger.admit(
            drop.filter(F.col("part") <= part), ledger.read_ledger(spark, path), f"run{part}",
            TWO_REQUIRED,
        )
        ledger.write_ledger(admission.ledger, path)
    return ledger.read_ledger(spark, path).select(
        "path", "table", "file_date", "first_run", "taken_run"
    )


@query
def latest_failures(spark, sf_dir):
    return calendar.latest_failures(views.earlier_log(spark, sf_dir))


@query
def fill_dates(spark, sf_dir):
    log = views.earlier_log(spark, sf_dir)
    return calendar.fill_dates(log, views.requested_days(spark, sf_dir))


@query
def plan_dates(spark, sf_dir):
    return calendar.plan_dates(
        views.earlier_log(spark, sf_dir), views.requested_days(spark, sf_dir), TODAY, HOLIDAYS
    )


@query
def files_of_days(spark, sf_dir):
    return runlog.files_of_days(
        views.drop_manifest(spark, sf_dir), views.wanted_days(spark, sf_dir)
    )


@query
def run_log_rows(spark, sf_dir):
    return runlog.run_log_rows(
        views.drop_manifest(spark, sf_dir), views.wanted_days(spark, sf_dir), TODAY, TWO_REQUIRED
    )


@query
def day_paths(spark, sf_dir):
    return runlog.day_paths(run_log_rows(spark, sf_dir))


@query
def missing_from_log(spark, sf_dir):
    return runlog.missing_from_log(
        views.earlier_log(spark, sf_dir), views.requested_days(spark, sf_dir)
    )


@query
def log_consistency(spark, sf_dir):
    """Days whose stated missing tables differ from those in the log."""
    stated = views.requested_days(spark, sf_dir).withColumn(
        "missing",
        F.when(F.col("file_date") < "20240115", "FD_SALES,FD_STORE_INV").otherwise("FD_STORE_INV"),
    )
    return runlog.differing_rows(stated, missing_from_log(spark, sf_dir))


# ---- sources and sinks ---------------------------------------------------------------------

def written_csv(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "drop")
    sinks.write_csv(views.text_rows(spark, sf_dir).drop("file"), path)
    return path


def written_tables(spark: SparkSession, sf_dir: str, *wanted: str) -> str:
    """Raw tables as the preprocessor leaves them: by store group, masters whole."""
    root = work_dir(spark, "tables")
    raw = views.raw_tables(spark, sf_dir)
    for name in wanted:
        path = tables.table_path(root, MAPPING[name].source)
        if name in tables.MASTERS:
            sinks.write_master(raw[name], path)
        else:
            sinks.write_partitioned(sinks.with_location_group(raw[name]), path)
    return root


@query
def raw_csv_scan(spark, sf_dir):
    return csv.read_raw_csv(spark, written_csv(spark, sf_dir)).drop("file")


@query
def typed_csv_scan(spark, sf_dir):
    typed = csv.read_typed_csv(spark, written_csv(spark, sf_dir), MAPPING["sales"])
    return conform.conform(typed, MAPPING, "sales")


def written_drop(spark: SparkSession, sf_dir: str) -> str:
    """The text rows as dropped CSV files, one folder per table."""
    root = work_dir(spark, "dropped")
    for source in ("FD_SALES", "FD_RETURNS"):
        rows = views.text_rows(spark, sf_dir).filter(F.col("file").contains(f"/{source}/"))
        sinks.write_csv(rows.drop("file"), f"{root}/{source}")
    return root


@query
def mixed_header_scan(spark, sf_dir):
    """Two layouts in one folder; each file is read by its own header."""
    root, rows = work_dir(spark, "mixed"), views.text_rows(spark, sf_dir).drop("file")
    sinks.write_csv(rows.filter("LOCATION <> '25'"), f"{root}/a")
    sinks.write_csv(
        rows.filter("LOCATION = '25'").select("UNITS", "LOCATION", "SKU", "TRAN_DATE"), f"{root}/b"
    )
    return csv.read_raw_csv(spark, [f"{root}/a", f"{root}/b"], mixed_headers=True).drop("file")


def sales_rules() -> tuple[str, ...]:
    return tuple(r.column for r in rules())


def files_below(spark: SparkSession, folder: str) -> DataFrame:
    files = manifest.file_manifest(spark, folder)
    return files.filter(F.col("path").endswith(".csv")).select("path")


@query
def header_verdicts(spark, sf_dir):
    """Files of three layouts in one folder: the usual one, one with another order and a column
    more, and one that lacks prices, whose files fail as a whole. Errors per layout."""
    folder = work_dir(spark, "layouts")
    sold = views.text_rows(spark, sf_dir).filter("file LIKE '%/FD_SALES/%'").drop("file")
    store = F.col("LOCATION")
    sinks.write_csv(sold.filter(~store.isin("25", "50")), folder)
    sinks.write_csv(sold.filter(store == "25").select(
        "UNITS", store.alias("NOTE"), "TOTAL_RETAIL", "LOCATION", "SKU", "TRAN_DATE"
    ), folder, "append")
    sinks.write_csv(sold.filter(store == "50").drop("TOTAL_RETAIL"), folder, "append")
    files = files_below(spark, folder)
    wanted = files.select(dropped.spelled(F.col("path")).alias("file"))
    layouts = dropped.file_layouts(
        dropped.wanted_lines(spark, folder, wanted), wanted, sales_rules()
    )
    found = validate.validate(
        dropped.dropped_rows(spark, folder, files, sales_rules()), rules()
    )
    return (
        found.counts.join(layouts, F.col("uri") == F.col("file"))
        .groupBy("header", F.get(F.array(*map(F.lit, sales_rules())), F.col("lacking"))
                 .alias("lacking"))
        .agg(F.sum("error_row_count").alias("error_row_count"),
             F.sum("original_row_count").alias("original_row_count"))
    )


@query
def malformed_lines(spark, sf_dir):
    """Lines with a field too few in one store, and with one too many in another, among whole
    ones: the invalid rows they make, with their text."""
    folder = work_dir(spark, "malformed")
    fields = [F.coalesce(c, F.lit("")) for c in
              ("SKU", "LOCATION", "TRAN_DATE", "UNITS", "TOTAL_RETAIL")]
    few, many = F.col("LOCATION") == "75", F.col("LOCATION") == "125"
    line = F.when(few, F.concat_ws(",", *fields[:4])).when(
        many, F.concat_ws(",", *fields, F.lit("more"))
    ).otherwise(F.concat_ws(",", *fields))
    lines = views.text_rows(spark, sf_dir).filter("SKU IS NOT NULL").select(
        line.alias("SKU,LOCATION,TRAN_DATE,UNITS,TOTAL_RETAIL")
    )
    # a separator that no line holds, so that lines are written as they are
    lines.write.option("header", True).option("sep", "|").option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    rows = dropped.dropped_rows(spark, folder, files_below(spark, folder), sales_rules())
    invalid = validate.validate(rows, rules()).invalid
    return invalid.filter(F.col(dropped.LINE).isNotNull()).select(
        "SKU", "LOCATION", "TRAN_DATE", "UNITS", "TOTAL_RETAIL",
        F.col(dropped.LINE).alias("line"),
    )


@query
def manifest_tables(spark, sf_dir):
    """The tables whose files lie in a written drop."""
    files = manifest.file_manifest(spark, written_drop(spark, sf_dir))
    return files.filter(F.col("path").endswith(".csv")).select(
        names.folder_name(F.col("path")).alias("table")
    ).distinct()


@query
def preprocess_passed(spark, sf_dir):
    """A drop is validated and routed, and the files that passed are preprocessed: sales are
    over the limit of errors, returns are let through."""
    root, out = written_drop(spark, sf_dir), work_dir(spark, "passed")
    path = F.col("path")
    files = manifest.file_manifest(spark, root).filter(path.endswith(".csv")).select(
        "path", names.folder_name(path).alias("table"), F.lit("20230701").alias("file_date")
    )
    missing = spark.createDataFrame([("01072023", "None")], "file_date string, missing string")
    routes = validation.validate_files(
        spark, root, files, {"FD_SALES": rules()}, missing, f"{out}/err", f"{out}/report"
    )
    preprocess.preprocess(
        spark, root, preprocess.passed_files(routes), f"{out}/tables", f"{out}/master", MAPPING
    )
    found = spark.read.parquet(f"{out}/tables/FD_RETURNS.parquet")
    if preprocess.tables_of(preprocess.passed_files(routes)) != ["FD_RETURNS"]:
        raise ValueError("a file that was held back has passed")
    return found


@query
def invalid_rows_csv(spark, sf_dir):
    path = work_dir(spark, "invalid")
    sinks.write_csv(invalid_rows(spark, sf_dir).withColumnRenamed("file", "dropped"), path)
    return csv.read_raw_csv(spark, path).drop("file")


@query
def partitioned_table(spark, sf_dir):
    """Written by store group, read back for two groups only."""
    root = written_tables(spark, sf_dir, "sales")
    return tables.read_table(spark, root, MAPPING, "sales", groups=[1.0, 3.0])


@query
def location_groups(spark, sf_dir):
    return tables.location_groups(
        spark, written_tables(spark, sf_dir, "inventory_snapshot"), MAPPING
    )


@query
def master_table(spark, sf_dir):
    return tables.read_master(spark, written_tables(spark, sf_dir, "sku"), MAPPING, "sku")


@query
def optional_sources(spark, sf_dir):
    """Only the mandatory tables and the sales were delivered; all other facts are zero."""
    root = written_tables(spark, sf_dir, "inventory_snapshot", "sku", "sales")
    return denormalize(tables.read_all(spark, root, root, MAPPING))


@query
def written_denormalized(spark, sf_dir):
    path = work_dir(spark, "wide")
    sinks.write_partitioned(sinks.with_location_group(denormalized(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query
def merge_rows(spark, sf_dir):
    """Monthly partitions; a later batch delivers only the even items from September on, and
    items not sold before."""
    path, by = work_dir(spark, "consolidated"), ("LOCATION_GROUP", "MONTH")
    sold = daily_sales(spark, sf_dir).select(*facts.KEYS, "SALES_UNITS")
    first = sold.withColumn("MONTH", F.trunc("DATE", "month"))
    merge.merge_rows(first, path, by=by)
    later = first.filter("DATE >= '2021-09-01' AND SKU % 2 = 0")
    again = later.withColumn("SALES_UNITS", F.col("SALES_UNITS") * 2)
    new = later.withColumn("SKU", -F.col("SKU") - 1)
    for _ in range(2):  # the same batch twice is the same as once
        merge.merge_rows(again.unionByName(new), path, by=by)
    return spark.read.parquet(path)


@query
def densify_batches(spark, sf_dir):
    """The snapshot in three batches, each merged into the densified table by rows."""
    path, by = work_dir(spark, "densified"), ("MONTH",)
    snapshot = one(spark, sf_dir, "inventory_snapshot").filter("DATE IS NOT NULL")
    state = snapshot.limit(0)
    for first, last in (("2021-01-01", "2021-04-10"), ("2021-04-11", "2021-09-30"),
                        ("2021-10-01", "2022-12-31")):
        batch = inventory.densify_batch(snapshot.filter(F.col("DATE").between(first, last)), state)
        month = F.trunc("DATE", "month")
        merge.merge_rows(batch.rows.withColumn("MONTH", month), path, by=by)
        state = materialize(batch.state, "state")
    return spark.read.parquet(path).drop("MONTH")


@query
def merge_partitions(spark, sf_dir):
    """Monthly partitions; a later batch replaces those from September on."""
    path, by = work_dir(spark, "consolidated"), ("LOCATION_GROUP", "MONTH")
    sold = daily_sales(spark, sf_dir).select(*facts.KEYS, "SALES_UNITS")
    first = sold.withColumn("MONTH", F.trunc("DATE", "month"))
    merge.merge_partitions(first, path, by)
    later = first.filter(F.col("DATE") >= "2021-09-01")
    merge.merge_partitions(later.withColumn("SALES_UNITS", F.col("SALES_UNITS") * 2), path, by)
    return spark.read.parquet(path)
