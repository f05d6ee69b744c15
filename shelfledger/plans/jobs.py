"""Command line of the stages: ``python -m shelfledger.plans.jobs <stage> ...``."""

from __future__ import annotations

import argparse
import ast

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.fixed_values import (
    ERROR_THRESHOLD_PERCENT, HOLIDAYS, PERMITTED_EXTENSIONS, REQUIRED_TABLES,
)
from shelfledger.functions.dates import day_text, file_day, named_day
from shelfledger.mapping import Mapping, default_mapping, load_mapping
from shelfledger.operators.audit import audit_actuals
from shelfledger.operators.calendar import plan_dates, run_day
from shelfledger.operators.carriers import carrier_arrivals
from shelfledger.operators.checks import denorm_checks, require_clean, write_checked
from shelfledger.operators.conform import GROUP
from shelfledger.operators.inventory import densify_inventory
from shelfledger.operators.ledger import admit, read_ledger, write_ledger
from shelfledger.operators.merge import merge_denorm
from shelfledger.operators.routing import missing_mandatory, route_files
from shelfledger.operators.runlog import missing_from_log, require_same, run_log_rows
from shelfledger.operators.validate import read_rules
from shelfledger.plans.denormalize import denormalize
from shelfledger.plans.preprocess import passed_files, preprocess
from shelfledger.plans.validation import validate_files
from shelfledger.session import build_session
from shelfledger.sources.manifest import file_manifest
from shelfledger.sources.sinks import with_location_group, write_csv, write_partitioned
from shelfledger.sources.tables import read_all, read_optional, read_table
from shelfledger.sources.workspace import materialize


def _mapping(spark: SparkSession, path: str | None) -> Mapping:
    return load_mapping(spark, path) if path else default_mapping()


def _listed(text: str | None, default: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(t for t in text.split(",") if t) if text is not None else default


def _missing(spark: SparkSession, literal: str) -> DataFrame:
    """The {date: "None" or "TABLE,TABLE"} literal of the scheduler, one row per day."""
    days = [(str(k), str(v)) for k, v in ast.literal_eval(literal).items()]
    return spark.createDataFrame(days, "file_date string, missing string")


def _table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Writes the accepted files (output/routes), the others (error/routes), what each day
    misses (output/missing) and the run log.

    The days are those stated, else those that files came for. A stated calendar must agree
    with the earlier log, where there is one, on the days both name.

    With ``--ledger_path`` only files that no earlier run took are accepted, and those of a day
    that lacks a required table wait until a later run completes it. The ledger is written last:
    a run that fails before is as if it had not been.
    """
    required = _listed(args.required_tables, REQUIRED_TABLES)
    extensions = _listed(args.extensions, PERMITTED_EXTENSIONS)
    holidays = _listed(args.holidays, HOLIDAYS)
    run_date = args.run_date or run_day()
    run_id = args.run_id or run_date
    manifest = file_manifest(spark, args.input_path)
    routes = materialize(route_files(manifest, extensions=extensions), "routes")
    accepted = routes.filter("class = 'all_valid'")
    admission = None
    if args.ledger_path:
        drop = accepted.join(manifest, "path")
        admission = admit(drop, read_ledger(spark, args.ledger_path), run_id, required)
        came = materialize(admission.missing, "missing")
        accepted = accepted.withColumn("day", day_text(F.col("file_date"))).join(
            admission.taken.select("path", F.col("file_date").alias("day")), ["path", "day"],
            "left_semi",
        ).drop("day")
    else:
        came = materialize(missing_mandatory(accepted.select("path"), required), "missing")
    write_csv(accepted, f"{args.output_path}/routes")
    write_csv(routes.filter("class <> 'all_valid'"), f"{args.error_path}/routes")
    stated = _missing(spark, args.date_missing_files) if args.date_missing_files else None
    write_csv(came if stated is None else _with_stated(came, stated), f"{args.output_path}/missing")
    days = (came if stated is None else stated).select("file_date")
    if args.earlier_log:
        log = _table(spark, args.earlier_log)
        if stated is not None and args.check_log:
            require_same(
                stated.select("file_date", F.when(F.col("missing") != "None", F.col("missing"))
                              .otherwise("").alias("missing")),
                missing_from_log(log, stated),
            )
        days = plan_dates(log, days, run_date, holidays)
    # one folder per run, so a run that is repeated replaces its own rows
    write_csv(
        run_log_rows(manifest, days, run_date, required=required, extensions=extensions),
        f"{args.log_path}/run={run_id}",
    )
    if admission is not None:
        write_ledger(admission.ledger, args.ledger_path)


def _with_stated(came: DataFrame, stated: DataFrame) -> DataFrame:
    """What days miss, as stated where that is, else as the files show."""
    said = stated.withColumn("file_date", day_text(F.col("file_date")))
    return said.unionByName(came.join(said.select("file_date"), "file_date", "left_anti"))


def run_validation(spark: SparkSession, args: argparse.Namespace) -> None:
    missing = (
        _missing(spark, args.date_missing_files) if args.date_missing_files
        else _table(spark, args.missing_path)
    )
    routes = validate_files(
        spark,
        args.input_path,
        _table(spark, args.routes_path),
        read_rules(spark, args.json_path),
        missing,
        args.error_path,
        args.report_path,
        float(args.threshold) if args.threshold else ERROR_THRESHOLD_PERCENT,
    )
    write_csv(routes, f"{args.error_path.rstrip('/')}/routes")


def run_preprocess(spark: SparkSession, args: argparse.Namespace) -> None:
    """Takes the files that validation let through; ``--dates`` limits them to those days."""
    routes = _table(spark, args.routes_path)
    if args.dates:
        days = spark.createDataFrame([(d,) for d in args.dates.split(",")], "day string")
        wanted = days.select(file_day(F.col("day")).alias("day"))
        routes = routes.withColumn("day", named_day(F.col("file_date"))).join(
            wanted, "day", "left_semi"
        )
    preprocess(
        spark, args.input_path, passed_files(routes), args.output_path,
        args.master_output_path, _mapping(spark, args.mapping_path),
    )


def run_denormalize(spark: SparkSession, args: argparse.Namespace) -> None:
    mapping = _mapping(spark, args.mapping_path)
    groups = [float(g) for g in args.location_groups.split(",")] if args.location_groups else None
    historical = args.historical_mode == "Y"
    tables = read_all(spark, args.src_path, args.master_src_path, mapping, groups, historical)
    arrivals = actuals = None
    if args.with_arrivals == "Y":
        master = read_optional(spark, args.master_src_path, mapping, "carrier_master")
        arrivals = carrier_arrivals(master)
    if args.with_audits == "Y":
        actuals = audit_actuals(tables["yearly_audit"], tables["yearly_audit_schedule"])
    wide = denormalize(tables, historical, arrivals, actuals)
    if GROUP not in wide.columns:
        wide = with_location_group(wide)

    def write(df: DataFrame) -> None:
        write_partitioned(mapping.rename_output(df), args.dest_path, replace_all=groups is None)

    if not args.counts_path:
        write(wide)
        return
    base = tables["inventory_snapshot"]
    rows = (densify_inventory(base) if historical else base).count()
    write_csv(write_checked(wide, rows, write), args.counts_path)


def run_check(spark: SparkSession, args: argparse.Namespace) -> None:
    """All checks over the finished table; with ``--counts_path`` those that were counted while it
    was written, without reading it."""
    if args.counts_path:
        require_clean(_table(spark, args.counts_path).withColumn(
            "failures", F.col("failures").cast("bigint")))
        return
    mapping = _mapping(spark, args.mapping_path)
    groups = [float(g) for g in args.location_groups.split(",")] if args.location_groups else None
    historical = args.historical_mode == "Y"
    wide = spark.read.parquet(args.source_path)
    snapshot = read_table(spark, args.src_path, mapping, "inventory_snapshot", groups, historical)
    require_clean(denorm_checks(wide, densify_inventory(snapshot) if historical else snapshot))


def run_merge(spark: SparkSession, args: argparse.Namespace) -> None:
    groups = args.location_group_list
    merge_denorm(
        spark, args.source_path, args.dest_path,
        [float(g) for g in groups.split(",")] if groups else None, args.by_rows == "Y",
    )


# Stages with the arguments they take; "?" marks optional ones.
STAGES = {
    "ingest": (
        ingest,
        ["date_missing_files?", "input_path", "error_path", "output_path", "log_path",
         "run_date?", "run_id?", "earlier_log?", "check_log?", "required_tables?", "extensions?",
         "holidays?", "ledger_path?"],
    ),
    "validate": (
        run_validation,
        ["date_missing_files?", "missing_path?", "input_path", "routes_path", "error_path",
         "report_path", "json_path", "threshold?"],
    ),
    "preprocess": (
        run_preprocess,
        ["input_path", "routes_path", "output_path", "master_output_path", "mapping_path?",
         "dates?"],
    ),
    "denormalize": (
        run_denormalize,
        ["location_groups?", "mapping_path?", "src_path", "master_src_path", "dest_path",
         "historical_mode", "with_arrivals?", "with_audits?", "counts_path?"],
    ),
    "check": (
        run_check,
        ["source_path", "src_path", "historical_mode", "mapping_path?", "location_groups?",
         "counts_path?"],
    ),
    "merge": (run_merge, ["source_path", "dest_path", "location_group_list?", "by_rows?"]),
}
#: What a stage does beyond its name, for the command line's help.
HELP = {
    "merge": "replace whole (store group, day) partitions by those of the batch, so that a partial "
    "delivery of a day replaces the whole day; with --by_rows Y only rows of the same item, store "
    "and day are replaced",
    "ingest": "route the dropped files; with --ledger_path take each file once, and only when its "
    "day is complete",
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="shelfledger")
    stages = parser.add_subparsers(dest="stage", required=True)
    for stage, (_, names) in STAGES.items():
        sub = stages.add_parser(stage, help=HELP.get(stage))
        sub.add_argument("--shuffled_bytes", type=int, default=None)
        for name in names:
            sub.add_argument(f"--{name.rstrip('?')}", required=not name.endswith("?"))
    args = parser.parse_args(argv)
    STAGES[args.stage][0](build_session(f"shelfledger {args.stage}", args.shuffled_bytes), args)


if __name__ == "__main__":
    main()
