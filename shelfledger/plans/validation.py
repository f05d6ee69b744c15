"""Validate accepted files, write what failed, and route whole files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.fixed_values import ERROR_THRESHOLD_PERCENT, VALIDATED_TABLES
from shelfledger.operators.quarantine import PASS, quarantine_routes
from shelfledger.operators.validate import ColumnRule, file_error_counts, validate
from shelfledger.plans.preprocess import rows_of_files, tables_of
from shelfledger.sources.dropped import FILE, spelled
from shelfledger.sources.sinks import write_csv


def rowless_counts(files: DataFrame, table: str, counts: DataFrame) -> DataFrame:
    """Zero counts for files that hold no row and so do not occur in ``counts``."""
    listed = files.filter(F.col("table") == table).select(
        spelled(F.col("path")).alias(FILE)
    ).distinct()
    rowless = listed.join(counts.select(F.col("uri").alias(FILE)), FILE, "left_anti")
    zero = F.lit(0).cast("bigint")
    return file_error_counts(
        rowless.withColumns({"rows": zero, "bad": zero, "failed": F.lit(None).cast("int")})
    )


def validate_files(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    rules: dict[str, list[ColumnRule]],
    missing: DataFrame,
    error_path: str,
    report_path: str,
    threshold: float = ERROR_THRESHOLD_PERCENT,
) -> DataFrame:
    """Writes invalid rows and report per table and the error counts; returns the routes.

    ``files`` are the accepted ones (path, table, file_date). One scan for the statistics and
    one for the rows per table, whatever the number of files and rules. Files of tables without
    rules are let through.
    """
    counts, judged = [], []
    for table in tables_of(files):
        if table not in VALIDATED_TABLES or not rules.get(table):
            continue
        judged.append(table)
        required = tuple(r.column for r in rules[table])
        result = validate(rows_of_files(spark, root, table, files, required), rules[table])
        write_csv(result.invalid, f"{error_path.rstrip('/')}/invalid_rows/{table}")
        write_csv(result.report, f"{report_path.rstrip('/')}/{table}")
        counts.append(result.counts)
        counts.append(rowless_counts(files, table, result.counts))
    others = files.filter(~F.col("table").isin(judged)).select(
        spelled(F.col("path")).alias("uri"), "file_date", "table", F.lit(PASS).alias("route")
    )
    if not counts:
        return others
    analysis = f"{error_path.rstrip('/')}/analysis"
    write_csv(reduce(DataFrame.unionByName, counts), analysis)
    written = spark.read.option("header", True).csv(
        analysis,
        schema="file_date string, uri string, table string,"
        " error_row_count bigint, original_row_count bigint",
    )
    return quarantine_routes(written, missing, threshold).unionByName(others)
