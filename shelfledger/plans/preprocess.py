"""Accepted files -> parquet tables by store group, and whole master tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.fixed_values import MASTER_TABLES
from shelfledger.mapping import LogicalTable, Mapping
from shelfledger.operators.quarantine import PASS
from shelfledger.sources.csv import typed
from shelfledger.sources.dropped import FILE, LACKING, LINE, dropped_rows
from shelfledger.sources.sinks import with_location_group, write_master, write_partitioned
from shelfledger.sources.tables import table_path


def tables_of(files: DataFrame) -> list[str]:
    """The tables that occur in a list of files: as many as there are table names."""
    return sorted(r["table"] for r in files.select("table").distinct().collect())


def rows_of_files(
    spark: SparkSession, root: str, table: str, files: DataFrame, required: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of those files (path, table) that lie in the table's folder."""
    return dropped_rows(
        spark, f"{root.rstrip('/')}/{table}", files.filter(F.col("table") == table), required
    )


def passed_files(routes: DataFrame) -> DataFrame:
    """(path, table) of the files that validation let through."""
    return routes.filter(F.col("route") == PASS).select(F.col("uri").alias("path"), "table")


def preprocess(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    output: str,
    master_output: str,
    mapping: Mapping,
) -> None:
    """One job per table over all its files; each table is replaced as a whole.

    A malformed line keeps the fields that can be told, as all rows of a file that passed.
    """
    for source in tables_of(files):
        table = mapping.by_source(source) or LogicalTable(source, source, ())
        rows = rows_of_files(spark, root, source, files).drop(FILE, LINE, LACKING)
        df = typed(rows, table)
        if source in MASTER_TABLES:
            write_master(df, table_path(master_output, source))
        else:
            write_partitioned(
                with_location_group(df), table_path(output, source), replace_all=True
            )
