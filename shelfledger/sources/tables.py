"""Parquet tables behind the wide table: partitioned by store group, or whole masters."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.mapping import Mapping
from shelfledger.operators.conform import GROUP, conform

_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}

MASTERS = ("sku", "carrier_master")
GROUPED = (
    "inventory_snapshot", "inventory_adjustment", "sales", "returns", "store_transfers",
    "store_invoice", "yearly_audit", "yearly_audit_schedule",
)
MANDATORY = ("inventory_snapshot", "sku")


def table_path(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{source}.parquet"


def read_master(
    spark: SparkSession, root: str, mapping: Mapping, table: str, historical: bool = False
) -> DataFrame:
    df = spark.read.parquet(table_path(root, mapping[table].source))
    return conform(df, mapping, table, historical)


def read_table(
    spark: SparkSession,
    root: str,
    mapping: Mapping,
    table: str,
    groups: list[float] | None = None,
    historical: bool = False,
) -> DataFrame:
    """A partitioned table; ``groups`` prunes it to those store groups' folders."""
    df = spark.read.parquet(table_path(root, mapping[table].source))
    if groups is not None:
        df = df.filter(F.col(GROUP).isin(*groups))
    return conform(df, mapping, table, historical)


def empty_table(spark: SparkSession, mapping: Mapping, table: str) -> DataFrame:
    return spark.createDataFrame([], mapping[table].schema())


def read_optional(
    spark: SparkSession, root: str, mapping: Mapping, table: str, **options
) -> DataFrame:
    """The table, or an empty one with its columns where it was never delivered."""
    try:
        read = read_master if table in MASTERS else read_table
        return read(spark, root, mapping, table, **options)
    except AnalysisException as error:
        if error.getCondition() not in _ABSENT:
            raise
        return empty_table(spark, mapping, table)


def read_all(
    spark: SparkSession,
    root: str,
    master_root: str,
    mapping: Mapping,
    groups: list[float] | None = None,
    historical: bool = False,
) -> dict[str, DataFrame]:
    """Every table the wide table needs; only the snapshot and the SKU master must exist."""
    tables = {
        name: read_optional(
            spark, root, mapping, name, groups=groups, historical=historical
        )
        for name in GROUPED if name not in MANDATORY
    }
    tables["inventory_snapshot"] = read_table(
        spark, root, mapping, "inventory_snapshot", groups, historical
    )
    tables["sku"] = read_master(spark, master_root, mapping, "sku")
    return tables


def location_groups(spark: SparkSession, root: str, mapping: Mapping) -> DataFrame:
    """Store groups present in the partitioned snapshot; no column is read."""
    path = table_path(root, mapping["inventory_snapshot"].source)
    return spark.read.parquet(path).select(GROUP).distinct()
