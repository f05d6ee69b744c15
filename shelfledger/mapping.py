"""Logical tables: which raw column feeds which conformed column, and with which type."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfledger.fixed_values import TABLES

_SPARK_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "string": T.StringType(),
}


@dataclass(frozen=True)
class MappedColumn:
    key: str
    raw: str | None
    name: str
    type: str
    output: str

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.type]


@dataclass(frozen=True)
class LogicalTable:
    name: str
    source: str | None
    columns: tuple[MappedColumn, ...]

    def schema(self) -> T.StructType:
        """Conformed schema of the columns that come from the raw table."""
        return T.StructType([T.StructField(c.name, c.spark_type) for c in self.columns if c.raw])

    def raw_types(self) -> dict[str, str]:
        return {c.raw: c.type for c in self.columns if c.raw}


@dataclass(frozen=True)
class Mapping:
    tables: dict[str, LogicalTable]

    def __getitem__(self, table: str) -> LogicalTable:
        return self.tables[table]

    def by_source(self, source: str) -> LogicalTable | None:
        return next((t for t in self.tables.values() if t.source == source), None)

    def rename_output(self, df: DataFrame) -> DataFrame:
        """Give a finished table the column names that a custom mapping asks for."""
        renames = {
            c.name: c.output
            for t in self.tables.values()
            for c in t.columns
            if c.output != c.name and c.name in df.columns
        }
        return df.withColumnsRenamed(renames)


def default_mapping() -> Mapping:
    return Mapping({
        table: LogicalTable(table, source, tuple(
            MappedColumn(key, raw, name, kind, name) for key, raw, name, kind in columns
        ))
        for table, (source, columns) in TABLES.items()
    })


def read_json(spark: SparkSession, path: str) -> dict:
    """One small JSON configuration file from any file system Spark can reach."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def load_mapping(spark: SparkSession, path: str) -> Mapping:
    """Mapping file: logical table -> source_table_name and columns {key: {src, dest}}.

    Operators work on the standard conformed names; a file with other ``dest`` names takes
    effect at the end, in ``Mapping.rename_output``.
    """
    given = read_json(spark, path)
    tables = {}
    for table in default_mapping().tables.values():
        entry = given.get(table.name, {})
        columns = entry.get("columns", {})
        tables[table.name] = LogicalTable(
            table.name,
            entry.get("source_table_name") or table.source,
            tuple(
                replace(
                    c,
                    raw=columns[c.key].get("src") if c.key in columns else c.raw,
                    output=(columns.get(c.key, {}).get("dest") or "").strip() or c.name,
                )
                for c in table.columns
            ),
        )
    return Mapping(tables)
