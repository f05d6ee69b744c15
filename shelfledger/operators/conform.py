"""Raw table -> conformed table: one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.functions.casts import lenient_cast
from shelfledger.functions.dates import (
    DAY_MONTH_NAME, ISO, is_date_name, parse_date, parse_historical_date,
)
from shelfledger.mapping import Mapping, MappedColumn

GROUP = "LOCATION_GROUP"


def _conformed(
    column: MappedColumn, data_type: T.DataType, table: str, historical: bool
) -> Column:
    raw = F.col(f"`{column.raw}`")
    if is_date_name(column.name):
        if historical and table == "yearly_audit_schedule":
            return parse_date(raw, data_type, DAY_MONTH_NAME)
        if historical:
            return parse_historical_date(raw, data_type)
        return parse_date(raw, data_type, ISO)
    if isinstance(data_type, T.StringType) and column.type in ("int", "double"):
        return lenient_cast(raw, column.type)
    return raw


def conform(
    df: DataFrame, mapping: Mapping, table: str, historical: bool = False
) -> DataFrame:
    """Keep the mapped raw columns that are present, rename them and parse dates.

    The store group of a partitioned table is carried along, so that one job can serve all
    groups. A date that fits no format becomes NULL.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        _conformed(c, types[c.raw], table, historical).alias(c.name)
        for c in mapping[table].columns
        if c.raw in types
    ]
    if GROUP in types:
        columns.append(F.col(GROUP))
    return df.select(columns)


def select_conformed(df: DataFrame, mapping: Mapping, table: str) -> DataFrame:
    """Conformed columns that are present, in mapping order, plus the store group."""
    wanted = [c.name for c in mapping[table].columns] + [GROUP]
    return df.select([n for n in wanted if n in df.columns])
