"""Writers.

Rows are rebalanced on the partition columns first: adaptive execution then merges small
partitions into full files and cuts a hot one into several, so one store group or day with
most of the rows is written by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.functions.measures import location_group
from shelfledger.operators.conform import GROUP

GZIP = "gzip"


def with_location_group(df: DataFrame) -> DataFrame:
    return df.withColumn(GROUP, location_group(F.col("LOCATION")))


def write_partitioned(
    df: DataFrame,
    path: str,
    by: tuple[str, ...] = (GROUP,),
    compression: str = GZIP,
    replace_all: bool = False,
) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay, unless the whole
    table is replaced."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .option("compression", compression)
        .partitionBy(*by)
        .parquet(path)
    )


def write_master(df: DataFrame, path: str, compression: str = GZIP) -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header and blanks kept; a small result comes out as one file, a large one as
    many."""
    (
        df.hint("rebalance")
        .write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
