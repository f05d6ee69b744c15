"""Which dropped files are acceptable, and which required tables a day lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.fixed_values import (
    PERMITTED_EXTENSIONS, README_NAME, REQUIRED_TABLES, SPECIAL_TABLES,
)
from shelfledger.functions.dates import day_text
from shelfledger.functions.names import extension, file_name, stem

ALL_TABLES = (*REQUIRED_TABLES, *SPECIAL_TABLES)

# Classes of dropped files.
ALL_VALID = "all_valid"
EXTENSION_ERROR = "extension_error"
FILE_NAME_ERROR = "file_name_error"


def tables_named_in(name: Column, tables: tuple[str, ...]) -> Column:
    """The given tables whose name occurs in a file name, in the given order."""
    return F.array_compact(F.array(*[F.when(name.contains(t), t) for t in tables]))


def listed_files(manifest: DataFrame) -> DataFrame:
    """Manifest with ``name``, without folder markers and the readme."""
    name = file_name(F.col("path"))
    return manifest.withColumn("name", name).filter(
        (F.col("name") != "") & ~F.col("path").contains(README_NAME)
    )


def route_files(
    manifest: DataFrame,
    tables: tuple[str, ...] = ALL_TABLES,
    extensions: tuple[str, ...] = PERMITTED_EXTENSIONS,
) -> DataFrame:
    """Class and destination of each file, once per table its name contains.

    A good name is TABLE-<8 digits>-<digits>; a file that contains no table's name is a
    file-name error of its own.
    """
    name = F.col("name")
    named = listed_files(manifest).select(
        "path", name, F.explode_outer(tables_named_in(name, tables)).alias("table")
    )
    rest = F.expr("substring(substring_index(name, '.', 1), length(table) + 1)")
    good_name = F.coalesce(
        stem(name).startswith(F.col("table")) & rest.rlike("^-[0-9]{8}-[0-9]+$"), F.lit(False)
    )
    good_extension = extension(name).isin(*extensions)
    verdict = (
        F.when(good_name & good_extension, ALL_VALID)
        .when(good_name, EXTENSION_ERROR)
        .otherwise(FILE_NAME_ERROR)
    )
    judged = named.withColumn("class", verdict).withColumns({
        "file_date": F.when(good_name, F.split(stem(name), "-")[1]).otherwise(""),
        "table": F.when(good_name, F.col("table")).otherwise(""),
    })
    return judged.withColumn(
        "destination",
        F.when(F.col("class") == ALL_VALID, F.concat_ws("/", "table", "name"))
        .when(
            F.col("class") == EXTENSION_ERROR,
            F.concat_ws("/", F.lit(EXTENSION_ERROR), "table", "name"),
        )
        .otherwise(F.concat_ws("/", F.lit(FILE_NAME_ERROR), "name")),
    )


def received_files(manifest: DataFrame) -> DataFrame:
    """Table and day of each file: the parts of its name between "-" and ".".

    A day is given as yyyyMMdd, however the name spells it; a text that is none stays.
    """
    parts = F.split(F.col("name"), "[-.]")
    return (
        listed_files(manifest)
        .filter(F.size(parts) > 1)
        .select(parts[0].alias("table"), day_text(parts[1]).alias("file_date"), "path")
    )


def received_by_date(manifest: DataFrame) -> DataFrame:
    return received_files(manifest).select("file_date", "table").distinct()


def missing_mandatory(
    manifest: DataFrame, required: tuple[str, ...] = REQUIRED_TABLES
) -> DataFrame:
    """Per date seen: "None", or the required tables that did not come, comma-separated.

    One yes/no per required table is aggregated, never a list of files.
    """
    wanted = sorted(required)
    table = F.col("table")
    came = [F.max(table == t).alias(f"came_{i}") for i, t in enumerate(wanted)]
    dates = received_files(manifest).groupBy("file_date").agg(F.count(F.lit(1)).alias("n"), *came)
    absent = F.concat_ws(
        ",", *[F.when(~F.col(f"came_{i}"), t) for i, t in enumerate(wanted)]
    )
    return dates.select(
        "file_date", F.when(absent == "", "None").otherwise(absent).alias("missing")
    )
