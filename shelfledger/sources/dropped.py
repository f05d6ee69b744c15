"""Rows of dropped files, each read by its own header, without opening any other file.

A drop folder grows for years while a run needs a few days of it. The names of dropped files
hold their table and day, so the scan is filtered by the names' stems that the wanted files
have; Spark applies a filter on ``_metadata`` while it lists files, and the rest is never
opened. What is left is joined by path, so the result does not hang on how files are named.
"""

from __future__ import annotations

from csv import reader as csv_lines

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.functions.names import file_name
from shelfledger.operators.joins import skew_safe_left_join
from shelfledger.sources.csv import DROPPED, first_lines, parsed_once
from shelfledger.sources.manifest import file_manifest
from shelfledger.sources.workspace import materialize

FILE = "file"
#: Raw text of a line that could not be read whole; NULL for all others.
LINE = "_line"
#: Place, in the list of required columns, of the first one that the row's file lacks.
LACKING = "_lacking"
_CORRUPT = "_corrupt"


def spelled(path: Column) -> Column:
    """A path as Spark spells those of scanned rows: local ones may start file:/ or file:///."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def name_stem(name: Column) -> Column:
    """TABLE-<8 digits> of TABLE-<8 digits>-<digits>.<extension>; empty for other names."""
    return F.regexp_extract(name, "^(.*-[0-9]{8})-[0-9]+[.]", 1)


def _present(spark: SparkSession, folder: str, wanted: DataFrame) -> None:
    """Stops on files that do not lie in the folder, rather than give no rows for them."""
    lost = wanted.join(
        file_manifest(spark, folder).select(spelled(F.col("path")).alias(FILE)), FILE, "left_anti"
    ).limit(3).collect()
    if lost:
        raise ValueError(f"not in {folder}: {', '.join(r[FILE] for r in lost)}")


def wanted_lines(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(file, start, value): the lines of a folder's files, of as few unwanted files as their
    names can tell. The driver gets one stem per table and day, not the files."""
    stems = [r[0] for r in wanted.select(name_stem(file_name(F.col(FILE)))).distinct().collect()]
    name = F.col("_metadata.file_name")
    return (
        spark.read.option("pathGlobFilter", DROPPED).text(folder)
        .filter(name_stem(name).isin(*stems))
        .select(
            spelled(F.col("_metadata.file_path")).alias(FILE),
            F.col("_metadata.file_block_start").alias("start"), "value",
        )
    )


def column_names(header: str) -> tuple[str, ...]:
    """Column names of a header line; a name's later copies and missing names get their place."""
    names: list[str] = []
    for i, name in enumerate(next(csv_lines([header.lstrip("﻿")]), [])):
        names.append(f"{name}_{i}" if name in names or not name else name)
    return tuple(names)


def _first_lacking(names: tuple[str, ...], required: tuple[str, ...]) -> int | None:
    return next((i for i, c in enumerate(required) if c not in names), None)


def file_layouts(lines: DataFrame, wanted: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """(file, header, lacking): the first line of each wanted file, and the place of the first
    required column it lacks, NULL if it has all.

    The driver gets the distinct headers that hold the names of all required columns; a file of
    another kind, without a header even, is judged where it lies.
    """
    headers = materialize(first_lines(lines).join(wanted, FILE, "left_semi"), "headers")
    header = F.col("header")
    absent = F.coalesce(*(
        F.when(~header.contains(c), F.lit(i)) for i, c in enumerate(required)
    ), F.lit(None).cast("int"))
    whole = [
        r.header for r in headers.filter(absent.isNull()).select("header").distinct().collect()
    ]
    # a name may be a part of another column's
    false = {h: i for h in whole if (i := _first_lacking(column_names(h), required)) is not None}
    judged = absent
    for text, place in false.items():
        judged = F.when(header == text, F.lit(place)).otherwise(judged)
    return headers.withColumn("lacking", judged.cast("int"))


def dropped_rows(
    spark: SparkSession, folder: str, files: DataFrame, required: tuple[str, ...] = ()
) -> DataFrame:
    """Rows of those ``files(path)`` that lie in the folder, as text columns with ``file``.

    Each file is read by its own header; a column it lacks is NULL. A line with too few or too
    many fields keeps the fields that can be told, and its text in LINE. A file that lacks a
    required column is not parsed: its rows have their text in LINE and the column's place in
    LACKING. A line that equals its file's header is one. Files that are listed but not there
    stop the job.
    """
    wanted = materialize(files.select(spelled(F.col("path")).alias(FILE)).distinct(), "wanted")
    _present(spark, folder, wanted)
    lines = wanted_lines(spark, folder, wanted)
    layouts = materialize(file_layouts(lines, wanted, required), "layouts")
    fit = sorted(r.header for r in layouts.filter("lacking IS NULL").select("header")
                 .distinct().collect())
    columns = list(dict.fromkeys([*(c for h in fit for c in column_names(h)), *required]))
    found = skew_safe_left_join(lines.select(FILE, "value"), layouts, [FILE]).filter(
        "header IS NOT NULL AND value <> header AND value <> ''"
    )
    parsed = F.lit(None)
    for header in fit:
        parsed = F.when(
            F.col("header") == header, parsed_once(column_names(header), columns, _CORRUPT)
        ).otherwise(parsed)
    if not fit:
        parsed = F.array(F.struct(*(
            F.lit(None).cast("string").alias(c) for c in (*columns, _CORRUPT)
        )))
    unread = F.when(F.col("lacking").isNotNull(), F.col("value"))
    return found.select(
        F.explode_outer(parsed).alias("row"), unread.alias("unread"), "lacking", FILE
    ).select(
        *(F.col("row").getField(c).alias(c) for c in columns), FILE,
        F.coalesce(F.col("row").getField(_CORRUPT), F.col("unread")).alias(LINE),
        F.col("lacking").alias(LACKING),
    )
