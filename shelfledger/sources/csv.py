"""Dropped CSV files (plain or gzip) as rows of text, or typed by the mapping."""

from __future__ import annotations

from csv import reader as csv_lines

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.fixed_values import PERMITTED_EXTENSIONS
from shelfledger.functions.casts import lenient_cast
from shelfledger.mapping import LogicalTable
from shelfledger.operators.joins import skew_safe_left_join
from shelfledger.sources.workspace import materialize

#: Glob of the dropped files that are tables.
DROPPED = "*.{" + ",".join(PERMITTED_EXTENSIONS) + "}"


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of the first table file at a path; reads its first line only."""
    return tuple(
        spark.read.option("header", True).option("pathGlobFilter", DROPPED).csv(path).columns
    )


def _names(header: str) -> tuple[str, ...]:
    return tuple(next(csv_lines([header.lstrip("\ufeff")])))


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("pathGlobFilter", DROPPED).text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )


def first_lines(lines: DataFrame) -> DataFrame:
    """(file, header): the first line of each file of ``lines(file, start, value)``.

    A file's first block lies in one task in file order, so its first line is the header. Texts
    are held in a hash table, one per file, only where an aggregate has objects in its buffers;
    else Spark sorts all lines of a task by file first. The list of nothing is such an aggregate.
    """
    nothing = F.collect_list(F.lit(None).cast("int"))
    return (
        lines.filter("start = 0").withColumn("at", F.monotonically_increasing_id())
        .groupBy("file").agg(F.min_by("value", "at").alias("header"), nothing.alias("nothing"))
        .filter(F.size("nothing") == 0).select("file", "header")
    )


def file_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, header): the first line of each file."""
    return first_lines(_lines(spark, paths))


def parsed_once(names: tuple[str, ...], columns: list[str], corrupt: str | None = None) -> Column:
    """An array of one struct: the text ``columns`` of a line with the fields ``names``, and if
    ``corrupt`` is named the text of a line with too few or too many.

    Each field that is taken from ``from_csv`` parses the line again, and so does each use of it
    in a filter that Spark moves to the parse. The fields of an array's element do not, and no
    filter is moved below the explosion of one.
    """
    read = (*names, corrupt) if corrupt else names
    row = F.from_csv(
        "value", ", ".join(f"`{c}` STRING" for c in read),
        {"columnNameOfCorruptRecord": corrupt} if corrupt else {},
    )
    wanted = [*columns, corrupt] if corrupt else columns
    return F.transform(F.array(row), lambda r: F.struct(*(
        (r[c] if c in read else F.lit(None).cast("string")).alias(c) for c in wanted
    )))


def read_mixed_csv(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Files with any headers as one table; a column that a file lacks is NULL.

    The driver gets the distinct headers, never the files. Lines are scanned once and parsed by
    the header of their file, which is joined to them; a line that equals its file's header is
    one.
    """
    headers = materialize(file_headers(spark, paths), "headers")
    layouts = sorted(r.header for r in headers.select("header").distinct().collect())
    columns = sorted({c for h in layouts for c in _names(h)}, key=_first_seen(layouts))
    lines = skew_safe_left_join(_lines(spark, paths), headers, ["file"]).filter(
        "value <> header AND value <> ''"
    )
    parsed = F.lit(None)
    for header in layouts:
        parsed = F.when(
            F.col("header") == header, parsed_once(_names(header), columns)
        ).otherwise(parsed)
    return lines.select(F.explode_outer(parsed).alias("row"), "file").select("row.*", "file")


def _first_seen(layouts: list[str]):
    order: dict[str, int] = {}
    for header in layouts:
        for name in _names(header):
            order.setdefault(name, len(order))
    return order.__getitem__


def _scan(spark: SparkSession, paths: list[str], columns: tuple[str, ...]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", DROPPED)
        .csv(paths)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )


def read_raw_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    mixed_headers: bool = False,
) -> DataFrame:
    """All files of a table in one scan: text columns, and the path of each row in ``file``.

    A path may be a folder; files of other extensions in it are left out. Every file's header
    is compared with ``columns`` (default: the first file's header) while it is read, and a
    different one stops the job, since columns would get mixed up. With ``mixed_headers`` the
    headers are looked at beforehand.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if mixed_headers:
        return read_mixed_csv(spark, paths)
    return _scan(spark, paths, tuple(columns or header_of(spark, paths[0])))


def read_typed_csv(
    spark: SparkSession, paths: str | list[str], table: LogicalTable, **options
) -> DataFrame:
    """Raw files with numbers cast as the mapping says; dates stay text until conformed."""
    return typed(read_raw_csv(spark, paths, **options).drop("file"), table)


def typed(raw: DataFrame, table: LogicalTable) -> DataFrame:
    types = table.raw_types()
    return raw.select([
        lenient_cast(F.col(f"`{c}`"), types[c]).alias(c)
        if types.get(c) in ("int", "double") else F.col(f"`{c}`")
        for c in raw.columns
    ])
