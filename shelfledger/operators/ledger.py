"""A ledger of dropped files: what each run took, and what waits for its day to be complete.

The ledger is a table with one row per version of a file, partitioned by day. A run looks at the
days its drop has files of, and only rewrites these. Files of a day that lacks a required table
are held; the run whose files complete the day takes them too, so a late file releases its day
without reading anything twice.

A run names itself. What it wrote earlier counts as not yet known when it runs again, so a run
that failed later on can be repeated, and takes the same files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.functions.dates import day_text
from shelfledger.functions.names import file_name
from shelfledger.operators.joins import skew_safe_left_join
from shelfledger.sources.sinks import write_partitioned
from shelfledger.sources.workspace import materialize

VERSION = ["path", "length", "modificationTime"]
COLUMNS = [*VERSION, "table", "first_run", "taken_run", "file_date"]
SCHEMA = (
    "path string, length bigint, modificationTime timestamp, `table` string,"
    " first_run string, taken_run string, file_date string"
)


@dataclass(frozen=True)
class Admission:
    """``taken`` files (COLUMNS) of this run, ``missing`` tables per day (file_date, missing) as
    known by now, and the ``ledger`` rows of those days as they become."""

    taken: DataFrame
    missing: DataFrame
    ledger: DataFrame


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, or an empty one where there is none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path).select(*COLUMNS)


def write_ledger(rows: DataFrame, path: str) -> None:
    """Replaces the days that occur in ``rows``; all others stay."""
    write_partitioned(rows.select(*COLUMNS), path, ("file_date",))


def before_run(ledger: DataFrame, run: str) -> DataFrame:
    """The ledger without what the run of this name put there."""
    return ledger.filter(F.col("first_run") != run).withColumn(
        "taken_run", F.when(F.col("taken_run") != run, F.col("taken_run"))
    )


def tables_missing(files: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """(file_date, missing): "None", or the required tables of which no file is listed."""
    wanted = sorted(required)
    came = [F.max(F.col("table") == t).alias(f"came_{i}") for i, t in enumerate(wanted)]
    days = files.groupBy("file_date").agg(F.count(F.lit(1)).alias("files"), *came)
    absent = F.concat_ws(",", *[
        F.when(~F.coalesce(F.col(f"came_{i}"), F.lit(False)), t) for i, t in enumerate(wanted)
    ])
    return days.select(
        "file_date", F.when(absent == "", "None").otherwise(absent).alias("missing")
    )


def admit(
    drop: DataFrame, ledger: DataFrame, run: str, required: tuple[str, ...]
) -> Admission:
    """Which files a run takes, given the accepted ones of its drop: path, length,
    modificationTime, table and file_date in either spelling.

    A file that the ledger has with the same length and time is not taken again; with another
    it is a new version, which replaces the old one. Days without news stay as they are.
    """
    known = before_run(ledger, run)
    listed = drop.withColumn("file_date", day_text(F.col("file_date"))).select(
        *VERSION, "table", "file_date"
    ).dropDuplicates(VERSION)
    fresh = materialize(
        listed.join(known.select("file_date", *VERSION), ["file_date", *VERSION], "left_anti"),
        "fresh",
    )
    days = materialize(fresh.select("file_date").distinct(), "days-with-news")
    # an older version of a file gives way to the one that came now
    earlier = known.join(days, "file_date", "left_semi").join(
        fresh.select("file_date", "path"), ["file_date", "path"], "left_anti"
    )
    none = F.lit(None).cast("string")
    files = materialize(earlier.select(*COLUMNS).unionByName(fresh.select(
        *VERSION, "table", F.lit(run).alias("first_run"), none.alias("taken_run"), "file_date"
    )), "files-of-days")
    missing = tables_missing(files, required)
    complete = missing.filter("missing = 'None'").select("file_date", F.lit(True).alias("complete"))
    judged = skew_safe_left_join(files, complete, ["file_date"])
    taken_now: Column = F.when(F.col("complete"), F.lit(run))
    rows = materialize(
        judged.withColumn("taken_run", F.coalesce("taken_run", taken_now)).select(*COLUMNS),
        "ledger-rows",
    )
    return Admission(rows.filter(F.col("taken_run") == run), missing, rows)


def held_files(ledger: DataFrame) -> DataFrame:
    """(file_date, table, name, first_run) of the files that wait for their day."""
    return ledger.filter("taken_run IS NULL").select(
        "file_date", "table", file_name(F.col("path")).alias("name"), "first_run"
    )
