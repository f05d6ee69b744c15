"""The drop folder as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """path, length and modificationTime of every file below ``folder``; contents unread.

    Paths are spelled as the ``file`` column of scanned rows spells them.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(F.col("_metadata.file_path").alias("path"), "length", "modificationTime")
    )
