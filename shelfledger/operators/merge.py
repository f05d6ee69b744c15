"""Merge a finished batch into the consolidated wide table, by partitions or by rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.operators.conform import GROUP
from shelfledger.operators.facts import KEYS
from shelfledger.operators.joins import same_key
from shelfledger.sources.sinks import with_location_group, write_partitioned
from shelfledger.sources.workspace import work_dir

MERGE_KEYS = (GROUP, "DATE")
#: Rows of a batch up to which its keys are sent to all tasks, some 10 MB; those of a larger one
#: are met by sorting. Spark would go by the size of the compressed files, a small part of it.
SENT = 100_000


def _grouped(batch: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The batch with the store group, where that is needed and not there."""
    return with_location_group(batch) if GROUP in by and GROUP not in batch.columns else batch


def merge_partitions(
    batch: DataFrame, consolidated: str, by: tuple[str, ...] = MERGE_KEYS
) -> None:
    """Each (store group, day) of the batch replaces that partition; the rest is untouched.

    Running the same batch again gives the same table.
    """
    write_partitioned(_grouped(batch, by), consolidated, by)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def merge_rows(
    batch: DataFrame,
    consolidated: str,
    keys: list[str] | tuple[str, ...] = tuple(KEYS),
    by: tuple[str, ...] = MERGE_KEYS,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Each key of the batch replaces the rows of that key; all other rows stay.

    Only partitions that the batch touches are read and written. The merged partitions are
    written aside first and must hold exactly the batch and the rows it does not replace;
    ``check`` may look at them too. Only then do they take the place of the old ones, so a run
    that fails, or does not pass, leaves the table as it was. Running the same batch again gives
    the same table. The keys must contain the partition columns or decide them; a key without
    a value is a key like any other. A key given several times keeps all its rows.
    """
    spark = batch.sparkSession
    incoming = work_dir(spark, "merge-batch")
    batch = _grouped(batch, by)
    write_partitioned(batch, incoming, by, replace_all=True)
    # the written batch names the partitions it touches, and meets the old rows several times
    fresh = spark.read.schema(batch.schema).parquet(incoming)
    merged, expected, sent = fresh, 0, fresh.count()
    if _exists(spark, consolidated):
        touched = fresh.select(*by).distinct()
        given = fresh.select(*keys).hint("broadcast" if sent <= SENT else "merge")
        here = spark.read.parquet(consolidated).alias("o").join(
            touched.alias("t"), same_key("o", "t", by), "left_semi"
        )
        replaced = here.alias("o").join(given.alias("b"), same_key("o", "b", keys), "left_semi")
        stays = here.alias("o").join(given.alias("b"), same_key("o", "b", keys), "left_anti")
        expected = here.count() - replaced.count()
        merged = stays.unionByName(fresh, allowMissingColumns=True)
    aside = work_dir(spark, "merge-aside")
    write_partitioned(merged, aside, by, replace_all=True)
    staged = spark.read.schema(merged.schema).parquet(aside)
    found = staged.count()
    if found != expected + sent:
        raise ValueError(
            f"merge written aside holds {found} rows, not the {expected} that stay and {sent} new"
        )
    if check is not None:
        check(staged)
    write_partitioned(staged, consolidated, by)


def merge_denorm(
    spark: SparkSession,
    source: str,
    consolidated: str,
    groups: list[float] | None = None,
    by_rows: bool = False,
) -> None:
    """Merges a written batch, whole (store group, day) partitions at a time or row by row."""
    batch = spark.read.parquet(source)
    if groups is not None:
        batch = batch.filter(F.col(GROUP).isin(*groups))
    (merge_rows if by_rows else merge_partitions)(batch, consolidated)
