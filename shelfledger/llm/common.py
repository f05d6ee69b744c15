"""What the operators share: the folder for written tables, words, and names that cannot clash."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blank characters of a text; a word is a run of other characters.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Shuffle partitions, which are as many as the texts need, whose ids and counts fill one file.
PARTITIONS_A_FILE = 32


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster names in ``spark.checkpoint.dir``.

    A session without that setting, as in tests, gets it set to a temporary folder; this is
    refused where executors run on other machines.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


#: Where ``written`` notes its tables while ``noted`` is in force.
_NOTES: list[list[str]] = []


@contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """Adds the tables written meanwhile to ``paths``, for ``cleared``."""
    _NOTES.append(paths)
    try:
        yield
    finally:
        _NOTES.pop()


def cleared(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that nothing reads any more."""
    while paths:
        name = paths.pop()
        spark.sql(f"DROP TABLE IF EXISTS {_table_at(name)}")
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _table_at(path: str) -> str:
    """The name of a table in the catalog whose files lie at the path."""
    return "".join(c if c.isalnum() else "_" for c in path.rstrip("/").rsplit("/", 1)[-1])


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder: computed once, with no lineage."""
    path = shared_path(df.sparkSession, name)
    if _NOTES:
        _NOTES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_files(spark: SparkSession) -> int:
    """In how many files to write ids or counts: in as many as tasks run at once, or more of large
    inputs. A file per shuffle partition would hold a few rows, and take longer to open than to read.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(spark.sparkContext.defaultParallelism, partitions // PARTITIONS_A_FILE)


def written_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """``written``, dealt into buckets by ``key``: joins on the key don't move its rows again."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    if _NOTES:
        _NOTES[-1].append(path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, key).write.format("parquet").bucketBy(n, key).sortBy(key).option(
        "path", path
    ).saveAsTable(_table_at(path))
    return spark.table(_table_at(path))


def whole_rows(docs: DataFrame, *used: str | Column) -> DataFrame:
    """The ``used`` columns, and all columns together as one, so that an operator's own names
    can't meet those of further columns."""
    return docs.select(
        F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns)).alias("_whole"),
        *used,
    )


def restored(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again from ``whole_rows``, some of them changed."""
    return rows.select(*(
        changed.get(c, F.col("_whole").getField(c)).alias(c) for c in docs.columns
    ))


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def null_safe(one: str, other: str) -> Column:
    """Two columns are equal or both null."""
    return F.col(one).eqNullSafe(F.col(other))


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, BLANK_RUN)
    )


def word_count(text: Column) -> Column:
    """The number of words of a text as a long."""
    return F.size(words(text)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
