"""Line dedup against levelled sorted runs of line hashes.

The lines seen so far are kept as runs: tables of 128-bit line hashes, dealt into buckets and
sorted by hash. A new batch is dealt the same way once, merge-anti-joined with each run in turn
without moving the runs, and what is left of it becomes a run of level 0. When a level holds
FANOUT runs, they are merged into one run of the next level, so n batches leave at most
FANOUT * log(n) runs and each hash is rewritten log(n) times.

A batch is two steps, so that it can be repeated after a failure: ``stage`` writes its run aside,
and ``commit`` makes the run part of the index once the caller has written its results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from shelfledger.llm.common import (
    BLANKS, cleared, documents, let, noted, null_safe, shared_path, written,
)

#: Runs of a level that are merged into one of the next level.
FANOUT = 4
#: Batches that a whole table is cut into, by ranges of doc_id.
BATCHES = 6
#: Code points of the shortest line that is looked at.
LEAST_KEY = 10
HASH = ["h1", "h2"]


class LineRuns:
    """An index of line hashes in ``folder``, which all executors must reach.

    Opening a folder again continues with its last committed state. ``kind`` is the SQL type of
    the ids of the documents.
    """

    def __init__(self, spark: SparkSession, folder: str, kind: str = "bigint",
                 fanout: int = FANOUT):
        self.spark, self.folder, self.kind, self.fanout = spark, folder, kind, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._tables: dict[str, str] = {}
        self._staged: str | None = None
        self.version, self.runs = self._last_state()

    # ---- state ------------------------------------------------------------------------

    def _last_state(self) -> tuple[int, list[tuple[int, str, int]]]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = fs.globStatus(
            self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/state-*/_SUCCESS")
        ) if fs.exists(path) else None
        if not done:
            return 0, []
        last = max(s.getPath().getParent().getName() for s in done)
        rows = self.spark.read.parquet(f"{self.folder}/{last}").orderBy("level", "name").collect()
        return int(last.split("-")[1]), [(r["level"], r["name"], r["buckets"]) for r in rows]

    def _save_state(self, runs: list[tuple[int, str, int]]) -> None:
        """A new version of the list of runs; a version counts once it is written whole."""
        rows = F.explode(F.array(*(
            F.struct(F.lit(level).alias("level"), F.lit(name).alias("name"),
                     F.lit(buckets).alias("buckets"))
            for level, name, buckets in runs
        ))).alias("r")
        self.version += 1
        self.spark.range(1, numPartitions=1).select(rows).select("r.*").write.parquet(
            f"{self.folder}/state-{self.version:09d}"
        )
        self.runs = runs

    def _run(self, name: str, buckets: int) -> DataFrame:
        """A run as a table that Spark knows to be dealt by hash."""
        if name not in self._tables:
            table = f"line_run_{uuid.uuid4().hex[:12]}"
            self.spark.sql(
                f"CREATE TABLE {table} (h1 BIGINT, h2 BIGINT, first {self.kind}) USING parquet "
                f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {buckets} BUCKETS "
                f"LOCATION '{self.folder}/{name}'"
            )
            self._tables[name] = table
        return self.spark.table(self._tables[name])

    def _write_run(self, rows: DataFrame) -> str:
        name, table = f"run-{uuid.uuid4().hex[:12]}", f"line_run_{uuid.uuid4().hex[:12]}"
        rows.select(*HASH, "first").write.format("parquet").bucketBy(
            self.buckets, *HASH
        ).sortBy(*HASH).option("path", f"{self.folder}/{name}").saveAsTable(table)
        self._tables[name] = table
        return name

    # ---- batches ----------------------------------------------------------------------

    def stage(self, lines: DataFrame) -> DataFrame:
        """Writes the run of a batch ``lines(h1, h2, doc_id)`` aside and returns its rows
        (h1, h2, first): the hashes that no earlier batch holds, each with the least doc_id
        of the batch that holds it, null if only rows without an id do."""
        fresh = lines.groupBy(*HASH).agg(F.min("doc_id").alias("first"))
        for _, name, buckets in self.runs:
            fresh = fresh.join(
                self._run(name, buckets).select(*HASH).hint("merge"), HASH, "left_anti"
            )
        self._staged = self._write_run(fresh)
        return self.spark.read.schema(f"h1 bigint, h2 bigint, first {self.kind}").parquet(
            f"{self.folder}/{self._staged}"
        )

    def commit(self) -> None:
        """Makes the staged run part of the index and merges levels that are full."""
        if self._staged is None:
            raise ValueError("no batch is staged")
        runs = [*self.runs, (0, self._staged, self.buckets)]
        self._staged = None
        merged: list[str] = []
        level = 0
        while sum(1 for r in runs if r[0] == level) >= self.fanout:
            full = [r for r in runs if r[0] == level]
            whole = self._run(full[0][1], full[0][2])
            for _, name, buckets in full[1:]:
                whole = whole.union(self._run(name, buckets))
            # runs of an index share no hash, so laying them together is enough
            name = self._write_run(whole.repartition(self.buckets, *HASH))
            merged += [r[1] for r in full]
            runs = [r for r in runs if r[0] != level] + [(level + 1, name, self.buckets)]
            level += 1
        self._save_state(runs)
        self._forget(merged)
        cleared(self.spark, [f"{self.folder}/{name}" for name in merged])

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(name)}")

    def close(self) -> None:
        """Takes the runs out of the catalog; their files stay."""
        self._forget(list(self._tables))


# ---------------------------------------------------------------------------------- lines

def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A to Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # Spark's lower is faster, and the same where all characters are single bytes
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(
        F.translate(bare, upper, upper.lower())
    )


def _hashes(value: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, text, t1, t2): rows are told apart by id and hashes of their text, which
    together decide what happens to them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    t1, t2 = _hashes(F.col("text"))
    return docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", t1.alias("t1"), t2.alias("t2")
    )


def keyed_lines(docs: DataFrame, batch: Column) -> DataFrame:
    """(batch, doc_id, t1, t2, at, h1, h2): each line with a key of LEAST_KEY code points or
    more, by the hashes of the key; ``at`` counts lines from 0."""
    lines = _identified(docs).select(
        batch.alias("batch"), "doc_id", "t1", "t2",
        F.posexplode(F.split("text", "\n")).alias("at", "line"),
    ).select("batch", "doc_id", "t1", "t2", "at", line_key(F.col("line")).alias("key"))
    h1, h2 = _hashes(F.col("key"))
    return lines.where(F.length("key") >= LEAST_KEY).select(
        "batch", "doc_id", "t1", "t2", "at", h1.alias("h1"), h2.alias("h2")
    )


def _batch_of(docs: DataFrame, batches: int) -> tuple[Column, int]:
    """The batch of a row and the number of batches: ranges of doc_id of about equal size."""
    if batches < 2 or not isinstance(docs.schema["doc_id"].dataType, NumericType):
        return F.lit(0), 1
    cuts = docs.agg(F.percentile_approx(
        "doc_id", [i / batches for i in range(1, batches)], 1000
    )).first()[0]
    cuts = sorted(set(cuts or []))
    place = sum(((F.col("doc_id") > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    return F.coalesce(place, F.lit(len(cuts))), len(cuts) + 1


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """(doc_id, kept_text, n_lines, n_dropped): texts without the lines that
    ``dropped(doc_id, t1, t2, at)`` names."""
    rows = _identified(docs)
    # from a written table, so that a row with most of the copies can be split in the join
    gone = written(dropped.groupBy("doc_id", "t1", "t2").agg(
        F.collect_set("at").alias("gone")
    ).select(
        F.col("doc_id").alias("_doc"), F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), "gone"
    ), "gone")
    kept = let(F.split("text", "\n"), lambda lines: F.concat_ws("\n", F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")),
        lambda i: F.get(lines, i),
    )))
    return rows.join(
        gone, null_safe("doc_id", "_doc") & (F.col("t1") == F.col("_t1"))
        & (F.col("t2") == F.col("_t2")), "left",
    ).select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
        .cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, batches: int = BATCHES, runs: LineRuns | None = None) -> DataFrame:
    """(doc_id, kept_text, n_lines, n_dropped), one row per input row.

    Takes doc_id and text; other columns are left out. Lines are parted by \\n and compared by
    ``line_key``; keys of LEAST_KEY code points or more that are found in several documents stay
    only in the one with the least doc_id, there on every line. A null or empty text is one empty
    line. Rows with the same doc_id are one document; rows without one are one document that
    comes last. An empty table gives no rows. Keys are compared as 128-bit hashes.

    The table is cut into ``batches`` ranges of doc_id that enter the index one after another;
    any number gives the same result, and ids that are no numbers are one batch. With ``runs``
    the lines of earlier tables are known, and all of these go too.
    """
    spark = docs.sparkSession
    batch, n = _batch_of(docs, batches)
    lines_path = shared_path(spark, "lines")
    keyed = keyed_lines(docs, batch)
    keyed.write.partitionBy("batch").parquet(lines_path)
    lines = spark.read.schema(keyed.schema).parquet(lines_path)
    own = runs is None
    if own:
        kind = docs.schema["doc_id"].dataType.simpleString()
        runs = LineRuns(spark, shared_path(spark, "line-runs"), kind)
    dropped, read = [], [lines_path]
    for i in range(n):
        part = lines.where(F.col("batch") == i)
        fresh = runs.stage(part.select(*HASH, "doc_id")).select(
            F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first"
        )
        # the key holds the document too, so a line of many documents is many keys
        with noted(read):
            dropped.append(written(part.join(
                fresh, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
                & null_safe("doc_id", "first"), "left_anti",
            ).select("doc_id", "t1", "t2", "at"), "dropped"))
        runs.commit()
    if own:
        runs.close()
        cleared(spark, [runs.folder])
    gone = dropped[0]
    for more in dropped[1:]:
        gone = gone.union(more)
    kept = without(docs, gone)
    cleared(spark, read)
    return kept


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


OP13_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), lines AS (
    SELECT row_no, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM texts
), keyed AS (
    SELECT *, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), firsts AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key
), judged AS (
    SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.first AS gone
    FROM keyed k LEFT JOIN firsts f ON k.key = f.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
    CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), ''))
        AS kept_sha256
FROM judged GROUP BY row_no
"""
