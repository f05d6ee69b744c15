"""Run-log rows of an ingestion run, and what an earlier log says is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger import fixed_values as fixed
from shelfledger.functions.dates import DAY, file_day
from shelfledger.functions.names import extension
from shelfledger.operators.joins import skew_safe_left_join
from shelfledger.operators.routing import listed_files, tables_named_in

def _matches(manifest: DataFrame, days: DataFrame) -> DataFrame:
    """(file_date, name), twice where a name holds both spellings of a day.

    "Contains" is turned into an equi-join: every eight-digit piece of a name is looked up
    among the two spellings of each day.
    """
    pieces = F.expr(
        "array_distinct(flatten(transform(regexp_extract_all(name, '[0-9]{8,}', 0),"
        " run -> transform(sequence(1, length(run) - 7), i -> substring(run, i, 8)))))"
    )
    named = listed_files(manifest).select("name", F.explode(pieces).alias("spelling"))
    day = file_day(F.col("file_date"))
    spellings = F.array(F.date_format(day, "ddMMyyyy"), F.date_format(day, DAY))
    wanted = days.select("file_date", F.explode(F.array_distinct(spellings)).alias("spelling"))
    return named.join(wanted, "spelling").select("file_date", "name")


def files_of_days(manifest: DataFrame, days: DataFrame) -> DataFrame:
    """(file_date, name) where the name holds the day as ddMMyyyy or yyyyMMdd anywhere."""
    return _matches(manifest, days).distinct()


def _listed(names: Column) -> Column:
    """List notation as the log holds it: ['A', 'B']."""
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def _log_row(**values: Column) -> Column:
    empty = F.lit("")
    return F.struct(*[
        values.get(c, empty).alias(c) for c in fixed.RUN_LOG_COLUMNS if c != "file_date"
    ])


def run_log_rows(
    manifest: DataFrame,
    days: DataFrame,
    run_date: str,
    required: tuple[str, ...] = fixed.REQUIRED_TABLES,
    special: tuple[str, ...] = fixed.SPECIAL_TABLES,
    extensions: tuple[str, ...] = fixed.PERMITTED_EXTENSIONS,
    ids: tuple[str, str, str] = ("", "", ""),
) -> DataFrame:
    """Log rows per day: a critical failure where required tables are missing, a success
    with the tables that came, and a moderate failure for each file of a wrong extension.

    Tables are listed once each and sorted. Every wrong-extension file has a row of its own,
    so no day's files are gathered, however many there are.
    """
    name = F.col("name")
    hits = files_of_days(manifest, days).withColumn(
        "permitted", F.lower(extension(name)).isin(*extensions)
    )
    tables = sorted({*required, *special})
    wrong = ~F.col("permitted") & (F.size(tables_named_in(name, tuple(tables))) > 0)
    came = hits.groupBy("file_date").agg(
        *[F.max(F.col("permitted") & name.contains(t)).alias(t) for t in tables]
    )
    state = skew_safe_left_join(days.select("file_date").distinct(), came, ["file_date"])
    got = {t: F.coalesce(F.col(t), F.lit(False)) for t in tables}
    missed = F.array_compact(F.array(*[F.when(~got[t], t) for t in required]))
    processed = F.array_compact(F.array(*[F.when(got[t], t) for t in tables]))
    common = dict(
        zip(("sub_proc_id", "run_id", "task_id"), map(F.lit, ids), strict=True),
        component=F.lit(fixed.INGESTION_COMPONENT),
        run_date=F.lit(run_date),
    )

    def failure(code: str, message: str) -> Column:
        return _log_row(
            **common, status=F.lit("failed"), priority=F.lit("critical"),
            error_code=F.lit(code), error_message=F.lit(message), missed_files=_listed(missed),
        )

    success = _log_row(
        **common, status=F.lit("success"), processed_files=_listed(processed)
    )
    gap = F.when(F.size(missed) > 0, F.when(
        F.size(missed) == len(required), failure(*fixed.ALL_MISSED)
    ).otherwise(failure(*fixed.SOME_MISSED)))
    rows = state.select(
        "file_date",
        F.inline(F.array_compact(F.array(gap, F.when(F.size(processed) > 0, success)))),
    )

    moderate = _log_row(
        **common, status=F.lit("failed"), priority=F.lit("moderate"),
        unpermitted_files=_listed(F.array(name)),
    )
    unpermitted = hits.filter(wrong).select("file_date", F.inline(F.array(moderate)))
    return rows.unionByName(unpermitted).select(*fixed.RUN_LOG_COLUMNS)


def day_paths(log_rows: DataFrame) -> DataFrame:
    """(file_date, path): a day that misses any required table goes to "error" as a whole."""
    critical = F.col("priority") == "critical"
    return log_rows.groupBy("file_date").agg(
        F.when(F.max(critical), "error").otherwise("output").alias("path")
    )


def missing_from_log(log_rows: DataFrame, days: DataFrame) -> DataFrame:
    """Per day the missed tables its log rows list, deduplicated, comma-separated; "" if none."""
    quoted = F.from_json("missed_files", "array<string>", {"allowSingleQuotes": "true"})
    listed = (
        log_rows.filter(F.col("missed_files").isNotNull() & (F.col("missed_files") != ""))
        .select("file_date", F.explode(quoted).alias("table"))
        .distinct()
        .groupBy("file_date")
        .agg(F.array_join(F.sort_array(F.collect_set("table")), ",").alias("missing"))
    )
    return skew_safe_left_join(
        days.select("file_date").distinct(), listed, ["file_date"]
    ).na.fill("", ["missing"])


def differing_rows(stated: DataFrame, logged: DataFrame) -> DataFrame:
    """Rows that only one side has; empty when the two agree."""
    left = stated.exceptAll(logged).withColumn("only_in", F.lit("stated"))
    return left.unionByName(logged.exceptAll(stated).withColumn("only_in", F.lit("logged")))


def require_same(stated: DataFrame, logged: DataFrame) -> None:
    if not differing_rows(stated, logged).isEmpty():
        raise ValueError("the stated missing files differ from those in the run log")
