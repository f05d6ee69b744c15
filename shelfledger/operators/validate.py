"""Row validation against declarative rules, for all files of a table in one pass.

Rules per column: ``data_type`` fails a whole file when no value of the column casts to the
type; ``null_check`` and ``date_format`` fail single rows. A column that is missing from the
input counts as NULL in every row, so its file fails.

Rows of ``sources.dropped`` also tell which lines could not be read whole, which are invalid,
and which files lack a rule's column, which fail as a whole without being parsed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.functions.casts import lenient_cast
from shelfledger.functions.dates import day_text, matches_any_format
from shelfledger.functions.names import dash_part, file_name, folder_name
from shelfledger.mapping import read_json
from shelfledger.operators.joins import skew_safe_left_join
from shelfledger.sources.dropped import FILE, LACKING, LINE
from shelfledger.sources.workspace import materialize

#: What the report calls lines that could not be read whole.
MALFORMED = "(malformed line)"


@dataclass(frozen=True)
class ColumnRule:
    column: str
    types: tuple[str, ...] = ()
    nulls: tuple[str, ...] = ()
    formats: tuple[str, ...] = ()


@dataclass(frozen=True)
class Validation:
    """``valid`` and ``invalid`` rows, the per-column ``report`` and per-file ``counts``."""

    valid: DataFrame
    invalid: DataFrame
    report: DataFrame
    counts: DataFrame


def parse_rules(tables: dict) -> dict[str, list[ColumnRule]]:
    """Rules from the JSON form: table -> columns -> validations of {name, values}."""
    parsed = {}
    for table, entry in tables.items():
        rules = []
        for column in entry["columns"]:
            found = {"data_type": (), "null_check": (), "date_format": ()}
            for validation in column["validations"]:
                found[validation["name"]] += tuple(validation["values"])
            rules.append(ColumnRule(column["name"], *found.values()))
        parsed[table] = rules
    return parsed


def read_rules(spark: SparkSession, path: str) -> dict[str, list[ColumnRule]]:
    return parse_rules(read_json(spark, path))


def rules_for(rules: dict[str, list[ColumnRule]], name: str) -> list[ColumnRule]:
    """Rules of the table whose name is part of a file name; none if no table fits."""
    return next((r for table, r in rules.items() if table in name), [])


def _null_flag(rule: ColumnRule) -> Column:
    column = F.col(rule.column)
    flag = column.isNull() if "null" in rule.nulls else F.lit(False)
    texts = [v for v in rule.nulls if v != "null"]
    return flag | F.coalesce(column.isin(*texts), F.lit(False)) if texts else flag


def _date_flag(rule: ColumnRule) -> Column:
    if not rule.formats:
        return F.lit(False)
    column = F.col(rule.column)
    blank = column.isNull() | F.coalesce(column.isin("", " "), F.lit(False))
    return ~(blank | matches_any_format(column, rule.formats))


def _row_flag(rules: list[ColumnRule]) -> Column:
    flag = F.lit(False)
    for rule in rules:
        flag = flag | _null_flag(rule) | _date_flag(rule)
    return flag


def _read_whole(df: DataFrame) -> Column:
    """The row's file has all columns of the rules, as far as the scan looked."""
    return F.col(LACKING).isNull() if LACKING in df.columns else F.lit(True)


def _malformed(df: DataFrame) -> Column:
    return _read_whole(df) & F.col(LINE).isNotNull() if LINE in df.columns else F.lit(False)


def _with_rule_columns(df: DataFrame, rules: list[ColumnRule]) -> DataFrame:
    absent = [r.column for r in rules if r.column not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in absent})


def file_statistics(df: DataFrame, rules: list[ColumnRule]) -> DataFrame:
    """Per file: rows, rows with a row error, and per rule the counts behind the report.

    ``failed`` is the position of the first rule whose column the file lacks, or whose type
    fits no value, else NULL.
    """
    whole, broken = _read_whole(df), _malformed(df)
    counts = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(whole & (_row_flag(rules) | broken)).alias("bad"),
        F.count_if(broken).alias("malformed"),
    ]
    misfits = [F.col("lacking")]
    for i, rule in enumerate(rules):
        counts.append(F.count_if(whole & _null_flag(rule)).alias(f"nulls_{i}"))
        counts.append(F.count_if(whole & _date_flag(rule)).alias(f"dates_{i}"))
        for j, type_name in enumerate(rule.types):
            fits = f"fits_{i}_{j}"
            counts.append(F.count(lenient_cast(F.col(rule.column), type_name)).alias(fits))
            misfits.append(F.when(F.col(fits) == 0, i))
    lacking = F.min(LACKING) if LACKING in df.columns else F.min(F.lit(None).cast("int"))
    grouped = _with_rule_columns(df, rules).groupBy(FILE).agg(*counts, lacking.alias("lacking"))
    return grouped.withColumn("failed", F.coalesce(*misfits))


def validation_report(
    statistics: DataFrame, rules: list[ColumnRule], malformed: bool = False
) -> DataFrame:
    """Failing rows per file, column and kind of rule; with ``malformed`` also the lines of each
    file that could not be read whole.

    Null and date failures count over all rows of the file; a type failure counts every row,
    on the first failing column only.
    """
    lines = [
        F.struct(
            F.lit(rule.column).alias("column"),
            F.when(F.col("failed") == i, F.col("rows")).otherwise(0).alias("data_type"),
            F.col(f"nulls_{i}").alias("null_check"),
            F.col(f"dates_{i}").alias("date_format"),
        )
        for i, rule in enumerate(rules)
    ]
    if malformed:
        zero = F.lit(0).cast("bigint")
        lines.append(F.struct(
            F.lit(MALFORMED).alias("column"), F.col("malformed").alias("data_type"),
            zero.alias("null_check"), zero.alias("date_format"),
        ))
    return statistics.select(FILE, F.inline(F.array(*lines)))


def file_error_counts(statistics: DataFrame) -> DataFrame:
    """Per file: day (yyyyMMdd) and table from its path, error rows and all rows."""
    path = F.col(FILE)
    return statistics.select(
        day_text(dash_part(file_name(path), -2)).alias("file_date"),
        path.alias("uri"),
        folder_name(path).alias("table"),
        F.when(F.col("failed").isNotNull(), F.col("rows")).otherwise(F.col("bad"))
        .alias("error_row_count"),
        F.col("rows").alias("original_row_count"),
    )


def flag_rows(df: DataFrame, rules: list[ColumnRule], statistics: DataFrame) -> DataFrame:
    """Rows plus ``is_invalid``: an own error, or a file that failed as a whole.

    The failed files are joined by file. Their list is a written table, so Spark knows its
    size and broadcasts a short one; mostly it is empty, and then there is nothing to join.
    """
    failed_files = statistics.filter(F.col("failed").isNotNull()).select(
        FILE, F.lit(True).alias("_file_failed")
    )
    rows = _with_rule_columns(df, rules)
    flag = _row_flag(rules) | _malformed(df)
    if not failed_files.isEmpty():
        rows = skew_safe_left_join(rows, failed_files, [FILE])
        flag = flag | F.coalesce("_file_failed", F.lit(False))
    return rows.withColumn("is_invalid", flag).select(*df.columns, "is_invalid")


def validate(df: DataFrame, rules: list[ColumnRule]) -> Validation:
    """Validate text rows that carry their path in column ``file``.

    The per-file statistics are computed here, in one pass, and written to the shared work
    folder, since every result needs them. Invalid rows keep the text of lines that could not
    be read whole.
    """
    statistics = materialize(file_statistics(df, rules), "file-statistics")
    flagged = flag_rows(df, rules, statistics)
    return Validation(
        flagged.filter(~F.col("is_invalid")).drop("is_invalid", LINE, LACKING),
        flagged.filter("is_invalid").drop("is_invalid", LACKING),
        validation_report(statistics, rules, LINE in df.columns),
        file_error_counts(statistics),
    )
