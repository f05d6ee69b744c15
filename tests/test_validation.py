import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shelfledger.functions.dates import matches_any_format
from shelfledger.operators import quarantine, validate
from shelfledger.operators.validate import ColumnRule

BLANKS = ("", "null", " ")
RULES = [
    ColumnRule("date_string_column", ("string",), BLANKS, ("%Y-%m-%d",)),
    ColumnRule("float_column", ("double",), BLANKS),
    ColumnRule("string_column", ("string",), BLANKS),
    ColumnRule("integer_column", ("int",), BLANKS),
]
COLUMNS = [r.column for r in RULES]
ROWS = [
    ("2023-04-03", "3.14", "apple", "4"),
    ("2023-04-25", "3.7", "correct_string", "4"),
    (" ", "2", "cherry", None),
    ("2023-04-03", " ", "23", "10"),
    ("2023-28-03", "1", "values", "20"),
    ("2023-04-03", "4", "strings", " "),
    (None, "3.86", "returns", "23"),
    ("2023-11-03", "23", "final", "23"),
    ("2023-04-03", None, None, "43"),
]


def frame(spark, files):
    data = [(f"x/{name}", *row) for name, content in files.items() for row in content]
    return spark.createDataFrame(
        data, "file string, " + ", ".join(f"{c} string" for c in COLUMNS)
    )


def report_of(result, name):
    return {
        r.column: (r.data_type, r.null_check, r.date_format)
        for r in result.report.filter(F.col("file").endswith(name)).collect()
    }


def test_dirty_sample(spark):
    result = validate.validate(frame(spark, {"a": ROWS}), RULES)
    assert report_of(result, "a") == {
        "date_string_column": (0, 2, 1), "float_column": (0, 2, 0),
        "string_column": (0, 1, 0), "integer_column": (0, 2, 0),
    }
    assert result.invalid.count() == 6
    assert rows(result.valid, *COLUMNS) == sorted([ROWS[0], ROWS[1], ROWS[7]])


def test_whole_file_fails_on_type(spark):
    """The first column that casts nowhere fails its file; other files stay as they are."""
    bad = [("x", "y", "s", "1"), ("2023-01-01", "z", "s", "q")]
    ok = [("2023-01-01", "1", "s", "1"), ("2023-01-01", "1", "s", "q")]
    result = validate.validate(frame(spark, {"bad": bad, "ok": ok}), RULES)
    assert report_of(result, "bad") == {
        "date_string_column": (0, 0, 1), "float_column": (2, 0, 0),
        "string_column": (0, 0, 0), "integer_column": (0, 0, 0),
    }
    assert result.invalid.filter("file = 'x/bad'").count() == 2
    assert result.valid.filter("file = 'x/ok'").count() == 2
    assert rows(result.counts, "uri", "error_row_count", "original_row_count") == [
        ("x/bad", 2, 2), ("x/ok", 0, 2)
    ]


def test_many_failed_files_are_joined(spark):
    files = {f"f{i}": [("2023-01-01", "no", "s", "1")] * 2 for i in range(5)}
    files["good"] = ROWS
    df = frame(spark, files)
    expected = rows(validate.validate(df, RULES).invalid)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(validate.validate(df, RULES).invalid) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(expected) == 16


def test_missing_column_fails_the_file(spark):
    df = frame(spark, {"a": ROWS}).drop("integer_column")
    result = validate.validate(df, RULES)
    assert result.valid.isEmpty() and result.invalid.count() == len(ROWS)
    assert report_of(result, "a")["integer_column"] == (9, 9, 0)


def test_whole_numbers_with_decimals_are_integers(spark):
    content = [("2023-01-01", "1", "s", "4.0"), ("2023-01-01", "1", "s", "12.")]
    assert validate.validate(frame(spark, {"a": content}), RULES).valid.count() == 2


def test_rules_of_only_null(spark):
    rule = [ColumnRule("string_column", (), ("null",))]
    result = validate.validate(frame(spark, {"a": ROWS}), rule)
    assert result.invalid.count() == 1 and result.valid.count() == 8


def test_valid_and_invalid_make_all(spark, small):
    from entry_queries.queries import QUERIES, views

    total = views.text_rows(spark, small).count()
    valid, invalid = (QUERIES[n](spark, small).count() for n in ("valid_rows", "invalid_rows"))
    assert valid + invalid == total


def test_rule_file(spark, tmp_path):
    columns = []
    for rule in RULES:
        checks = {"data_type": rule.types, "null_check": rule.nulls, "date_format": rule.formats}
        columns.append({"name": rule.column, "validations": [
            {"name": kind, "values": list(values)} for kind, values in checks.items() if values]})
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"FD_RETURNS": {"columns": columns}}, indent=1))
    rules = validate.read_rules(spark, str(path))
    assert rules == {"FD_RETURNS": RULES}
    assert validate.rules_for(rules, "FD_RETURNS-01072023-1.csv") == RULES
    assert validate.rules_for(rules, "FD_OTHER-01072023-1.csv") == []


@pytest.mark.parametrize("text,fits", [
    ("2023-04-03", True), ("2023-4-3", True), ("2023-02-30", False), ("2023-28-03", False),
    ("23-04-03", False), ("2023-04-03 ", False), ("2023-004-03", False), ("0000-01-01", False),
    ("2023/04/03", False), ("", False), (None, False), ("18-Mar-22", False),
])
def test_date_format(spark, text, fits):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(matches_any_format(df.t, ["%Y-%m-%d"])).first()[0] is fits


def test_several_date_formats(spark):
    df = spark.createDataFrame([("18-Mar-22",), ("03/04/2023",), ("2023.1.2",), ("x",)], "t string")
    flag = matches_any_format(df.t, ["%d-%b-%y", "%m/%d/%Y", "%Y.%m.%d"])
    assert [r[0] for r in df.select(flag).collect()] == [True, True, True, False]


@pytest.mark.parametrize("errors,total,late,route", [
    (1, 100, False, "pass"), (2, 100, False, "validation_threshold_error/required_files"),
    (1, 100, True, "missed_files"), (2, 100, True, "validation_threshold_error/missed_files"),
    (0, 0, False, "pass"),
])
def test_routes(spark, errors, total, late, route):
    counts = spark.createDataFrame(
        [("01072023", "u1", "T", errors, total), ("01072023", "u2", "T", 0, 0)],
        "file_date string, uri string, table string, error_row_count bigint,"
        " original_row_count bigint",
    )
    missing = spark.createDataFrame(
        [("01072023", "FD_STORE_INV" if late else "None")], "file_date string, missing string"
    )
    found = rows(quarantine.quarantine_routes(counts, missing), "uri", "route")
    assert found == [("u1", route), ("u2", route)]
