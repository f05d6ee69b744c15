import datetime as dt

import pytest

from conftest import rows
from shelfledger.operators import calendar, routing, runlog
from shelfledger.sources.manifest import file_manifest


def manifest(spark, *names):
    return spark.createDataFrame([(f"drop/{n}",) for n in names], "path string")


@pytest.mark.parametrize("name,kind", [
    ("FD_STORE_INV-14032024-501.csv", "all_valid"),
    ("FD_DSD_INVOICE-20240315-502.csv", "all_valid"),
    ("FD_STORE_INV-16032024_503-7.csv", "file_name_error"),
    ("FD_STORE_INV-16032024-503-7.csv", "file_name_error"),
    ("FD_INV_ADJ_ERROR-1403202499-504.csv", "file_name_error"),
    ("FD_MARKDOWNS0-17032024-505.csv", "file_name_error"),
    ("FD_SALES-01072023-1.txt", "extension_error"),
    ("FD_SALES-01072023-1.csv.gz", "all_valid"),
    ("FD_SALES-01072023-1", "extension_error"),
    ("FD_SALES-0107202-1.csv", "file_name_error"),
])
def test_route_of_name(spark, name, kind):
    found = routing.route_files(manifest(spark, name)).collect()
    assert [r["class"] for r in found] == [kind]
    good = kind != "file_name_error"
    assert found[0].table == (name.split("-")[0] if good else "")
    assert found[0].file_date == (name.split("-")[1] if good else "")


def test_dropped_folder(spark, tmp_path):
    """Ten days of five tables, one of them unknown, plus some odd names in a sub-folder."""
    known = ["FD_DSD_INVOICE", "FD_INV_ADJ", "FD_PHYSICAL_INV_ADJUSTMENTS", "FD_RETURNS"]
    names = [f"{t}-{d:02d}102020-{100 + d}.csv" for t in [*known, "FD_MARKDOWNS"]
             for d in range(1, 11)]
    odd = ["FD_INV_ADJ_ERROR-1403202499-504.csv", "FD_STORE_INV-03072023-1.txt", "readme.txt"]
    (tmp_path / "more").mkdir()
    for name in names:
        (tmp_path / name).write_text("x")
    for name in odd:
        (tmp_path / "more" / name).write_text("x")
    listed = file_manifest(spark, str(tmp_path))
    assert listed.columns == ["path", "length", "modificationTime"]
    assert listed.count() == 53
    found = routing.route_files(listed).groupBy("class").count().collect()
    assert {r["class"]: r["count"] for r in found} == {
        "all_valid": 40, "file_name_error": 11, "extension_error": 1
    }


def test_name_with_two_tables_and_readme(spark):
    found = routing.route_files(
        manifest(spark, "FD_SALES-FD_RETURNS-1.csv", "readme.txt"), ("FD_SALES", "FD_RETURNS")
    )
    assert rows(found, "name", "class") == [("FD_SALES-FD_RETURNS-1.csv", "file_name_error")] * 2


def test_missing_mandatory(spark):
    files = manifest(
        spark, "FD_STORE_INV-20230701-1.csv", "FD_SALES-20230701-1.csv", "FD_SALES-20230702-1.csv",
        "nodate",
    )
    assert rows(routing.missing_mandatory(files)) == [
        ("20230701", "None"), ("20230702", "FD_STORE_INV")
    ]
    both = routing.missing_mandatory(files, ("FD_STORE_INV", "FD_RETURNS"))
    assert rows(both)[1] == ("20230702", "FD_RETURNS,FD_STORE_INV")


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [("Data Ingestion", "20230630", "20230630", "failed", "critical", "['FD_STORE_INV']"),
         ("Data Ingestion", "20230701", "20230630", "success", None, None),
         ("Data Ingestion", "20230701", "20230701", "failed", "critical",
          "['FD_STORE_INV', 'FD_SALES']"),
         ("Data Validator", "20230702", "20230702", "failed", "critical", "['FD_RETURNS']")],
        "component string, run_date string, file_date string, status string, priority string,"
        " missed_files string",
    )


def test_earlier_log(spark, log):
    latest = calendar.latest_failures(log)
    assert rows(latest, "file_date") == [("20230701",)]
    days = spark.createDataFrame([("20230701",), ("20230702",)], "file_date string")
    found = runlog.missing_from_log(latest, days)
    assert rows(found) == [("20230701", "FD_SALES,FD_STORE_INV"), ("20230702", "")]
    runlog.require_same(found, found)
    with pytest.raises(ValueError):
        runlog.require_same(found, found.filter("missing = ''"))


@pytest.mark.parametrize("offset,day", [(0, "05"), (1, "05"), (3, "07"), (-2, "03")])
def test_run_day(offset, day):
    assert calendar.run_day(offset, dt.date(2023, 7, 5)) == f"202307{day}"


def test_planned_days(spark, log):
    asked = spark.createDataFrame([("20230705",)], "file_date string")
    planned = calendar.plan_dates(log, asked, "20230705")
    assert [r[0] for r in planned.collect()] == ["20230701", "20230703", "20230705"]


@pytest.mark.parametrize("logged,asked,expected", [
    ([], [], []), (["20230703"], [], [3]), ([], ["20230701", "20230703"], [1, 3]),
    (["20230701"], ["20230703"], [1, 2, 3]), (["20230701"], ["20230701"], [1]),
])
def test_fill_dates(spark, logged, asked, expected):
    def frame(days):
        return spark.createDataFrame([(d,) for d in days], "file_date string")

    found = calendar.fill_dates(frame(logged), frame(asked))
    assert rows(found) == [(dt.date(2023, 7, n),) for n in expected]


REQUIRED = ("FD_STORE_INV", "FD_SALES")


def log_of(spark, names, days, **options):
    days = spark.createDataFrame([(d,) for d in days], "file_date string")
    return runlog.run_log_rows(
        manifest(spark, *names), days, "20230705", REQUIRED, ("FD_RETURNS",), **options
    )


def test_log_rows(spark):
    found = log_of(
        spark,
        ["FD_STORE_INV-01072023-1.csv", "FD_SALES-20230701-1.CSV", "FD_SALES-20230702-1.csv.gz",
         "FD_RETURNS-02072023-7.csv", "FD_RETURNS-02072023-8.txt", "OTHER-02072023-9.txt",
         "readme.txt"],
        ["20230701", "20230702", "20230703"],
    )
    assert rows(
        found, "file_date", "status", "priority", "error_code", "missed_files",
        "processed_files", "unpermitted_files",
    ) == sorted([
        ("20230701", "success", "", "", "", "['FD_SALES', 'FD_STORE_INV']", ""),
        ("20230702", "failed", "critical", "DATA_ING_ERR_002", "['FD_STORE_INV']", "", ""),
        ("20230702", "success", "", "", "", "['FD_RETURNS', 'FD_SALES']", ""),
        ("20230702", "failed", "moderate", "", "", "", "['FD_RETURNS-02072023-8.txt']"),
        ("20230703", "failed", "critical", "DATA_ING_ERR_001", "['FD_STORE_INV', 'FD_SALES']",
         "", ""),
    ])
    assert rows(runlog.day_paths(found)) == [
        ("20230701", "output"), ("20230702", "error"), ("20230703", "error")
    ]


def test_day_anywhere_in_name(spark):
    days = spark.createDataFrame([("20230701",)], "file_date string")
    names = ["A-0107202312-1.csv", "B-9920230701-1.csv", "C-0207202312-1.csv", "short", "D-1.csv"]
    found = runlog.files_of_days(manifest(spark, *names), days)
    assert rows(found, "name") == [("A-0107202312-1.csv",), ("B-9920230701-1.csv",)]


def test_both_spellings_count_once(spark):
    found = log_of(spark, ["FD_SALES-01072023-20230701.txt"], ["20230701"])
    wrong = found.filter("priority = 'moderate'")
    assert rows(wrong, "unpermitted_files") == [("['FD_SALES-01072023-20230701.txt']",)]


@pytest.mark.parametrize("count", [10, 5000])
def test_each_wrong_file_has_a_row(spark, count):
    names = [f"FD_SALES-01072023-{i}.txt" for i in range(count)]
    found = log_of(spark, names, ["20230701"])
    listed = found.filter("priority = 'moderate'").select("unpermitted_files").collect()
    assert sorted(r[0][2:-2] for r in listed) == sorted(names)
