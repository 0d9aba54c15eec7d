from datetime import date, datetime

import pytest

from dropforge.functions.formats import digit_regex, spark_pattern
from dropforge.quality.drops import check_headers, header_report, issues, require_valid, summary
from dropforge.quality.expectations import (
    Expectation,
    expect_bool,
    expect_column,
    expect_date_format,
    expect_type,
    repeated_keys,
    violation_counts,
)
from dropforge.sources.schemas import Source


@pytest.fixture
def df(spark):
    rows = [
        (1, "true", True, "2024-12-31", date(2024, 12, 31), 1.5),
        (2, "maybe", False, "31-12-2024", None, None),
        (3, None, None, None, None, None),
        (4, "FALSE", None, "", None, None),
    ]
    return spark.createDataFrame(rows, "k int, flag string, b boolean, day string, d date, x double")


def keys(frame):
    return sorted(r["k"] for r in frame.collect())


def test_formats():
    assert spark_pattern("YYYY-MM-DD HH24:MI:SS") == "yyyy-MM-dd HH:mm:ss"
    assert spark_pattern("DD/MM/YY") == "dd/MM/yy"
    assert digit_regex("YYYY-MM-DD") == r"^\d{4}-\d{2}-\d{2}$"


def test_bool(df):
    assert keys(expect_bool(df, "flag")) == [2]
    assert keys(expect_bool(df, "b")) == []
    assert keys(expect_bool(df, "k")) == [1, 2, 3, 4]


def test_date_format(df):
    got = sorted(tuple(r) for r in expect_date_format(df, "day").collect())
    assert got == [("", ""), ("31-12-2024", "31-12-2024")]
    assert expect_date_format(df, "d").isEmpty()
    assert expect_date_format(df, "day", "DD-MM-YYYY").count() == 2


def test_timestamps_are_formatted_first(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5),)], "t timestamp")
    assert expect_date_format(df, "t", "DD/MM/YYYY HH24:MI:SS").isEmpty()


def test_column_exists(df):
    assert expect_column(df, "FLAG").isEmpty()
    assert expect_column(df, "absent").collect() == [("absent",)]


def test_type(df):
    assert expect_type(df, "k", "INTEGER").isEmpty()
    assert expect_type(df, "x", "FLOAT").isEmpty()
    assert expect_type(df, "d", "DATE").isEmpty()
    assert expect_type(df, "absent", "DATE").isEmpty()
    (row,) = expect_type(df, "day", "DATE").collect()
    assert (row.column_name, row.actual_type, row.expected_type) == ("day", "string", "DATE")


def test_suite_in_one_scan(df, spark, tmp_path):
    path = str(tmp_path / "t")
    df.write.parquet(path)
    suite = [
        Expectation("bool", "flag"),
        Expectation("date_format", "day"),
        Expectation("column", "absent"),
        Expectation("column", "k"),
        Expectation("type", "day", "DATE"),
    ]
    counts = violation_counts(spark.read.parquet(path), suite)
    assert [r.violations for r in counts.collect()] == [1, 2, 4, 0, 4]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<flag:string,day:string>" in plan
    assert [r.violations for r in violation_counts(df.limit(0), suite).collect()] == [0, 0, 0, 0, 0]


def test_repeated_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), (None,)], "com string")
    assert {tuple(r) for r in repeated_keys(df, "com").collect()} == {("a", 2), (None, 2)}


def test_header_checks(spark):
    df = spark.createDataFrame(
        [
            ("ok", ["a", "b"], ["b", "a"]),
            ("blank", ["a", "b"], ["a", "", "b"]),
            ("repeat", ["a", "b"], ["a", "b", "b"]),
            ("other", ["a", "b"], ["a", "c"]),
        ],
        "file string, expected array<string>, headers array<string>",
    )
    report = check_headers(df)
    assert {r["file"]: r["valid"] for r in report.collect()} == {
        "ok": True, "blank": True, "repeat": False, "other": False,
    }
    assert sorted(tuple(r) for r in issues(report).collect()) == [
        ("other", "Extra columns: c"),
        ("other", "Missing columns: b"),
        ("repeat", "Column count mismatch: expected 2, got 3"),
    ]
    assert summary(report).collect() == [(4, 2, 2)]


def test_header_report_on_files(spark, tmp_path):
    good, bad, empty = (tmp_path / n for n in ("good.csv", "bad.csv", "empty.csv"))
    good.write_text("﻿Numéro;Libellé; \n1;2;\n", encoding="utf-8")
    bad.write_text("Numéro,Autre\n1,2\n", encoding="utf-8")
    empty.write_text("")
    source = Source("s", "s").with_columns(["numero", "libelle"])
    report = header_report(spark, {str(good): source})
    require_valid(report)
    with pytest.raises(ValueError, match="Missing columns: libelle.*Extra columns: autre"):
        require_valid(header_report(spark, {str(bad): source}))
    with pytest.raises(ValueError, match="expected 2, got 0"):
        require_valid(header_report(spark, {str(empty): source}))
