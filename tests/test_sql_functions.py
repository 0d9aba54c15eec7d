from datetime import date

import pytest
from pyspark.sql import functions as F

from dropforge.functions import calendar as cal
from dropforge.functions import sql, text

RUNS = [date(y, m, 15) for y in (2024, 2025) for m in range(1, 13)] + [date(2024, 2, 29), date(2024, 7, 31), date(2024, 12, 31)]


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    assert sql.register(spark) == list(sql.FUNCTIONS)


@pytest.mark.parametrize(
    ("call", "column"),
    [
        ("day_first_to_iso(c)", lambda: text.day_first_to_iso("c")),
        ("day_first_to_month(c)", lambda: text.day_first_to_month("c")),
        ("visit_timestamp(c)", lambda: text.visit_timestamp("c")),
        ("pad_if_length(c, 8)", lambda: text.pad_if_length("c", 8)),
        ("department_of_commune(c)", lambda: text.department_of_commune("c")),
        ("split_pipe(c)", lambda: text.split_pipe("c")),
    ],
)
def test_text_functions_equal_the_columns(texts, call, column):
    df = texts("31-12-2024", "2024-12-31 00:00:00", "", None, "12345678", "97105", "2A004", "a|b| c|", "|")
    rows = df.select(F.expr(call).alias("sql"), column().alias("col")).collect()
    assert [r.sql for r in rows] == [r.col for r in rows]


@pytest.mark.parametrize("ref", RUNS)
def test_run_date_literals_equal_the_python_ones(spark, ref):
    day = f"DATE '{ref}'"
    row = spark.sql(
        f"""SELECT previous_year(2, {day}), previous_years(3, {day}), last_completed_quarter({day}),
        first_day_years_ago(3, {day}), yesterday({day}), rolling_year_start({day}), rolling_year_end({day})"""
    ).first()
    assert tuple(row) == (
        cal.previous_year(ref, 2), cal.previous_years(ref), cal.last_completed_quarter(ref), cal.first_day_years_ago(ref),
        str(cal.yesterday(ref)), cal.rolling_year_start(ref), cal.rolling_year_end(ref),
    )


def test_predicates_equal_the_columns(spark):
    months = spark.createDataFrame([(y, m) for y in range(2021, 2027) for m in range(1, 13)], "annee int, mois int")
    for ref in RUNS:
        day = f"DATE '{ref}'"
        pairs = {
            f"in_last_six_months(annee, mois, {day})": cal.in_last_six_months(ref, "annee", "mois"),
            f"in_remaining_months(annee, mois, {day})": cal.in_remaining_months(ref, "annee", "mois"),
            f"is_month_back(annee, mois, 3, {day})": cal.is_month_back(ref, 3, "annee", "mois"),
            f"in_previous_year_and_current(annee, mois, {day})": cal.in_previous_year_and_current(ref, "annee", "mois"),
        }
        row = months.agg(
            *[F.count_if(F.expr(call) != column).alias(f"n{i}") for i, (call, column) in enumerate(pairs.items())],
        ).first()
        assert tuple(row) == (0, 0, 0, 0), ref


def test_today_is_the_default(spark):
    today = spark.sql("SELECT current_date()").first()[0]
    assert spark.sql("SELECT yesterday()").first()[0] == str(cal.yesterday(today))


def test_calls_are_folded_into_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([(2024, 3, "2024-01-01")], "annee int, mois int, jour string").write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("months")
    ref = "ref => DATE '2024-08-15'"
    plan = spark.sql(
        f"SELECT * FROM months WHERE in_last_six_months(annee, mois, {ref}) AND jour <= yesterday({ref})"
    )._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(annee,2024)" in plan and "LessThanOrEqual(jour,2024-08-14)" in plan
