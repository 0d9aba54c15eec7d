from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from dropforge.functions import calendar as cal

RUNS = [date(y, m, 15) for y in (2023, 2024, 2025) for m in range(1, 13)] + [
    date(2024, 2, 29), date(2024, 1, 1), date(2024, 3, 31), date(2024, 4, 1), date(2024, 7, 10), date(2024, 12, 31),
]


@pytest.fixture(scope="module")
def months(spark):
    rows = [(y, m) for y in range(2019, 2027) for m in range(1, 13)]
    return spark.createDataFrame(rows, "annee int, mois int").cache()


def chosen(months, predicates):
    """Months each predicate keeps, in one query."""
    flags = [p.alias(f"p{i}") for i, p in enumerate(predicates)]
    rows = months.select("annee", "mois", *flags).collect()
    return [{(r.annee, r.mois) for r in rows if r[f"p{i}"]} for i in range(len(predicates))]


def back(day, i):
    """Year and month ``i`` months back, one month at a time."""
    y, m = day.year, day.month
    for _ in range(i):
        y, m = (y, m - 1) if m > 1 else (y - 1, 12)
    return y, m


def test_last_six_months(months):
    got = chosen(months, [cal.in_last_six_months(d) for d in RUNS])
    assert got == [{back(d, i) for i in range(6)} for d in RUNS]


def test_remaining_months(months):
    got = chosen(months, [cal.in_remaining_months(d) for d in RUNS])
    want = []
    for d in RUNS:
        y, first = back(d, 5)
        want.append({(y, m) for m in range(1, first)})
    assert got == want
    assert chosen(months, [cal.in_remaining_months(date(2024, 6, 1))]) == [set()]


@pytest.mark.parametrize("i", [0, 1, 7, 12, 13, 30])
def test_month_back(months, i):
    got = chosen(months, [cal.is_month_back(d, i, "annee", "mois") for d in RUNS])
    assert got == [{back(d, i)} for d in RUNS]


def test_previous_year_and_current(months):
    got = chosen(months, [cal.in_previous_year_and_current(d, "annee", "mois") for d in RUNS])
    assert got == [
        {(d.year - 1, m) for m in range(1, 13)} | {(d.year, m) for m in range(1, d.month) if m != 7} for d in RUNS
    ]


def test_text_months_are_cast(spark):
    df = spark.createDataFrame([("2024", "03"), ("2024", "09")], "annee string, mois string")
    assert df.where(cal.in_last_six_months(date(2024, 8, 1))).collect() == [("2024", "03")]


def test_years():
    ref = date(2025, 8, 15)
    assert cal.previous_year(ref) == 2024
    assert cal.previous_year(ref, 4) == 2021
    assert cal.previous_years(ref) == ["2022", "2023", "2024"]
    assert cal.first_day_years_ago(ref) == "2022-01-01"


@pytest.mark.parametrize(
    ("month", "quarter"),
    [(1, "202312"), (3, "202312"), (4, "202403"), (6, "202403"), (7, "202406"), (9, "202406"), (10, "202409"), (12, "202409")],
)
def test_last_completed_quarter(month, quarter):
    assert cal.last_completed_quarter(date(2024, month, 1)) == quarter


def test_rolling_year():
    assert cal.rolling_year_start(date(2025, 8, 15)) == 20240815
    assert cal.rolling_year_start(date(2024, 2, 29)) == 20230228
    assert cal.rolling_year_end(date(2024, 3, 1)) == 20240229


def test_reference_date():
    assert cal.reference_date("2024-02-29") == date(2024, 2, 29)
    assert cal.reference_date(date(2024, 1, 1)) == date(2024, 1, 1)
    assert date.today() - cal.reference_date() <= timedelta(days=1)


def test_column_forms_agree_with_the_literals(spark):
    df = spark.createDataFrame([(d,) for d in RUNS], "d date")
    rows = df.select(
        "d",
        cal.last_completed_quarter_col("d").alias("q"),
        F.date_format(cal.first_day_years_ago_col("d"), "yyyy-MM-dd").alias("f"),
        cal.rolling_year_start_col("d").alias("s"),
        cal.rolling_year_end_col("d").alias("e"),
    ).collect()
    for r in rows:
        assert (r.q, r.f, r.s, r.e) == (
            cal.last_completed_quarter(r.d),
            cal.first_day_years_ago(r.d),
            cal.rolling_year_start(r.d),
            cal.rolling_year_end(r.d),
        )


def test_month_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([(2024, 3)], "annee int, mois int").write.parquet(path)
    plan = spark.read.parquet(path).where(cal.in_last_six_months(date(2024, 8, 1)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(annee,2024)" in text and "GreaterThanOrEqual(mois,3)" in text
