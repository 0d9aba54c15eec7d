from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dropforge.functions import text
from dropforge.sources.headers import normalise


def test_day_first_to_iso(evaluate):
    got = evaluate(text.day_first_to_iso, "31-12-2024", "31/12/2024", "2024-12-31", "", None, "31-12-202")
    assert got == ["2024-12-31", "2024-12-31", "2-31-4--20", "--", None, "202-12-31"]


def test_day_first_to_month(evaluate):
    assert evaluate(text.day_first_to_month, "31-12-2024", "", None) == ["202412", "", None]


def test_visit_timestamp_touches_ten_characters_only(evaluate):
    got = evaluate(text.visit_timestamp, "31-12-2024", "2024-12-31 08:15:00", "", None, "31-12-24")
    assert got == ["2024-12-31 00:00:00", "2024-12-31 08:15:00", "", None, "31-12-24"]


def test_to_iso_takes_both_shapes(evaluate):
    assert evaluate(text.to_iso, "31/12/2024", "2024-12-31", "", None) == ["2024-12-31", "2024-12-31", "", None]


def test_pad_if_length(evaluate):
    got = evaluate(lambda c: text.pad_if_length(c, 8), "12345678", "123456789", "1234567", "", "   ", None)
    assert got == ["012345678", "123456789", "1234567", "", "   ", None]


def test_department_of_commune(evaluate):
    got = evaluate(text.department_of_commune, "01004", "2A004", "97105", "98818", "", None)
    assert got == ["01", "2A", "971", "988", "", None]


def test_date_from_parts(spark):
    df = spark.createDataFrame([(2024, 2, 29), (2023, 2, 29), (2024, 0, 1), (2024, 1, 0)], "y int, m int, d int")
    got = [r[0] for r in df.select(text.date_from_parts("y", "m", "d", lenient=True)).collect()]
    assert got == [date(2024, 2, 29), None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(text.date_from_parts("y", "m", "d")).collect()


def test_iif_takes_the_second_value_on_null(evaluate):
    assert evaluate(lambda c: text.iif(F.col(c) == "a", F.lit(1), F.lit(2)), "a", "b", None) == [1, 2, 2]


def test_split_pipe(spark, texts):
    def rows(trim):
        df = texts("a|b", "a| b ", "a||b", "a|", "", None)
        return [r[0] for r in df.select(F.explode(text.split_pipe("c", trim=trim))).collect()]

    assert rows(False) == ["a", "b", "a", " b ", "a", "", "b", "a", "", ""]
    assert rows(True) == ["a", "b", "a", "b", "a", "", "b", "a", "", ""]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZ09_ -°'/éÉçÑœß²\t.", max_size=80), min_size=1, max_size=30))
def test_slug_is_the_header_rule(evaluate, names):
    assert evaluate(text.slug, *names) == [normalise(n) for n in names]
