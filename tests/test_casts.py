from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.functions import casts


def test_numbers(evaluate):
    values = ["12", "12.9", "-3.7", "nan", "", None, "abc", "NaN", "Infinity", "1e3", "99999999999", " 7 "]
    assert evaluate(casts.cast_number, *values) == [12, 12, -3, 0, 0, 0, 0, 0, 0, 1000, 0, 7]
    assert evaluate(casts.cast_number, "7d", "1.5f", "0x1p3", "12,5", "1e999", ".5", "5.", "+3") == [0, 0, 0, 0, 0, 0, 5, 3]
    assert evaluate(lambda c: casts.cast_number(c, "bigint"), "99999999999", "5.5") == [99999999999, 5]
    assert evaluate(lambda c: casts.cast_number(c, "float"), "12.5", "", None) == [12.5, 0.0, 0.0]


def test_booleans(evaluate):
    values = ["true", "False", "1", "y", "N", "maybe", "tRuE", "", None, "nan", "0", "YES", "T"]
    want = [True, False, True, True, False, False, False, False, False, False, False, True, True]
    assert evaluate(casts.cast_bool, *values) == want


def test_dates(evaluate):
    got = evaluate(casts.cast_date, "31-12-2024", "2024-12-31", "", None, "31-02-2024", "1-2-2024", "31/12/2024")
    assert got == [date(2024, 12, 31), None, None, None, None, date(2024, 2, 1), None]


def test_text(evaluate):
    assert evaluate(lambda c: casts.cast_text(c, 3), "éàüx", "", None, "ab") == ["éàü", "", "", "ab"]
    assert evaluate(casts.cast_text, "long enough", None) == ["long enough", ""]


def test_other_types_are_tried(evaluate):
    field = T.StructField("c", T.TimestampType())
    got = evaluate(lambda c: casts.cast_to(field, F.col(c)).cast("string"), "2024-01-01 10:00:00", "no")
    assert got == ["2024-01-01 10:00:00", None]


def test_unmapped_booleans(texts):
    got = casts.unmapped_booleans(texts("true", "maybe", "maybe", "tRuE", None, ""), "c").collect()
    assert sorted(r[0] for r in got) == ["maybe", "tRuE"]


def test_cast_failures(spark):
    df = spark.createDataFrame(
        [("1", "maybe", "x"), ("x", "true", "31-12-2024"), ("", "", ""), (None, None, None), ("99999999999", "no", "1-1-2024")],
        "n string, b string, d string",
    )
    fields = [
        T.StructField("n", T.IntegerType()),
        T.StructField("b", T.BooleanType()),
        T.StructField("d", T.DateType()),
        T.StructField("t", T.StringType()),
    ]
    assert dict(casts.cast_failures(df, fields).collect()) == {"n": 2, "b": 1, "d": 1}
    assert dict(casts.cast_failures(df.limit(0), fields).collect()) == {"n": 0, "b": 0, "d": 0}
