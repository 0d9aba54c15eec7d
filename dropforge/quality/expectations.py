"""Expectations on a relation. Each gives the violations; an empty result is a pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.functions.formats import digit_regex, spark_pattern
from dropforge.sources.headers import reduce_name

# Type families and the Spark types in them.
FAMILIES = {
    "INTEGER": (T.IntegerType, T.LongType, T.ShortType, T.ByteType),
    "VARCHAR": (T.StringType, T.VarcharType, T.CharType),
    "FLOAT": (T.FloatType, T.DoubleType, T.DecimalType),
    "DATE": (T.DateType,),
    "BOOLEAN": (T.BooleanType,),
}
BOOLEAN_TEXTS = ("true", "false")


def _field(df: DataFrame, column: str) -> T.StructField | None:
    """Field by name, without regard to case."""
    wanted = reduce_name(column).lower()
    return next((f for f in df.schema.fields if f.name.lower() == wanted), None)


def _not_bool(df: DataFrame, column: str) -> Column:
    field, c = _field(df, column), F.col(column)
    if isinstance(field.dataType, T.BooleanType):
        return F.lit(False)
    return c.isNotNull() & ~F.lower(c.cast("string")).isin(*BOOLEAN_TEXTS)


def _formatted(df: DataFrame, column: str, fmt: str) -> Column:
    field, c = _field(df, column), F.col(column)
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, spark_pattern(fmt))
    return c.cast("string")


def _not_format(df: DataFrame, column: str, fmt: str) -> Column:
    """Nulls pass, blanks do not."""
    text = _formatted(df, column, fmt)
    return text.isNotNull() & ~text.rlike(digit_regex(fmt))


def expect_bool(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is neither true, false nor null."""
    return df.where(_not_bool(df, column))


def expect_date_format(df: DataFrame, column: str, fmt: str = "YYYY-MM-DD") -> DataFrame:
    """Raw and formatted value of the rows that do not have the format."""
    return df.where(_not_format(df, column, fmt)).select(
        F.col(column).cast("string").alias("raw_value"), _formatted(df, column, fmt).alias("formatted_value")
    )


def expect_column(df: DataFrame, column: str) -> DataFrame:
    """One row if the relation has no such column."""
    missing = [] if _field(df, column) else [(reduce_name(column),)]
    return df.sparkSession.createDataFrame(missing, "missing_column string")


def type_violation(df: DataFrame, column: str, family: str) -> tuple[str, str, str, str] | None:
    field = _field(df, column)
    if field is None or isinstance(field.dataType, FAMILIES[family]):
        return None
    actual = field.dataType.simpleString()
    # Fixed value: the wording of the message.
    message = f"La colonne {field.name} a un type différent de {family} (trouvé: {actual})"
    return field.name, actual, family, message


def expect_type(df: DataFrame, column: str, family: str) -> DataFrame:
    """One row if the column is of another type family; a missing column is no violation of this one."""
    found = type_violation(df, column, family)
    return df.sparkSession.createDataFrame(
        [found] if found else [], "column_name string, actual_type string, expected_type string, message string"
    )


@dataclass(frozen=True)
class Expectation:
    """``kind`` is ``bool``, ``date_format``, ``column`` or ``type``; ``detail`` a date format or a family."""

    kind: str
    column: str
    detail: str | None = None


def violation_columns(df: DataFrame, suite: list[Expectation]) -> list[Column]:
    """Aggregates over ``df``, one per expectation: how many rows break it.

    A missing column or a wrong type concerns every row, so it counts all of them.
    """

    def broken(e: Expectation) -> Column:
        if e.kind == "column":
            return F.lit(_field(df, e.column) is None)
        if e.kind == "type":
            return F.lit(type_violation(df, e.column, e.detail) is not None)
        if e.kind == "bool":
            return _not_bool(df, e.column)
        return _not_format(df, e.column, e.detail or "YYYY-MM-DD")

    return [F.coalesce(F.sum(broken(e).cast("long")), F.lit(0)) for e in suite]


def violation_counts(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """Violations of a whole suite in one scan of the columns it checks."""
    counts = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(violation_columns(df, suite))])
    rows = [
        F.struct(
            F.lit(e.kind).alias("expectation"),
            F.lit(e.column).alias("column_name"),
            F.lit(e.detail or "").alias("detail"),
            F.col(f"_{i}").alias("violations"),
        )
        for i, e in enumerate(suite)
    ]
    return counts.select(F.inline(F.array(*rows)))


def repeated_keys(df: DataFrame, *key: str) -> DataFrame:
    """Key values held by several rows, with their number."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
