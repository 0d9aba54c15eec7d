"""Casts from landed text, and what could not be cast.

Blank, null and ``nan`` have a defined value for every type, so none of these fail a load; the values that
were not understood are reported by ``unmapped_booleans`` and ``cast_failures``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.functions.text import as_col
from dropforge.sources.schemas import MAX_LENGTH

# The tokens read as true and as false. They are listed, not case-folded.
TRUE_TOKENS = ("true", "True", "TRUE", "1", "yes", "Yes", "YES", "y", "Y", "t", "T")
FALSE_TOKENS = ("false", "False", "FALSE", "0", "no", "No", "NO", "n", "N", "f", "F", "", "nan", "NaN", "NAN")
# Number text that counts as zero, besides null.
ZERO_TOKENS = ("", "nan")

# Day and month may be written with one digit.
DROP_DATE = "d-M-yyyy"


# A decimal number; the cast alone would also take ``7d``, ``0x1p3`` and ``Infinity``.
_DECIMAL = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _finite(c: Column) -> Column:
    """Double value of a text; null when it is no finite number."""
    d = F.when(c.rlike(_DECIMAL), c.try_cast("double"))
    return F.when(F.abs(d) < float("inf"), d)


def cast_number(c: Column | str, kind: str = "int") -> Column:
    """Null, blank, ``nan`` and unreadable text are 0; fractions are cut toward zero for integer kinds."""
    value = _finite(as_col(c)).try_cast(kind)
    return F.coalesce(value, F.lit(0).cast(kind))


def cast_bool(c: Column | str) -> Column:
    return F.coalesce(as_col(c).isin(*TRUE_TOKENS), F.lit(False))


def cast_date(c: Column | str, pattern: str = DROP_DATE) -> Column:
    """Date by pattern; unreadable text is null."""
    return F.to_date(F.try_to_timestamp(as_col(c), F.lit(pattern)))


def cast_text(c: Column | str, max_length: int | None = None) -> Column:
    c = F.coalesce(as_col(c).cast("string"), F.lit(""))
    return F.substring(c, 1, max_length) if max_length else c


def cast_to(field: T.StructField, c: Column) -> Column:
    """The cast rule of a declared field."""
    kind = field.dataType
    if isinstance(kind, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        return cast_number(c, kind.simpleString())
    if isinstance(kind, T.BooleanType):
        return cast_bool(c)
    if isinstance(kind, T.DateType):
        return cast_date(c)
    if isinstance(kind, T.StringType):
        return cast_text(c, field.metadata.get(MAX_LENGTH))
    return c.try_cast(kind)


def fails_cast(field: T.StructField, c: Column) -> Column:
    """True where a non-blank text is not understood by the rule of its field."""
    kind = field.dataType
    if isinstance(kind, T.StringType):
        return F.lit(False)
    if isinstance(kind, T.BooleanType):
        return c.isNotNull() & ~c.isin(*TRUE_TOKENS, *FALSE_TOKENS)
    blank = c.isNull() | c.isin(*ZERO_TOKENS)
    if isinstance(kind, (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)):
        return ~blank & _finite(c).try_cast(kind).isNull()
    if isinstance(kind, T.DateType):
        return ~blank & cast_date(c).isNull()
    return ~blank & c.try_cast(kind).isNull()


def unmapped_booleans(df: DataFrame, column: str) -> DataFrame:
    """Distinct texts outside both token lists; they are cast to false."""
    c = F.col(column)
    return df.where(c.isNotNull() & ~c.isin(*TRUE_TOKENS, *FALSE_TOKENS)).select(column).distinct()


def cast_failures(df: DataFrame, fields) -> DataFrame:
    """One row per non-text field with the number of texts its rule did not understand; one scan."""
    fields = [f for f in fields if not isinstance(f.dataType, T.StringType) and f.name in df.columns]
    counts = df.agg(
        *[F.sum(fails_cast(f, F.col(f.name)).cast("long")).alias(f.name) for f in fields]
    )
    return counts.unpivot([], [f.name for f in fields], "column_name", "failures").select(
        "column_name", F.coalesce("failures", F.lit(0)).alias("failures")
    )
