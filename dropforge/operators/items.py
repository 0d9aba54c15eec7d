"""Rows out of separated text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.functions.text import split_pipe


def pipe_items(df: DataFrame, column: str, out: str, *, keep=(), trim: bool = False) -> DataFrame:
    """One row per pipe-separated item of ``column``, with the ``keep`` columns. Null text gives no row, blank
    text one blank item."""
    return df.select(*keep, F.explode(split_pipe(column, trim=trim)).alias(out))
