"""Left lookups on derived keys.

No side is hinted. A reference table is broadcast when its size is known to be under
``spark.sql.autoBroadcastJoinThreshold``, by the file statistics at planning or by the measured shuffle at run
time; past it the join is a sort-merge join, and adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(facts: DataFrame, key: Column | str, table: DataFrame, table_key: str, **picks: str) -> DataFrame:
    """Left equi join of ``facts`` to ``table`` on a column or an expression of ``facts``.

    ``picks`` maps output names to columns of ``table``; a key held by several rows repeats the fact, a missing
    key gives nulls. The output is the columns of ``facts`` followed by the picks.
    """
    right = table.select(
        F.col(table_key).alias("_table_key"), *[F.col(c).alias(f"_pick_{out}") for out, c in picks.items()]
    )
    on = (F.col(key) if isinstance(key, str) else key) == F.col("_table_key")
    return facts.join(right, on, "left").select(
        *facts.columns, *[F.col(f"_pick_{out}").alias(out) for out in picks]
    )


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row aggregates put into one row; their columns must have different names."""
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
