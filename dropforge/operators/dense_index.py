"""Dense 1..n row index without an unpartitioned sort.

``row_number()`` over a window without partitions sends every row to one task. Here the rows are put in the
order of a digest of their values, whose leading hex digits name a fixed number of even buckets:

1. identical rows are counted first (partial aggregation on the map side), so a group of copies, however
   large, is a few counted rows before the shuffle. A count above ``chunk`` is split into chunks with digests
   of their own, which lets the copies of one row end up in many buckets;
2. the sizes of at most ``16 ** digits`` buckets are summed up in order; that table is broadcast, its size
   being bounded by the digits and not by the data;
3. inside each bucket a window gives every counted row its start, and ``explode`` restores the copies.

The order is total over the values, so the index is the same on every run and after a lost executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 4
CHUNK = 100_000
MOST_DIGITS = 5

_NULL = "\u0000"  # stands for null in a digest
_SEP = "\u001f"


def _digest(columns, chunk):
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in columns]
    return F.md5(F.concat_ws(_SEP, *parts, F.col(chunk).cast("string")))


def dense_index(df: DataFrame, name: str = "index", *, digits: int = DIGITS, chunk: int = CHUNK) -> DataFrame:
    """Add ``name``, a bigint 1..n in an order fixed by the row values. Columns must be orderable.

    Copies of one row have neighbouring numbers up to ``chunk`` of them; more are numbered in several runs. The
    table of bucket sizes is summed in one task and broadcast, so ``digits`` may be ``MOST_DIGITS`` at most.
    """
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"digits must be from 1 to {MOST_DIGITS}")
    columns = df.columns
    order = [F.col(c) for c in columns]

    counted = (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {chunk}"))))
        .withColumn("_size", F.least(F.lit(chunk), F.col("_copies") - F.col("_chunk") * chunk))
        .withColumn("_bucket", F.substring(_digest(columns, "_chunk"), 1, digits))
    )

    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counted.groupBy("_bucket")
        .agg(F.sum("_size").alias("_rows"))
        # At most 16 ** digits rows, whatever the size of the input.
        .select("_bucket", F.coalesce(F.sum("_rows").over(running), F.lit(0)).alias("_before"))
    )

    inside = (
        Window.partitionBy("_bucket")
        .orderBy(*order, "_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_before") + F.col("_in_bucket") + 1
    return (
        counted.withColumn("_in_bucket", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_bucket")
        .select(F.explode(F.sequence(first, first + F.col("_size") - 1)).alias(name), *order)
    )
