"""Reading the given tables and cutting lineage with written ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dropforge.session import scratch

LAST_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: later steps survive lost executors and never recompute it."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_id(col: str = "doc_id") -> Column:
    """The id as a number to order by; a row without an id comes after all others."""
    return F.coalesce(F.col(col).cast("long"), F.lit(LAST_ID))


def whole_text(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads, as far as the planner knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.length())]
    return sum(s for s in sizes if s < 2**60)  # rows without files have no known size


def blocks_for(df: DataFrame, bytes_per_block: int, least: int = 1) -> int:
    """Groups to deal the rows of ``df`` to, so that each holds about ``bytes_per_block`` of its input."""
    return max(least, -(-input_bytes(df) // bytes_per_block))


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame, leave_out: tuple[str, ...] = ()) -> Column:
    """All columns as one struct, so that none of them can clash with what an operator adds."""
    return F.struct(*[quoted(c).alias(c) for c in df.columns if c not in leave_out])


def unpacked(df: DataFrame, row: str, *added: str) -> DataFrame:
    """The columns of a struct made by ``whole_row``, and added ones beside them."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in df.schema[row].dataType.names], *added)
