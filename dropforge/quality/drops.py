"""Header check of drops against their declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropforge.sources.headers import Header, normalise, read_headers
from dropforge.sources.schemas import Source

_HEADERS = "file string, expected array<string>, headers array<string>"


def check_headers(headers: DataFrame) -> DataFrame:
    """Per file: counts, missing and extra columns, and whether all is well.

    Input has ``file``, and the ``expected`` and ``headers`` names as arrays. Blank names are ignored; repeated
    names count, but are compared as a set.
    """
    actual = F.filter("headers", lambda h: h != "")
    report = headers.select(
        "file",
        F.size("expected").alias("expected_count"),
        F.size(actual).alias("actual_count"),
        F.array_sort(F.array_except("expected", actual)).alias("missing"),
        F.array_sort(F.array_except(actual, F.col("expected"))).alias("extra"),
    )
    valid = (
        (F.col("expected_count") == F.col("actual_count"))
        & (F.size("missing") == 0)
        & (F.size("extra") == 0)
    )
    return report.withColumn("valid", valid)


def issues(report: DataFrame) -> DataFrame:
    """One row per issue of an invalid file."""
    count = F.concat(
        F.lit("Column count mismatch: expected "),
        F.col("expected_count").cast("string"),
        F.lit(", got "),
        F.col("actual_count").cast("string"),
    )
    found = F.array(
        F.when(F.col("expected_count") != F.col("actual_count"), count),
        F.when(F.size("missing") > 0, F.concat(F.lit("Missing columns: "), F.array_join("missing", ", "))),
        F.when(F.size("extra") > 0, F.concat(F.lit("Extra columns: "), F.array_join("extra", ", "))),
    )
    return report.select("file", F.explode(F.array_compact(found)).alias("issue"))


def header_report(
    spark: SparkSession, drops: dict[str, Source], headers: dict[str, Header] | None = None
) -> DataFrame:
    """``check_headers`` over the first line of each drop (path and source); open sources accept any header."""
    headers = headers or read_headers(spark, drops)
    rows = []
    for path, source in drops.items():
        names = [normalise(cell.strip()) for cell in headers[path][1] if cell.strip()]
        rows.append((path, source.columns if source.fields is not None else names, names))
    return check_headers(spark.createDataFrame(rows, _HEADERS))


def summary(report: DataFrame) -> DataFrame:
    """One row: total, valid and invalid files."""
    invalid = F.coalesce(F.sum((~F.col("valid")).cast("long")), F.lit(0))
    total = F.count(F.lit(1))
    return report.agg(
        total.alias("total"), (total - invalid).alias("valid"), invalid.alias("invalid")
    )


def require_valid(report: DataFrame) -> None:
    """Stop a run when a drop has another header than declared. Collects one row per issue of a drop."""
    found = issues(report).collect()
    if found:
        raise ValueError("; ".join(f"{row['file']}: {row['issue']}" for row in found))
