"""Delimited drops to conformed DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.functions.casts import cast_to, fails_cast
from dropforge.session import size_of
from dropforge.sources.headers import Header, column_names, csv_options, read_header
from dropforge.sources.ranges import read_lines, records
from dropforge.sources.schemas import MAX_LENGTH, Source

MALFORMED = "_malformed"


def read_text(spark: SparkSession, path: str, source: Source, header: Header | None = None) -> DataFrame:
    """The drop as text columns under normalised names, with ``_malformed`` holding rows of another width.

    The header is skipped by position and its names are applied here, so repeated and accented headers never
    reach the CSV reader. ``header`` saves reading it again. A drop with quoted newlines that is larger than a scan split
    is read by ranges (``dropforge.sources.ranges``), a smaller one by the CSV reader in one task per file: the rows are
    the same.
    """
    sep, cells = header or read_header(spark, path, source)
    names = column_names(cells)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, MALFORMED]])
    if source.multiline and size_of(spark, path) > spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes():
        split = read_by_ranges(spark, path, sep, schema)
        if split is not None:
            return split
    reader = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", MALFORMED)
    # The width of a row is judged by the columns that are read, so all of them are.
    reader = reader.option("columnPruning", False)
    return csv_options(reader, sep, multiline=source.multiline).csv(path)


def read_by_ranges(spark: SparkSession, path: str, sep: str, schema: T.StructType) -> DataFrame | None:
    """``read_text`` of files with quoted newlines, by all cores; None where lines end with carriage returns alone.

    All files of a drop end their lines alike.
    """
    head = read_lines(spark, path).select("line").head()
    line = head["line"] if head else ""
    if "\r" in line[:-1]:
        return None
    found = records(spark, path, sep).where(~F.col("first"))
    read = F.col("record")
    if line.endswith("\r"):
        # In fields a line end is a newline; rejected rows stay as they are in the drop.
        found = found.withColumn("record", F.when(read.endswith("\r"), F.left(read, F.length(read) - 1)).otherwise(read))
        read = F.replace(read, F.lit("\r\n"), F.lit("\n"))
    options = {"sep": sep, "quote": '"', "escape": '"', "columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    named = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = found.select("record", F.from_csv(read, named, options).alias("row"))
    malformed = F.when(F.col("row")[MALFORMED].isNotNull(), F.col("record"))
    return parsed.select(*[F.col("row").getField(f.name).alias(f.name) for f in schema.fields[:-1]], malformed.alias(MALFORMED))


def conform(df: DataFrame, source: Source) -> DataFrame:
    """Cast to the declared fields in one projection.

    Columns that were not declared are left out and declared columns the drop lacks get the value of a blank;
    ``dropforge.quality.drops`` reports both. A source without declared columns keeps all of them as text.
    """
    if source.fields is None:
        source = source.with_columns([c for c in df.columns if c != MALFORMED])
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            cast_to(f, F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None).cast("string"))
            .alias(f.name, metadata=f.metadata)
            for f in source.fields
        ]
    )


def read_source(spark: SparkSession, path: str, source: Source, header: Header | None = None) -> DataFrame:
    """The conformed rows of a drop that are as wide as its header."""
    return conform(good_rows(read_text(spark, path, source, header)), source)


def malformed_rows(df: DataFrame) -> DataFrame:
    """Raw text of the rows of ``read_text`` that were shorter or longer than the header."""
    # Always true: Spark refuses a query that names the malformed text alone.
    named = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in df.columns if c != MALFORMED])) >= 0
    return df.where(F.col(MALFORMED).isNotNull() & named).select(MALFORMED)


def good_rows(df: DataFrame) -> DataFrame:
    """The rows of ``read_text`` that are as wide as the header."""
    return df.where(F.col(MALFORMED).isNull()) if df.columns != [MALFORMED] else df  # an empty file


def fault_counts(df: DataFrame, source: Source) -> dict[str, Column]:
    """Aggregates over ``read_text`` by name: ``rows``, ``malformed``, and by kind and column what a load can't use.

    ``failed_cast`` counts numbers and dates that were not understood, ``unmapped_boolean`` texts outside the token
    lists, ``cut_text`` texts longer than their declared length; malformed rows are not looked into.
    """
    if df.columns == [MALFORMED]:
        return {"rows": F.sum(F.lit(0)), "malformed": F.sum(F.lit(0))}
    good = F.col(MALFORMED).isNull()
    counts = {"rows": F.sum(good.cast("long")), "malformed": F.sum((~good).cast("long"))}
    present = {c.lower(): c for c in df.columns}
    for field in source.fields or ():
        if field.name.lower() not in present:
            continue
        c = F.col(f"`{present[field.name.lower()]}`")
        if isinstance(field.dataType, T.StringType):
            most = field.metadata.get(MAX_LENGTH)
            if not most:
                continue
            kind, fault = "cut_text", F.coalesce(F.length(c) > most, F.lit(False))
        else:
            kind = "unmapped_boolean" if isinstance(field.dataType, T.BooleanType) else "failed_cast"
            fault = fails_cast(field, c)
        counts[f"{kind}:{field.name}"] = F.sum((good & fault).cast("long"))
    return counts
