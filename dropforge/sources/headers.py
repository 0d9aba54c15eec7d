"""Header rules: delimiter, column names, and the header line of a drop.

Headers are one line per drop, so names are worked out on the driver; rows never are.
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from dropforge.functions.text import ACCENTED, PLAIN, as_col
from dropforge.sources.schemas import Source

MAX_NAME = 63
# Candidate delimiters, the first one winning a tie, and the one taken where none occurs.
DELIMITERS = (",", ";", "¤", "\t")
DEFAULT_DELIMITER = ","
# Lower-case accented letters that count twice where names are measured in bytes.
TWO_BYTE = "àâäéèêëîïôöùûüç"

_UNACCENT = str.maketrans(ACCENTED, PLAIN)
_BOM = "﻿"


def normalise(name: str) -> str:
    """ASCII letters for accents, lower case, ``_`` for anything but letters and digits, cut to 63."""
    plain = name.translate(_UNACCENT).lower()
    return "_".join(part for part in re.split(r"[\W_]+", plain) if part)[:MAX_NAME]


def column_names(headers) -> list[str]:
    """Normalised, distinct names for a header row.

    A repeated name gets ``_1``, ``_2``, … and gives up its last characters where the suffix would pass 63.
    A blank header is named by its position.
    """
    taken: set[str] = set()
    repeats: dict[str, int] = {}
    out = []
    for position, header in enumerate(headers, 1):
        base = normalise(header) or f"column{position}"
        name = base
        while name in taken:
            repeats[base] = repeats.get(base, 0) + 1
            suffix = f"_{repeats[base]}"
            name = base[: MAX_NAME - len(suffix)] + suffix
        taken.add(name)
        out.append(name)
    return out


def reduce_name(name: str, size: int = MAX_NAME, *, byte_aware: bool = False) -> str:
    """Name as the catalog holds it: cut to ``size`` with accented letters counted twice and a doubled
    apostrophe once, or only stripped where names are not cut."""
    if not byte_aware:
        return name.strip()
    kept, used = [], 0
    for unit in re.findall("''|.", name, re.DOTALL):
        if used >= size:
            break
        kept.append(unit)
        used += 2 if unit in TWO_BYTE else 1
    return "".join(kept)


def reduce_text(text: Column | str, size: int = MAX_NAME) -> Column:
    """``reduce_name(byte_aware=True)`` of a column."""
    # No more than that many characters can be kept.
    units = F.regexp_extract_all(F.left(as_col(text), F.lit(2 * size)), F.lit("(?s)(''|.)"), 1)

    def add(held, unit):
        width = F.when(unit.isin(*TWO_BYTE), 2).otherwise(1)
        more = F.struct(F.concat(held["text"], unit).alias("text"), (held["used"] + width).alias("used"))
        return F.when(held["used"] >= size, held).otherwise(more)

    return F.aggregate(units, F.struct(F.lit("").alias("text"), F.lit(0).alias("used")), add)["text"]


def first_line(text: Column | str) -> Column:
    """First line of a text that is not blank."""
    # Anchored to line starts, so that long blank lines are looked at once.
    return F.regexp_extract(as_col(text), r"(?m)^([^\r\n]*\S[^\r\n]*)", 1)


def guess_delimiter(line: Column | str) -> Column:
    """The candidate that occurs most often in a line; the earlier one on a tie, ``,`` where none occurs."""
    line = as_col(line)
    counts = [F.length(line) - F.length(F.replace(line, F.lit(d), F.lit(""))) for d in DELIMITERS]
    best = F.greatest(*counts)
    pick = F.when(best == 0, DEFAULT_DELIMITER)
    for count, d in zip(counts, DELIMITERS):
        pick = pick.when(count == best, d)
    return pick


Header = tuple[str, list[str]]  # delimiter and raw cells


def read_header(spark: SparkSession, path: str, source: Source) -> Header:
    """Header of a drop. Reads its first line that is not blank, and stops there."""
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
    head = lines.select("value", guess_delimiter("value").alias("sep")).head(1)
    if not head:
        return source.sep or DEFAULT_DELIMITER, []
    sep = source.sep or head[0]["sep"]
    if source.multiline and head[0]["value"].count('"') % 2:
        # A quoted header cell goes on in the next line.
        record = csv_options(spark.read, sep, multiline=True).csv(path).head(1)
        return sep, [cell or "" for cell in record[0]]
    return sep, next(csv.reader([head[0]["value"].lstrip(_BOM)], delimiter=sep), [])


def read_headers(spark: SparkSession, drops: dict[str, Source], at_once: int = 4) -> dict[str, Header]:
    """Headers of several drops, given as path and source."""
    with ThreadPoolExecutor(at_once) as pool:
        headers = pool.map(lambda drop: read_header(spark, *drop), drops.items())
        return dict(zip(drops, headers))


def csv_options(reader: DataFrameReader, sep: str, *, multiline: bool) -> DataFrameReader:
    """Quotes are doubled inside quotes."""
    return reader.option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", multiline)
