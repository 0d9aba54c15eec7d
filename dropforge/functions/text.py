"""Column expressions over codes and text dates. All are built-in Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the plain letters that stand for them, position by position.
ACCENTED = "éèêëàâäîïôöùûüçñÉÈÊËÀÂÄÎÏÔÖÙÛÜÇÑ"
PLAIN = "eeeeaaaiioouuucnEEEEAAAIIOOUUUCN"

# Anything but letters and digits of any script.
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_first_to_iso(c: Column | str) -> Column:
    """``DD?MM?YYYY`` by position to ``YYYY-MM-DD``; blank gives ``'--'``, null stays null."""
    c = as_col(c)
    return F.concat(
        F.substring(c, 7, 4), F.lit("-"), F.substring(c, 4, 2), F.lit("-"), F.substring(c, 1, 2)
    )


def day_first_to_month(c: Column | str) -> Column:
    """``DD?MM?YYYY`` to ``YYYYMM``; blank gives ``''``."""
    c = as_col(c)
    return F.concat(F.substring(c, 7, 4), F.substring(c, 4, 2))


def visit_timestamp(c: Column | str) -> Column:
    """Ten-character day-first text to ``YYYY-MM-DD 00:00:00``; any other length is left as it is."""
    c = as_col(c)
    return F.when(F.length(c) == 10, F.concat(day_first_to_iso(c), F.lit(" 00:00:00"))).otherwise(c)


def to_iso(c: Column | str) -> Column:
    """ISO text from either day-first or ISO text, told apart by where the first separator stands."""
    c = as_col(c)
    return F.when(c.rlike(r"^\d{2}\D\d{2}\D\d{4}"), day_first_to_iso(c)).otherwise(c)


def pad_if_length(c: Column | str, n: int) -> Column:
    """Put one zero before a code that is exactly ``n`` long (not a general left pad)."""
    c = as_col(c)
    return F.when(F.length(c) == n, F.concat(F.lit("0"), c)).otherwise(c)


def department_of_commune(c: Column | str) -> Column:
    """Three characters for overseas communes, two elsewhere."""
    c = as_col(c)
    return F.when(c >= "97000", F.substring(c, 1, 3)).otherwise(F.substring(c, 1, 2))


def date_from_parts(year, month, day, *, lenient: bool = False) -> Column:
    """``DATE`` from integer parts. Strict by default: an impossible day fails the query."""
    text = F.concat(
        as_col(year).cast("string"),
        F.lit("-"),
        F.lpad(as_col(month).cast("string"), 2, "0"),
        F.lit("-"),
        F.lpad(as_col(day).cast("string"), 2, "0"),
    )
    return text.try_cast("date") if lenient else text.cast("date")


def iif(condition: Column, when_true, when_false) -> Column:
    return F.when(condition, when_true).otherwise(when_false)


def slug(c: Column | str, max_length: int | None = 63) -> Column:
    """Value form of the header rule: plain letters, lower case, other characters folded to ``_``."""
    words = F.regexp_replace(F.lower(F.translate(as_col(c), ACCENTED, PLAIN)), BETWEEN_WORDS, "_")
    name = F.btrim(words, F.lit("_"))
    return name if max_length is None else F.substring(name, 1, max_length)


def split_pipe(c: Column | str, *, trim: bool = False) -> Column:
    """Array of pipe-separated items; ``explode`` it for one row per item (null text gives no row)."""
    items = F.split(as_col(c), r"\|", -1)
    return F.transform(items, lambda item: F.trim(item)) if trim else items
