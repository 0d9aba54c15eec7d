"""Run-date literals and predicates.

Every function takes the run date, so that results can be repeated; the driver folds the dates to literals
and Catalyst pushes the predicates into the scan. Month arithmetic uses one running number,
``year * 12 + month - 1``.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from dropforge.functions.text import as_col


def reference_date(given: str | date | None = None) -> date:
    if given is None:
        return date.today()
    return given if isinstance(given, date) else date.fromisoformat(given)


def previous_year(ref: date, i: int = 1) -> int:
    return ref.year - i


def previous_years(ref: date, x: int = 3) -> list[str]:
    """The ``x`` years before the run year, oldest first, as text for ``isin``."""
    return [str(y) for y in range(ref.year - x, ref.year)]


def last_completed_quarter(ref: date) -> str:
    """``YYYYMM`` of the last month of the last complete quarter."""
    last = ref.year * 12 + (ref.month - 1) // 3 * 3 - 1
    return f"{last // 12}{last % 12 + 1:02d}"


def first_day_years_ago(ref: date, x: int = 3) -> str:
    return f"{ref.year - x}-01-01"


def yesterday(ref: date) -> date:
    return ref - timedelta(days=1)


def rolling_year_start(ref: date) -> int:
    """Same day last year as ``YYYYMMDD``; Feb 29 falls back to Feb 28."""
    leap = ref.month == 2 and ref.day == 29
    return int(ref.replace(year=ref.year - 1, day=28 if leap else ref.day).strftime("%Y%m%d"))


def rolling_year_end(ref: date) -> int:
    """Yesterday as ``YYYYMMDD``."""
    return int(yesterday(ref).strftime("%Y%m%d"))


def _in_months(first: int, last: int, year, month) -> Column:
    """Year and month columns inside a span of running month numbers.

    Written as one equality and one range per year, so that it can be pushed to a scan or prune partitions.
    """
    y, m = as_col(year).cast("int"), as_col(month).cast("int")
    spans = [
        (y == yy) & m.between(max(first - yy * 12, 0) + 1, min(last - yy * 12, 11) + 1)
        for yy in range(first // 12, last // 12 + 1)
    ]
    return reduce(or_, spans)


def in_last_six_months(ref: date, year="annee", month="mois") -> Column:
    """The run month and the five before it."""
    k = ref.year * 12 + ref.month - 1
    return _in_months(k - 5, k, year, month)


def in_remaining_months(ref: date, year="annee", month="mois") -> Column:
    """Months before the six-month window in the year the window starts in; none for a June run."""
    start = ref.year * 12 + ref.month - 1 - 5
    y, m = as_col(year).cast("int"), as_col(month).cast("int")
    return (y == start // 12) & m.between(1, start % 12)


def is_month_back(ref: date, i: int = 1, year="adec", month="mdec") -> Column:
    """Exactly ``i`` months before the run month."""
    k = ref.year * 12 + ref.month - 1 - i
    return _in_months(k, k, year, month)


def in_previous_year_and_current(ref: date, year="adec", month="mdec") -> Column:
    """The whole previous year, and the run year before the run month without July."""
    y, m = as_col(year).cast("int"), as_col(month).cast("int")
    return (y == ref.year - 1) | ((y == ref.year) & (m < ref.month) & (m != 7))


# Column forms of the run-date literals, for a run date held in the data.


def last_completed_quarter_col(d: Column | str) -> Column:
    return F.date_format(F.add_months(F.trunc(as_col(d), "quarter"), -1), "yyyyMM")


def first_day_years_ago_col(d: Column | str, x: int = 3) -> Column:
    return F.make_date(F.year(as_col(d)) - x, F.lit(1), F.lit(1))


def rolling_year_start_col(d: Column | str) -> Column:
    return F.date_format(F.add_months(as_col(d), -12), "yyyyMMdd").cast("int")


def rolling_year_end_col(d: Column | str) -> Column:
    return F.date_format(F.date_sub(as_col(d), 1), "yyyyMMdd").cast("int")
