"""The column and run-date expressions as SQL functions, for those who query the views in SQL.

They are temporary SQL functions: Spark replaces a call by its body, so nothing leaves the JVM and a run date
given as a literal is folded. ``ref`` is today where it is not given; arguments may be named
(``in_last_six_months(annee, mois, ref => DATE '2025-08-15')``). The text dates they give compare with text.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_REF = "ref DATE DEFAULT current_date()"


def _in_months(first: str, last: str) -> str:
    """Condition on ``y`` and ``m`` between two dates; at most two years, one range each."""
    return (
        f"(y = year({first}) AND m >= month({first}) AND (year({first}) < year({last}) OR m <= month({last})))"
        f" OR (y = year({last}) AND year({first}) < year({last}) AND m BETWEEN 1 AND month({last}))"
    )


FUNCTIONS: dict[str, tuple[str, str, str]] = {  # name: parameters, result, body
    "day_first_to_iso": (
        "c STRING", "STRING", "substr(c, 7, 4) || '-' || substr(c, 4, 2) || '-' || substr(c, 1, 2)",
    ),
    "day_first_to_month": ("c STRING", "STRING", "substr(c, 7, 4) || substr(c, 4, 2)"),
    "visit_timestamp": (
        "c STRING", "STRING",
        "CASE WHEN length(c) = 10 THEN substr(c, 7, 4) || '-' || substr(c, 4, 2) || '-' || substr(c, 1, 2)"
        " || ' 00:00:00' ELSE c END",
    ),
    "pad_if_length": ("c STRING, n INT", "STRING", "CASE WHEN length(c) = n THEN '0' || c ELSE c END"),
    "department_of_commune": ("c STRING", "STRING", "substr(c, 1, CASE WHEN c >= '97000' THEN 3 ELSE 2 END)"),
    "split_pipe": ("c STRING", "ARRAY<STRING>", "split(c, '[|]', -1)"),
    "previous_year": (f"i INT DEFAULT 1, {_REF}", "INT", "year(ref) - i"),
    "previous_years": (
        f"x INT DEFAULT 3, {_REF}", "ARRAY<STRING>", "CAST(sequence(year(ref) - x, year(ref) - 1) AS ARRAY<STRING>)",
    ),
    "last_completed_quarter": (_REF, "STRING", "date_format(add_months(trunc(ref, 'quarter'), -1), 'yyyyMM')"),
    "first_day_years_ago": (f"x INT DEFAULT 3, {_REF}", "STRING", "(year(ref) - x) || '-01-01'"),
    "yesterday": (_REF, "STRING", "CAST(date_sub(ref, 1) AS STRING)"),
    "rolling_year_start": (_REF, "INT", "CAST(date_format(add_months(ref, -12), 'yyyyMMdd') AS INT)"),
    "rolling_year_end": (_REF, "INT", "CAST(date_format(date_sub(ref, 1), 'yyyyMMdd') AS INT)"),
    "in_last_six_months": (f"y INT, m INT, {_REF}", "BOOLEAN", _in_months("add_months(ref, -5)", "ref")),
    "in_remaining_months": (
        f"y INT, m INT, {_REF}", "BOOLEAN",
        "y = year(add_months(ref, -5)) AND m BETWEEN 1 AND month(add_months(ref, -5)) - 1",
    ),
    "is_month_back": (
        f"y INT, m INT, i INT DEFAULT 1, {_REF}", "BOOLEAN",
        "y = year(add_months(ref, -i)) AND m = month(add_months(ref, -i))",
    ),
    "in_previous_year_and_current": (
        f"y INT, m INT, {_REF}", "BOOLEAN",
        "y = year(ref) - 1 OR (y = year(ref) AND m < month(ref) AND m <> 7)",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Create all functions in the session; gives their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
