"""Queries on single operators over the given tables, and their SQL."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.functions import calendar as cal
from dropforge.functions import casts, text
from dropforge.functions.sql import register
from dropforge.operators.dense_index import dense_index
from dropforge.operators.factored import Factored
from dropforge.operators.items import pipe_items
from dropforge.operators.joins import one_row
from dropforge.operators.profile_state import keep_state, profile_of_history
from dropforge.operators.stable_index import COPY, ROW
from dropforge.plans import Views
from dropforge.plans.deaths import NUMBERS, numbered
from dropforge.plans.missions import targets_and_missions
from dropforge.plans.profiles import KEPT
from dropforge.quality import drops as drop_checks
from dropforge.quality.expectations import (
    Expectation,
    expect_bool,
    expect_date_format,
    repeated_keys,
    violation_counts,
)
from dropforge.session import scratch
from dropforge.sinks.load import load_all, run
from dropforge.sinks.publish import copy_views, export_csv, export_views, row_counts
from dropforge.sinks.store import Store
from dropforge.sources.headers import first_line, guess_delimiter, reduce_text
from dropforge.sources.landing import newest_per_source
from dropforge.sources.reader import MALFORMED, good_rows, read_by_ranges, read_source
from dropforge.sources.schemas import SOURCES, Source
from dropforge.streaming.drops import load_new_drops
from harness.compare import TABLES
from harness.standins import reader, stand_in, stand_in_sql, table, with_sources
from harness.views import RUN_DATE, view_oracles

QUERIES = {}
SQL = {}


def check(sql: str | None = None, name: str | None = None):
    def keep(query):
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            SQL[key] = sql
        return query

    return keep


# ---- Run-date predicates, over the orders ----

SUMMER = date(1998, 8, 15)
SPRING = date(1998, 3, 10)
_MONTHS = "(SELECT *, CAST(YEAR(o_orderdate) AS INT) AS y, CAST(MONTH(o_orderdate) AS INT) AS m FROM orders)"


def _months(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumns({"y": F.year("o_orderdate"), "m": F.month("o_orderdate")})


def _calendar(name, predicate, where):
    """``predicate`` makes the Column when the query is built; ``where`` is the same condition written out."""

    def query(spark, sf_dir):
        return _months(spark, sf_dir).where(predicate()).select("o_orderkey", "y", "m")

    check(f"SELECT o_orderkey, y, m FROM {_MONTHS} WHERE {where}", name)(query)


def _pairs(*pairs):
    return " OR ".join(f"(y = {y} AND m = {m})" for y, m in pairs)


_calendar(
    "last_six_months", lambda: cal.in_last_six_months(SUMMER, "y", "m"),
    _pairs(*[(1998, m) for m in (3, 4, 5, 6, 7, 8)]),
)
_calendar(
    "last_six_months_over_new_year", lambda: cal.in_last_six_months(SPRING, "y", "m"),
    _pairs((1997, 10), (1997, 11), (1997, 12), (1998, 1), (1998, 2), (1998, 3)),
)
_calendar("remaining_months", lambda: cal.in_remaining_months(SUMMER, "y", "m"), "y = 1998 AND m IN (1, 2)")
_calendar(
    "remaining_months_over_new_year", lambda: cal.in_remaining_months(SPRING, "y", "m"),
    "y = 1997 AND m IN (1, 2, 3, 4, 5, 6, 7, 8, 9)",
)
_calendar("remaining_months_in_june", lambda: cal.in_remaining_months(date(1998, 6, 15), "y", "m"), "1 = 0")
_calendar("month_back", lambda: cal.is_month_back(SUMMER, 1, "y", "m"), _pairs((1998, 7)))
_calendar("month_back_over_new_year", lambda: cal.is_month_back(SPRING, 3, "y", "m"), _pairs((1997, 12)))
_calendar("month_back_two_years", lambda: cal.is_month_back(SPRING, 28, "y", "m"), _pairs((1995, 11)))
_calendar(
    "previous_year_and_current", lambda: cal.in_previous_year_and_current(date(1998, 10, 2), "y", "m"),
    "y = 1997 OR (y = 1998 AND m IN (1, 2, 3, 4, 5, 6, 8, 9))",
)
_calendar("previous_year", lambda: F.col("y") == cal.previous_year(SUMMER, 2), "y = 1996")
_calendar(
    "previous_years", lambda: F.col("y").cast("string").isin(cal.previous_years(SUMMER, 3)), "y IN (1995, 1996, 1997)"
)
_calendar(
    "until_last_quarter",
    lambda: F.date_format("o_orderdate", "yyyyMM") <= cal.last_completed_quarter(SUMMER), "y * 100 + m <= 199806",
)


def _day(number):
    return F.to_date(F.lit(str(number)), "yyyyMMdd")


_calendar(
    "rolling_year",
    lambda: (F.col("o_orderdate") >= _day(cal.rolling_year_start(SUMMER)))
    & (F.col("o_orderdate") < F.date_add(_day(cal.rolling_year_end(SUMMER)), 1)),
    "o_orderdate BETWEEN DATE '1997-08-15' AND DATE '1998-08-14'",
)
_calendar(
    "years_back_until_yesterday",
    lambda: (F.col("o_orderdate") >= F.lit(cal.first_day_years_ago(SUMMER, 3)).cast("date"))
    & (F.col("o_orderdate") < F.date_add(F.lit(cal.yesterday(SUMMER)), 1)),
    "o_orderdate BETWEEN DATE '1995-01-01' AND DATE '1998-08-14'",
)


@check("""SELECT o_orderkey, STRFTIME(DATE_TRUNC('quarter', o_orderdate) - INTERVAL 1 MONTH, '%Y%m') AS quarter_end,
  MAKE_DATE(CAST(YEAR(o_orderdate) - 3 AS INT), 1, 1) AS first_day,
  CAST(STRFTIME(o_orderdate - INTERVAL 1 YEAR, '%Y%m%d') AS INT) AS rolling_start,
  CAST(STRFTIME(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS INT) AS rolling_end FROM orders""")
def run_date_columns(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        cal.last_completed_quarter_col("o_orderdate").alias("quarter_end"),
        cal.first_day_years_ago_col("o_orderdate", 3).alias("first_day"),
        cal.rolling_year_start_col("o_orderdate").alias("rolling_start"),
        cal.rolling_year_end_col("o_orderdate").alias("rolling_end"),
    )


@check(f"""SELECT o_orderkey, y, m FROM {_MONTHS} WHERE ({_pairs(*[(1998, m) for m in (3, 4, 5, 6, 7, 8)])})
  OR ({_pairs((1997, 1), (1997, 2), (1996, 4))}) OR (y = 1995 AND m <> 7 AND m < 8)""")
def sql_run_date_predicates(spark, sf_dir):
    """The predicates as SQL functions, on several run dates."""
    register(spark)
    return spark.sql(
        """SELECT o_orderkey, y, m FROM {orders} WHERE in_last_six_months(y, m, DATE '1998-08-15')
        OR in_remaining_months(y, m, DATE '1997-08-15') OR is_month_back(y, m, 16, DATE '1997-08-15')
        OR in_previous_year_and_current(y, m, DATE '1995-08-15')""",
        orders=_months(spark, sf_dir),
    )


@check(with_sources("sa_siicea_missions_real", """
  SELECT identifiant_de_la_mission AS id, CASE LENGTH(finess_geographique) WHEN 8 THEN '0' || finess_geographique
    ELSE finess_geographique END AS cd_finess, SUBSTR(date_reelle_visite, 7, 4) || '-' ||
    SUBSTR(date_reelle_visite, 4, 2) || '-' || SUBSTR(date_reelle_visite, 1, 2) AS visite
  FROM sa_siicea_missions_real WHERE SUBSTR(date_reelle_visite, 7, 4) || '-' || SUBSTR(date_reelle_visite, 4, 2) || '-' ||
    SUBSTR(date_reelle_visite, 1, 2) BETWEEN '2022-01-01' AND '2025-08-14'
    AND SUBSTR(date_reelle_visite, 7, 4) || SUBSTR(date_reelle_visite, 4, 2) <= '202506'"""))
def sql_text_functions(spark, sf_dir):
    """The code and text-date expressions as SQL functions, over the missions."""
    register(spark)
    return spark.sql(
        """SELECT identifiant_de_la_mission AS id, pad_if_length(finess_geographique, 8) AS cd_finess,
        day_first_to_iso(date_reelle_visite) AS visite FROM {missions}
        WHERE day_first_to_iso(date_reelle_visite) BETWEEN first_day_years_ago(3, DATE '2025-08-15')
        AND yesterday(DATE '2025-08-15')
        AND day_first_to_month(date_reelle_visite) <= last_completed_quarter(DATE '2025-08-15')""",
        missions=stand_in(spark, sf_dir, "sa_siicea_missions_real"),
    )


# ---- Casts of landed text, over texts made from the orders ----

_RAW = {
    "number": "CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'nan' WHEN 3 THEN '7d'"
              " WHEN 4 THEN '-3.7' WHEN 5 THEN CAST(o_custkey AS STRING) || '.9' WHEN 6 THEN '1e3'"
              " WHEN 7 THEN '12,5' ELSE CAST(o_orderkey AS STRING) END",
    "flag": "CASE o_orderkey % 13 WHEN 0 THEN 'true' WHEN 1 THEN 'True' WHEN 2 THEN 'tRuE' WHEN 3 THEN '1'"
            " WHEN 4 THEN '0' WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'nan' WHEN 8 THEN 'yes' WHEN 9 THEN 'N'"
            " WHEN 10 THEN 'maybe' WHEN 11 THEN o_orderstatus ELSE 'f' END",
    "day": "CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN SUBSTR(CAST(o_orderdate AS STRING), 1, 10)"
           " WHEN 3 THEN '31-02-1998' WHEN 4 THEN '1-2-1998' ELSE SUBSTR(CAST(o_orderdate AS STRING), 9, 2) || '-' ||"
           " SUBSTR(CAST(o_orderdate AS STRING), 6, 2) || '-' || SUBSTR(CAST(o_orderdate AS STRING), 1, 4) END",
    "label": "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'éà' || o_orderpriority END",
}
_RAW_SQL = f"(SELECT o_orderkey, {', '.join(f'{e} AS {c}' for c, e in _RAW.items())} FROM orders)"
_RAW_FIELDS = (
    T.StructField("number", T.IntegerType()),
    T.StructField("flag", T.BooleanType()),
    T.StructField("day", T.DateType()),
    T.StructField("label", T.StringType()),
)
_TRUE = "('true', 'True', 'TRUE', '1', 'yes', 'Yes', 'YES', 'y', 'Y', 't', 'T')"
_KNOWN = (
    "('true', 'True', 'TRUE', '1', 'yes', 'Yes', 'YES', 'y', 'Y', 't', 'T', 'false', 'False', 'FALSE', '0', 'no', 'No',"
    " 'NO', 'n', 'N', 'f', 'F', '', 'nan', 'NaN', 'NAN')"
)
_DOUBLE = "COALESCE(CASE WHEN number = 'nan' THEN 0 ELSE TRY_CAST(number AS DOUBLE) END, 0)"


def _raw(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", *[f"{e} AS {c}" for c, e in _RAW.items()])


@check(f"""SELECT o_orderkey, CAST(TRUNC({_DOUBLE}) AS INTEGER) AS as_int, CAST(TRUNC({_DOUBLE}) AS BIGINT) AS as_long,
  CAST({_DOUBLE} AS FLOAT) AS as_real FROM {_RAW_SQL}""")
def cast_number(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "o_orderkey",
        casts.cast_number("number").alias("as_int"),
        casts.cast_number("number", "bigint").alias("as_long"),
        casts.cast_number("number", "float").alias("as_real"),
    )


@check(f"SELECT o_orderkey, COALESCE(flag IN {_TRUE}, FALSE) AS flag FROM {_RAW_SQL}")
def cast_bool(spark, sf_dir):
    return _raw(spark, sf_dir).select("o_orderkey", casts.cast_bool("flag").alias("flag"))


@check(f"SELECT DISTINCT flag FROM {_RAW_SQL} WHERE flag NOT IN {_KNOWN}")
def unmapped_booleans(spark, sf_dir):
    return casts.unmapped_booleans(_raw(spark, sf_dir), "flag")


@check(f"SELECT o_orderkey, CAST(TRY_STRPTIME(day, '%d-%m-%Y') AS DATE) AS day FROM {_RAW_SQL}")
def cast_date(spark, sf_dir):
    return _raw(spark, sf_dir).select("o_orderkey", casts.cast_date("day").alias("day"))


@check(f"SELECT o_orderkey, COALESCE(label, '') AS whole, SUBSTR(COALESCE(label, ''), 1, 5) AS cut FROM {_RAW_SQL}")
def cast_text(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "o_orderkey", casts.cast_text("label").alias("whole"), casts.cast_text("label", 5).alias("cut")
    )


@check(f"""SELECT 'number' AS column_name, COUNT(*) AS failures FROM {_RAW_SQL} WHERE number IN ('7d', '12,5')
  UNION ALL SELECT 'flag', COUNT(*) FROM {_RAW_SQL} WHERE flag NOT IN {_KNOWN}
  UNION ALL SELECT 'day', COUNT(*) FROM {_RAW_SQL} WHERE day <> '' AND TRY_STRPTIME(day, '%d-%m-%Y') IS NULL""")
def cast_failures(spark, sf_dir):
    return casts.cast_failures(_raw(spark, sf_dir), _RAW_FIELDS)


# ---- Text and rows ----

_ACCENTS = "'éèêëàâäîïôöùûüçñÉÈÊËÀÂÄÎÏÔÖÙÛÜÇÑ', 'eeeeaaaiioouuucnEEEEAAAIIOOUUUCN'"


@check(rf"""SELECT doc_id, TRIM(REGEXP_REPLACE(REGEXP_REPLACE(LOWER(TRANSLATE(text, {_ACCENTS})), '[^\p{{L}}\p{{N}}_]', '_', 'g'),
  '_+', '_', 'g'), '_') AS slug FROM documents""")
def slug_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.slug("text", None).alias("slug"))


@check(r"""SELECT doc_id, CASE WHEN GREATEST(a, b, c, d) = 0 THEN ',' WHEN a >= GREATEST(b, c, d) THEN ','
  WHEN b >= GREATEST(c, d) THEN ';' WHEN c >= d THEN '¤' ELSE chr(9) END AS sep
  FROM (SELECT doc_id, LENGTH(l) - LENGTH(REPLACE(l, ',', '')) AS a, LENGTH(l) - LENGTH(REPLACE(l, ';', '')) AS b,
    LENGTH(l) - LENGTH(REPLACE(l, '¤', '')) AS c, LENGTH(l) - LENGTH(REPLACE(l, chr(9), '')) AS d
    FROM (SELECT doc_id, REGEXP_EXTRACT(text, '([^\r\n]*\S[^\r\n]*)', 1) AS l FROM documents))""")
def delimiter_guess(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", guess_delimiter(first_line("text")).alias("sep"))


_PIPED = ("CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN p_type || '||' || p_brand"
          " WHEN 3 THEN p_type || '|' ELSE p_type || '| ' || p_brand || ' |' || p_name END")


def _piped(spark, sf_dir, trim):
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_PIPED} AS motifs")
    return pipe_items(parts, "motifs", "motif_value", keep=["p_partkey"], trim=trim)


_ITEMS = f"(SELECT p_partkey, UNNEST(STRING_SPLIT({_PIPED}, '|')) AS item FROM part)"


@check(f"SELECT p_partkey, item AS motif_value FROM {_ITEMS}")
def pipe_items_as_they_are(spark, sf_dir):
    return _piped(spark, sf_dir, False)


@check(f"SELECT p_partkey, TRIM(item) AS motif_value FROM {_ITEMS}")
def pipe_items_trimmed(spark, sf_dir):
    return _piped(spark, sf_dir, True)


@check("""SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END AS returned
  FROM lineitem""")
def iif_flag(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.iif(F.col("l_returnflag") == "R", F.col("l_extendedprice"), F.lit(0.0)).alias("returned"),
    )


@check(f"""SELECT o_orderkey, CASE WHEN day ~ '^[0-9]{{2}}[^0-9][0-9]{{2}}[^0-9][0-9]{{4}}'
  THEN SUBSTR(day, 7, 4) || '-' || SUBSTR(day, 4, 2) || '-' || SUBSTR(day, 1, 2) ELSE day END AS day FROM {_RAW_SQL}""")
def iso_from_either(spark, sf_dir):
    return _raw(spark, sf_dir).select("o_orderkey", text.to_iso("day").alias("day"))


@check("""SELECT o_orderkey, TRY_CAST(CAST(YEAR(o_orderdate) AS VARCHAR) || '-' ||
  LPAD(CAST(o_orderkey % 14 AS VARCHAR), 2, '0') || '-' || LPAD(CAST(o_custkey % 32 AS VARCHAR), 2, '0') AS DATE) AS day
  FROM orders""")
def date_from_parts_lenient(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.date_from_parts(
            F.year("o_orderdate"), F.col("o_orderkey") % 14, F.col("o_custkey") % 32, lenient=True
        ).alias("day"),
    )


@check("""WITH copies AS (SELECT o_orderstatus AS status, o_orderpriority AS priority, (ROW_NUMBER() OVER (
  PARTITION BY o_orderstatus, o_orderpriority) - 1) // 7 AS chunk FROM orders)
  SELECT ROW_NUMBER() OVER (ORDER BY SUBSTR(MD5(status || chr(31) || priority || chr(31) || CAST(chunk AS VARCHAR)), 1, 2),
    status, priority, chunk) AS row_index, status, priority FROM copies""")
def dense_index_of_copies(spark, sf_dir):
    """Very few distinct rows, each with very many copies: the index splits them into chunks."""
    pairs = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    )
    return dense_index(pairs, "row_index", digits=2, chunk=7)


# ---- Expectations ----


@check(f"SELECT o_orderkey, flag FROM {_RAW_SQL} WHERE LOWER(flag) NOT IN ('true', 'false')")
def check_bool(spark, sf_dir):
    return expect_bool(_raw(spark, sf_dir).select("o_orderkey", "flag"), "flag")


@check(f"""SELECT day AS raw_value, day AS formatted_value FROM {_RAW_SQL}
  WHERE NOT REGEXP_MATCHES(day, '^[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}$')""")
def check_date_format(spark, sf_dir):
    return expect_date_format(_raw(spark, sf_dir), "day", "DD-MM-YYYY")


@check("""SELECT CAST(ts AS VARCHAR) AS raw_value, STRFTIME(ts, '%Y-%m-%d') AS formatted_value FROM events
  WHERE NOT REGEXP_MATCHES(STRFTIME(ts, '%Y-%m-%d'), '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')""")
def check_date_format_of_timestamps(spark, sf_dir):
    return expect_date_format(table(spark, sf_dir, "events"), "ts")


@check(f"""SELECT * FROM (VALUES ('bool', 'flag', ''), ('date_format', 'day', 'DD-MM-YYYY'), ('date_format', 'day', 'YYYY-MM-DD'),
    ('column', 'FLAG', ''), ('column', 'absent', ''), ('type', 'o_orderkey', 'INTEGER'), ('type', 'label', 'DATE'))
    AS suite (expectation, column_name, detail)
  JOIN (SELECT 'bool' AS expectation, '' AS detail, 'flag' AS column_name, COUNT(*) AS violations FROM {_RAW_SQL}
      WHERE LOWER(flag) NOT IN ('true', 'false')
    UNION ALL SELECT 'date_format', 'DD-MM-YYYY', 'day', COUNT(*) FROM {_RAW_SQL}
      WHERE NOT REGEXP_MATCHES(day, '^[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}$')
    UNION ALL SELECT 'date_format', 'YYYY-MM-DD', 'day', COUNT(*) FROM {_RAW_SQL}
      WHERE NOT REGEXP_MATCHES(day, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
    UNION ALL SELECT 'column', '', 'FLAG', 0
    UNION ALL SELECT 'column', '', 'absent', COUNT(*) FROM orders
    UNION ALL SELECT 'type', 'INTEGER', 'o_orderkey', 0
    UNION ALL SELECT 'type', 'DATE', 'label', COUNT(*) FROM orders) found USING (expectation, column_name, detail)""")
def violation_suite(spark, sf_dir):
    """A suite of all kinds of expectation in one scan."""
    return violation_counts(
        _raw(spark, sf_dir),
        [
            Expectation("bool", "flag"),
            Expectation("date_format", "day", "DD-MM-YYYY"),
            Expectation("date_format", "day", "YYYY-MM-DD"),
            Expectation("column", "FLAG"),
            Expectation("column", "absent"),
            Expectation("type", "o_orderkey", "INTEGER"),
            Expectation("type", "label", "DATE"),
        ],
    )


@check(f"SELECT com, COUNT(*) AS copies FROM ({stand_in_sql('v_commune')}) GROUP BY com HAVING COUNT(*) > 1")
def repeated_communes(spark, sf_dir):
    return repeated_keys(stand_in(spark, sf_dir, "v_commune"), "com")


_EXPECTED = ["the", "of", "la", "der"]
_HEADS = r"""(SELECT doc_id, LIST_FILTER(LIST_TRANSFORM(STRING_SPLIT(REGEXP_EXTRACT(text, '([^\r\n]*\S[^\r\n]*)', 1), ' '),
  lambda w: SUBSTR(TRIM(REGEXP_REPLACE(REGEXP_REPLACE(LOWER(TRANSLATE(w, @)), '[^\p{L}\p{N}_]', '_', 'g'), '_+', '_', 'g'),
    '_'), 1, 63)), lambda w: w <> '') AS h, ['the', 'of', 'la', 'der'] AS e FROM documents)""".replace("@", _ACCENTS)
_HEADER_SQL = f"""SELECT doc_id, CAST(4 AS INT) AS expected_count, CAST(LEN(h) AS INT) AS actual_count,
  ARRAY_TO_STRING(LIST_SORT(LIST_FILTER(e, lambda x: NOT LIST_CONTAINS(h, x))), ',') AS missing,
  ARRAY_TO_STRING(LIST_SORT(LIST_FILTER(LIST_DISTINCT(h), lambda x: NOT LIST_CONTAINS(e, x))), ',') AS extra FROM {_HEADS}"""


def _header_rows(spark, sf_dir):
    """The first line of every document taken for a header."""
    words = F.split(first_line("text"), " ", -1)
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file"),
        F.array(*[F.lit(c) for c in _EXPECTED]).alias("expected"),
        F.transform(words, lambda w: text.slug(w)).alias("headers"),
    )


@check(f"SELECT *, expected_count = actual_count AND missing = '' AND extra = '' AS valid FROM ({_HEADER_SQL})")
def check_headers(spark, sf_dir):
    return drop_checks.check_headers(_header_rows(spark, sf_dir)).select(
        F.col("file").alias("doc_id"),
        "expected_count",
        "actual_count",
        F.array_join("missing", ",").alias("missing"),
        F.array_join("extra", ",").alias("extra"),
        "valid",
    )


@check(f"""SELECT doc_id AS file, UNNEST(LIST_FILTER([CASE WHEN actual_count <> 4 THEN
    'Column count mismatch: expected 4, got ' || actual_count END,
    CASE WHEN missing <> '' THEN 'Missing columns: ' || REPLACE(missing, ',', ', ') END,
    CASE WHEN extra <> '' THEN 'Extra columns: ' || REPLACE(extra, ',', ', ') END], lambda x: x IS NOT NULL)) AS issue
  FROM ({_HEADER_SQL})""")
def header_issues(spark, sf_dir):
    return drop_checks.issues(drop_checks.check_headers(_header_rows(spark, sf_dir)))


@check(f"""SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE ok) AS valid, COUNT(*) FILTER (WHERE NOT ok) AS invalid
  FROM (SELECT expected_count = actual_count AND missing = '' AND extra = '' AS ok FROM ({_HEADER_SQL}))""")
def header_summary(spark, sf_dir):
    return drop_checks.summary(drop_checks.check_headers(_header_rows(spark, sf_dir)))


@check("""WITH u AS (SELECT doc_id, UNNEST(l) AS unit, UNNEST(RANGE(LEN(l))) AS p FROM (
    SELECT doc_id, REGEXP_EXTRACT_ALL(LEFT(text, 126), '(?s)''''|.') AS l FROM documents)),
  s AS (SELECT *, COALESCE(SUM(CASE WHEN unit IN ('à', 'â', 'ä', 'é', 'è', 'ê', 'ë', 'î', 'ï', 'ô', 'ö', 'ù', 'û', 'ü', 'ç') THEN 2 ELSE 1 END)
    OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM u)
SELECT d.doc_id, COALESCE(STRING_AGG(unit, '' ORDER BY p), CASE WHEN ANY_VALUE(d.text) IS NOT NULL THEN '' END) AS name
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id AND used < 63 GROUP BY d.doc_id""")
def reduced_names(spark, sf_dir):
    """Whole texts cut to the length of a catalog's name."""
    return table(spark, sf_dir, "documents").select("doc_id", reduce_text("text").alias("name"))


# ---- Landing, loading, publishing ----

_LISTED = """(SELECT ts, CASE WHEN event_id % 4 = 0 THEN 'OPS' ELSE 'WEB' END AS folder,
  event_type || '_' || CAST(event_id AS STRING) || CASE event_id % 5 WHEN 0 THEN '.gpg' WHEN 1 THEN '.xlsx' ELSE '.csv' END
  AS name FROM events)"""


@check(f"""SELECT source, '/landing/' || folder || '/' || name AS path, ts AS modified FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY ts DESC, folder || '/' || name DESC) AS n FROM (
    SELECT 'clicks' AS source, * FROM {_LISTED} WHERE folder = 'WEB' AND name LIKE '%click%' AND name LIKE '%.csv'
    UNION ALL SELECT 'views', * FROM {_LISTED} WHERE folder = 'WEB' AND name LIKE '%view%' AND name LIKE '%.csv'
    UNION ALL SELECT 'faults', * FROM {_LISTED} WHERE folder = 'OPS' AND name LIKE '%error%'
    UNION ALL SELECT 'ops', * FROM {_LISTED} WHERE folder = 'OPS' AND name LIKE '%\\_%' ESCAPE '\\' AND name LIKE '%.csv'))
  WHERE n = 1""")
def latest_drop(spark, sf_dir):
    files = table(spark, sf_dir, "events").selectExpr("*", "event_id % 4 = 0 AS ops").selectExpr(
        "'file:/landing/' || CASE WHEN ops THEN 'OPS' ELSE 'WEB' END || '/' || event_type || '_' || event_id ||"
        " CASE event_id % 5 WHEN 0 THEN '.gpg' WHEN 1 THEN '.xlsx' ELSE '.csv' END AS path",
        "ts AS modified",
    )
    sources = [
        Source("clicks", "click", "WEB"),
        Source("views", "view", "WEB"),
        Source("faults", "error", "OPS", any_extension=True),
        Source("ops", "_", "OPS"),
    ]
    newest = newest_per_source(files, "/landing", sources)
    return newest.withColumn("path", F.regexp_replace("path", "^file:", ""))


@check(f"""SELECT COALESCE(number_text, '') AS n_du_client, SUBSTR(label, 1, 12) AS libelle_de_l_etablissement, nation AS code_pays,
  active AS est_actif, c_mktsegment AS code_pays_1, c_mktsegment || '!' AS nombre_de_personnes_accompagnees_presentant_une_deficience_inte
  FROM (SELECT c_mktsegment, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS number_text,
    c_name || ' "é;¤,"' AS label, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_nationkey END AS nation,
    c_custkey % 3 = 0 AS active FROM customer)""")
def csv_roundtrip(spark, sf_dir):
    """Customers written with accented, repeated and over-long headers and quoted delimiters, and read back as declared."""
    path = scratch(spark, "roundtrip")
    table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey").cast("string")).alias("N° du Client"),
        F.concat("c_name", F.lit(' "é;¤,"')).alias("Libellé de l'établissement"),
        F.when(F.col("c_custkey") % 5 != 0, F.concat(F.col("c_nationkey").cast("string"), F.lit(".0"))).alias("Code (pays)"),
        F.when(F.col("c_custkey") % 3 == 0, "true").otherwise("no").alias("Est actif ?"),
        F.lit("left out").alias("Not declared"),
        F.col("c_mktsegment").alias("Code [pays]"),
        F.concat("c_mktsegment", F.lit("!")).alias("Nombre de personnes accompagnées présentant une déficience intellectuelle légère"),
    ).write.option("header", True).option("sep", "¤").option("escape", '"').csv(path)
    declared = Source(
        "clients", "clients", sep="¤",
        fields=(
            T.StructField("n_du_client", T.StringType()),
            T.StructField("libelle_de_l_etablissement", T.StringType(), True, {"max_length": 12}),
            T.StructField("code_pays", T.IntegerType()),
            T.StructField("est_actif", T.BooleanType()),
            T.StructField("code_pays_1", T.StringType()),
            T.StructField("nombre_de_personnes_accompagnees_presentant_une_deficience_inte", T.StringType()),
        ),
    )
    return read_source(spark, path, declared)


_GEO_SOURCES = ["v_commune", "v_commune_comer", "v_commune_depuis", "v_departement", "v_comer", "v_region"]


@check(view_oracles()["staging__ref_geo"].replace("WHERE reg <> ''", "WHERE reg <> '' AND reg IS NOT NULL"))
def load_run(spark, sf_dir):
    """Drops of six sources landed, chosen, checked, conformed, saved; then the hierarchy over the store."""
    landing, home = scratch(spark, "landing"), scratch(spark, "store")
    for name in _GEO_SOURCES:
        source = SOURCES[name]
        stand_in(spark, sf_dir, name).write.option("header", True).option("sep", ";").csv(
            f"{landing}/{source.folder}/{source.keyword}_20250815.csv"
        )
    views, _ = run(
        spark, landing, Store(spark, root=home), today=date(2025, 8, 15), sources={n: SOURCES[n] for n in _GEO_SOURCES}
    )
    return views.view("staging__ref_geo")


@check(view_oracles()["staging__ref_geo"])
def kept_geography(spark, sf_dir):
    """The hierarchy over its three dimensions written as tables."""
    views = Views(reader(spark, sf_dir), RUN_DATE)
    views.keep(
        Store(spark, root=scratch(spark, "kept")),
        "staging__ref_departements", "staging__ref_regions", "staging__ref_communes",
    )
    return views.view("staging__ref_geo")


_FAULTY = Source(
    "clients", "clients", "IN", sep=";", multiline=True,
    fields=(
        T.StructField("numero", T.LongType()), T.StructField("libelle", T.StringType(), True, {"max_length": 12}),
        T.StructField("pays", T.IntegerType()), T.StructField("actif", T.BooleanType()),
    ),
)


def _faulty_drop(spark, sf_dir, landing):
    """Customers as raw lines: short and long rows, quoted newlines, bad numbers, unknown booleans, long texts."""
    number = "CAST(c_custkey AS STRING)"
    line = f"""CASE c_custkey % 10 WHEN 0 THEN {number} || ';short' WHEN 1 THEN {number} || ';a;3;yes;more'
      WHEN 2 THEN {number} || ';"two' || CHR(10) || 'lines";3;yes' WHEN 3 THEN {number} || ';a;7d;yes'
      WHEN 4 THEN {number} || ';a;3;perhaps' WHEN 5 THEN {number} || ';' || c_name || ';3;no' ELSE {number} || ';"b;c";4;no' END"""
    # A folder of part files, each with the header above its first line.
    first = "(monotonically_increasing_id() & 8589934591) = 0"
    head = f"IF({first}, CONCAT('numero;libelle;pays;actif', CHR(10)), '')"
    lines = table(spark, sf_dir, "customer").selectExpr(f"{line} AS line").repartition(8)
    lines.selectExpr(f"CONCAT({head}, line) AS value").write.text(f"{landing}/IN/clients.csv")


@check("""WITH c AS (SELECT c_custkey AS k, c_custkey % 10 AS m FROM customer)
SELECT * FROM (SELECT 'rows' AS fault, '' AS column_name, COUNT(*) AS found FROM c WHERE m > 1
  UNION ALL SELECT 'sum of keys', 'numero', CAST(SUM(k) AS BIGINT) FROM c WHERE m > 1
  UNION ALL SELECT 'newlines', 'libelle', COUNT(*) FROM c WHERE m = 2
  UNION ALL SELECT 'malformed', '', COUNT(*) FROM c WHERE m < 2
  UNION ALL SELECT 'rejected', '', COUNT(*) FROM c WHERE m < 2
  UNION ALL SELECT 'failed_cast', 'pays', COUNT(*) FROM c WHERE m = 3
  UNION ALL SELECT 'unmapped_boolean', 'actif', COUNT(*) FROM c WHERE m = 4
  UNION ALL SELECT 'cut_text', 'libelle', COUNT(*) FROM c WHERE m = 5) WHERE found > 0""")
def load_with_faults(spark, sf_dir):
    """A drop with faults of every kind: what was loaded, what was rejected, and the report of the load."""
    landing, store = scratch(spark, "landing"), Store(spark, root=scratch(spark, "store"))
    _faulty_drop(spark, sf_dir, landing)
    _, counts, faults = load_all(spark, landing, store, today=date(2025, 8, 15), sources={"clients": _FAULTY})
    one = lambda fault, column, found: found.select(F.lit(fault).alias("fault"), F.lit(column).alias("column_name"), "found")
    loaded = store.read("clients")
    parts = [
        one("rows", "", counts.select(F.col("row_count").alias("found"))),
        one("sum of keys", "numero", loaded.agg(F.sum("numero").alias("found"))),
        one("newlines", "libelle", loaded.agg(F.sum(F.col("libelle").contains("\n").cast("long")).alias("found"))),
        one("rejected", "", store.history("clients_rejected").agg(F.count("row").alias("found"))),
        faults.select("fault", "column_name", "found"),
    ]
    return reduce(DataFrame.unionByName, parts)


_SUITE = [
    Expectation("bool", "actif"), Expectation("column", "Numero"), Expectation("column", "absent"), Expectation("type", "numero", "INTEGER"),
    Expectation("type", "libelle", "BOOLEAN"), Expectation("date_format", "libelle"),
]


@check("""WITH c AS (SELECT c_custkey % 10 AS m FROM customer WHERE c_custkey % 10 > 1)
SELECT * FROM (SELECT 'expectation:column' AS fault, 'absent' AS column_name, COUNT(*) AS found FROM c
  UNION ALL SELECT 'expectation:type', 'libelle', COUNT(*) FROM c
  UNION ALL SELECT 'expectation:date_format', 'libelle', COUNT(*) FROM c) WHERE found > 0""")
def load_with_expectations(spark, sf_dir):
    """What a suite counts while the rows are written; values that could not be cast are faults of the load instead."""
    landing, store = scratch(spark, "landing"), Store(spark, root=scratch(spark, "store"))
    _faulty_drop(spark, sf_dir, landing)
    faults = load_all(spark, landing, store, today=date(2025, 8, 15), sources={"clients": _FAULTY}, suites={"clients": _SUITE})[2]
    return faults.where(F.col("fault").startswith("expectation")).select("fault", "column_name", "found")


@check("""SELECT 'customer' AS table_name, DATE '2025-08-14' AS date_ingestion, COUNT(*) AS row_count FROM customer
  UNION ALL SELECT 'customer', DATE '2025-08-15', COUNT(*) FROM customer WHERE c_nationkey < 12
  UNION ALL SELECT 'supplier', DATE '2025-08-15', COUNT(*) FROM supplier""")
def load_counts(spark, sf_dir):
    """Rows of every load that counts, from the versions of the store alone."""
    store = Store(spark, root=scratch(spark, "store"))
    customers = table(spark, sf_dir, "customer")
    for day in (14, 15):
        store.load(customers, "customer", date(2025, 8, day))
    with store.commit() as run:
        run.load(customers.where("c_nationkey < 12"), "customer", date(2025, 8, 15))
        run.load(table(spark, sf_dir, "supplier"), "supplier", date(2025, 8, 15))
    return store.load_counts()


_VISITS = "identifiant_de_la_mission, finess_geographique, date_reelle_visite"


@check(with_sources("sa_siicea_missions_real", f""", every AS (SELECT {_VISITS} FROM sa_siicea_missions_real
    UNION ALL SELECT {_VISITS} FROM sa_siicea_missions_real WHERE nombre_d_ecarts < 30
    UNION ALL SELECT identifiant_de_la_mission || 'x', finess_geographique, date_reelle_visite FROM sa_siicea_missions_real WHERE nombre_d_ecarts > 100)
  SELECT COUNT(*) AS nombre_de_lignes, COUNT(DISTINCT identifiant_de_la_mission) AS nombre_distinct_id_missions,
    CAST(SUM(CASE LENGTH(finess_geographique) WHEN 8 THEN 1 ELSE 0 END) AS BIGINT) AS longueur_ko_finess,
    CAST(SUM(CASE LENGTH(finess_geographique) WHEN 9 THEN 1 ELSE 0 END) AS BIGINT) AS longueur_ok_finess,
    COUNT(DISTINCT LENGTH(finess_geographique)) AS nombre_de_longueurs_differentes_finess,
    MIN(date_reelle_visite) AS date_reelle_visite_plus_ancienne, MAX(date_reelle_visite) AS date_reelle_visite_plus_recente,
    MIN(SUBSTR(date_reelle_visite, 1, 4)) AS annee_min, MIN(SUBSTR(date_reelle_visite, 6, 2)) AS mois_min,
    MAX(SUBSTR(date_reelle_visite, 1, 4)) AS annee_max, MAX(SUBSTR(date_reelle_visite, 6, 2)) AS mois_max FROM every"""))
def profile_from_state(spark, sf_dir):
    """The mission profile of a history of three days, one of them loaded twice, from the state kept with the loads."""
    store, name = Store(spark, root=scratch(spark, "store")), "sa_siicea_missions_real"
    missions, kept = stand_in(spark, sf_dir, name), KEPT[name]
    again = missions.where("nombre_d_ecarts > 100").withColumn("identifiant_de_la_mission", F.concat("identifiant_de_la_mission", F.lit("x")))
    for day, load in ((13, missions), (14, missions.where("nombre_d_ecarts < 60")), (15, again), (14, missions.where("nombre_d_ecarts < 30"))):
        with store.commit() as run:
            run.load(load.select(kept.key, kept.code, kept.when), name, date(2025, 8, day))
            keep_state(run, name, date(2025, 8, day), kept)
    return profile_of_history(store, name, kept)


@check(with_sources("sa_insern", """SELECT COUNT(*) AS certificates, COUNT(*) AS numbers, 1 AS least, COUNT(*) AS most, 0 AS moved FROM sa_insern"""))
def numbers_that_stay(spark, sf_dir):
    """Certificates numbered after a first load of some and a second one of all: dense, and none of the first has moved."""
    store = Store(spark, root=scratch(spark, "store"))
    every = stand_in(spark, sf_dir, "sa_insern").withColumn("_part", F.xxhash64("annee", "mois", "jour", "commune_code") % 3)
    views = {k: Views(lambda _, df=df: df.drop("_part"), RUN_DATE, lenient=True) for k, df in (("first", every.where("_part = 0")), ("all", every))}
    numbered(views["first"], store)
    before = store.read(NUMBERS).select(ROW, COPY, F.col("index").alias("had"))
    after = numbered(views["all"], store).select(F.col("index").cast("long").alias("number"))
    moved = before.join(store.read(NUMBERS), [ROW, COPY], "left").agg(F.sum(F.coalesce((F.col("had") != F.col("index")).cast("int"), F.lit(1))).alias("moved"))
    return one_row(
        after.agg(
            F.count(F.lit(1)).alias("certificates"), F.count_distinct("number").alias("numbers"),
            F.min("number").cast("int").alias("least"), F.max("number").alias("most"),
        ),
        moved.select(F.coalesce("moved", F.lit(0)).cast("int").alias("moved")),
    )


@check("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(CAST(DATE '2025-08-14' + CAST(o_orderkey % 3 AS INT) AS DATE) AS VARCHAR) AS ingested FROM orders""")
def drops_as_they_come(spark, sf_dir):
    """Orders in three drops; the stream is called after the first one and after the others, then with nothing new."""
    landing, checkpoint = scratch(spark, "landing"), scratch(spark, "checkpoint")
    store = Store(spark, root=scratch(spark, "store"))
    source = Source("orders", "orders", sep=";", fields=(T.StructField("o_orderkey", T.StringType()), T.StructField("part", T.IntegerType())))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), (F.col("o_orderkey") % 3).cast("int").alias("part"))
    path, fs = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.org.apache.hadoop.fs.Path(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    for k in range(3):
        parts = scratch(spark, "parts")
        orders.where(F.col("part") == k).write.option("header", True).option("sep", ";").csv(parts)
        for n, status in enumerate(fs.globStatus(path(f"{parts}/part-*.csv"))):  # each file with a header is a drop
            fs.mkdirs(path(landing))
            at = path(f"{landing}/orders_{k}_{n}.csv")
            fs.rename(status.getPath(), at)
            fs.setTimes(at, 1755172800000 + 86_400_000 * k + 1000 * n, -1)
        if k != 1:
            load_new_drops(store, landing, source, checkpoint)
    load_new_drops(store, landing, source, checkpoint)
    return store.history("orders").select("o_orderkey", F.col("date_ingestion").cast("string").alias("ingested"))


@check("""SELECT DATE '2025-08-14' AS date_ingestion, c_custkey, c_name FROM customer
  UNION ALL SELECT DATE '2025-08-15', c_custkey, c_name FROM customer WHERE c_nationkey < 12""")
def reload_that_fails(spark, sf_dir):
    """A day loaded again by a job that stops half way, in a run that had loaded another table: all is as before."""
    store = Store(spark, root=scratch(spark, "store"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    store.load(customers, "customer", date(2025, 8, 14))
    store.load(table(spark, sf_dir, "customer").where("c_nationkey < 12").select("c_custkey", "c_name"), "customer", date(2025, 8, 15))
    broken = customers.withColumn("c_name", F.when(F.col("c_custkey") % 100 == 50, F.raise_error("stopped").cast("string")).otherwise(F.col("c_name")))
    try:
        with store.commit() as run:
            run.load(customers.limit(1), "other", date(2025, 8, 15))
            run.load(broken, "customer", date(2025, 8, 15))
    except Exception as e:
        if "stopped" not in str(e):
            raise
    if store.has("other"):
        raise RuntimeError("a run that failed was published")
    return store.history("customer").select("date_ingestion", "c_custkey", "c_name")


@check("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, LENGTH(COALESCE(text, '')) AS chars, MD5(COALESCE(text, '')) AS digest FROM documents""")
def quoted_newlines_by_ranges(spark, sf_dir):
    """Documents written as drops with quoted newlines and read back by ranges, each file by several tasks."""
    path = scratch(spark, "ranges")
    documents = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    documents.write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("doc_id", "text", "lang", MALFORMED)])
    found = good_rows(read_by_ranges(spark, path, ";", schema))
    text_ = F.coalesce("text", F.lit(""))
    return found.select("doc_id", "lang", F.length(text_).cast("long").alias("chars"), F.md5(text_).alias("digest"))


_PAIRS = view_oracles()["staging__matrice_siicea_cibles"]


@check(f"SELECT finess AS key, COUNT(*) AS pairs FROM ({_PAIRS}) GROUP BY finess")
def targets_missions_by_code(spark, sf_dir):
    """How many rows the join of targets and missions has by code, counted without making one."""
    return targets_and_missions(Views(reader(spark, sf_dir), RUN_DATE)).counts().select("key", "pairs")


@check(_PAIRS)
def targets_missions_from_sides(spark, sf_dir):
    """The join expanded from its two sides, kept as tables."""
    sides = targets_and_missions(Views(reader(spark, sf_dir), RUN_DATE))
    store = Store(spark, root=scratch(spark, "sides"))
    sides.save(store, "by_code")
    kept = Factored.read(store, "by_code", "finess", "_finess")
    return kept.expand().drop("_finess")


@check(with_sources("v_region", "SELECT DISTINCT reg, ncc, libelle FROM v_region"))
def load_run_partial(spark, sf_dir):
    """A load in which one drop of two is missing: its table is there, empty, and the regions come from the other."""
    landing, home = scratch(spark, "landing"), scratch(spark, "store")
    source = SOURCES["v_region"]
    stand_in(spark, sf_dir, "v_region").write.option("header", True).option("sep", ";").csv(
        f"{landing}/{source.folder}/{source.keyword}_20250815.csv"
    )
    sources = {n: SOURCES[n] for n in ("v_region", "v_comer")}
    views, _ = run(spark, landing, Store(spark, root=home), today=date(2025, 8, 15), sources=sources)
    return views.view("staging__ref_regions")


_HISTORY = """SELECT date_ingestion, COUNT(*) AS n, CAST(SUM(k) AS BIGINT) AS keys, COUNT(c_name) AS names,
  COUNT(segment) AS segments FROM (
  SELECT DATE '2025-08-14' AS date_ingestion, c_custkey AS k, c_name, NULL AS segment FROM customer
  UNION ALL SELECT DATE '2025-08-15', c_custkey, c_name, NULL FROM customer WHERE c_nationkey < 12
  UNION ALL SELECT DATE '2025-08-17', c_custkey, NULL, c_mktsegment FROM customer WHERE c_nationkey < 5) GROUP BY 1"""


def _history(spark, sf_dir, store):
    """The second day is loaded twice, the third is emptied by a reload, the fourth has another set of columns."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    store.append_history(customers, "customer", date(2025, 8, 14))
    store.append_history(customers, "customer", date(2025, 8, 15))
    store.append_history(customers.where("c_nationkey < 12"), "customer", date(2025, 8, 15))
    store.append_history(customers, "customer", date(2025, 8, 16))
    store.append_history(customers.where("false"), "customer", date(2025, 8, 16))
    changed = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    store.append_history(changed.where("c_nationkey < 5"), "customer", date(2025, 8, 17))
    return (
        store.history("customer")
        .groupBy("date_ingestion")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("keys"), F.count("c_name").alias("names"),
            F.count("segment").alias("segments"),
        )
    )


@check(_HISTORY)
def history_append(spark, sf_dir):
    return _history(spark, sf_dir, Store(spark, root=scratch(spark, "history")))


@check(_HISTORY)
def history_in_catalog(spark, sf_dir):
    name = f"history_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(spark, name)}'")
    return _history(spark, sf_dir, Store(spark, namespace=name))


@check(" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES), "row_counts")
def _row_counts(spark, sf_dir):
    return row_counts({t: table(spark, sf_dir, t) for t in TABLES})


@check("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  o_orderpriority FROM orders""")
def export_roundtrip(spark, sf_dir):
    """A view exported under a dated name and read back as text."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    path = export_csv(orders, scratch(spark, "orders"), date(2025, 8, 15))
    return spark.read.option("header", True).option("sep", ";").csv(path)


@check("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def table_copy(spark, sf_dir):
    """A saved table copied to another store under another name."""
    here, there = Store(spark, root=scratch(spark, "here")), Store(spark, root=scratch(spark, "there"))
    here.save(table(spark, sf_dir, "supplier"), "supplier")
    here.copy_to(there, {"supplier": "fournisseur"})
    return there.read("fournisseur")


@check(view_oracles()["staging__tdb_ic_finess_500"])
def view_copy(spark, sf_dir):
    """A view saved as a table of a consumer."""
    consumer = Store(spark, root=scratch(spark, "consumer"))
    copy_views(Views(reader(spark, sf_dir), RUN_DATE), consumer, {"staging__tdb_ic_finess_500": "ehpad"})
    return consumer.read("ehpad")


@check(view_oracles()["staging__tdb_ic_siicea_cibles"].replace(
    "nb_mission_realisees, nb_mission_abandonnees,", "nb_mission_realisees::VARCHAR AS nb_mission_realisees,"
    " nb_mission_abandonnees::VARCHAR AS nb_mission_abandonnees,"
).replace("nb_decisions AS nb_decisions_prises", "nb_decisions::VARCHAR AS nb_decisions_prises"))
def view_export(spark, sf_dir):
    """A view exported under a dated name and read back as text."""
    views = Views(reader(spark, sf_dir), RUN_DATE)
    paths = export_views(views, scratch(spark, "out"), {"staging__tdb_ic_siicea_cibles": "tdb/cibles"})
    return spark.read.option("header", True).option("sep", ";").csv(*paths.values())


@check(view_oracles()["staging__helios_sirec"])
def published_view(spark, sf_dir):
    """A view read by name after all views were published."""
    Views(reader(spark, sf_dir), RUN_DATE).publish(prefix="published_")
    return spark.table("published_staging__helios_sirec")
