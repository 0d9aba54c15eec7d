"""Line dedup: windows of three consecutive lines that occurred before are removed.

The lines of a text are what stands between its newlines. A window is three consecutive lines of one document, compared
exactly by a 128-bit digest. Among equal windows the first one is that of the smallest doc_id (then text digest, then
line); every later one covers its three lines, in other documents and in the same one. Covered lines go, overlapping
windows are merged by that. The text that is left is the remaining lines joined by newlines.

Equal windows are counted with partial aggregation, so a passage in a third of all rows is one row per task before the
shuffle; occurrences meet the repeated windows in a plain join, whose hot side adaptive execution splits.

* A null text is the empty text, one empty line. Texts of fewer than three lines keep all their lines, whatever their copies.
* A null id comes after all others. Rows with equal id and text are one document: each keeps what the first keeps.
* Without rows the result is empty; columns of the input named like an added one are replaced.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.llm.tables import ordered_id, table, whole_text

WINDOW = 3
ADDED = ("n_lines", "n_removed", "n_spans", "kept_text")


def windows(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """``_id, _digest, _at, _window`` for every window of every document."""
    lines = docs.select(ordered_id().alias("_id"), F.xxhash64(whole_text()).alias("_digest"), F.split(whole_text(), "\n").alias("_lines"))
    digest = lambda i: F.unhex(F.md5(F.concat_ws("\n", *[F.element_at("_lines", i + k) for k in range(length)])))
    starts = F.sequence(F.lit(1), F.size("_lines") - (length - 1))
    return lines.where(F.size("_lines") >= length).select(
        "_id", "_digest", F.posexplode(F.transform(starts, digest)).alias("_at", "_window")
    )


def covered(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """``_id, _digest, _starts``: where the later windows of each document start, in any order."""
    every = windows(docs, length)
    place = F.struct("_id", "_digest", "_at")
    repeated = every.groupBy("_window").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    later = every.join(repeated, "_window").where(place != F.col("_first"))
    return later.groupBy("_id", "_digest").agg(F.collect_set("_at").alias("_starts"))


def _runs(gone: np.ndarray) -> int:
    return int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0


def dedup_lines(docs: DataFrame, length: int = WINDOW) -> DataFrame:
    """The documents with ``n_lines, n_removed, n_spans, kept_text``."""
    base = docs.drop(*ADDED)
    joined = base.withColumns({"_id": ordered_id(), "_digest": F.xxhash64(whole_text())}).join(
        covered(docs, length), ["_id", "_digest"], "left"
    ).drop("_id", "_digest")
    schema = T.StructType([*base.schema.fields, *(T.StructField(n, T.LongType()) for n in ADDED[:3]), T.StructField("kept_text", T.StringType())])

    def cut(batches):
        for batch in batches:
            found = ([], [], [], [])
            names = batch.schema.names
            for text, starts in zip(batch.column(names.index("text")), batch.column(names.index("_starts")), strict=True):
                lines = (text.as_py() or "").split("\n")
                gone = np.zeros(len(lines), bool)
                if starts.is_valid:
                    at = starts.values.to_numpy()
                    for k in range(length):
                        gone[at + k] = True
                    lines = [line for line, out in zip(lines, gone, strict=True) if not out]
                for out, value in zip(found, (len(gone), int(gone.sum()), _runs(gone), "\n".join(lines)), strict=True):
                    out.append(value)
            own = [batch.column(i) for i, n in enumerate(names) if n != "_starts"]
            added = [pa.array(x, pa.int64()) for x in found[:3]] + [pa.array(found[3], pa.string())]
            yield pa.RecordBatch.from_arrays([*own, *added], [*[n for n in names if n != "_starts"], *ADDED])

    return joined.mapInArrow(cut, schema)


def op1_line_dedup(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "n_spans", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = """
WITH l AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, p, md5(lines[p] || chr(10) || lines[p + 1] || chr(10) || lines[p + 2]) AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS p FROM l)),
later AS (SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM later, (SELECT unnest([0, 1, 2]) AS k)),
every AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS p, unnest(lines) AS line FROM l),
marked AS (SELECT e.*, g.p IS NOT NULL AS out FROM every e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.p = g.p),
runs AS (SELECT *, out AND NOT coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM marked)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE out) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT out), '')) AS kept_sha256
FROM runs GROUP BY doc_id
"""
