"""The corpus pipeline: documents through five stages, each written as Parquet and read again as the next one's input.

Every stage takes ``(spark, docs, sf_dir)``, works on all documents its predecessor kept and returns the columns of
documents; the last one adds how often the mix takes each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropforge.llm.decontaminate import decontaminate
from dropforge.llm.line_dedup import dedup_lines
from dropforge.llm.minhash import keep_one
from dropforge.llm.source_mix import mix
from dropforge.llm.tables import table, written
from dropforge.llm.toxicity import score_toxicity


def _carrying(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns an operator looks at, beside the whole row, so that no other column can clash with what it adds."""
    return docs.select(*columns, F.struct(*docs.columns).alias("_row"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go."""
    scored = score_toxicity(_carrying(docs, "doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of three lines or more go; a document keeps its other lines, ``n_chars`` follows them."""
    found = dedup_lines(_carrying(docs, "doc_id", "text"))
    changed = F.col("n_removed") > 0
    new = {
        "text": F.when(changed, F.col("kept_text")).otherwise(F.col("_row.text")),
        "n_chars": F.when(changed, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_row.n_chars")),
    }
    return found.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


def minhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with how many copies (``copies``) and words (``taken``) it takes of each."""
    mixed = mix(_carrying(docs, "doc_id", "source", "text")).where("copies > 0")
    return mixed.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in ("copies", "taken")], "copies", "taken")


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mix),
]
#: The toxicity scores, the samples and the masks cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
