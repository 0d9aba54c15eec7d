"""Row counts, post-load check, dated exports, and copies for consumers."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dropforge.plans.registry import Views
from dropforge.sinks.store import Store


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per relation with its number of rows; Parquet footers are enough to answer it."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def require_loaded(counts: DataFrame) -> None:
    """Stop a run whose tables are all empty."""
    if counts.where(F.col("row_count") > 0).isEmpty():
        raise RuntimeError("nothing was loaded: every table is empty")


def observed(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """``df`` counting its rows as a write passes them; read the count from ``observation.get``."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation


def export_path(stem: str, day: date) -> str:
    return f"{stem}_{day.isoformat()}.csv"


def export_csv(df: DataFrame, stem: str, day: date, *, sep: str = ";") -> str:
    """Write ``<stem>_<day>.csv``, a folder of part files with headers; the stem may lie in a folder."""
    path = export_path(stem, day)
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return path


def export_views(views: Views, root: str, stems: dict[str, str], *, sep: str = ";") -> dict[str, str]:
    """Export views under ``root``, given as view and stem; gives the path of each."""
    root = root.rstrip("/")
    return {name: export_csv(views.view(name), f"{root}/{stem}", views.today, sep=sep) for name, stem in stems.items()}


def copy_views(views: Views, target: Store, tables: dict[str, str]) -> None:
    """Save views as tables of a consumer's store, given as view and table."""
    for name, table in tables.items():
        target.save(views.view(name), table)
