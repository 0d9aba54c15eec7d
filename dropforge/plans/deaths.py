"""Death certificates."""

from __future__ import annotations

from pyspark.sql import functions as F

from dropforge.functions.text import date_from_parts
from dropforge.operators.dense_index import dense_index
from dropforge.operators.stable_index import COPY, ROW, stable_index
from dropforge.plans.registry import view
from dropforge.sources.schemas import SOURCES


@view("staging__cert_dc_insern")
def dated(views):
    """Certificates with a dense text index, a real date and a count of one."""
    columns = SOURCES["sa_insern"].columns
    return dense_index(views.view("staging__sa_insern").select(*columns)).select(
        F.col("index").cast("string").alias("index"),
        date_from_parts("annee", "mois", "jour", lenient=views.lenient).alias("date_deces"),
        *columns,
        F.lit(1).alias("deces_nb"),
    )


NUMBERS = "cert_dc_insern__numbers"


def numbered(views, store):
    """``staging__cert_dc_insern`` whose certificates keep their index from load to load.

    The numbers are kept in a table of ``store`` and published by this call.
    """
    columns = SOURCES["sa_insern"].columns
    certificates = views.view("staging__sa_insern").select(*columns)
    kept = store.read(NUMBERS) if store.has(NUMBERS) else None
    indexed = stable_index(certificates, kept)
    store.save(indexed.select(ROW, COPY, "index"), NUMBERS)
    return indexed.select(
        F.col("index").cast("string").alias("index"),
        date_from_parts("annee", "mois", "jour", lenient=views.lenient).alias("date_deces"),
        *columns,
        F.lit(1).alias("deces_nb"),
    )
