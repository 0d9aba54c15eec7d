"""One-row input profiles: counts, code lengths, and the range of a text date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.operators.joins import one_row


def input_profile(
    df: DataFrame, *, key: str, code: str, when: str, key_count: str, length_kinds: str | None = None
) -> DataFrame:
    """Profile ``df``; ``key_count`` and ``length_kinds`` name the two distinct counts (the latter is optional).

    Each distinct count is a branch of its own, which reads only its column: together, or mixed with minima of
    text, they would expand the input or sort it.
    """

    def length_is(n):
        return F.sum(F.when(F.length(code) == n, 1).otherwise(0))

    year, month = F.substring(when, 1, 4), F.substring(when, 6, 2)
    plain = df.agg(
        F.count(F.lit(1)).alias("nombre_de_lignes"),
        length_is(8).alias("longueur_ko_finess"),
        length_is(9).alias("longueur_ok_finess"),
        F.min(when).alias("date_reelle_visite_plus_ancienne"),
        F.max(when).alias("date_reelle_visite_plus_recente"),
        F.min(year).alias("annee_min"),
        F.min(month).alias("mois_min"),
        F.max(year).alias("annee_max"),
        F.max(month).alias("mois_max"),
    )
    profile = one_row(plain, df.agg(F.count_distinct(F.col(key)).alias(key_count)))
    if length_kinds:
        profile = one_row(profile, df.agg(F.count_distinct(F.length(code)).alias(length_kinds)))
    names = ["nombre_de_lignes", key_count, "longueur_ko_finess", "longueur_ok_finess"]
    names += [length_kinds] if length_kinds else []
    names += ["date_reelle_visite_plus_ancienne", "date_reelle_visite_plus_recente"]
    names += ["annee_min", "mois_min", "annee_max", "mois_max"]
    return profile.select(*names)
