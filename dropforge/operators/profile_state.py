"""Input profiles of a whole history from state that is kept by load, exact, without reading the history again.

With each load two small tables go into the same commit: ``<table>__profile``, one row of counts, extremes and code
lengths, and ``<table>__keys``, the different keys of the load. A profile of the history adds up the rows and counts the
different keys of all loads; a day that is loaded again brings its own state in place of the earlier one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.operators.joins import one_row

STATE, KEYS = "__profile", "__keys"
_SUMS = ("nombre_de_lignes", "longueur_ko_finess", "longueur_ok_finess")
_LEAST = ("date_reelle_visite_plus_ancienne", "annee_min", "mois_min")
_MOST = ("date_reelle_visite_plus_recente", "annee_max", "mois_max")


@dataclass(frozen=True)
class Profile:
    """The columns of ``dropforge.operators.profile.input_profile``."""

    key: str
    code: str
    when: str
    key_count: str
    length_kinds: str | None = None


def state_of(df: DataFrame, profile: Profile) -> DataFrame:
    """One row of what can be added up over loads."""
    code, when = F.col(profile.code), F.col(profile.when)
    length_is = lambda n: F.coalesce(F.sum(F.when(F.length(code) == n, 1).otherwise(0)), F.lit(0)).cast("long")
    year, month = F.substring(when, 1, 4), F.substring(when, 6, 2)
    return df.agg(
        F.count(F.lit(1)).alias("nombre_de_lignes"),
        length_is(8).alias("longueur_ko_finess"),
        length_is(9).alias("longueur_ok_finess"),
        F.min(when).alias("date_reelle_visite_plus_ancienne"),
        F.max(when).alias("date_reelle_visite_plus_recente"),
        F.min(year).alias("annee_min"),
        F.min(month).alias("mois_min"),
        F.max(year).alias("annee_max"),
        F.max(month).alias("mois_max"),
        F.collect_set(F.length(code)).alias("lengths"),  # as many as a code has lengths
    )


def keys_of(df: DataFrame, profile: Profile) -> DataFrame:
    return df.select(F.col(profile.key).cast("string").alias("key")).where("key IS NOT NULL").distinct()


def keep_state(run, table: str, day: date, profile: Profile, *, beside: bool = False) -> None:
    """Add the state of the load of ``table`` that ``run`` has just written; reads three columns of that load."""
    loaded = run.written(table, day)
    run.append_history(state_of(loaded, profile), table + STATE, day, beside=beside)
    run.append_history(keys_of(loaded, profile), table + KEYS, day, beside=beside)


def profile_of_history(store, table: str, profile: Profile) -> DataFrame:
    """``input_profile`` over the whole history of ``table``, from its state."""
    state = store.history(table + STATE)
    any_rows = F.sum("nombre_de_lignes") > 0
    plain = state.agg(
        F.coalesce(F.sum("nombre_de_lignes"), F.lit(0)).alias("nombre_de_lignes"),
        *[F.when(any_rows, F.sum(c)).alias(c) for c in _SUMS[1:]],
        *[F.min(c).alias(c) for c in _LEAST],
        *[F.max(c).alias(c) for c in _MOST],
    )
    found = one_row(plain, store.history(table + KEYS).agg(F.count_distinct("key").alias(profile.key_count)))
    if profile.length_kinds:
        lengths = state.select(F.explode("lengths").alias("n")).agg(F.count_distinct("n").alias(profile.length_kinds))
        found = one_row(found, lengths)
    names = ["nombre_de_lignes", profile.key_count, "longueur_ko_finess", "longueur_ok_finess"]
    names += [profile.length_kinds] if profile.length_kinds else []
    names += ["date_reelle_visite_plus_ancienne", "date_reelle_visite_plus_recente"]
    names += ["annee_min", "mois_min", "annee_max", "mois_max"]
    return found.select(*names)
