"""Inspection missions and their targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from dropforge.functions.calendar import first_day_years_ago, yesterday
from dropforge.functions.text import day_first_to_iso, pad_if_length, visit_timestamp
from dropforge.operators.factored import Factored
from dropforge.plans.constants import (
    CARE_SECTORS,
    CLOSED_STATUSES,
    DONE_STATUSES,
    ELDERLY_TARGET,
    EXCLUDED_TYPES,
    SOCIAL_SECTOR,
    THEMES,
)
from dropforge.plans.registry import view

REAL = "staging__sa_siicea_missions_real"
PLANNED = "staging__sa_siicea_missions_prog"


def theme_kept():
    return F.col("code_theme_igas").isin(*THEMES)


def type_kept():
    """A null type is dropped too."""
    return ~F.col("type_de_mission").isin(*EXCLUDED_TYPES)


def done():
    return F.col("statut_de_la_mission").isin(*DONE_STATUSES)


def still_open():
    return ~F.col("statut_de_la_mission").isin(*CLOSED_STATUSES)


def social():
    return F.col("secteur_d_intervention") == SOCIAL_SECTOR


def for_elderly():
    return F.col("type_de_cible") == ELDERLY_TARGET


# Output names of the dashboard columns, in order; a name alone is kept.
DASHBOARD = {
    "identifiant_de_la_mission": "identifiant_mission",
    "code_theme_igas": "code_theme_igas",
    "theme_igas": "theme_igas",
    "type_de_mission": "type_mission",
    "modalite_d_investigation": "modalite_d_investigation",
    "type_de_planification": "type_planification",
    "modalite_de_la_mission": "modalite_mission",
    "mission_conjointe_avec_1": "mission_conjointe_1",
    "mission_conjointe_avec_2": "mission_conjointe_2",
    "departement": "departement",
    "commune": "commune",
    "adresse": "adresse",
    "groupe_de_cibles": "groupe_cibles",
    "cible": "cible",
    "caractere_juridique": "caractere_juridique",
    "type_de_cible": "type_cible",
    "finess_geographique": "code_finess",
    "statut_de_la_mission": "statut_mission",
}


def _dashboard(missions, names):
    return missions.select(
        *[F.col(c).alias(out) for c, out in names.items()],
        visit_timestamp("date_provisoire_visite").alias("date_provisoire_visite"),
        visit_timestamp("date_reelle_visite").alias("date_reelle_visite"),
        "date_provisoire_fin_mission",
        "date_reelle_fin_mission",
        pad_if_length("finess_geographique", 8).alias("cd_finess"),
    )


@view("staging__tdb_ic_siicea_missions_prog")
def dashboard_planned(views):
    """Open missions visited, or if never visited planned, after the cut-off."""
    after = F.lit(views.cutoffs.planned_after)
    not_visited = F.col("date_reelle_visite") == ""
    upcoming = (not_visited & (visit_timestamp("date_provisoire_visite") > after)) | (
        visit_timestamp("date_reelle_visite") > after
    )
    kept = views.view(PLANNED).where(upcoming & still_open() & social() & for_elderly() & theme_kept() & type_kept())
    return _dashboard(kept, DASHBOARD)


@view("staging__tdb_ic_siicea_missions_real")
def dashboard_done(views):
    """Missions visited inside the window. The theme label column carries the theme code unless ``fixed``."""
    cut = views.cutoffs
    visited = visit_timestamp("date_reelle_visite").between(
        f"{cut.visits_from} 00:00:00", f"{cut.visits_to} 00:00:00"
    )
    kept = views.view(REAL).where(visited & done() & social() & for_elderly() & theme_kept() & type_kept())
    names = DASHBOARD | {"type_de_planification": "type_de_planification", "type_de_cible": "type_de_cible"}
    if not views.fixed:
        names = {c: out for c, out in names.items() if c != "theme_igas"} | {"code_theme_igas": "theme_igas"}
    return _dashboard(kept, names)


@view("staging__helios_siicea_missions")
def recent(views):
    """Done missions visited, by day-first date, from January 1st some years back until yesterday."""
    visited = day_first_to_iso("date_reelle_visite").between(
        first_day_years_ago(views.today, views.cutoffs.years_back), str(yesterday(views.today))
    )
    return (
        views.view(REAL)
        .where(theme_kept() & type_kept() & done() & visited)
        .select("*", pad_if_length("finess_geographique", 8).alias("cd_finess"))
    )


@view("staging__matrice_siicea_missions_real")
def done_in_window(views):
    """Done missions whose visit date, compared as ISO text, lies in the window."""
    visited = F.col("date_reelle_visite").between(views.cutoffs.visits_from, views.cutoffs.visits_to)
    return views.view(REAL).where(visited & done() & social() & theme_kept() & type_kept())


@view("staging__matrice_siicea_missions_prog")
def planned_after(views):
    """Open missions planned, by ISO text, after the cut-off."""
    planned = F.col("date_provisoire_visite") > views.cutoffs.planned_iso_after
    return views.view(PLANNED).where(planned & still_open() & social() & theme_kept() & type_kept())


@view("staging__tdb_ic_siicea_cibles")
def targets(views):
    """Targets that have a facility code."""
    return (
        views.view("staging__sa_siicea_cibles")
        .where(F.trim("finess") != "")
        .select(
            F.col("finess").alias("code_finess"),
            F.col("rpps").alias("code_rppss"),
            F.col("siret").alias("code_siret"),
            "code_ape",
            "code_uai",
            "groupe_cibles",
            "nom_cible",
            F.col("code_departement").alias("departement"),
            "commune",
            "adresse",
            "nb_mission_realisees",
            "nb_mission_abandonnees",
            F.col("nb_decisions").alias("nb_decisions_prises"),
        )
    )


_VISIT = ("date_reelle_visite", "statut_de_la_mission", "secteur_d_intervention", "type_de_mission")


def targets_and_missions(views) -> Factored:
    """Targets and done missions in the window by facility code, not joined yet.

    Blank codes equal each other, as they have always: ``counts`` tells how many rows they would make.
    """
    targets = views.view("staging__sa_siicea_cibles")
    missions = (
        views.view(REAL)
        .where(
            F.col("date_reelle_visite").between(views.cutoffs.visits_from, views.cutoffs.visits_to)
            & done()
            & F.col("secteur_d_intervention").isin(*CARE_SECTORS)
            & type_kept()
        )
        .select(F.col("finess_geographique").alias("_finess"), *_VISIT)
    )
    if not views.blank_codes:
        targets, missions = targets.where("finess <> ''"), missions.where("_finess <> ''")
    return Factored(targets, missions, "finess", "_finess")


@view("staging__matrice_siicea_cibles")
def targets_with_missions(views):
    """Targets beside their done missions in the window, many to many.

    The filters on the mission side make the left join an inner one, so they go below the join and both sides
    may be split where a facility code is hot. Blank codes are equal to each other, as they have always been: the
    number of their rows is that of blank targets times blank missions. ``blank_codes=False`` leaves them out;
    ``targets_and_missions`` gives the two sides with their counts instead.
    """
    sides = targets_and_missions(views)
    return sides.expand().select(*sides.left.columns, *_VISIT)
