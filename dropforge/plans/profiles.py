"""Input profiles of complaints and missions."""

from __future__ import annotations

from pyspark.sql import functions as F

from dropforge.functions.text import pad_if_length
from dropforge.operators.profile import input_profile
from dropforge.operators.profile_state import Profile
from dropforge.plans.registry import view

_MISSION_COUNTS = {
    "key_count": "nombre_distinct_id_missions",
    "length_kinds": "nombre_de_longueurs_differentes_finess",
}
#: Profiles to keep the state of with each load, so that one of the whole history needs no scan of it.
KEPT = {
    "sa_siicea_missions_real": Profile("identifiant_de_la_mission", "finess_geographique", "date_reelle_visite", **_MISSION_COUNTS),
    "sa_sirec": Profile("numero_de_la_reclamation", "n_finess_rpps", "date_de_reception_a_l_ars", "nombre_distinct_reclamations"),
}


@view("staging__siicea_input_test")
def missions(views):
    return input_profile(
        views.view("staging__sa_siicea_missions_real"),
        key="identifiant_de_la_mission",
        code="finess_geographique",
        when="date_reelle_visite",
        **_MISSION_COUNTS,
    )


@view("staging__helios_siicea_missions_test")
def padded_missions(views):
    """The mission profile over the padded facility code."""
    padded = views.view("staging__sa_siicea_missions_real").select(
        "identifiant_de_la_mission",
        pad_if_length("finess_geographique", 8).alias("cd_finess"),
        "date_reelle_visite",
    )
    return input_profile(
        padded,
        key="identifiant_de_la_mission",
        code="cd_finess",
        when="date_reelle_visite",
        **_MISSION_COUNTS,
    )


@view("staging__sirec_input_test")
def complaints(views):
    """The complaint profile; its date columns carry the names of the mission profile."""
    return input_profile(
        views.view("staging__sa_sirec").select(
            "numero_de_la_reclamation",
            F.col("n_finess_rpps").cast("string").alias("n_finess_rpps"),
            "date_de_reception_a_l_ars",
        ),
        key="numero_de_la_reclamation",
        code="n_finess_rpps",
        when="date_de_reception_a_l_ars",
        key_count="nombre_distinct_reclamations",
    )
