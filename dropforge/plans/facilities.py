"""Facility register views."""

from __future__ import annotations

from pyspark.sql import functions as F

from dropforge.functions.text import department_of_commune, pad_if_length
from dropforge.operators.joins import lookup
from dropforge.plans.constants import CURRENT_STATE, FACILITY_CATEGORIES, NURSING_HOME_CATEGORY
from dropforge.plans.registry import view
from dropforge.sources.schemas import SOURCES

# Register columns the labelled register leaves out.
NOT_LABELLED = ("source", "date_maj", "san_rea", "san_ssr")
# Columns whose output spelling differs from the declared one.
RESPELLED = {"esms_capatot_inst": "esms_capaTot_inst", "esms_capainternat_inst": "esms_capaInternat_inst"}


@view("staging__cert_dc_finess")
def labelled_register(views):
    """The register with padded commune codes, an integer category, and commune and department labels."""
    derived = {
        "com_code": pad_if_length("com_code", 4),
        "categ_code": F.col("categ_code").try_cast("int") if views.lenient else F.col("categ_code").cast("int"),
    }
    columns = [c for c in SOURCES["sa_t_finess"].columns if c not in NOT_LABELLED]
    register = views.view("staging__sa_t_finess").select(
        *[derived.get(c, F.col(c)).alias(RESPELLED.get(c, c)) for c in columns]
    )
    department = (
        department_of_commune("com_code") if views.overseas_departments else F.substring("com_code", 1, 2)
    )
    register = lookup(register, "com_code", views.view("staging__v_commune"), "com", commune_libelle="libelle")
    return lookup(register, department, views.view("staging__v_departement"), "dep", departement_libelle="libelle")


@view("staging__dgcs_query")
def facilities_by_category(views):
    """Facilities of the listed categories, placed in the geography by their unpadded commune code."""
    category = F.col("categ_code")
    category = category.try_cast("int") if views.lenient else category.cast("int")
    facilities = (
        views.view("staging__sa_t_finess")
        .where(category.isin(*FACILITY_CATEGORIES))
        .select("finess", "com_code", "categ_code", "categ_lib", "etat")
    )
    geo = views.view("staging__v_commune").select("com", F.col("libelle").alias("commune_libelle"), "dep")
    geo = lookup(
        geo,
        "dep",
        views.view("staging__v_departement"),
        "dep",
        departement_code="dep",
        departement_libelle="libelle",
        _reg="reg",
    )
    geo = lookup(geo, "_reg", views.view("staging__v_region"), "reg", region_code="reg", region_libelle="libelle")
    labels = ("region_code", "region_libelle", "departement_code", "departement_libelle", "commune_libelle")
    return lookup(facilities, "com_code", geo, "com", **{c: c for c in labels})


@view("staging__tdb_ic_finess_500")
def nursing_homes(views):
    return (
        views.view("staging__sa_t_finess")
        .where((F.col("categ_code") == NURSING_HOME_CATEGORY) & (F.col("etat") == CURRENT_STATE))
        .select(
            "finess",
            "rs",
            pad_if_length("com_code", 4).alias("com_code"),
            "statut_jur_niv2_code",
            "statut_jur_niv2_lib",
            "etat",
        )
    )
