"""Communes, departments and regions, with overseas collectivities, and the hierarchy over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from dropforge.functions.text import department_of_commune
from dropforge.operators.joins import lookup
from dropforge.plans.registry import view


@view("staging__ref_departements")
def departments(views):
    mainland = views.view("staging__v_departement").select("dep", "reg", "ncc", "libelle")
    overseas = views.view("staging__v_comer").select(
        F.col("comer").alias("dep"), F.col("comer").alias("reg"), "ncc", "libelle"
    )
    return mainland.union(overseas).distinct()


@view("staging__ref_regions")
def regions(views):
    mainland = views.view("staging__v_region").select("reg", "ncc", "libelle")
    overseas = views.view("staging__v_comer").select(F.col("comer").alias("reg"), "ncc", "libelle")
    return mainland.union(overseas).distinct()


@view("staging__ref_communes")
def communes(views):
    """Current, overseas and historical communes; one duplicate removal over the three."""
    current = (
        views.view("staging__v_commune").where(F.col("reg") != "").select("com", "reg", "dep", "ncc", "libelle")
    )
    overseas = views.view("staging__v_commune_comer").select(
        F.col("com_comer").alias("com"),
        F.col("comer").alias("reg"),
        F.col("comer").alias("dep"),
        "ncc",
        "libelle",
    )
    past = views.view("staging__v_commune_depuis").select(
        "com", department_of_commune("com").alias("dep"), "ncc", "libelle"
    )
    past = lookup(past, "dep", views.view("staging__ref_departements"), "dep", reg="reg")
    columns = ["com", "reg", "dep", "ncc", "libelle"]
    return current.union(overseas).union(past.select(*columns)).distinct()


@view("staging__ref_geo")
def hierarchy(views):
    """Commune, department and region codes and labels; the region is that of the department."""
    com = views.view("staging__ref_communes").select(
        F.col("com").alias("com_cd"), F.col("libelle").alias("com_lb"), F.col("dep").alias("_dep")
    )
    geo = lookup(
        com, "_dep", views.view("staging__ref_departements"), "dep", dep_cd="dep", dep_lb="libelle", _reg="reg"
    )
    geo = lookup(geo, "_reg", views.view("staging__ref_regions"), "reg", reg_cd="reg", reg_lb="libelle")
    return geo.select("com_cd", "com_lb", "dep_cd", "dep_lb", "reg_cd", "reg_lb")
