"""Views that hand on one landed table as it is."""

from __future__ import annotations

from dropforge.plans.registry import view

# View names that differ from ``staging__`` and the table name, and the table they read.
RENAMED = {
    "staging__sa_siicea_missions": "sa_siicea_missions_real",
    "staging__matrice_ciblage": "sa_ciblage",
    "staging__matrice_tdb_esms": "sa_tdb_esms",
    "staging__helios_siicea_decisions": "sa_siicea_decisions",
}

SAME_NAME = """
    sa_insern sa_siicea_cibles sa_siicea_decisions sa_siicea_missions_prog sa_siicea_missions_real sa_sirec
    sa_sivss sa_t_finess v_comer v_commune v_commune_comer v_commune_depuis v_departement v_region
    cert_dc_insern_2023_2024 cert_dc_insern_n2_n1 dc_det sa_esms sa_hubee sa_insee_histo sa_pmsi sa_rpu sa_usld
""".split()

PASSED_ON = {f"staging__{t}": t for t in SAME_NAME} | RENAMED


def _hand_on(table):
    return lambda views: views.source(table)


for _name, _table in PASSED_ON.items():
    view(_name)(_hand_on(_table))
