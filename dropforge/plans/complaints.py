"""Complaint views."""

from __future__ import annotations

from pyspark.sql import functions as F

from dropforge.functions.calendar import first_day_years_ago, yesterday
from dropforge.plans.registry import view
from dropforge.sources.schemas import SOURCES

# Complaint columns that are renamed; all others keep their name.
RENAMED = {
    "numero_de_la_reclamation": "numero_reclamation",
    "ancien_numero_de_la_reclamation": "ancien_numero_reclamation",
    "statut_de_la_reclamation": "statut_reclamation",
    "date_de_la_demande_du_requerant": "date_demande_requerant",
    "date_de_reception_a_l_ars": "date_reception_ars",
    "service_de_premier_niveau": "service_premier_niveau",
    "date_de_reception_au_service_de_premier_niveau": "date_reception_service_premier_niveau",
    "date_de_creation_de_la_reclamation": "date_creation_reclamation",
    "mode_de_reception": "mode_reception",
    "precisions_sur_le_caractere_prioritaire": "precisions_caractere_prioritaire",
    "departement_de_la_reclamation": "departement_reclamation",
    "destinataire_s_de_la_reclamation": "destinataires_reclamation",
    "saisine_du_procureur_par_requerant": "saisine_procureur_requerant",
    "institutions_de_provenance": "institutions_provenance",
    "date_de_reception_a_l_institution_de_provenance": "date_reception_institution_provenance",
    "statut_du_requerant": "statut_requerant",
    "service_pour_les_etablissements_sanitaires": "service_etablissements_sanitaires",
    "observations_du_mis_en_cause": "observations_mis_en_cause",
    "niveau_de_competence_de_traitement_de_la_reclamation": "niveau_competence_traitement_reclamation",
    "institution_s_partenaire_s": "institutions_partenaires",
    "precisions_sur_le_niveau_de_competence_de_traitement_de_la_recl":
        "precisions_niveau_competence_traitement_reclamation",
    "envoi_d_un_accuse_reception": "envoi_accuse_reception",
    "date_d_envoi_de_l_ar": "date_envoi_ar",
    "precisions_sur_le_non_envoi_de_l_ar": "precisions_non_envoi_ar",
    "date_de_transfert_a_l_institution_competente": "date_transfert_institution_competente",
    "date_de_prise_en_charge_par_le_service_gestionnaire": "date_prise_en_charge_service_gestionnaire",
    "type_de_traitement": "type_traitement",
    "precisions_sur_le_type_de_traitement": "precisions_type_traitement",
    "reclamation_en_lien_avec_un_ou_plusieurs_signalements": "reclamation_lien_signalements",
    "numero_s_de_signalement_s_associe_s": "numeros_signalements_associes",
    "date_d_examen_en_commission": "date_examen_commission",
    "type_d_action": "type_action",
    "mesures_prises_par_le_mis_en_cause": "mesures_mis_en_cause",
    "mesures_a_l_initiative_de": "mesures_a_initiative",
    "reponse_au_requerant_par_l_ars": "reponse_requerant_ars",
    "date_de_reponse_au_requerant": "date_reponse_requerant",
    "precisions_sur_la_reponse_au_requerant": "precisions_reponse_requerant",
    "date_de_reponse_a_l_institution_de_provenance": "date_reponse_institution_provenance",
    "motif_de_cloture": "motif_cloture",
    "date_de_cloture": "date_cloture",
}


@view("staging__helios_sirec")
def received_in_window(views):
    """Complaints received from January 1st some years back until yesterday, compared as ISO text."""
    received = F.col("date_de_reception_a_l_ars")
    return views.view("staging__sa_sirec").where(
        received.between(
            first_day_years_ago(views.today, views.cutoffs.years_back), str(yesterday(views.today))
        )
    )


@view("staging__matrice_sirec")
def renamed(views):
    """Complaints on a facility, under short names.

    The facility code stands under ``autre_type`` and has no column of its own; ``fixed`` gives both.
    """
    code = F.col("n_finess_rpps").cast("string")
    kept = views.view("staging__sa_sirec").where(
        F.length(code).isin(8, 9) & (F.col("date_de_reception_a_l_ars") < views.cutoffs.complaints_before)
    )
    columns = [F.col(c).alias(RENAMED.get(c, c)) for c in SOURCES["sa_sirec"].columns]
    if not views.fixed:
        at = SOURCES["sa_sirec"].columns.index("n_finess_rpps")
        columns[at : at + 2] = [code.alias("autre_type")]
    return kept.select(*columns)
