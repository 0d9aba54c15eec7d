"""Names and order of the columns of the renamed views, as fixed values."""

import pytest

from harness.views import view_queries

SMALL = "/root/testdata/sf0.001"

COLUMNS = {
    "staging__matrice_sirec": """
        numero_reclamation ancien_numero_reclamation numero_demat_social service_gestionnaire
        statut_reclamation services_en_lecture signalement date_demande_requerant date_reception_ars
        service_premier_niveau date_reception_service_premier_niveau description date_creation_reclamation
        domaine_fonctionnel mode_reception prioritaire_oui_non precisions_caractere_prioritaire
        departement_reclamation destinataires_reclamation destinataire_primaire destinataire_secondaire
        saisine_procureur_requerant institutions_provenance date_reception_institution_provenance
        reponse_attendue courrier_signale_oui_non le_requerant_est le_requerant_est_anonyme
        le_requerant_souhaite_garder_l_anonymat statut_requerant plus_de_2_reclamations_deposees
        usager_victime_non_identifiee sans_mis_en_cause autre_type nom_structure adresse code_postal ville
        service_etablissements_sanitaires observations_mis_en_cause motifs_igas_entree motifs_igas_sortie
        niveau_competence_traitement_reclamation institutions_partenaires
        precisions_niveau_competence_traitement_reclamation envoi_accuse_reception date_envoi_ar
        precisions_non_envoi_ar date_transfert_institution_competente
        date_prise_en_charge_service_gestionnaire type_traitement precisions_type_traitement
        reclamation_lien_signalements numeros_signalements_associes date_examen_commission type_action
        mesures_mis_en_cause mesures_a_initiative reponse_requerant_ars date_reponse_requerant
        precisions_reponse_requerant date_reponse_institution_provenance motif_cloture commentaire
        date_cloture siege_ars motifs_declares
    """,
    "staging__cert_dc_finess": """
        finess finess8 etat date_extract_finess rs type ej_finess ej_rs et_finess et_rs siren siret
        date_autorisation date_ouverture date_maj_finess adresse_num_voie adresse_comp_voie adresse_type_voie
        adresse_nom_voie adresse_lieuditbp adresse_code_postal adresse_lib_routage telephone telecopie
        com_code statut_jur_code statut_jur_lib statut_jur_etat statut_jur_niv3_code statut_jur_niv3_lib
        statut_jur_niv2_code statut_jur_niv2_lib statut_jur_niv1_code statut_jur_niv1_lib categ_code categ_lib
        categ_lib_court categ_etat categ_niv3_code categ_niv3_lib categ_niv2_code categ_niv2_lib
        categ_niv1_code categ_niv1_lib categ_domaine esms esms_capaTot_inst esms_capaInternat_inst esms_esh
        esms_ash esms_pa san san_med san_chir san_obs san_psy san_sld san_urg san_dialyse san_cancer
        nb_scanners nb_irm gestion_ars gestion_dreets gestion_drihl version_nomenclature tutelle mft_code
        mft_lib sph_code sph_lib geoloc_source geoloc_precision geoloc_legal_x geoloc_legal_y
        geoloc_legal_projection geoloc_3857_x geoloc_3857_y geoloc_4326_long geoloc_4326_lat commune_libelle
        departement_libelle
    """,
    "staging__helios_sivss": """
        structure_intitule numero_sivss date_reception famille_principale nature_principale
        autre_signal_libelle famille_secondaire nature_secondaire autre_signal_secondaire_libelle est_eigs
        consequences_personne_exposee reclamation declarant_est_anonyme declarant_qualite_fonction
        declarant_categorie declarant_organisme_type declarant_etablissement_type
        declarant_organisme_numero_finess declarant_organisme_nom declarant_organisme_region
        declarant_organisme_departement declarant_organisme_code_postal declarant_organisme_commune
        declarant_organisme_code_insee survenue_cas_collectivite scc_organisme_type scc_etablissement_type
        scc_organisme_nom scc_organisme_finess scc_organisme_region scc_organisme_departement
        scc_organisme_code_postal scc_organisme_commune scc_organisme_code_insee etat support_signalement
        date_cloture motif_cloture
    """,
}


@pytest.mark.parametrize("name", COLUMNS)
def test_names_and_order(spark, name):
    assert view_queries()[name](spark, SMALL).columns == COLUMNS[name].split()
