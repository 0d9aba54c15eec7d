"""Declared sources: one entry per drop, with its landing keyword, delimiter and fixed schema.

Schemas are declared, never inferred. A drop is read as text and conformed to these fields; the length
a text field is cut to travels in the field metadata.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

MAX_LENGTH = "max_length"


@dataclass(frozen=True)
class Source:
    """A delimited drop and the table it lands in."""

    name: str
    keyword: str
    folder: str = ""
    sep: str | None = None  # None: guess from the header line
    any_extension: bool = False  # True: archives and workbooks are not skipped when drops are chosen
    multiline: bool = False  # quoted newlines; makes a file unsplittable, so it is set per source
    fields: tuple[T.StructField, ...] | None = None  # None: every header column, as text

    @property
    def schema(self) -> T.StructType:
        if self.fields is None:
            raise ValueError(f"{self.name} has no declared columns; use with_columns() or its header")
        return T.StructType(list(self.fields))

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def with_columns(self, names) -> Source:
        """Declare the columns of an open source, all text."""
        return replace(self, fields=_fields(" ".join(names)))


SOURCES: dict[str, Source] = {}


def source(name: str, keyword: str, folder: str, **options) -> None:
    SOURCES[name] = Source(name, keyword, folder, **options)


def _fields(names, *, integer="", long="", real="", length=None, default_length=None, unbounded=""):
    """Fields for a blank-separated name list; text unless listed under another type."""
    kinds = {n: T.IntegerType() for n in integer.split()}
    kinds |= {n: T.LongType() for n in long.split()}
    kinds |= {n: T.FloatType() for n in real.split()}
    free = set(unbounded.split())
    out = []
    for n in names.split():
        kind = kinds.get(n, T.StringType())
        cut = (length or {}).get(n, None if n in free else default_length)
        meta = {MAX_LENGTH: cut} if cut and isinstance(kind, T.StringType) else None
        out.append(T.StructField(n, kind, True, meta))
    return tuple(out)


# ---- Fixed values: the column names and types below are those of the landed files. ----

_AGENT_COLUMNS = "nom prenom role_mission profession statut departement temps_total"


def _mission_fields():
    """Planned and completed missions share one layout: a head, seven columns for each of ten agents, a tail."""
    agents = [f"{c}_agent_{i}" for i in range(1, 11) for c in _AGENT_COLUMNS.split()]
    return _fields(
        f"""
        identifiant_de_la_mission mission_proposee_par secteur_d_intervention code_theme_igas
        theme_igas code_theme_regional theme_regional type_d_orientation commanditaire_principal
        referent_thematique references_reglementaires type_de_mission modalite_d_investigation
        type_de_planification modalite_de_la_mission critere_de_ciblage_1 critere_de_ciblage_2
        critere_de_ciblage_3 mission_conjointe_avec_1 mission_conjointe_avec_2 code_uai code_rpps
        code_siret departement commune adresse groupe_de_cibles cible service_cible
        caractere_juridique type_de_cible finess_geographique
        {" ".join(agents)}
        commentaire periode_de_realisation date_provisoire_debut_mission date_reelle_debut_mission
        etat_d_avancement_debut_mission date_provisoire_visite date_reelle_visite
        etat_d_avancement_visite date_provisoire_rapport date_reelle_rapport
        etat_d_avancement_rapport date_provisoire_fin_mission date_reelle_fin_mission
        etat_d_avancement_fin_mission commentaire_1 niveau_de_risque nombre_d_ecarts
        nombre_de_remarques injonction complement prescription recommandation saisine_cng
        saisine_juridiction_ordinale saisine_parquet autre_saisine commentaire_2
        statut_de_la_mission
        """,
        integer="""
        temps_total_agent_1 temps_total_agent_2 temps_total_agent_3 nombre_d_ecarts
        nombre_de_remarques injonction prescription recommandation saisine_cng
        saisine_juridiction_ordinale saisine_parquet autre_saisine
        """,
        real="temps_total_agent_4 temps_total_agent_5",
    )


source(
    "sa_insern", "DNUM_TdB_CertDc", "INSERN",
    fields=_fields(
        """
        annee mois jour departement_code commune_code et_finess lieu_de_deces source
        """,
        integer="annee mois jour",
    ),
)

source(
    "sa_siicea_cibles", "GROUPECIBLES_SCN", "SIICEA", sep=",",
    fields=_fields(
        """
        finess finess_ej rpps siret code_ape code_uai groupe_cibles nom_cible code_departement
        commune adresse nb_mission_realisees nb_mission_abandonnees nb_decisions
        """,
        integer="nb_mission_realisees nb_mission_abandonnees nb_decisions",
    ),
)

source(
    "sa_siicea_decisions", "DECISIONS_SCN", "SIICEA", multiline=True, sep=",",
    fields=_fields(
        """
        type_de_decision complement theme_decision sous_theme_decision nombre_d_ecart commentaire
        nombre_de_decisions statut_de_decision identifiant_de_la_mission
        date_realisation_visite_mission type_de_mission modalite_d_investigation groupe_de_cibles
        nom_de_la_cible finess_geographique finess_de_rattcahement identifiant_rpps
        identifiant_siret identifiant_uai code_ape type_d_etablissement departement commune
        coordonnateur_mission date_previsionelle date_de_realisation etat_d_avancement
        action_type_action commentaire_action date_echeance_previsionnelle_action
        date_realisation_action etat_avancement_action
        """,
        integer="nombre_de_decisions",
        default_length=50,
        length={"sous_theme_decision": 64, "commentaire": 2048},
        unbounded="finess_geographique finess_de_rattcahement identifiant_siret departement",
    ),
)

source("sa_siicea_missions_prog", "MISSIONSPREV", "SIICEA", multiline=True, sep=",", fields=_mission_fields())

source("sa_siicea_missions_real", "MISSIONSREAL_SCN", "SIICEA", multiline=True, sep=",", fields=_mission_fields())

source(
    "sa_sirec", "sirec", "SIREC", multiline=True, sep=";",
    fields=_fields(
        """
        numero_de_la_reclamation ancien_numero_de_la_reclamation numero_demat_social
        service_gestionnaire statut_de_la_reclamation services_en_lecture signalement
        date_de_la_demande_du_requerant date_de_reception_a_l_ars service_de_premier_niveau
        date_de_reception_au_service_de_premier_niveau description
        date_de_creation_de_la_reclamation domaine_fonctionnel mode_de_reception prioritaire_oui_non
        precisions_sur_le_caractere_prioritaire departement_de_la_reclamation
        destinataire_s_de_la_reclamation destinataire_primaire destinataire_secondaire
        saisine_du_procureur_par_requerant institutions_de_provenance
        date_de_reception_a_l_institution_de_provenance reponse_attendue courrier_signale_oui_non
        le_requerant_est le_requerant_est_anonyme le_requerant_souhaite_garder_l_anonymat
        statut_du_requerant plus_de_2_reclamations_deposees usager_victime_non_identifiee
        sans_mis_en_cause n_finess_rpps autre_type nom_structure adresse code_postal ville
        service_pour_les_etablissements_sanitaires observations_du_mis_en_cause motifs_igas_entree
        motifs_igas_sortie niveau_de_competence_de_traitement_de_la_reclamation
        institution_s_partenaire_s precisions_sur_le_niveau_de_competence_de_traitement_de_la_recl
        envoi_d_un_accuse_reception date_d_envoi_de_l_ar precisions_sur_le_non_envoi_de_l_ar
        date_de_transfert_a_l_institution_competente
        date_de_prise_en_charge_par_le_service_gestionnaire type_de_traitement
        precisions_sur_le_type_de_traitement reclamation_en_lien_avec_un_ou_plusieurs_signalements
        numero_s_de_signalement_s_associe_s date_d_examen_en_commission type_d_action
        mesures_prises_par_le_mis_en_cause mesures_a_l_initiative_de reponse_au_requerant_par_l_ars
        date_de_reponse_au_requerant precisions_sur_la_reponse_au_requerant
        date_de_reponse_a_l_institution_de_provenance motif_de_cloture commentaire date_de_cloture
        siege_ars motifs_declares
        """,
        long="code_postal",
    ),
)

source(
    "sa_sivss", "SIVSS_SCN", "SIVSS", multiline=True, sep="¤",
    fields=_fields(
        """
        structure_intitule numero_sivss date_reception famille_principale nature_principale
        autre_signal_libelle famille_secondaire nature_secondaire autre_signal_secondaire_libelle
        est_eigs consequences_personne_exposee reclamation declarant_est_anonyme
        declarant_qualite_fonction declarant_categorie declarant_organisme_type
        declarant_etablissement_type declarant_organisme_numero_finess declarant_organisme_nom
        declarant_organisme_region declarant_organisme_departement declarant_organisme_code_postal
        declarant_organisme_commune declarant_organisme_code_insee survenue_cas_collectivite
        scc_organisme_type scc_etablissement_type scc_organisme_nom scc_organisme_finess
        scc_organisme_region scc_organisme_departement scc_organisme_code_postal
        scc_organisme_commune scc_organisme_code_insee etat support_signalement date_cloture
        motif_cloture
        """,
        length={"est_eigs": 5, "reclamation": 5, "declarant_est_anonyme": 5, "survenue_cas_collectivite": 5},
    ),
)

source(
    "sa_t_finess", "t-finess", "T_FINESS",
    fields=_fields(
        """
        source date_maj finess finess8 etat date_extract_finess rs type ej_finess ej_rs et_finess
        et_rs siren siret date_autorisation date_ouverture date_maj_finess adresse_num_voie
        adresse_comp_voie adresse_type_voie adresse_nom_voie adresse_lieuditbp adresse_code_postal
        adresse_lib_routage telephone telecopie com_code statut_jur_code statut_jur_lib
        statut_jur_etat statut_jur_niv3_code statut_jur_niv3_lib statut_jur_niv2_code
        statut_jur_niv2_lib statut_jur_niv1_code statut_jur_niv1_lib categ_code categ_lib
        categ_lib_court categ_etat categ_niv3_code categ_niv3_lib categ_niv2_code categ_niv2_lib
        categ_niv1_code categ_niv1_lib categ_domaine esms esms_capatot_inst esms_capainternat_inst
        esms_esh esms_ash esms_pa san san_med san_chir san_obs san_psy san_sld san_urg san_rea
        san_dialyse san_cancer san_ssr nb_scanners nb_irm gestion_ars gestion_dreets gestion_drihl
        version_nomenclature tutelle mft_code mft_lib sph_code sph_lib geoloc_source
        geoloc_precision geoloc_legal_x geoloc_legal_y geoloc_legal_projection geoloc_3857_x
        geoloc_3857_y geoloc_4326_long geoloc_4326_lat
        """,
    ),
)

source(
    "v_comer", "v_comer", "INSEE",
    fields=_fields(
        """
        comer tncc ncc nccenr libelle
        """,
    ),
)

source(
    "v_commune_comer", "v_commune_comer", "INSEE",
    fields=_fields(
        """
        com_comer tncc ncc nccenr libelle nature_zonage comer libelle_comer
        """,
    ),
)

source(
    "v_commune_depuis", "v_commune_depuis", "INSEE",
    fields=_fields(
        """
        com tncc ncc nccenr libelle date_debut date_fin
        """,
    ),
)

source(
    "v_commune", "v_commune_2024", "INSEE",
    fields=_fields(
        """
        typecom com reg dep ctcd arr tncc ncc nccenr libelle can comparent
        """,
    ),
)

source(
    "v_departement", "v_departement", "INSEE",
    fields=_fields(
        """
        dep reg cheflieu tncc ncc nccenr libelle
        """,
        integer="tncc",
    ),
)

source(
    "v_region", "v_region", "INSEE",
    fields=_fields(
        """
        reg cheflieu tncc ncc nccenr libelle
        """,
        integer="tncc",
    ),
)

source(
    "cert_dc_insern_n2_n1", "sa_insern_n_2_n_1", "INSERN/historique",
    fields=_fields(
        """
        index annee mois jour departement_code commune_code et_finess lieu_de_deces source deces_nb
        """,
        integer="annee mois jour deces_nb",
    ),
)

source(
    "cert_dc_insern_2023_2024", "CertDCInsern_2023_2024", "INSERN/historique",
    fields=_fields(
        """
        index annee mois jour departement_code commune_code et_finess lieu_de_deces source deces_nb
        """,
        integer="annee mois jour deces_nb",
    ),
)

source(
    "sa_esms", "sa_esms", "DIAMANT/pour le script etl", any_extension=True,
    fields=_fields(
        """
        column1 annee finess total
        """,
        integer="column1 total",
    ),
)

source(
    "sa_pmsi", "sa_pmsi", "DIAMANT/pour le script etl", any_extension=True,
    fields=_fields(
        """
        column1 mois finess somme_de_mco_hors_seances somme_de_mco_seances somme_de_ssr somme_de_had
        somme_de_psy
        """,
        integer="column1 somme_de_mco_hors_seances somme_de_mco_seances somme_de_ssr somme_de_had somme_de_psy",
    ),
)

source(
    "sa_rpu", "sa_rpu", "DIAMANT/pour le script etl", any_extension=True,
    fields=_fields(
        """
        column1 mois finess total
        """,
        integer="column1 total",
    ),
)

source(
    "sa_usld", "sa_usld", "DIAMANT/pour le script etl", any_extension=True,
    fields=_fields(
        """
        column1 annee finess total
        """,
        integer="column1 total",
    ),
)

source(
    "sa_hubee", "sa_hubee", "HUBEE",
    fields=_fields(
        """
        type_d_organisation companyregister_de_l_organisation branchcode_de_l_organisation
        nom_de_l_organisation nom_operateur_de_service_en_ligne code_demarche nom_de_la_demarche
        n_datapass modalite_d_acces statut date_de_creation date_de_validation date_d_activation
        date_de_suspension date_de_modification frequence_de_notification email_de_notification
        administrateur_local edt companyregister_edt branchcode_edt nom_de_l_organisation_edt
        """,
    ),
)

source(
    "dc_det", "DC_det", "INSEE",
    fields=_fields(
        """
        date adec mdec jdec depdec comdec depdom regdom anais mnais jnais sexe depnais pnais
        lieudeces_r
        """,
        integer="adec mdec jdec anais mnais jnais",
    ),
)

source(
    "sa_insee_histo", "sa_insee_n_2_n_3", "INSEE/historique",
    fields=_fields(
        """
        adec mdec jdec depdec comdec anais mnais jnais sexe comdom lieudec2
        """,
        integer="adec mdec jdec anais mnais jnais",
    ),
)

source(
    "sa_ciblage", "ciblage", "TMP",
    fields=_fields(
        """
        code_reg region code_dep departement categorie libelle_categorie finess_geographique
        raison_sociale_et ouvert_fermee principale_secondaire finess_juridique raison_sociale_ej
        statut_juridique adresse code_postal commune code_commune_insee date_d_ouverture public
        capacite_totale_autorisee internat tma externat mo autre
        nombre_de_personnes_accompagnees_au_31_12_2023 nombre_de_places_installees_hp_au_31_12_2023
        nombre_de_places_installees_ht_au_31_12_2023 nombre_de_places_installees_aj_au_31_12_2023
        deficit_ou_excedent_2020 deficit_ou_excedent_2021 deficit_ou_excedent_2022 total_des_charges
        produits_de_la_tarification produits_du_compte_70
        total_des_produits_hors_c_775_777_7781_et_78 saisie_des_indicateurs_du_tdb_ms_campagne_2024
        taux_d_absenteisme_2021 taux_d_absenteisme_2022 taux_d_absenteisme_2023
        absenteisme_moyen_sur_la_periode taux_de_rotation_du_personnel_titulaire_2021
        taux_de_rotation_du_personnel_titulaire_2022 taux_de_rotation_du_personnel_titulaire_2023
        rotation_moyenne_du_personnel_sur_la_periode etp_vacants_2021 etp_vacants_2022
        etp_vacants_2023 etp_vacants_moyen_sur_la_periode dont_taux_de_fonctions_soins_2023
        dont_taux_de_fonctions_socio_educatives_2023
        taux_de_prestations_externes_sur_les_prestations_directes_2021
        taux_de_prestations_externes_sur_les_prestations_directes_2022
        taux_de_prestations_externes_sur_les_prestations_directes_2023
        taux_moyen_de_prestations_externes_sur_les_prestations_directes
        nombre_total_d_etp_par_usager_en_2021 nombre_total_d_etp_par_usager_en_2022
        nombre_total_d_etp_par_usager_en_2023 nombre_moyen_d_etp_par_usager_sur_la_periode
        etp_soins_par_usager_en_2023 medical total_du_nombre_d_etp taux_de_personnel_soins
        taux_de_personnel_socio_educatif deficiences_intellectuelles deficiences_auditives
        deficiences_visuelles deficiences_motrices
        deficiences_metaboliques_viscerales_et_nutritionnelles autres_types_de_deficiences
        taux_de_residents_de_plus_de_20_ans taux_de_vetuste_des_constructions
        taux_de_vetuste_des_equipements_en nombre_de_reclamations_sur_la_periode_2021_2024
        rapport_reclamations_capacite_totale_autorisee hotellerie_locaux_restauration
        probleme_d_organisation_ou_de_fonctionnement_de_l_etablissement
        probleme_de_qualite_des_soins_medicaux probleme_de_qualite_des_soins_paramedicaux
        recherche_d_etablissement_ou_d_un_professionnel mise_en_cause_attitude_des_professionnels
        informations_et_droits_des_usagers facturation_et_honoraires sante_environnementale
        activites_d_esthetique_reglementees nb_eigs nb_eias
        somme_ei_eigs_eias_sur_la_periode_2021_2024 ice_2021_2024_realise
        inspection_sur_site_2021_2024_deja_realisee controle_sur_piece_2021_2024_deja_realise
        inspection_controle_programme annee_de_derniere_inspection
        """,
    ),
)

# The facility dashboard is several hundred text columns wide and changes with every campaign, so its
# columns are a parameter: the normalised header of the drop, or a list handed to ``with_columns``.
source("sa_tdb_esms", "sa_tdb_esms", "TMP")
