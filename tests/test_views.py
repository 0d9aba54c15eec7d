"""Views over small literal sources; every case of the fixtures list has a row here."""

from datetime import date

import pytest
from pyspark.sql import types as T

from dropforge.plans import VIEWS, Cutoffs, Views
from dropforge.plans.constants import EXCLUDED_TYPES, THEMES
from dropforge.sinks.store import Store
from dropforge.sources.schemas import SOURCES

TODAY = date(2025, 8, 15)
ELDERLY = "Etablissements et Services pour Personnes Agées"


@pytest.fixture
def sources(spark):
    """Builds views over rows given as dictionaries; columns not given are blank, or 0 for numbers."""

    def build(tables, today=TODAY, **options):
        def read(name):
            source = SOURCES[name]
            if source.fields is None:
                source = source.with_columns(["index", "1_an"])
            rows = []
            for given in tables.get(name, []):
                unknown = set(given) - set(source.columns)
                assert not unknown, unknown
                rows.append(tuple(
                    given.get(f.name, "" if isinstance(f.dataType, T.StringType) else
                              0.0 if isinstance(f.dataType, T.FloatType) else 0)
                    for f in source.fields
                ))
            return spark.createDataFrame(rows, source.schema)

        return Views(read, today, **options)

    return build


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def mission(i, **given):
    base = {
        "identifiant_de_la_mission": i,
        "statut_de_la_mission": "Clôturé",
        "secteur_d_intervention": "Médico-social",
        "type_de_cible": ELDERLY,
        "code_theme_igas": THEMES[0],
        "theme_igas": "label",
        "type_de_mission": "Inspection",
        "date_reelle_visite": "15-06-2023",
        "finess_geographique": "12345678",
    }
    return base | given


def test_every_view_builds(sources):
    views = sources({})
    for name in VIEWS:
        assert views.view(name).columns
    assert len(VIEWS) == 48


def test_geography(sources):
    views = sources({
        "v_departement": [{"dep": "01", "reg": "84", "libelle": "Ain"}, {"dep": "971", "reg": "", "libelle": "Guadeloupe"}],
        "v_region": [{"reg": "84", "libelle": "ARA"}],
        "v_comer": [{"comer": "975", "libelle": "SPM"}],
        "v_commune": [
            {"com": "01004", "reg": "84", "dep": "01", "libelle": "Ambérieu"},
            {"com": "01005", "reg": "", "dep": "01", "libelle": "no region"},
            {"com": "97105", "reg": "01", "dep": "971", "libelle": "Basse-Terre"},
        ],
        "v_commune_comer": [{"com_comer": "97501", "comer": "975", "libelle": "Miquelon"}],
        "v_commune_depuis": [
            {"com": "01004", "libelle": "Ambérieu", "date_debut": "1943-01-01"},
            {"com": "01004", "libelle": "Ambérieu", "date_debut": "1955-03-31"},
            {"com": "2A004", "libelle": "Ajaccio"},
            {"com": "97801", "libelle": "Saint-Martin"},
        ],
    })
    assert rows(views.view("staging__ref_departements"), "dep", "reg") == [("01", "84"), ("971", ""), ("975", "975")]
    assert rows(views.view("staging__ref_regions"), "reg") == [("84",), ("975",)]
    assert rows(views.view("staging__ref_communes"), "com", "reg", "dep") == [
        ("01004", "84", "01"), ("2A004", None, "2A"), ("97105", "01", "971"), ("97501", "975", "975"),
        ("97801", None, "978"),
    ]
    assert rows(views.view("staging__ref_geo"), "com_cd", "dep_lb", "reg_cd", "reg_lb") == [
        ("01004", "Ain", "84", "ARA"), ("2A004", None, None, None), ("97105", "Guadeloupe", None, None),
        ("97501", "SPM", "975", "SPM"), ("97801", None, None, None),
    ]


FACILITIES = [
    {"finess": "1", "com_code": "1004", "categ_code": "500", "etat": "ACTUEL"},
    {"finess": "2", "com_code": "01004", "categ_code": "448", "etat": "ACTUEL"},
    {"finess": "3", "com_code": "97105", "categ_code": "500", "etat": "FERME"},
    {"finess": "4", "com_code": "", "categ_code": "0182"},
    {"finess": "5", "com_code": None, "categ_code": "999"},
]
PLACES = {
    "v_commune": [
        {"com": "01004", "dep": "01", "reg": "84", "libelle": "Ambérieu"},
        {"com": "01004", "dep": "01", "reg": "84", "libelle": "Ambérieu (déléguée)"},
        {"com": "97105", "dep": "971", "reg": "01", "libelle": "Basse-Terre"},
    ],
    "v_departement": [{"dep": "01", "reg": "84", "libelle": "Ain"}, {"dep": "971", "reg": "01", "libelle": "Guadeloupe"}],
    "v_region": [{"reg": "84", "libelle": "ARA"}],
}


def test_labelled_register(sources):
    tables = PLACES | {"sa_t_finess": FACILITIES}
    df = sources(tables).view("staging__cert_dc_finess")
    assert len(df.columns) == 82 and dict(df.dtypes)["categ_code"] == "int"
    assert "san_rea" not in df.columns and "esms_capaTot_inst" in df.columns
    picked = ("finess", "com_code", "categ_code", "commune_libelle", "departement_libelle")
    assert rows(df, *picked) == [
        ("1", "01004", 500, "Ambérieu (déléguée)", "Ain"), ("1", "01004", 500, "Ambérieu", "Ain"),
        ("2", "01004", 448, "Ambérieu (déléguée)", "Ain"), ("2", "01004", 448, "Ambérieu", "Ain"),
        ("3", "97105", 500, "Basse-Terre", None), ("4", "", 182, None, None), ("5", None, 999, None, None),
    ]
    overseas = sources(tables, overseas_departments=True).view("staging__cert_dc_finess")
    assert rows(overseas.where("finess = '3'"), "departement_libelle") == [("Guadeloupe",)]


def test_facilities_by_category(sources):
    df = sources(PLACES | {"sa_t_finess": FACILITIES}).view("staging__dgcs_query")
    assert rows(df, "finess", "commune_libelle", "departement_code", "region_libelle") == [
        ("2", "Ambérieu (déléguée)", "01", "ARA"), ("2", "Ambérieu", "01", "ARA"), ("4", None, None, None),
    ]


def test_bad_category_fails_unless_lenient(sources):
    tables = {"sa_t_finess": [{"finess": "1", "categ_code": "x"}, {"finess": "2", "categ_code": "182"}]}
    for name in ("staging__dgcs_query", "staging__cert_dc_finess"):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            sources(tables).view(name).collect()
    assert rows(sources(tables, lenient=True).view("staging__dgcs_query"), "finess") == [("2",)]
    assert rows(sources(tables, lenient=True).view("staging__cert_dc_finess"), "categ_code") == [(182,), (None,)]


def test_nursing_homes(sources):
    df = sources({"sa_t_finess": FACILITIES}).view("staging__tdb_ic_finess_500")
    assert rows(df, "finess", "com_code") == [("1", "01004")]


def test_dashboard_done(sources):
    tables = {"sa_siicea_missions_real": [
        mission("day-first"),
        mission("slashes", date_reelle_visite="15/06/2023"),
        mission("first day", date_reelle_visite="01-01-2022"),
        mission("last day", date_reelle_visite="31-12-2024"),
        mission("last day later", date_reelle_visite="2024-12-31 08:15:00"),
        mission("stamp", date_reelle_visite="2023-06-15 08:15:00"),
        mission("iso of ten", date_reelle_visite="2023-06-15"),
        mission("blank", date_reelle_visite=""),
        mission("null", date_reelle_visite=None),
        mission("open", statut_de_la_mission="Prévu"),
        mission("kept", statut_de_la_mission="Maintenu"),
        mission("sector", secteur_d_intervention="Sanitaire"),
        mission("target", type_de_cible="x"),
        mission("theme", code_theme_igas="x"),
        mission("null type", type_de_mission=None),
        *[mission(t, type_de_mission=t) for t in EXCLUDED_TYPES],
        mission("nine", finess_geographique="123456789"),
    ]}
    df = sources(tables).view("staging__tdb_ic_siicea_missions_real")
    assert len(df.columns) == 22
    assert [r[0] for r in rows(df, "identifiant_mission")] == [
        "day-first", "first day", "kept", "last day", "nine", "slashes", "stamp",
    ]
    assert rows(df.where("identifiant_mission = 'day-first'"), "theme_igas", "date_reelle_visite", "cd_finess") == [
        (THEMES[0], "2023-06-15 00:00:00", "012345678"),
    ]
    fixed = sources(tables, fixed=True).view("staging__tdb_ic_siicea_missions_real")
    assert len(fixed.columns) == 23
    assert rows(fixed.where("identifiant_mission = 'nine'"), "code_theme_igas", "theme_igas", "cd_finess") == [
        (THEMES[0], "label", "123456789"),
    ]


def test_dashboard_planned(sources):
    def planned(i, real, due, **given):
        return mission(i, date_reelle_visite=real, date_provisoire_visite=due, statut_de_la_mission="Prévu", **given)

    tables = {"sa_siicea_missions_prog": [
        planned("due later", "", "01-01-2025"),
        planned("due before", "", "30-12-2024"),
        planned("due on the cut-off", "", "31-12-2024"),
        planned("visited later", "02-01-2025", "01-01-2020"),
        planned("visited before", "02-01-2024", "01-01-2026"),
        planned("null visit", None, "01-01-2026"),
        planned("closed", "", "01-01-2025") | {"statut_de_la_mission": "Abandonné"},
        planned("null status", "", "01-01-2025") | {"statut_de_la_mission": None},
    ]}
    df = sources(tables).view("staging__tdb_ic_siicea_missions_prog")
    assert len(df.columns) == 23
    assert [r[0] for r in rows(df, "identifiant_mission")] == ["due later", "visited later"]
    earlier = sources(tables, cutoffs=Cutoffs(planned_after="2024-12-30 00:00:00"))
    assert [r[0] for r in rows(earlier.view("staging__tdb_ic_siicea_missions_prog"), "identifiant_mission")] == [
        "due later", "due on the cut-off", "visited later",
    ]


def test_recent_missions(sources):
    tables = {"sa_siicea_missions_real": [
        mission("first day", date_reelle_visite="01-01-2022"),
        mission("day before", date_reelle_visite="31-12-2021"),
        mission("yesterday", date_reelle_visite="14-08-2025"),
        mission("today", date_reelle_visite="15-08-2025"),
        mission("iso", date_reelle_visite="2023-06-15"),
        mission("blank", date_reelle_visite=""),
        mission("sector is free", secteur_d_intervention="Social"),
    ]}
    df = sources(tables).view("staging__helios_siicea_missions")
    assert len(df.columns) == 131
    assert [r[0] for r in rows(df, "identifiant_de_la_mission")] == ["first day", "sector is free", "yesterday"]


def test_iso_windows(sources):
    tables = {
        "sa_siicea_missions_real": [
            mission("iso", date_reelle_visite="2023-06-15"),
            mission("last day", date_reelle_visite="2024-12-31"),
            mission("last day later", date_reelle_visite="2024-12-31 08:15:00"),
            mission("day-first", date_reelle_visite="15-06-2023"),
        ],
        "sa_siicea_missions_prog": [
            mission("after", date_provisoire_visite="2024-10-01", statut_de_la_mission="Prévu"),
            mission("on", date_provisoire_visite="2024-09-30", statut_de_la_mission="Prévu"),
            mission("day-first sorts high", date_provisoire_visite="31-01-2020", statut_de_la_mission="Prévu"),
            mission("closed", date_provisoire_visite="2024-10-01"),
        ],
    }
    views = sources(tables)
    assert rows(views.view("staging__matrice_siicea_missions_real"), "identifiant_de_la_mission") == [
        ("iso",), ("last day",),
    ]
    assert rows(views.view("staging__matrice_siicea_missions_prog"), "identifiant_de_la_mission") == [
        ("after",), ("day-first sorts high",),
    ]


TARGETS = {
    "sa_siicea_cibles": [{"finess": f, "nom_cible": n} for f, n in (
        ("A", "many"), ("B", "one"), ("C", "none"), ("", "blank"), ("   ", "spaces"), (None, "null"))],
    "sa_siicea_missions_real": [
        mission("1", finess_geographique="A", date_reelle_visite="2023-01-01"),
        mission("2", finess_geographique="A", date_reelle_visite="2023-01-02", secteur_d_intervention="Sanitaire"),
        mission("3", finess_geographique="B", date_reelle_visite="2023-01-03"),
        mission("4", finess_geographique="B", date_reelle_visite="2021-01-03"),
        mission("5", finess_geographique="", date_reelle_visite="2023-01-04"),
        mission("6", finess_geographique=None, date_reelle_visite="2023-01-05"),
        mission("7", finess_geographique="C", date_reelle_visite="2023-01-05", secteur_d_intervention="Social"),
    ],
}


def test_targets(sources):
    df = sources(TARGETS).view("staging__tdb_ic_siicea_cibles")
    assert rows(df, "code_finess") == [("A",), ("B",), ("C",)]
    assert len(df.columns) == 13


def test_targets_with_missions(sources):
    df = sources(TARGETS).view("staging__matrice_siicea_cibles")
    assert len(df.columns) == 18
    assert rows(df, "nom_cible", "date_reelle_visite") == [
        ("blank", "2023-01-04"), ("many", "2023-01-01"), ("many", "2023-01-02"), ("one", "2023-01-03"),
    ]


def test_complaints(sources):
    tables = {"sa_sirec": [
        {"numero_de_la_reclamation": n, "n_finess_rpps": f, "date_de_reception_a_l_ars": d, "autre_type": "other"}
        for n, f, d in (
            ("seven", "1234567", "2023-01-01"), ("eight", "12345678", "2023-01-01"), ("nine", "123456789", "2024-12-30"),
            ("cut-off", "123456789", "2024-12-31"), ("later", "123456789", "2025-08-14"),
            ("yesterday timed", "123456789", "2025-08-14 10:00:00"), ("old", "123456789", "2021-12-31"),
            ("blank", "", ""), ("null", None, None),
        )
    ]}
    df = sources(tables).view("staging__matrice_sirec")
    assert len(df.columns) == 67
    assert rows(df, "numero_reclamation", "autre_type") == [
        ("eight", "12345678"), ("nine", "123456789"), ("old", "123456789"),
    ]
    fixed = sources(tables, fixed=True).view("staging__matrice_sirec")
    assert len(fixed.columns) == 68
    assert rows(fixed, "n_finess_rpps", "autre_type")[0] == ("12345678", "other")
    assert rows(sources(tables).view("staging__helios_sirec"), "numero_de_la_reclamation") == [
        ("cut-off",), ("eight",), ("later",), ("nine",), ("seven",),
    ]


def test_signals(sources):
    tables = {"sa_sivss": [
        {"numero_sivss": n, "date_reception": d} for n, d in (
            ("quarter end", "30/06/2025"), ("next month", "01/07/2025"), ("blank", ""), ("null", None))
    ]}
    df = sources(tables).view("staging__helios_sivss")
    assert rows(df, "numero_sivss", "date_reception") == [("blank", "--"), ("quarter end", "2025-06-30")]
    assert len(df.columns) == 38


def test_deaths(sources):
    day = {"annee": 2024, "mois": 2, "jour": 29, "source": "x"}
    df = sources({"sa_insern": [day, day, day | {"jour": 1}]}).view("staging__cert_dc_insern")
    assert df.columns[:3] == ["index", "date_deces", "annee"] and df.columns[-1] == "deces_nb"
    assert sorted(r["index"] for r in df.collect()) == ["1", "2", "3"]
    assert rows(df, "date_deces", "deces_nb") == [(date(2024, 2, 1), 1), (date(2024, 2, 29), 1), (date(2024, 2, 29), 1)]
    bad = {"sa_insern": [day | {"mois": 0}]}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sources(bad).view("staging__cert_dc_insern").collect()
    assert rows(sources(bad, lenient=True).view("staging__cert_dc_insern"), "date_deces") == [(None,)]


def test_profiles(sources):
    views = sources({
        "sa_siicea_missions_real": [
            mission("1", date_reelle_visite="2023-06-15"), mission("1", finess_geographique="123456789"),
            mission("2", finess_geographique="", date_reelle_visite=""),
        ],
        "sa_sirec": [{"numero_de_la_reclamation": "1", "n_finess_rpps": "12345678", "date_de_reception_a_l_ars": "2023-01-01"}],
    })
    assert views.view("staging__siicea_input_test").collect() == [
        (3, 2, 1, 1, 3, "", "2023-06-15", "", "", "2023", "06"),
    ]
    assert views.view("staging__helios_siicea_missions_test").first()["longueur_ok_finess"] == 2
    assert views.view("staging__sirec_input_test").collect() == [
        (1, 1, 1, 0, "2023-01-01", "2023-01-01", "2023", "01", "2023", "01"),
    ]


def test_profile_of_nothing_has_null_sums(sources):
    row = sources({}).view("staging__siicea_input_test").first()
    assert (row.nombre_de_lignes, row.nombre_distinct_id_missions) == (0, 0)
    assert row.longueur_ko_finess is None and row.annee_min is None


def test_kept_views_are_read_from_their_table(sources, spark, tmp_path):
    views = sources(PLACES)
    before = rows(views.view("staging__ref_geo"), "com_cd", "com_lb", "reg_lb")
    again = sources(PLACES)
    again.keep(Store(spark, root=str(tmp_path)), "staging__ref_departements", "staging__ref_regions", "staging__ref_communes")
    geo = again.view("staging__ref_geo")
    assert rows(geo, "com_cd", "com_lb", "reg_lb") == before
    plan = geo._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and "Exchange hashpartitioning" not in plan


def test_publish(sources, spark):
    names = sources({"v_region": [{"reg": "84"}]}).publish("staging__v_region", "staging__ref_regions")
    assert names == ["staging__v_region", "staging__ref_regions"]
    assert spark.sql("SELECT reg FROM staging__ref_regions").collect() == [("84",)]
