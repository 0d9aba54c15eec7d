"""Source tables derived from the given tables.

Each declared source stands on one given table, read whole, and every column is an expression in the SQL both
Spark and DuckDB read alike. The rows carry what the views must cope with: blank, null and mixed date texts,
codes of several lengths, a facility code on a quarter of all missions, a commune code on a third of all
facilities, a certificate repeated for a third of all deaths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dropforge.sources.schemas import SOURCES, Source


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def padded(x: str, n: int) -> str:
    """Left-padded to ``n``, longer numbers kept whole."""
    return f"CASE WHEN LENGTH({text(x)}) >= {n} THEN {text(x)} ELSE LPAD({text(x)}, {n}, '0') END"


def _serial(k: str) -> str:
    return f"CAST(FLOOR({k} / 24) AS BIGINT)"


def _dep2(k: str) -> str:
    return f"LPAD({text(f'{k} % 24 + 1')}, 2, '0')"


def department(k: str) -> str:
    return f"CASE WHEN {k} % 29 = 0 THEN '971' WHEN {k} % 31 = 0 THEN '2A' ELSE {_dep2(k)} END"


def commune(k: str) -> str:
    return (
        f"CASE WHEN {k} % 29 = 0 THEN '971' || {padded(_serial(k), 2)}"
        f" WHEN {k} % 31 = 0 THEN '2A' || {padded(_serial(k), 3)}"
        f" ELSE {_dep2(k)} || {padded(_serial(k), 3)} END"
    )


def facility(k: str) -> str:
    """Codes of 7, 8 and 9 characters."""
    return (
        f"CASE WHEN {k} % 13 = 0 THEN {padded(k, 7)}"
        f" WHEN {k} % 3 = 0 THEN '1' || {padded(k, 7)} ELSE '75' || {padded(k, 7)} END"
    )


def _two(x: str) -> str:
    return f"LPAD({text(x)}, 2, '0')"


def iso(ts: str, years: int = 0) -> str:
    return f"{text(f'YEAR({ts}) + {years}')} || '-' || {_two(f'MONTH({ts})')} || '-' || {_two(f'DAY({ts})')}"


def day_first(ts: str, years: int = 0, sep: str = "-") -> str:
    year = text(f"YEAR({ts}) + {years}")
    return f"{_two(f'DAY({ts})')} || '{sep}' || {_two(f'MONTH({ts})')} || '{sep}' || {year}"


def part_of(ts: str, part: str) -> str:
    return f"CAST({part}({ts}) AS INT)"


YEARS = 26  # moves 1995-2001 to 2021-2027, around the cut-offs of the views

_ORDER_ISO = iso("o_orderdate", YEARS)
_VISIT = f"""CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN {_ORDER_ISO} WHEN 3 THEN {_ORDER_ISO}
 WHEN 4 THEN {_ORDER_ISO} || ' 08:15:00' WHEN 5 THEN {day_first('o_orderdate', YEARS, '/')}
 ELSE {day_first('o_orderdate', YEARS)} END"""

_MISSIONS = {
    "identifiant_de_la_mission": f"'M' || {text('o_orderkey - o_orderkey % 2')}",
    "secteur_d_intervention":
        "CASE o_custkey % 4 WHEN 2 THEN 'Sanitaire' WHEN 3 THEN 'Social' ELSE 'Médico-social' END",
    "code_theme_igas": """CASE (o_orderkey + o_custkey) % 10 WHEN 0 THEN 'MS634D13' WHEN 1 THEN 'MS634N1'
 WHEN 2 THEN 'MS634E1' WHEN 3 THEN 'MS634D12' WHEN 4 THEN 'MS634R1' WHEN 5 THEN 'MS634D11' WHEN 6 THEN 'MS634D15'
 WHEN 7 THEN 'MS634C10' WHEN 8 THEN 'MS100A1' ELSE NULL END""",
    "type_de_mission": """CASE (3 * o_orderkey + o_custkey) % 11 WHEN 0 THEN 'Audit' WHEN 1 THEN 'Evaluation'
 WHEN 2 THEN 'Audit franco-wallon' WHEN 3 THEN 'Visites de conformité' WHEN 4 THEN 'Enquête administrative'
 WHEN 5 THEN NULL WHEN 6 THEN 'audit' ELSE 'Inspection' END""",
    "type_de_cible": "CASE WHEN o_custkey % 3 = 0 THEN 'Etablissements et Services pour Personnes Handicapées'"
                     " ELSE 'Etablissements et Services pour Personnes Agées' END",
    "statut_de_la_mission": """CASE o_orderkey % 7 WHEN 0 THEN 'Abandonné' WHEN 1 THEN 'Maintenu' WHEN 2 THEN 'Prévu'
 WHEN 3 THEN 'Prévu' WHEN 4 THEN NULL ELSE 'Clôturé' END""",
    "finess_geographique":
        f"CASE WHEN o_orderkey % 4 = 1 THEN '' WHEN o_orderkey % 50 = 2 THEN NULL ELSE {facility('o_custkey')} END",
    "date_reelle_visite": _VISIT,
    "date_provisoire_visite": f"""CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN {_ORDER_ISO}
 WHEN 2 THEN {_ORDER_ISO} || ' 00:00:00' ELSE {day_first('o_orderdate', YEARS)} END""",
}

_HOT_COMMUNE = "22001"

# Source: the given table it stands on, a number that identifies a row, and its columns of interest.
BASES: dict[str, tuple[str, str, dict[str, str]]] = {
    "sa_siicea_missions_real": ("orders", "o_orderkey", _MISSIONS),
    "sa_siicea_missions_prog": ("orders", "o_orderkey", _MISSIONS),
    "sa_siicea_cibles": ("customer", "c_custkey", {
        "finess": f"CASE WHEN c_custkey = 7 THEN '' WHEN c_custkey % 50 = 3 THEN '   '"
                  f" WHEN c_custkey % 50 = 4 THEN NULL ELSE {facility('c_custkey')} END",
        "groupe_cibles": "c_mktsegment",
        "nom_cible": "c_name",
        "code_departement": department("c_custkey"),
        "commune": commune("c_custkey"),
    }),
    "sa_siicea_decisions": ("lineitem", "(l_orderkey * 8 + l_linenumber)", {
        "identifiant_de_la_mission": f"'M' || {text('l_orderkey')}",
        "finess_geographique": facility("l_suppkey"),
        "date_de_realisation": day_first("l_shipdate", YEARS),
        "type_de_decision": "l_returnflag",
    }),
    "sa_sirec": ("orders", "o_orderkey", {
        "numero_de_la_reclamation": f"'R' || {text('o_orderkey - o_orderkey % 3')}",
        "n_finess_rpps": f"CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE {facility('o_custkey')} END",
        "date_de_reception_a_l_ars": f"CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN NULL"
                                     f" WHEN 2 THEN {_ORDER_ISO} || ' 10:30:00' ELSE {_ORDER_ISO} END",
        "code_postal": "CAST(10000 + o_orderkey % 85000 AS BIGINT)",
        "motifs_declares": "o_orderpriority || '|' || o_orderstatus",
    }),
    "sa_sivss": ("lineitem", "(l_orderkey * 8 + l_linenumber)", {
        "numero_sivss": f"'S' || {text('l_orderkey * 8 + l_linenumber')}",
        "date_reception": f"CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN NULL"
                          f" WHEN 3 THEN {day_first('l_shipdate', YEARS, '/')}"
                          f" ELSE {day_first('l_shipdate', YEARS)} END",
        "date_cloture": f"CASE WHEN l_linestatus = 'O' THEN '' ELSE {day_first('l_shipdate', YEARS)} END",
        "est_eigs": "CASE WHEN l_quantity > 25 THEN 'true' ELSE 'false' END",
        "reclamation": "CASE WHEN l_tax > 0.04 THEN 'true' ELSE 'false' END",
        "declarant_est_anonyme": "'false'",
        "survenue_cas_collectivite": "'true'",
    }),
    "sa_t_finess": ("part", "p_partkey", {
        "finess": facility("p_partkey"),
        "rs": "p_name",
        "etat": "CASE WHEN p_partkey % 7 = 0 THEN 'FERME' ELSE 'ACTUEL' END",
        "categ_code": f"CASE p_partkey % 5 WHEN 0 THEN '500' WHEN 1 THEN '448' ELSE {text('180 + p_size')} END",
        "categ_lib": "p_type",
        "com_code": f"CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN ''"
                    f" WHEN p_partkey % 3 = 0 THEN '{_HOT_COMMUNE}'"
                    f" WHEN p_partkey % 2 = 0 AND SUBSTR({commune('p_partkey')}, 1, 1) = '0'"
                    f" THEN SUBSTR({commune('p_partkey')}, 2) ELSE {commune('p_partkey')} END",
    }),
    "v_comer": ("supplier", "s_suppkey", {
        "comer": f"'9' || {padded('s_suppkey', 4)}",
        "ncc": "UPPER(s_name)",
        "libelle": "s_name",
    }),
    "v_commune_comer": ("customer", "c_custkey", {
        "com_comer": f"'9' || {padded('c_custkey % 100', 4)} || '-' || {text('c_custkey')}",
        "comer": f"'9' || {padded('c_custkey % 100', 4)}",
        "libelle": "c_name",
    }),
    "v_commune_depuis": ("orders", "o_orderkey", {
        "com": f"CASE WHEN o_orderkey % 17 = 0 THEN {commune('o_orderkey')} ELSE {commune('o_custkey')} END",
        "ncc": f"'COMMUNE ' || {text('o_custkey')}",
        "libelle": f"'Commune ' || {text('o_custkey')}",
        "date_debut": iso("o_orderdate"),
        "date_fin": "''",
    }),
    "v_commune": ("customer", "c_custkey", {
        "typecom": "CASE WHEN c_custkey % 11 = 0 THEN 'COMD' ELSE 'COM' END",
        "com": f"CASE WHEN c_custkey % 100 = 99 THEN {commune('(c_custkey - 24)')} ELSE {commune('c_custkey')} END",
        "reg": f"CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 37 = 0 THEN NULL"
               f" ELSE {text('(c_custkey % 24 % 5 + 1) * 11')} END",
        "dep": department("c_custkey"),
        "ncc": f"'COMMUNE ' || {text('c_custkey')}",
        "libelle": f"'Commune ' || {text('c_custkey')}",
    }),
    "v_departement": ("nation", "n_nationkey", {
        "dep": f"CASE WHEN n_nationkey = 24 THEN '971' ELSE {_dep2('n_nationkey')} END",
        "reg": f"CASE WHEN n_nationkey = 7 THEN '' ELSE {text('(n_regionkey + 1) * 11')} END",
        "ncc": "n_name",
        "libelle": "LOWER(n_name)",
    }),
    "v_region": ("region", "r_regionkey", {
        "reg": text("(r_regionkey + 1) * 11"),
        "ncc": "r_name",
        "libelle": "LOWER(r_name)",
    }),
    "sa_insern": ("events", "event_id", {
        "annee": f"CASE WHEN event_id % 3 = 0 THEN 2024 ELSE {part_of('ts', 'YEAR')} END",
        "mois": f"CASE WHEN event_id % 3 = 0 THEN 2 ELSE {part_of('ts', 'MONTH')} END",
        "jour": f"CASE WHEN event_id % 3 = 0 THEN 29 ELSE {part_of('ts', 'DAY')} END",
        "departement_code": "CASE WHEN event_id % 3 = 0 THEN '75' ELSE " + _dep2("user_id") + " END",
        "commune_code": "CASE WHEN event_id % 3 = 0 THEN '75056' ELSE " + commune("user_id") + " END",
        "et_finess": f"CASE WHEN event_id % 3 = 0 THEN NULL ELSE {facility('user_id')} END",
        "lieu_de_deces": "CASE WHEN event_id % 3 = 0 THEN 'Domicile' ELSE event_type END",
        "source": "'CertDc'",
    }),
    "cert_dc_insern_n2_n1": ("events", "event_id", {
        "index": text("event_id"), "annee": part_of("ts", "YEAR"), "mois": part_of("ts", "MONTH"),
        "jour": part_of("ts", "DAY"), "deces_nb": "1",
    }),
    "cert_dc_insern_2023_2024": ("events", "event_id", {
        "index": text("event_id + 1"), "annee": part_of("ts", "YEAR"), "mois": part_of("ts", "MONTH"),
        "jour": part_of("ts", "DAY"), "deces_nb": "1",
    }),
    "dc_det": ("events", "event_id", {
        "date": day_first("ts"), "adec": part_of("ts", "YEAR"), "mdec": part_of("ts", "MONTH"), "jdec": part_of("ts", "DAY"),
        "comdec": commune("user_id"),
    }),
    "sa_insee_histo": ("orders", "o_orderkey", {
        "adec": part_of("o_orderdate", "YEAR"), "mdec": part_of("o_orderdate", "MONTH"),
        "jdec": part_of("o_orderdate", "DAY"), "comdec": commune("o_custkey"),
    }),
    "sa_esms": ("part", "p_partkey", {"finess": facility("p_partkey"), "total": "p_size"}),
    "sa_pmsi": ("orders", "o_orderkey", {
        "mois": f"SUBSTR({iso('o_orderdate')}, 1, 7)", "finess": facility("o_custkey"),
    }),
    "sa_rpu": ("orders", "o_orderkey", {
        "mois": f"SUBSTR({iso('o_orderdate')}, 1, 7)", "finess": facility("o_custkey"),
    }),
    "sa_usld": ("supplier", "s_suppkey", {"finess": facility("s_suppkey")}),
    "sa_hubee": ("customer", "c_custkey", {"nom_de_l_organisation": "c_name", "type_d_organisation": "c_mktsegment"}),
    "sa_ciblage": ("part", "p_partkey", {"finess_geographique": facility("p_partkey"), "commune": commune("p_partkey")}),
    "sa_tdb_esms": ("part", "p_partkey", {"index": text("p_partkey"), "finess_geographique": facility("p_partkey")}),
}

# The dashboard names that need care, among as many indicators as make it wide.
DASHBOARD_COLUMNS = [
    "index", "region", "departement", "finess_geographique", "1_an", "1_2_ans", "6_10_ans",
    *[f"indicateur_{i}" for i in range(1, 353)],
]


def declared(name: str) -> Source:
    source = SOURCES[name]
    return source.with_columns(DASHBOARD_COLUMNS) if source.fields is None else source


def _expressions(name: str) -> dict[str, str]:
    _, key, given = BASES[name]
    out = {}
    for i, f in enumerate(declared(name).fields):
        if f.name in given:
            out[f.name] = given[f.name]
        elif isinstance(f.dataType, T.IntegerType):
            out[f.name] = f"CAST({key} % {i + 5} AS INT)"
        elif isinstance(f.dataType, T.FloatType):
            out[f.name] = f"CAST({key} % {i + 5} AS FLOAT)"
        elif i % 5 == 0:
            out[f.name] = f"'v{i} ' || {text(f'{key} % 13')}"
        else:
            out[f.name] = f"'v{i}'"
    return out


def stand_in(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The source as a DataFrame over the given table."""
    base = table(spark, sf_dir, BASES[name][0])
    return base.selectExpr(*[f"{e} AS `{c}`" for c, e in _expressions(name).items()])


def reader(spark: SparkSession, sf_dir: str):
    """Table resolver for the views: each source is derived once."""
    made: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        if name not in made:
            made[name] = stand_in(spark, sf_dir, name)
        return made[name]

    return read


def stand_in_sql(name: str) -> str:
    columns = ", ".join(f'{e} AS "{c}"' for c, e in _expressions(name).items())
    return f"SELECT {columns} FROM {BASES[name][0]}"


def with_sources(names: str, body: str) -> str:
    """SQL of ``body`` over the named sources; ``body`` may go on with tables of its own after a comma."""
    ctes = ", ".join(f"{n} AS ({stand_in_sql(n)})" for n in names.split())
    return f"WITH {ctes} {body.strip()}"
