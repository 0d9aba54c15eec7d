"""What the plans must keep at scale."""

import pytest

from dropforge.plans import Views
from dropforge.sources.schemas import SOURCES
from harness.standins import stand_in

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views(spark, tmp_path_factory):
    """Views over landed Parquet tables."""
    root = tmp_path_factory.mktemp("landed")
    for name, source in SOURCES.items():
        if source.fields is not None:
            stand_in(spark, SMALL, name).write.parquet(f"{root}/{name}")
    return Views(lambda t: spark.read.parquet(f"{root}/{t}"), "2025-08-15")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line]


def test_filters_reach_the_scan(views):
    (scan,) = scans(views.view("staging__matrice_siicea_missions_real"))
    for pushed in ("GreaterThanOrEqual(date_reelle_visite,2022-01-01)", "In(statut_de_la_mission", "EqualTo(secteur_d"):
        assert pushed in scan
    (scan,) = scans(views.view("staging__helios_sirec"))
    assert "LessThanOrEqual(date_de_reception_a_l_ars,2025-08-14)" in scan


def test_only_needed_columns_are_read(views):
    (scan,) = scans(views.view("staging__tdb_ic_finess_500"))
    assert len(scan.split("ReadSchema: struct<")[1].split(",")) == 7
    for scan in scans(views.view("staging__siicea_input_test")):
        assert len(scan.split("ReadSchema: struct<")[1].split(",")) <= 2


def test_mission_filters_go_below_the_join_with_targets(views):
    text = plan(views.view("staging__matrice_siicea_cibles"))
    assert "Inner" in text and "LeftOuter" not in text
    assert any("In(statut_de_la_mission" in s and "In(secteur_d_intervention" in s for s in scans(views.view("staging__matrice_siicea_cibles")))


def test_views_without_joins_do_not_shuffle(views):
    for name in (
        "staging__helios_siicea_missions", "staging__helios_sivss", "staging__matrice_sirec",
        "staging__tdb_ic_siicea_missions_prog", "staging__tdb_ic_siicea_missions_real", "staging__tdb_ic_siicea_cibles",
    ):
        assert "Exchange" not in plan(views.view(name))


def test_hot_keys_give_the_same_rows_when_partitions_are_split(views, spark):
    """A third of all facilities share a commune; a quarter of all missions share a blank facility code."""
    names = (
        "staging__cert_dc_finess", "staging__matrice_siicea_cibles", "staging__dgcs_query", "staging__ref_geo",
        "staging__ref_communes",
    )
    want = {n: sorted(map(str, views.view(n).collect())) for n in names}
    forced = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.files.maxPartitionBytes": "20k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in forced}
    split = False
    try:
        for k, v in forced.items():
            spark.conf.set(k, v)
        again = Views(views.read, views.today)
        for n in names:
            df = again.view(n)
            assert sorted(map(str, df.collect())) == want[n]
            split = split or "skew" in plan(df).lower()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert split


def test_geography_is_looked_up_by_broadcast_when_it_is_small(views):
    df = views.view("staging__ref_geo")
    df.collect()
    assert "SortMergeJoin" not in plan(df).split("Initial Plan")[0]


def test_profiles_do_not_expand_their_input(views):
    for name in ("staging__siicea_input_test", "staging__sirec_input_test", "staging__helios_siicea_missions_test"):
        assert "Expand" not in plan(views.view(name))
