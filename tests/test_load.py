"""The whole run over a landing zone with one small drop per source."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.plans import VIEWS
from dropforge.quality.expectations import Expectation
from dropforge.sinks.load import load_all, run
from dropforge.sinks.store import Store
from dropforge.sources.schemas import SOURCES

DASHBOARD = ["index", "1_an", "6_10_ans"]


def cell(field, row):
    if isinstance(field.dataType, T.IntegerType):
        return {"annee": "2024", "mois": "2", "jour": "29"}.get(field.name, f"{row}.0")
    if isinstance(field.dataType, (T.FloatType, T.LongType)):
        return "" if row else "1.5"
    return {"categ_code": "182", "com": "01004", "com_code": "1004"}.get(field.name, f"{field.name} {row}")


@pytest.fixture
def landing(tmp_path):
    for source in SOURCES.values():
        declared = source if source.fields is not None else source.with_columns(DASHBOARD)
        sep = source.sep or ";"
        lines = [sep.join(declared.columns).upper()]
        lines += [sep.join(cell(f, row) for f in declared.fields) for row in range(3)]
        folder = tmp_path / "landing" / source.folder
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{source.keyword}_20250815.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return tmp_path / "landing"


def test_run_loads_everything_and_the_views_stand_on_it(spark, landing, tmp_path):
    store = Store(spark, root=str(tmp_path / "store"))
    views, counts = run(spark, str(landing), store, today="2025-08-15")
    assert dict(counts.collect()) == {name: 3 for name in SOURCES}
    for name in VIEWS:
        views.view(name).collect()
    assert views.view("staging__sa_sirec").schema["code_postal"].dataType == T.LongType()
    assert [r["code_postal"] for r in views.view("staging__sa_sirec").orderBy("numero_de_la_reclamation").collect()] == [1, 0, 0]
    assert store.history("sa_sirec").first()["date_ingestion"] == date(2025, 8, 15)
    assert views.view("staging__matrice_tdb_esms").columns == DASHBOARD
    assert views.view("staging__cert_dc_insern").first()["date_deces"] == date(2024, 2, 29)


def test_second_day_keeps_the_first_in_history(spark, landing, tmp_path):
    store = Store(spark, root=str(tmp_path / "store"))
    one = {"v_region": SOURCES["v_region"]}
    for day in ("2025-08-14", "2025-08-15", "2025-08-15"):
        run(spark, str(landing), store, today=day, sources=one)
    assert store.read("v_region").count() == 3
    days = store.history("v_region").groupBy("date_ingestion").count().orderBy("date_ingestion").collect()
    assert days == [(date(2025, 8, 14), 3), (date(2025, 8, 15), 3)]


def test_run_stops_on_no_drop_wrong_header_or_no_rows(spark, tmp_path):
    store = Store(spark, root=str(tmp_path / "store"))
    folder = tmp_path / "landing" / "INSEE"
    folder.mkdir(parents=True)
    (folder / "other.csv").write_text("a\n1\n")
    one = {"v_region": SOURCES["v_region"]}
    with pytest.raises(FileNotFoundError, match="no drop"):
        run(spark, str(tmp_path / "landing"), store, sources=one)
    drop = folder / "v_region.csv"
    drop.write_text("reg,cheflieu\n84,Lyon\n")
    with pytest.raises(ValueError, match="Missing columns: libelle, ncc, nccenr, tncc"):
        run(spark, str(tmp_path / "landing"), store, sources=one)
    views, _ = run(spark, str(tmp_path / "landing"), store, sources=one, check_headers=False)
    assert views.view("staging__v_region").collect() == [("84", "Lyon", 0, "", "", "")]
    drop.write_text("reg,cheflieu,tncc,ncc,nccenr,libelle\n")
    with pytest.raises(RuntimeError, match="nothing was loaded"):
        run(spark, str(tmp_path / "landing"), store, sources=one)


def test_a_wrong_header_can_be_skipped_and_reported(spark, landing, tmp_path):
    (landing / SOURCES["v_comer"].folder / f"{SOURCES['v_comer'].keyword}_20250815.csv").write_text("other\n1\n")
    two = {n: SOURCES[n] for n in ("v_region", "v_comer")}
    store = Store(spark, root=str(tmp_path / "store"))
    suites = {"v_region": [Expectation("bool", "cheflieu")]}
    views, counts, faults = load_all(spark, str(landing), store, today="2025-08-15", sources=two, on_invalid="skip", suites=suites)
    assert counts.collect() == [("v_region", 3)]
    found = {(r.table_name, r.fault) for r in faults.collect()}
    assert found == {("v_comer", "header"), ("v_region", "expectation:bool")}
    assert views.view("staging__ref_regions").count() == 3 and store.read("v_comer").isEmpty()


def test_bad_rows_are_rejected_and_a_clean_reload_clears_them(spark, tmp_path):
    folder = tmp_path / "landing" / "INSEE"
    folder.mkdir(parents=True)
    drop, one = folder / "v_region.csv", {"v_region": SOURCES["v_region"]}
    head = "reg,cheflieu,tncc,ncc,nccenr,libelle\n"
    drop.write_text(head + "84,Lyon,x,N,n,l\n85\n86,a,1,b,c,d,e\n")
    store = Store(spark, root=str(tmp_path / "store"))
    _, counts, faults = load_all(spark, str(tmp_path / "landing"), store, today="2025-08-15", sources=one)
    assert counts.collect() == [("v_region", 1)]
    assert sorted(map(tuple, faults.collect())) == [("v_region", "failed_cast", "tncc", 1), ("v_region", "malformed", "", 2)]
    assert sorted(r["row"] for r in store.history("v_region_rejected").collect()) == ["85", "86,a,1,b,c,d,e"]
    with pytest.raises(RuntimeError, match="too many malformed rows: v_region"):
        load_all(spark, str(tmp_path / "landing"), store, today="2025-08-15", sources=one, most_malformed=0.5)
    drop.write_text(head + "84,Lyon,1,N,n,l\n")
    load_all(spark, str(tmp_path / "landing"), store, today="2025-08-15", sources=one)
    assert store.history("v_region_rejected").isEmpty() and store.read("v_region").count() == 1
    assert Store(spark, root=str(tmp_path / "store")).read("v_region").count() == 1


def test_expectations_are_counted_in_the_scan_that_loads(spark, landing, tmp_path):
    """One plan writes the rows, counts the faults and the violations; the loaded table is not read again."""
    from dropforge.sinks.store import Store as Home

    store, plans = Home(spark, root=str(tmp_path / "store")), []
    write = Home._write_load

    def spy(self, df, *where):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, *where)

    reads = []
    Home._write_load, read, Home._read = spy, Home._read, lambda self, version, table: reads.append(table) or read(self, version, table)
    try:
        suites = {"v_region": [Expectation("bool", "cheflieu"), Expectation("type", "reg", "DATE")]}
        _, _, faults = load_all(spark, str(landing), store, today="2025-08-15", sources={"v_region": SOURCES["v_region"]}, suites=suites)
    finally:
        Home._write_load, Home._read = write, read
    assert len(plans) == 1 and plans[0].count("CollectMetrics") == 3 and plans[0].count("FileScan") == 1 and reads == []
    assert {(r.fault, r.column_name, r.found) for r in faults.collect()} >= {("expectation:bool", "cheflieu", 3), ("expectation:type", "reg", 3)}


def test_views_are_published_without_the_drop_of_undeclared_columns(spark, landing, tmp_path):
    store = Store(spark, root=str(tmp_path / "store"))
    (landing / SOURCES["sa_tdb_esms"].folder / f"{SOURCES['sa_tdb_esms'].keyword}_20250815.csv").unlink()
    views, _ = run(spark, str(landing), store, today="2025-08-15")
    shown = views.publish(prefix="p_")
    assert set(VIEWS) - {n[2:] for n in shown} == {"staging__matrice_tdb_esms"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        views.publish("staging__matrice_tdb_esms")


def test_profiles_of_a_history_from_kept_state(spark, landing, tmp_path):
    from dropforge.operators.profile import input_profile
    from dropforge.operators.profile_state import KEYS, profile_of_history
    from dropforge.plans.profiles import KEPT

    store = Store(spark, root=str(tmp_path / "store"))
    two = {n: SOURCES[n] for n in KEPT}
    real = landing / SOURCES["sa_siicea_missions_real"].folder / f"{SOURCES['sa_siicea_missions_real'].keyword}_20250815.csv"
    lines = real.read_text().splitlines()
    for day, kept in (("2025-08-13", lines), ("2025-08-14", lines[:2]), ("2025-08-15", lines[:3]), ("2025-08-14", [*lines, lines[1].replace("0", "7")])):
        real.write_text("\n".join(kept) + "\n")
        load_all(spark, str(landing), store, today=day, sources=two, profiles=KEPT)
    for name, p in KEPT.items():
        history = store.history(name).withColumn(p.code, F.col(p.code).cast("string"))
        want = input_profile(history, key=p.key, code=p.code, when=p.when, key_count=p.key_count, length_kinds=p.length_kinds)
        assert profile_of_history(store, name, p).collect() == want.collect()
    assert store.history("sa_siicea_missions_real" + KEYS).where("date_ingestion = '2025-08-14'").count() == 4
    plan = profile_of_history(store, "sa_sirec", KEPT["sa_sirec"])._jdf.queryExecution().executedPlan().toString()
    assert "zsa_sirec/" not in plan
