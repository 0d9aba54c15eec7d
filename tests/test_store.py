from datetime import date

import pytest

from dropforge.session import scratch
from dropforge.plans import Views
from dropforge.sinks.publish import (
    copy_views,
    export_csv,
    export_path,
    export_views,
    observed,
    require_loaded,
    row_counts,
)
from dropforge.sinks.store import Store
from dropforge.sources.schemas import SOURCES


@pytest.fixture(params=["folders", "catalog"])
def store(request, spark, tmp_path):
    if request.param == "folders":
        yield Store(spark, root=str(tmp_path))
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS landed")
        yield Store(spark, namespace="landed")
        spark.sql("DROP DATABASE landed CASCADE")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def test_save_replaces(spark, store):
    store.save(frame(spark, (1, "a"), (2, "b")), "t")
    store.save(frame(spark, (3, "c")), "t")
    assert store.read("t").collect() == [(3, "c")]


def test_history_appends_days_and_replaces_a_day(spark, store):
    store.append_history(frame(spark, (1, "a")), "t", date(2025, 1, 1))
    store.append_history(frame(spark, (2, "b"), (3, "c")), "t", date(2025, 1, 2))
    store.append_history(frame(spark, (4, "d")), "t", date(2025, 1, 2))
    rows = store.history("t").select("k", "v", "date_ingestion").orderBy("k").collect()
    assert rows == [(1, "a", date(2025, 1, 1)), (4, "d", date(2025, 1, 2))]


def test_history_of_changing_columns(spark, tmp_path):
    store = Store(spark, root=str(tmp_path))
    store.append_history(frame(spark, (1, "a")), "t", date(2025, 1, 1))
    store.append_history(spark.createDataFrame([(2, "x")], "k int, w string"), "t", date(2025, 1, 2))
    rows = store.history("t").select("k", "v", "w").orderBy("k").collect()
    assert rows == [(1, "a", None), (2, None, "x")]


def test_history_has_one_meaning(spark, store):
    store.append_history(frame(spark, (1, "a")), "h", date(2025, 1, 1))
    store.append_history(frame(spark, (2, "b")), "h", date(2025, 1, 2))
    store.append_history(frame(spark).limit(0), "h", date(2025, 1, 2))
    store.append_history(spark.createDataFrame([(3, "x")], "k int, w string"), "h", date(2025, 1, 3))
    rows = store.history("h").select("k", "v", "w", "date_ingestion").orderBy("k").collect()
    assert rows == [(1, "a", None, date(2025, 1, 1)), (3, None, "x", date(2025, 1, 3))]


def test_load_saved_and_loaded_again(spark, store):
    store.load(frame(spark, (1, "a")), "t", date(2025, 1, 1))
    store.load(frame(spark, (2, "b")), "t", date(2025, 1, 2))
    assert store.read("t").collect() == [(2, "b")] and store.history("t").count() == 2
    store.save(frame(spark, (3, "c")), "t")
    assert store.read("t").collect() == [(3, "c")]
    store.load(frame(spark, (4, "d")), "t", date(2025, 1, 2))
    assert store.read("t").collect() == [(4, "d")] and store.history("t").count() == 2
    assert store.has_history("t") and not store.has_history("other")


def test_history_prunes_partitions(spark, store):
    store.append_history(frame(spark, (1, "a")), "t", date(2025, 1, 1))
    plan = store.history("t").where("date_ingestion = DATE '2025-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_ingestion" in plan


def test_declare_keeps_what_is_there(spark, store):
    source = SOURCES["v_region"]
    store.declare(source)
    assert store.read("v_region").columns == source.columns and store.read("v_region").isEmpty()
    store.save(store.read("v_region").select("*"), "other")
    store.save(spark.createDataFrame([("11", "x", 1, "N", "n", "l")], source.schema), "v_region")
    store.declare(source)
    assert store.read("v_region").count() == 1


def test_declare_all(spark, tmp_path):
    store = Store(spark, root=str(tmp_path))
    store.declare_all()
    for name, source in SOURCES.items():
        if source.fields is not None:
            assert store.read(name).columns == source.columns


def test_copy_to(spark, store, tmp_path):
    store.save(frame(spark, (1, "a")), "t")
    target = Store(spark, root=str(tmp_path / "consumer"))
    store.copy_to(target, {"t": "renamed"})
    assert target.read("renamed").collect() == [(1, "a")]


def test_views_for_consumers(spark, store, tmp_path):
    region = spark.createDataFrame([("84", "Lyon", 1, "N", "n", "ARA")], SOURCES["v_region"].schema)
    store.save(region, "v_region")
    store.save(spark.createDataFrame([], SOURCES["v_comer"].schema), "v_comer")
    views = Views(store.read, "2025-08-15")
    target = Store(spark, root=str(tmp_path / "consumer"))
    copy_views(views, target, {"staging__ref_regions": "regions"})
    assert target.read("regions").collect() == [("84", "N", "ARA")]
    paths = export_views(views, str(tmp_path / "out"), {"staging__ref_regions": "geo/regions"})
    assert paths == {"staging__ref_regions": str(tmp_path / "out/geo/regions_2025-08-15.csv")}
    assert spark.read.option("header", True).option("sep", ";").csv(*paths.values()).collect() == [("84", "N", "ARA")]


def test_row_counts_and_post_load_check(spark):
    counts = row_counts({"full": frame(spark, (1, "a")), "empty": frame(spark).limit(0)})
    assert dict(counts.collect()) == {"full": 1, "empty": 0}
    require_loaded(counts)
    with pytest.raises(RuntimeError, match="nothing was loaded"):
        require_loaded(row_counts({"empty": frame(spark).limit(0)}))


def test_observed_counts_on_the_way(spark, tmp_path):
    df, observation = observed(frame(spark, (1, "a"), (2, "b")))
    df.write.parquet(str(tmp_path / "o"))
    assert observation.get == {"row_count": 2}


def test_export(spark, tmp_path):
    stem = str(tmp_path / "out" / "report")
    path = export_csv(frame(spark, (1, 'x;"y"'), (2, "é")), stem, date(2025, 8, 15))
    assert path == export_path(stem, date(2025, 8, 15)) == stem + "_2025-08-15.csv"
    back = spark.read.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    assert sorted(back.collect()) == [("1", 'x;"y"'), ("2", "é")]


def test_scratch_is_new_each_time(spark):
    assert scratch(spark, "a") != scratch(spark, "a")


def failing(spark):
    """Two rows, and then the job fails."""
    return spark.range(3, numPartitions=1).selectExpr("CAST(id AS INT) AS k", "IF(id = 2, CAST(raise_error('stopped') AS STRING), 'x') AS v")


def test_a_failed_reload_leaves_the_earlier_load(spark, store):
    store.load(frame(spark, (1, "a"), (2, "b")), "t", date(2025, 1, 1))
    store.save(frame(spark, (5, "e")), "s")
    before = store.version()
    with pytest.raises(Exception, match="stopped"):
        store.load(failing(spark), "t", date(2025, 1, 1))
    with pytest.raises(Exception, match="stopped"):
        store.load(failing(spark), "t", date(2025, 1, 2))
    with pytest.raises(Exception, match="stopped"), store.commit() as run:
        run.load(frame(spark, (9, "z")), "t", date(2025, 1, 1))
        run.load(failing(spark), "other", date(2025, 1, 1))
    assert store.version() == before
    for again in (store, Store(spark, namespace=store.namespace, root=store.root)):
        assert sorted(again.read("t").collect()) == [(1, "a"), (2, "b")]
        assert sorted(again.history("t").collect()) == [(1, "a", date(2025, 1, 1)), (2, "b", date(2025, 1, 1))]
        assert again.read("s").collect() == [(5, "e")] and not again.has("other") and not again.has_history("other")
    store.load(frame(spark, (3, "c")), "t", date(2025, 1, 1))
    assert store.read("t").collect() == [(3, "c")] and store.history("t").count() == 1
    if store.namespace:
        assert spark.table("landed.t").collect() == [(3, "c")]
        assert spark.table("landed.zt").collect() == [(3, "c", date(2025, 1, 1))]


def test_a_run_is_seen_as_a_whole(spark, store):
    with store.commit() as run:
        run.load(frame(spark, (1, "a")), "t", date(2025, 1, 1))
        run.load(frame(spark, (2, "b")), "u", date(2025, 1, 1))
        assert store.version() == {"tables": {}, "history": {}, "streams": {}} and not store.has("t")
    earlier = store.snapshot()
    with store.commit() as run:
        run.load(frame(spark, (3, "c"), (4, "d")), "t", date(2025, 1, 2))
        run.load(frame(spark, (5, "e")), "u", date(2025, 1, 2))
        assert store.read("t").collect() == [(1, "a")] and store.read("u").collect() == [(2, "b")]
    assert store.read("t").count() == 2 and store.read("u").collect() == [(5, "e")]
    assert earlier("t").collect() == [(1, "a")] and earlier("u").collect() == [(2, "b")]
    counts = {(r.table_name, r.date_ingestion.day): r.row_count for r in store.load_counts().collect()}
    assert counts == {("t", 1): 1, ("t", 2): 2, ("u", 1): 1, ("u", 2): 1}


def test_two_writers_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    stores = [Store(spark, root=str(tmp_path)) for _ in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: stores[k].load(frame(spark, (k, "x")), f"t{k}", date(2025, 1, 1)), range(6)))
    assert sorted(stores[0].read(f"t{k}").first()["k"] for k in range(6)) == list(range(6))
    assert stores[0]._manifests.numbers() == list(range(1, 7))


def test_clean_deletes_what_no_version_names(spark, tmp_path, monkeypatch):
    from dropforge.sinks import manifest

    monkeypatch.setattr(manifest, "KEPT", 1)
    store = Store(spark, root=str(tmp_path))
    for k in range(3):
        store.load(frame(spark, (k, "a")), "t", date(2025, 1, 1))
        store.save(frame(spark, (k, "b")), "s")
    with pytest.raises(Exception, match="stopped"):
        store.load(failing(spark), "t", date(2025, 1, 3))
    assert len(store._manifests.numbers()) == 1
    gone = store.clean()
    assert len(gone) == 5 and store.clean() == []
    assert store.read("t").collect() == [(2, "a")] and store.read("s").collect() == [(2, "b")] and store.history("t").count() == 1
