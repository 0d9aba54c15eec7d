import shutil
from datetime import date
from os import utime
from pathlib import Path

import pytest

from dropforge.sinks.store import Store
from dropforge.sources.schemas import SOURCES
from dropforge.streaming.drops import load_new_drops

REGION = SOURCES["v_region"]
HEAD = "reg,cheflieu,tncc,ncc,nccenr,libelle\n"


def put(folder, name, day, *regions, head=HEAD):
    at = folder / REGION.folder / name
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_text(head + "".join(f"{r},c,1,n,n,l\n" for r in regions))
    stamp = 1755216000 + day * 86400 + 3600  # from 2025-08-15 on
    utime(at, (stamp, stamp))


@pytest.fixture(params=["folders", "catalog"])
def store(request, spark, tmp_path):
    if request.param == "folders":
        yield lambda: Store(spark, root=str(tmp_path / "store"))
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS streamed")
        yield lambda: Store(spark, namespace="streamed")
        spark.sql("DROP DATABASE streamed CASCADE")


def regions(df):
    return sorted((r["reg"], r["date_ingestion"].day) for r in df.collect())


def test_a_growing_folder_goes_into_the_history_once(spark, store, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    put(landing, "v_region_1.csv", 0, "01", "02")
    put(landing, "v_region_2.csv", 1, "03")
    put(landing, "v_region_3.csv.gpg", 1, "99")
    put(landing, "other.csv", 1, "98")
    found = load_new_drops(store(), str(landing), REGION, checkpoint)
    assert [(Path(p).name, c["rows"]) for p, c in found] == [("v_region_1.csv", 2), ("v_region_2.csv", 1)]
    assert regions(store().history("v_region")) == [("01", 15), ("02", 15), ("03", 16)]
    assert load_new_drops(store(), str(landing), REGION, checkpoint) == []
    put(landing, "v_region_4.csv", 1, "04", "05\n06")
    put(landing, "v_region_5.csv", 2, "07")
    load_new_drops(store(), str(landing), REGION, checkpoint, files_a_batch=1)
    assert regions(store().history("v_region")) == [("01", 15), ("02", 15), ("03", 16), ("04", 16), ("06", 16), ("07", 17)]
    assert [r["reg"] for r in store().read("v_region").collect()] == ["07"]
    assert [r["row"] for r in store().history("v_region_rejected").collect()] == ["05"]
    days = {r.date_ingestion: r.row_count for r in store().load_counts().where("table_name = 'v_region'").collect()}
    assert days == {date(2025, 8, 15): 2, date(2025, 8, 16): 3, date(2025, 8, 17): 1}


def test_a_batch_that_comes_again_is_not_loaded_twice(spark, store, tmp_path):
    landing, checkpoint = tmp_path / "landing", tmp_path / "checkpoint"
    put(landing, "v_region_1.csv", 0, "01")
    load_new_drops(store(), str(landing), REGION, str(checkpoint))
    # As if the process had died between the store's commit and the stream's.
    for left in (checkpoint / "commits").glob("*0*"):
        shutil.move(left, tmp_path / left.name)
    put(landing, "v_region_2.csv", 1, "02")
    load_new_drops(store(), str(landing), REGION, str(checkpoint))
    assert regions(store().history("v_region")) == [("01", 15), ("02", 16)]


def test_a_wrong_header_stops_its_batch_until_it_is_mended(spark, store, tmp_path):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    put(landing, "v_region_1.csv", 0, "01")
    put(landing, "v_region_2.csv", 1, "02", head="reg\n")
    with pytest.raises(Exception, match="Missing columns"):
        load_new_drops(store(), str(landing), REGION, checkpoint)
    assert not store().has("v_region")
    put(landing, "v_region_2.csv", 1, "02")
    load_new_drops(store(), str(landing), REGION, checkpoint)
    assert regions(store().history("v_region")) == [("01", 15), ("02", 16)]
