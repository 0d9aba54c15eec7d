import os

from dropforge.sources.landing import list_files, newest_per_source, select_drops
from dropforge.sources.schemas import SOURCES, Source


def put(root, path, mtime):
    file = root / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text("a\n1\n")
    os.utime(file, (mtime, mtime))


def chosen(spark, root, *sources):
    found = select_drops(spark, str(root), {s.name: s for s in sources})
    return {name: path.split(str(root) + "/")[1] for name, path in found.items()}


def test_newest_by_time_not_by_name(spark, tmp_path):
    put(tmp_path, "SIREC/sirec_20250801.csv", 2000)
    put(tmp_path, "SIREC/sirec_20251231.csv", 1000)
    assert chosen(spark, tmp_path, SOURCES["sa_sirec"]) == {"sa_sirec": "SIREC/sirec_20250801.csv"}


def test_equal_times_are_settled_by_path(spark, tmp_path):
    put(tmp_path, "SIREC/sirec_a.csv", 1000)
    put(tmp_path, "SIREC/sirec_b.csv", 1000)
    assert chosen(spark, tmp_path, SOURCES["sa_sirec"]) == {"sa_sirec": "SIREC/sirec_b.csv"}


def test_archives_and_workbooks_are_skipped_but_for_open_folders(spark, tmp_path):
    put(tmp_path, "SIREC/sirec_new.csv.gpg", 3000)
    put(tmp_path, "SIREC/sirec_new.XLSX", 3000)
    put(tmp_path, "SIREC/sirec_old.csv", 1000)
    put(tmp_path, "DIAMANT/pour le script etl/sa_rpu_new.xlsx", 3000)
    put(tmp_path, "DIAMANT/pour le script etl/sa_rpu_old.csv", 1000)
    assert chosen(spark, tmp_path, SOURCES["sa_sirec"], SOURCES["sa_rpu"]) == {
        "sa_sirec": "SIREC/sirec_old.csv", "sa_rpu": "DIAMANT/pour le script etl/sa_rpu_new.xlsx",
    }


def test_folders_keywords_and_absent_sources(spark, tmp_path):
    put(tmp_path, "INSEE/v_commune_2024.csv", 1000)
    put(tmp_path, "INSEE/v_commune_comer.csv", 2000)
    put(tmp_path, "OTHER/v_commune_2024.csv", 3000)
    put(tmp_path, "INSEE/historique/v_commune_2024.csv", 4000)
    names = ("v_commune", "v_commune_comer", "v_comer")
    assert chosen(spark, tmp_path, *[SOURCES[n] for n in names]) == {
        "v_commune": "INSEE/v_commune_2024.csv", "v_commune_comer": "INSEE/v_commune_comer.csv",
    }


def test_a_folder_of_part_files_is_one_drop(spark, tmp_path):
    put(tmp_path, "SIREC/sirec_1.csv/part-0.csv", 1000)
    put(tmp_path, "SIREC/sirec_1.csv/part-1.csv", 5000)
    put(tmp_path, "SIREC/sirec_2.csv", 3000)
    assert chosen(spark, tmp_path, SOURCES["sa_sirec"]) == {"sa_sirec": "SIREC/sirec_1.csv"}


def test_a_file_may_serve_several_sources_without_folder(spark, tmp_path):
    put(tmp_path, "x_one_two.csv", 1000)
    assert chosen(spark, tmp_path, Source("a", "one"), Source("b", "two")) == {"a": "x_one_two.csv", "b": "x_one_two.csv"}


def test_contents_are_not_read(spark, tmp_path):
    put(tmp_path, "SIREC/sirec.csv", 1000)
    plan = newest_per_source(list_files(spark, str(tmp_path)), str(tmp_path), [SOURCES["sa_sirec"]])
    assert "ReadSchema: struct<path:string,modificationTime:timestamp>" in plan._jdf.queryExecution().toString()


def test_root_with_a_scheme_or_its_name_further_down(spark, tmp_path):
    put(tmp_path, "z/INSEE/v_region.csv", 1000)
    put(tmp_path, "z/z/INSEE/v_region.csv", 2000)
    found = select_drops(spark, f"file://{tmp_path}/z/", {"v_region": SOURCES["v_region"]})
    assert found == {"v_region": f"file:{tmp_path}/z/INSEE/v_region.csv"}
    files = spark.createDataFrame(
        [("s3a://b/z/INSEE/v_region.csv/part-0", "2024-01-01"), ("s3a://b/z/x/z/INSEE/v_region.csv", "2025-01-01")],
        "path string, modified string",
    ).selectExpr("path", "to_timestamp(modified) AS modified")
    newest = newest_per_source(files, "s3a://b/z", [SOURCES["v_region"]])
    assert [r["path"] for r in newest.collect()] == ["s3a://b/z/INSEE/v_region.csv"]


def test_only_declared_folders_are_listed(spark, tmp_path):
    for folder in ("INSEE", "FOREIGN"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "v_region.csv").write_text("a\n")
    listed = [r["path"] for r in list_files(spark, str(tmp_path), ["INSEE", "ABSENT"]).collect()]
    assert [p.rsplit("/", 2)[1] for p in listed] == ["INSEE"]
    assert list_files(spark, str(tmp_path), ["ABSENT"]).collect() == []
