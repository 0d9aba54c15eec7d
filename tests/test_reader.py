from datetime import date

import pytest
from pyspark.sql import types as T

from dropforge.sources.headers import read_header
from dropforge.sources.reader import conform, malformed_rows, read_source, read_text
from dropforge.sources.schemas import SOURCES, Source

FIELDS = (
    T.StructField("code", T.StringType()),
    T.StructField("libelle", T.StringType(), True, {"max_length": 5}),
    T.StructField("nombre", T.IntegerType()),
)


def drop(tmp_path, content, name="drop.csv", encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(content.encode(encoding))
    return str(path)


@pytest.mark.parametrize("sep", [",", ";", "¤", "\t"])
@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig"])
def test_delimiters_and_bom(spark, tmp_path, sep, encoding):
    path = drop(tmp_path, f"Code{sep}Libellé{sep}Nombre\n01{sep}été{sep}3.9\n02{sep}{sep}\n", encoding=encoding)
    rows = read_source(spark, path, Source("d", "drop", fields=FIELDS)).collect()
    assert [tuple(r) for r in rows] == [("01", "été", 3), ("02", "", 0)]


def test_declared_delimiter_wins_over_the_guess(spark, tmp_path):
    path = drop(tmp_path, "a,b,c;code\n1,2,3;x\n")
    source = Source("d", "drop", sep=";", fields=(T.StructField("code", T.StringType()),))
    assert read_source(spark, path, source).collect() == [("x",)]


def test_quotes_and_newlines(spark, tmp_path):
    path = drop(tmp_path, 'code;libelle;nombre\n"a;b";"say ""hi""";1\n"two\nlines";x;2\n')
    source = Source("d", "drop", sep=";", multiline=True, fields=FIELDS)
    assert [tuple(r) for r in read_source(spark, path, source).collect()] == [
        ("a;b", 'say "', 1), ("two\nlines", "x", 2),
    ]


def test_repeated_and_reordered_headers(spark, tmp_path):
    path = drop(tmp_path, "Nombre;Commentaire;Code;Commentaire;COMMENTAIRE\n7;a;c1;b;c\n")
    text = read_text(spark, path, Source("d", "drop", fields=FIELDS))
    assert text.columns[:-1] == ["nombre", "commentaire", "code", "commentaire_1", "commentaire_2"]
    assert conform(text, Source("d", "drop", fields=FIELDS)).collect() == [("c1", "", 7)]


def test_leading_blank_line(spark, tmp_path):
    path = drop(tmp_path, "\n   \ncode;libelle;nombre\nx;y;1\n")
    assert read_header(spark, path, Source("d", "drop")) == (";", ["code", "libelle", "nombre"])
    assert read_source(spark, path, Source("d", "drop", fields=FIELDS)).collect() == [("x", "y", 1)]


def test_multiline_with_bom(spark, tmp_path):
    path = drop(tmp_path, '"Code";Libellé;Nombre\n"a\nb";x;2\n', encoding="utf-8-sig")
    source = Source("d", "drop", multiline=True, fields=FIELDS)
    assert read_source(spark, path, source).collect() == [("a\nb", "x", 2)]


def test_short_and_long_rows_are_kept_and_reported(spark, tmp_path):
    path = drop(tmp_path, "code;libelle;nombre\na;b\nc;d;3;more\ne;f;5\n")
    source = Source("d", "drop", fields=FIELDS)
    text = read_text(spark, path, source)
    assert [tuple(r) for r in conform(text, source).collect()] == [("a", "b", 0), ("c", "d", 3), ("e", "f", 5)]
    assert sorted(r[0] for r in malformed_rows(text).collect()) == ["a;b", "c;d;3;more"]


def test_empty_file(spark, tmp_path):
    path = drop(tmp_path, "")
    assert read_header(spark, path, Source("d", "drop")) == (",", [])
    df = read_source(spark, path, Source("d", "drop", fields=FIELDS))
    assert df.columns == ["code", "libelle", "nombre"] and df.isEmpty()


def test_open_source_keeps_its_header(spark, tmp_path):
    path = drop(tmp_path, "index,1 an,6-10 ans,1 an\n1,2,,4\n")
    df = read_source(spark, path, SOURCES["sa_tdb_esms"])
    assert df.columns == ["index", "1_an", "6_10_ans", "1_an_1"]
    assert df.collect() == [("1", "2", "", "4")]


def test_header_cell_over_two_lines(spark, tmp_path):
    path = drop(tmp_path, '"Code\ninterne";Libellé\na;b\n', encoding="utf-8-sig")
    df = read_source(spark, path, Source("d", "drop", sep=";", multiline=True))
    assert df.columns == ["code_interne", "libelle"] and df.collect() == [("a", "b")]


def test_dates_and_booleans(spark, tmp_path):
    fields = (T.StructField("d", T.DateType()), T.StructField("b", T.BooleanType()))
    path = drop(tmp_path, "d;b\n31-12-2024;yes\n2024-12-31;\n")
    rows = read_source(spark, path, Source("x", "x", fields=fields)).collect()
    assert rows == [(date(2024, 12, 31), True), (None, False)]


def test_folder_of_part_files(spark, tmp_path):
    for i in range(3):
        drop(tmp_path, f"code;libelle;nombre\nk{i};x;{i}\n", name=f"part-{i}.csv")
    df = read_source(spark, str(tmp_path), Source("d", "drop", fields=FIELDS))
    assert sorted(r["code"] for r in df.collect()) == ["k0", "k1", "k2"]
