from hypothesis import given
from hypothesis import strategies as st

from dropforge.sources.headers import MAX_NAME, column_names, first_line, guess_delimiter, normalise, reduce_name
from dropforge.sources.schemas import MAX_LENGTH, SOURCES


def test_normalise():
    assert normalise("N° FINESS/RPPS") == "n_finess_rpps"
    assert normalise("  Date d'envoi de l'AR ") == "date_d_envoi_de_l_ar"
    assert normalise("Précisions sur le NIVEAU (œuvre)") == "precisions_sur_le_niveau_œuvre"
    assert normalise("?!…") == ""
    assert len(normalise("é" * 70)) == MAX_NAME


def test_repeats_get_suffixes():
    assert column_names(["Commentaire", "a", "commentaire", "COMMENTAIRE"]) == [
        "commentaire", "a", "commentaire_1", "commentaire_2",
    ]
    long = "nombre_de_chambres_superieures_a_deux_lits_au_31_decembre_de_lannee"
    first, second = column_names([long, long])
    assert first == long[:63] and second == long[:61] + "_1"
    assert column_names(["", "x", " "]) == ["column1", "x", "column3"]


@given(st.lists(st.text(max_size=70), max_size=40))
def test_names_are_distinct_and_short(headers):
    names = column_names(headers)
    assert len(names) == len(headers) == len(set(names))
    assert all(0 < len(n) <= MAX_NAME for n in names)


def test_reduce_name():
    assert reduce_name("  a b ") == "a b"
    assert reduce_name("é" * 40, byte_aware=True) == "é" * 32
    assert reduce_name("a" * 62 + "éb", byte_aware=True) == "a" * 62 + "é"
    assert reduce_name("l''" + "a" * 70, byte_aware=True) == "l''" + "a" * 61
    assert reduce_name("É" * 70, byte_aware=True) == "É" * 63


def test_guess_delimiter(evaluate):
    got = evaluate(guess_delimiter, "a;b;c", "a,b;c", "a¤b¤c", "a\tb\tc,d", "plain", "")
    assert got == [";", ",", "¤", "\t", ",", ","]


def test_declared_sources():
    assert len(SOURCES) == 25
    widths = {n: len(s.fields) for n, s in SOURCES.items() if s.fields is not None}
    assert widths["sa_siicea_missions_prog"] == widths["sa_siicea_missions_real"] == 130
    assert (widths["sa_sirec"], widths["sa_t_finess"], widths["sa_ciblage"]) == (68, 84, 93)
    for s in SOURCES.values():
        if s.fields is not None:
            assert len(set(s.columns)) == len(s.columns)
            assert all(len(c) <= MAX_NAME for c in s.columns)
    assert SOURCES["sa_sivss"].schema["est_eigs"].metadata == {MAX_LENGTH: 5}
    assert SOURCES["sa_siicea_decisions"].schema["commentaire"].metadata == {MAX_LENGTH: 2048}


def test_first_line(evaluate):
    blank = " " * 50_000
    got = evaluate(first_line, "a\nb", "\n \t\n\ta;b\nc", "\r\nx\r\ny", "", "  \n ", blank + "\n" + blank + "z")
    assert got == ["a", "\ta;b", "x", "", "", blank + "z"]


def test_reduced_columns_are_reduced_names(evaluate):
    from dropforge.sources.headers import reduce_text

    names = ["", "plain", "é" * 40, "a''b" * 30, "'" * 130, "x" * 62 + "éé", "''" * 80, "ligne\nsuite " * 9, None, "Éœ" * 50]
    assert evaluate(reduce_text, *names) == [None if n is None else reduce_name(n, byte_aware=True) for n in names]
    assert evaluate(lambda c: reduce_text(c, 5), *names) == [None if n is None else reduce_name(n, 5, byte_aware=True) for n in names]
