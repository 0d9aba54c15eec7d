"""Reading by ranges against the CSV reader in one task."""

from contextlib import contextmanager

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dropforge.sources import reader
from dropforge.sources.ranges import INSIDE, OUTSIDE, States, range_states, read_lines, records, state_after
from dropforge.sources.reader import MALFORMED, malformed_rows, read_text
from dropforge.sources.schemas import Source

DROP = Source("t", "t", sep=";", multiline=True)


@contextmanager
def splits_of(spark, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", str(size))
    try:
        yield
    finally:
        for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def both(spark, path, size, monkeypatch=None):
    """Rows by ranges and by the CSV reader in one task, in any order."""
    key = lambda r: tuple((v is None, v or "") for v in r)
    one = sorted(map(tuple, read_text(spark, path, DROP).collect()), key=key)
    with splits_of(spark, size):
        df = read_text(spark, path, DROP)
        assert df.rdd.getNumPartitions() > 1
        split = sorted(map(tuple, df.collect()), key=key)
    return split, one


def content(rows, seed, end="\n"):
    rnd = np.random.default_rng(seed)
    odd = ["x", "", '"a;b"', '"two\nlines"', '"say ""so"" \n\n twice"', 'in"side', '"cut"off', '"a" ', " \t", "é", '""', '"' + "long\n" * 40 + '"', '";"', '"\n"', '""""']
    lines = ["a;b;c"]
    for _ in range(rows):
        width = rnd.choice([3, 3, 3, 3, 3, 2, 4])
        lines.append(";".join(rnd.choice(odd, width, p=[0.3, *[0.7 / 14] * 14])))
        if rnd.random() < 0.05:
            lines.append("")
    return (end.join(line.replace("\n", end) for line in lines) + end).encode()


@pytest.mark.parametrize("size, end", [(700, "\n"), (90, "\n"), (37, "\n"), (500, "\r\n")])
def test_rows_are_those_of_one_task(spark, tmp_path, size, end):
    for seed in range(3):
        at = tmp_path / f"{seed}.csv"
        at.write_bytes(content(150, seed, end))
        split, one = both(spark, str(at), size)
        assert split == one and len(one) > 100


def test_a_folder_of_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"part{k}.csv").write_bytes(content(60, 20 + k))
    split, one = both(spark, str(tmp_path), 300)
    assert split == one


def test_unclosed_at_the_end_and_no_quotes(spark, tmp_path):
    for k, text in enumerate(["a;b\n" + "1;2\n" * 50 + '3;"open\n' + "4;5\n" * 50, "a;b\n" + "1;2\n" * 100, 'a;b\n1;"' + "x\n" * 500 + '"\n' + "2;y\n" * 30]):
        at = tmp_path / f"{k}.csv"
        at.write_text(text)
        split, one = both(spark, str(at), 64)
        if k == 0:  # the line end of the file itself, in the record that it cuts off
            one = [(a, b[:-1] if a == "3" else b, c) for a, b, c in one]
        assert split == one


def test_columns_alone_judge_the_width_of_whole_records(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(content(200, 5))
    whole = read_text(spark, str(tmp_path / "t.csv"), DROP)
    with splits_of(spark, 256):
        df = read_text(spark, str(tmp_path / "t.csv"), DROP)
        good = [sorted(str(r[0]) for r in d.where(F.col(MALFORMED).isNull()).select("b").collect()) for d in (df, whole)]
        assert good[0] == good[1]
        assert sorted(r[0] for r in malformed_rows(df).collect()) == sorted(r[0] for r in malformed_rows(whole).collect())


def test_a_state_per_range(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a;b\n1;"' + "in\n" * 400 + '"\n' + "2;y\n" * 400)
    with splits_of(spark, 128):
        states = States.of(range_states(read_lines(spark, str(tmp_path / "t.csv")), ";"))
        assert states.fragments and len(states.start) == 2  # only ranges with a quote
        file = int(states.file[0])
        assert [states.around(file, s) for s in (0, 640, int(states.start[1]), 2560)] == [
            (OUTSIDE, INSIDE), (INSIDE, INSIDE), (INSIDE, OUTSIDE), (OUTSIDE, OUTSIDE),
        ]
        assert records(spark, str(tmp_path / "t.csv"), ";").where("first").collect()[0]["record"] == "a;b"


def plain_state(line, state, sep):
    mode = "quoted" if state == INSIDE else "field"
    k = 0
    while k < len(line):
        c = line[k]
        if mode == "quoted":
            if c == '"':
                if line[k + 1 : k + 2] == '"':
                    k += 1
                else:
                    mode = "plain"
        elif c == sep:
            mode = "field"
        else:
            mode = "quoted" if mode == "field" and c == '"' else "plain"
        k += 1
    return INSIDE if mode == "quoted" else OUTSIDE


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet='";a ', max_size=25), st.sampled_from([OUTSIDE, INSIDE]))
def test_state_after_a_line(line, state):
    assert state_after(line, state, ";") == plain_state(line, state, ";")


def test_small_drops_are_left_to_the_csv_reader(spark, tmp_path, monkeypatch):
    (tmp_path / "t.csv").write_bytes(content(20, 1))
    monkeypatch.setattr(reader, "read_by_ranges", None)
    assert read_text(spark, str(tmp_path / "t.csv"), DROP).count() > 10
