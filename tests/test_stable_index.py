from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dropforge.operators import stable_index as module
from dropforge.operators.stable_index import COPY, ROW, stable_index


def frame(spark, rows):
    return spark.createDataFrame([(a, b) for a, b in rows], "a int, `b.c` string")


def step(spark, rows, kept):
    """Rows with their numbers, and the numbers to keep."""
    got = stable_index(frame(spark, rows), kept)
    found = got.collect()
    numbers = spark.createDataFrame([(r[ROW], r[COPY], r["index"]) for r in found], f"{ROW} binary, {COPY} long, index long")
    return sorted((r["index"], r["a"], r["b.c"]) for r in found), numbers


def by_row(numbered):
    out = defaultdict(set)
    for n, a, b in numbered:
        out[a, b].add(n)
    return out


def check(spark, loads):
    kept, before = None, []
    for rows in loads:
        after, kept = step(spark, rows, kept)
        assert [n for n, _, _ in after] == list(range(1, len(rows) + 1))
        assert Counter((a, b) for _, a, b in after) == Counter(rows)
        had, has = by_row(before), by_row(after)
        for row, numbers in had.items():
            own = has.get(row, set())
            stay = {n for n in sorted(numbers) if n <= len(rows)}
            # As many of the earlier numbers as there are rows for them.
            assert len(own & stay) >= min(len(own), len(stay)) - (len(numbers) - len(stay))
            if len(own) >= len(numbers) and len(rows) >= len(before):
                assert numbers <= own
        before = after


def test_numbers_stay_when_rows_come_and_go(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 3)
    a = [(i, f"v{i}") for i in range(20)] + [(None, None)] * 4 + [(1, "")] * 8 + [(7, "v7")]
    check(spark, [a, a, a + [(100 + i, "new") for i in range(9)], a[5:] + [(1, "")] * 5, a[:6], [], a + a])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["", "x", None])), max_size=14), min_size=2, max_size=3))
def test_any_loads(spark, loads):
    check(spark, loads)


def test_keys_tell_rows_apart(spark):
    df = spark.createDataFrame([("a\u001f1:b", None), ("a", "b"), ("a", None), (None, "a"), ("", None)], "x string, y string")
    assert stable_index(df).select(ROW).distinct().count() == 5


@pytest.mark.parametrize("extra", [0, 3])
def test_only_new_rows_are_numbered(spark, extra):
    rows = [(i, "v") for i in range(30)]
    before, kept = step(spark, rows, None)
    after, _ = step(spark, rows + [(900 + k, "w") for k in range(extra)], kept)
    assert after[: len(rows)] == before
