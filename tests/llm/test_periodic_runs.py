"""Periodic runs against the definition, word by word."""

import hashlib
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dropforge.llm.periodic_runs import COVERS, Extensions, find_runs, kept_words, op12_periodic_runs, runs_of


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if w[q:] == w[: len(w) - q])


def plain_runs(w):
    """Every stretch that keeps a period and can't be made longer, if that is its smallest one and it is long enough."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - i
            if n >= max(6, 4 * q) and smallest_period(w[i : i + n]) == q:
                found.append((i, n, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return [x for k, x in enumerate(w) if k not in gone]


def runs_per_text(texts, period=None):
    numbers = {x: k for k, x in enumerate(sorted({x for t in texts for x in t}))}
    words = np.array([numbers[x] for t in texts for x in t], np.int64)
    before = np.cumsum([0, *map(len, texts)])
    found = runs_of(words, before, period)
    kept = kept_words(found, before)
    return [
        ([tuple(map(int, r[1:])) for r in found if r[0] == k], [x for x, stays in zip(t, kept[before[k] : before[k + 1]], strict=True) if stays])
        for k, t in enumerate(texts)
    ]


piece = st.tuples(st.lists(st.sampled_from("ab"), min_size=1, max_size=6), st.integers(1, 30))
text = st.lists(piece, max_size=6).map(lambda parts: [x for p, n in parts for x in p * n])


@settings(max_examples=120, deadline=None)
@given(st.lists(text, min_size=1, max_size=4), st.sampled_from([13, 31, 133]))
def test_runs_are_those_of_the_definition(texts, period):
    for t, (runs, kept) in zip(texts, runs_per_text(texts, period), strict=True):
        assert runs == plain_runs(t)
        assert kept == collapsed(t, runs)


@pytest.mark.parametrize("period", COVERS)
def test_extensions_of_all_positions(period):
    rnd = np.random.default_rng(period)
    w = np.concatenate([np.tile(rnd.integers(0, 3, 11), 20), rnd.integers(0, 2, 150), np.zeros(90, np.int64), [3], np.zeros(40, np.int64), [4]])
    x, y = (p.ravel() for p in np.meshgrid(np.arange(0, len(w), 3), np.arange(len(w))))
    x, y = x[x != y], y[x != y]
    full = [agreed_words(w, a, b) for a, b in zip(x, y, strict=True)]
    assert Extensions(w, period).lce(x, y).tolist() == full


def agreed_words(w, a, b):
    n = 0
    while max(a, b) + n < len(w) and w[a + n] == w[b + n]:
        n += 1
    return n


ODD = [None, "", " \t\n", "a", "x " * 6, "a b c " * 4, "a b c " * 3 + "a b", "word " * 40_000, "é ß " * 9 + "\x1c \x85 end", "p q p q p q p q q q q q q q q r"]


def test_whole_texts_and_odd_rows(spark):
    rows = [*enumerate(ODD), (3, "a"), (None, "z " * 7), (None, None)]
    d = spark.createDataFrame([(t, i, 1, 2) for i, t in rows], "text string, doc_id long, runs int, `a.text` int")
    found = find_runs(d)
    assert found.columns == ["text", "doc_id", "a.text", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "", r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()))
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = plain_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        want.append((i is None, i or 0, t or "", len(w), runs, " ".join(collapsed(w, runs))))
    assert got == sorted(want)
    assert find_runs(d.limit(0)).collect() == []


def test_a_long_text_takes_no_square_time():
    w = np.tile(np.concatenate([np.arange(500), [7] * 30]), 400)  # 212,000 words
    start = time.time()
    found = runs_of(w, np.array([0, len(w)]))
    assert time.time() - start < 30
    assert found[0].tolist() == [0, 0, len(w), 530] and (found[1:, 2:] == [30, 1]).all() and len(found) == 401


def brute_query(i, t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    h = zlib.crc32(("" if i is None else str(i)).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = plain_runs(w)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    tops = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *tops, digest("".join("%d,%d,%d\n" % r for r in runs)), digest(" ".join(collapsed(w, runs))))


def test_query_equals_brute_force(spark, tmp_path):
    rnd = np.random.default_rng(4)
    rows = [(i, " ".join(rnd.choice(list("abcdefgh"), rnd.integers(0, 70)))) for i in range(300)]
    rows += [(1000 + i, ("ab " * 5 + "\t" + " \n".join("xyz") + " ") * (i % 9)) for i in range(100)] + [(None, "u v " * 9), (5000, None), (5001, "")]
    spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op12_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted((brute_query(*r) for r in rows), key=key)
    assert sum(r.n_runs > 0 for r in got) > 60
