import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from dropforge.llm.components import components
from dropforge.llm.words import shingles, spaced_words, text_slices, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abAB é\n\t0-!", max_size=12)), max_size=6)


def same_partition(hashes, keys):
    assert len(hashes) == len(keys)
    seen = {}
    for h, k in zip(hashes.tolist(), keys, strict=True):
        assert seen.setdefault(k, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(deadline=None)
@given(TEXTS)
def test_words_are_hashed_by_their_letters(texts):
    hashes, before = words(pa.array(texts, pa.string()))
    split = [re.findall(r"[0-9a-zé]+", (t or "").lower()) for t in texts]
    assert np.diff(before).tolist() == [len(s) for s in split]
    same_partition(hashes, [w for s in split for w in s])
    made, at = shingles(hashes, before, 3)
    runs = [[tuple(s[i : i + 3]) for i in range(len(s) - 2)] or ([tuple(s)] if s else []) for s in split]
    assert np.diff(at).tolist() == [len(r) for r in runs]
    same_partition(made, [r for x in runs for r in x])


@settings(deadline=None)
@given(TEXTS)
def test_spaced_words(texts):
    hashes, before = spaced_words(pa.array(texts, pa.string()))
    split = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    assert np.diff(before).tolist() == [len(s) for s in split]
    same_partition(hashes, [w for s in split for w in s])


@settings(deadline=None)
@given(TEXTS)
def test_slices_hold_all_rows(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    assert [t for s in text_slices(batch, most=5) for t in s.column(0).to_pylist()] == texts


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (9, 7), (7, 8), (5, 5), (20, 10), (20, 11), (11, 12)], "a long, b long")
    found = dict(components(links).collect())
    assert found == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7, 10: 10, 11: 10, 12: 10, 20: 10}
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {c for _, c in components(chain).collect()} == {0}
    assert components(links.limit(0)).collect() == []
