import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from dropforge.llm import keyed, suffix_dedup


def brute(docs):
    first = {}
    rows = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in docs]
    for i, b in rows:
        for s in range(len(b) - 49):
            w = b[s : s + 50]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in rows:
        gone = [False] * len(b)
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < i:
                gone[s : s + 50] = [True] * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out)


@pytest.mark.parametrize("block_rows, slice_bytes", [(2500, 1 << 20), (3, 700)])
def test_equals_brute_force(spark, monkeypatch, block_rows, slice_bytes):
    monkeypatch.setattr(suffix_dedup, "blocked", lambda d, label, _: keyed.blocked(d, label, block_rows))
    parts = keyed.text_parts
    monkeypatch.setattr(suffix_dedup, "text_parts", lambda rows: parts(rows, most=slice_bytes))
    rnd = random.Random(11)
    letters = "abcdefghij é\n"
    make = lambda n, a=letters: "".join(rnd.choice(a) for _ in range(n))
    passages = [make(n) for n in (49, 50, 51, 80, 200, 400)] + ["ab" * 60, "x" * 130]
    docs = [(-3, make(120) + passages[3]), (7, None), (8, ""), (9, "short")]
    for i in range(60):
        text = make(rnd.randrange(90))
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p) // 2)
            text += p[a if rnd.random() < 0.5 else 0 :] + make(rnd.choice([0, 1, 30]))
        docs.append((rnd.randrange(10, 1000), text))
    docs += [docs[10], docs[10], (None, docs[12][1]), (5, docs[12][1]), (2000, docs[12][1] + docs[13][1]), (2001, "ab" * 200), (2002, "b" + "ab" * 100)]
    d = spark.createDataFrame([(t, i, "x") for i, t in docs], "text string, doc_id long, id string").repartition(3)
    found = sorted((*r[:5], bytes(r[5])) for r in suffix_dedup.dedup_suffixes(d).collect())
    assert found == brute(docs)
    assert suffix_dedup.dedup_suffixes(d.limit(0)).collect() == []


def test_rolling_hash_is_that_of_the_bytes():
    raw = np.frombuffer(b"abcabcabcdabcabcabcd" * 3, np.uint8)
    for n in (1, 2, 3, 5, 8, 24):
        h = suffix_dedup.gram_hashes(raw, n).tolist()
        assert len(h) == len(raw) - n + 1
        seen = {}
        for i, x in enumerate(h):
            assert seen.setdefault(raw[i : i + n].tobytes(), x) == x
        assert len(set(h)) == len(seen)


def test_phrases_of_one_trigger_are_told_apart_by_every_bit(monkeypatch):
    rnd = random.Random(8)
    shared = "".join(rnd.choice("abcdefgh ") for _ in range(200))
    texts = [shared + f" own ending number {i} " * 4 for i in range(50)]
    rows = pa.table({"id": list(range(50)), "text": texts})
    phrases = len(suffix_dedup.Parse(rows).sample)
    hashed = suffix_dedup.hash_spans
    monkeypatch.setattr(suffix_dedup, "hash_spans", lambda *a: hashed(*a) >> np.uint64(40))
    assert len(suffix_dedup.Parse(rows).sample) == phrases
