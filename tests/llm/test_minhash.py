import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dropforge.llm import minhash
from dropforge.llm.words import shingles, words


def features(text):
    h, b = words(pa.array([text]))
    return Counter(shingles(h, b, 5)[0].tolist())


def brute(docs):
    bags = [features(t or "") for _, t in docs]
    df = np.zeros(minhash.FEATURES, np.int64)
    for b in bags:
        for f in {x % minhash.FEATURES for x in b}:
            df[f] += 1
    w = minhash.feature_weights(df, len(docs))
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            keys = bags[i].keys() & bags[j].keys()
            if bags[i] and keys:
                low = sum(w[k % minhash.FEATURES] * min(bags[i][k], bags[j][k]) for k in keys)
                high = sum(w[k % minhash.FEATURES] * max(bags[i][k], bags[j][k]) for k in bags[i].keys() | bags[j].keys())
                if low / high >= minhash.SIMILARITY:
                    parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        groups[root(i)].append(2**63 - 1 if d is None else d)
    return sorted((2**63 - 1 if d is None else d, min(groups[root(i)])) for i, (d, _) in enumerate(docs))


@pytest.mark.parametrize("stars, block", [(2, 256), (0, 3), (1, 256)])
def test_classes_equal_brute_force(spark, monkeypatch, stars, block):
    monkeypatch.setattr(minhash, "STAR_ROUNDS", stars)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(30):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 40, 120, 300]))]
        for k in range(rnd.choice([1, 2, 6])):
            w = list(base)
            for _ in range(k):
                w[rnd.randrange(len(w))] = "changed"
            docs.append((len(docs) * 7 % 1009, " ".join(w) + rnd.choice(["", ".", "  "])))
    docs += [(5000, None), (5001, ""), (5002, " . "), (None, docs[3][1]), (5003, docs[3][1].upper()), (5003, docs[3][1].upper()), (5003, "quite other words stand here now")]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, class_id string, id int")
    found = sorted((r.id, r.class_id) for r in minhash.classes(d).collect())
    assert found == brute(docs)
    kept = minhash.keep_one(d)
    assert kept.columns == d.columns
    want = Counter(c for i, c in brute(docs) if i == c)
    assert sorted((2**63 - 1 if r.doc_id is None else r.doc_id) for r in kept.collect()) == sorted(want.elements())


def test_one_row_of_each_class_stays_whatever_the_ids(spark):
    words = [f"w{i}" for i in range(200)]
    near = lambda k: " ".join([*words[:k], "changed", *words[k + 1 :]])
    alone = [f"quite other words stand in this text number {i} here" for i in "abc"]
    groups = [[(None, near(k)) for k in (3, 3, 90)], [(None, alone[0])] * 3, [(7, alone[1])] * 3, [(7, alone[2])], [(None, "")], [(None, None)], [(7, " ")]]
    numbered = [(g, i, t) for g, rows in enumerate(groups) for i, t in rows]
    docs = spark.createDataFrame([(i, t, g, n) for n, (g, i, t) in enumerate(numbered)], "doc_id long, text string, class_id int, node int").repartition(3)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    kept = kept.collect()
    assert sorted(r["class_id"] for r in kept) == list(range(len(groups)))
    assert all(numbered[r["node"]] == (r["class_id"], r["doc_id"], r["text"]) for r in kept)
    found = minhash.classes(docs)
    assert found.count() == len(numbered) and found.where("kept").count() == len(groups)
    assert all(r.class_id == r.id for r in found.collect())


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.classes(d).collect() == [] and minhash.keep_one(d).collect() == []


def test_samples_agree_as_often_as_the_weights_do():
    rnd = np.random.default_rng(1)
    tables = minhash._random_table()
    made = np.sort(rnd.integers(0, 2**63, 300, dtype=np.uint64))
    agree = total = 0
    for t in range(40):
        one, two = np.ones(300, np.int64), np.ones(300, np.int64)
        two[:30] = 2
        h = np.sort(made ^ np.uint64(t * 7919))
        s = [minhash.band_hashes(h, c, np.array([0, 300]), np.ones(minhash.FEATURES), tables) for c in (one, two)]
        agree, total = agree + (s[0] == s[1]).sum(), total + minhash.BANDS
    assert abs(agree / total - (300 / 330) ** minhash.ROWS) < 0.06
    assert re.match("^0", f"{agree / total:.2f}")
