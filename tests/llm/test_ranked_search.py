"""Ranked search against scores of all documents, with copies, ties, odd rows and small shards."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from dropforge.llm import ranked_search as module
from dropforge.llm.ranked_search import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    documents, every = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    held = Counter(x for _, b in bags for x in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 50 + (50 * sum(b.values()) * documents) // every if every else 0
            s = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * held[x] + 1))) * ((10**9 * b[x]) // (1000 * b[x] + 20 * m)) for x in set(terms(text)) if b[x])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return Counter(out)


def corpus():
    rnd = np.random.default_rng(11)
    words = np.array([f"w{k}" for k in range(60)] + ["É", "ß1", "THE", "the"])
    p = 1 / np.arange(1, len(words) + 1)
    make = lambda n: " ".join(rnd.choice(words, n, p=p / p.sum()))
    docs = [(int(i), make(rnd.integers(0, 80))) for i in rnd.permutation(400)]
    docs += [(1000 + k, docs[3][1]) for k in range(120)] + [(7, docs[5][1]), (7, docs[5][1]), (None, docs[5][1]), (None, docs[9][1])]
    docs += [(2000, None), (2001, ""), (2002, " .,\x01"), (2003, "rare " + "w1 " * 30_000), (2004, "the-THE_the"), (-5, docs[3][1])]
    items = [(k, make(rnd.integers(1, 25))) for k in range(12)] + [(20, None), (21, "…"), (22, "nothing like it"), (23, "rare É"), (23, "W1 w1, w1"), (None, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("top, at_once, shard, batch", [(50, 2000, 16_384, 512), (5, 4, 60, 3), (1, 100, 7, 1)])
def test_equals_scores_of_all(spark, monkeypatch, top, at_once, shard, batch):
    monkeypatch.setattr(module, "SHARD_DOCS", shard)
    monkeypatch.setattr(module, "BATCH", batch)
    docs, items = corpus()
    d = spark.createDataFrame([(t, i, 1.0, "q") for i, t in docs], "text string, doc_id int, score double, `query.x` string").repartition(3)
    q = spark.createDataFrame([(t, i, 4) for i, t in items], "text string, item_id int, rank int")
    found = ranked_search(d, q, top=top, at_once=at_once)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == brute(docs, items, top)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search(d.limit(0), q).collect() == [] and ranked_search(d, q.limit(0)).collect() == []
    assert ranked_search(d.where("false"), q).collect() == []


def test_most_documents_are_never_scored():
    rnd = np.random.default_rng(2)
    n, known = 4000, 40
    doc = np.repeat(np.arange(n), 6)
    term = np.concatenate([rnd.choice(np.arange(10 * (k % 4), 10 * (k % 4) + 10), 6, replace=False) for k in range(n)])
    tf, size = rnd.integers(1, 5, len(doc)), rnd.integers(6, 60, n)
    shard = module.Shard(doc, term, tf, size, known, n, int(size.sum()))
    weight = module.weights(np.bincount(term, minlength=known), n)
    wanted, best = np.arange(10), module.Best(50)
    scored = shard.search(wanted, weight[wanted], best, np.zeros(n, bool), np.arange(n))
    scores = np.zeros(n, np.int64)
    own = term < 10
    np.add.at(scores, doc[own], (weight[term] * module.impacts(tf, size[doc], n, int(size.sum())))[own])
    assert sorted(best.score.tolist()) == sorted(scores)[-50:]
    assert scored < n / 4
