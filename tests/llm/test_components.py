import random

import numpy as np
import pytest

from dropforge.llm import components as module


def brute(links):
    label = {x: x for e in links for x in e}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        label[y] = x
    return {x: root(x) for x in label}


def graphs():
    rnd = random.Random(5)
    path = list(range(60))
    rnd.shuffle(path)
    yield "path", list(zip(path, path[1:], strict=False))
    yield "hub", [(500, k) for k in range(80)] + [(500, 500)]
    yield "random", [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)]
    yield "copies", [(9, -4), (-4, 9), (9, -4), (2**62, 9)]
    yield "none", []


@pytest.mark.parametrize("name, links", list(graphs()))
@pytest.mark.parametrize("chunk", [1, 40, 1 << 20])
def test_components_equal_union_find(spark, monkeypatch, name, links, chunk):
    monkeypatch.setattr(module, "CHUNK", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7" if chunk < 100 else "10000")
    try:
        frame = spark.createDataFrame(links, "a long, b long").repartition(5)
        found = {r.id: r.component for r in module.components(frame).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == brute([e for e in links if e[0] != e[1]])


def test_stars_of_a_chunk():
    u, v = module.stars(np.array([5, 7, 9, 3]), np.array([7, 9, 11, 3]))
    assert sorted(zip(u.tolist(), v.tolist(), strict=True)) == [(7, 5), (9, 5), (11, 5)]
    assert [len(x) for x in module.stars(np.array([], np.int64), np.array([], np.int64))] == [0, 0]
