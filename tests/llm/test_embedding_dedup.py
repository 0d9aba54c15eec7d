import math

import numpy as np

from dropforge.llm import embedding_dedup as e


def brute(rows):
    good = {i: np.array(v, float) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = {i: {j for j in good if j != i and len(good[j]) == len(good[i])
                 and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= 0.9} for i in good}
    part = {i: i for i, _ in rows}
    for _ in rows:
        for i, near in links.items():
            part[i] = min([part[i], *[part[j] for j in near]])
    return sorted((i, len(links.get(i, ())), part[i]) for i, _ in rows)


def vectors(rnd, d):
    rows = []
    for _ in range(40):
        base = rnd.normal(size=d)
        for _ in range(rnd.integers(1, 12)):
            rows.append([float(x) for x in base + rnd.normal(size=d) * rnd.choice([0, 0.05, 0.2])])
    return rows


def test_links_and_components_equal_brute_force(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    found = vectors(rnd, 32) + vectors(rnd, 3) + [[1.0], [2.0], [-1.0]]
    found += [None, [], [0.0] * 32, [None] + [1.0] * 31, [math.nan] * 32, [math.inf] + [0.0] * 31, [1e300] * 32, [1e-300] * 32]
    rows = [(int(i), v) for i, v in zip(rnd.permutation(len(found)), found, strict=True)]
    d = spark.createDataFrame([(v, i, "x") for i, v in rows], "embedding array<double>, vec_id long, id string")
    monkeypatch.setattr(e, "RECALL", 0.99999)
    big = {i for i, v in rows if v in ([1e300] * 32, [1e-300] * 32)}
    want = brute([(i, v if i not in big else [1.0] * 32) for i, v in rows])
    assert sorted(map(tuple, e.near_vectors(d).collect())) == want
    monkeypatch.setattr(e, "BLOCK", 16)
    assert sorted(map(tuple, e.near_vectors(d).collect())) == want
    assert e.near_vectors(d.limit(0)).collect() == []


def test_ids_join_no_vectors(spark):
    one, two, three, four = np.eye(8)[:4].tolist()
    near = lambda v, c: [x + c * (k == 7) for k, x in enumerate(v)]
    rows = [(1, one), (None, near(one, 0.1)), (2, two), (None, near(two, 0.1)), (None, three), (None, three), (None, near(three, 0.1))]
    rows += [(9, four), (9, near(four, 0.1)), (None, None), (9, [])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    last = e.LAST_ID
    found = e.marked_vectors(d).collect()
    assert sorted((r.id, r.n_links, r.component) for r in found) == sorted([
        (1, 1, 1), (last, 1, 1), (2, 1, 2), (last, 1, 2), (last, 2, last), (last, 2, last), (last, 2, last), (9, 1, 9), (9, 1, 9), (last, 0, last), (9, 0, 9),
    ])
    assert sorted(r.id for r in found if r.kept) == [1, 2, 9, 9, last, last]


def test_recall_at_the_threshold():
    rnd = np.random.default_rng(2)
    for n in (1000, 10**6):
        bits, tables = e.plan(n)
        x = rnd.normal(size=(400, 48))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z = rnd.normal(size=x.shape)
        z -= (z * x).sum(1, keepdims=True) * x
        y = 0.9 * x + math.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
        met = (e.cell_keys(x, bits, tables) == e.cell_keys(y, bits, tables)).any(1)
        assert met.mean() >= 0.95


def test_bounds_hold():
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(300, 64))
    x[150:] = x[:150] + rnd.normal(size=(150, 64)) * rnd.uniform(0.1, 0.6, (150, 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert (e.links_between(x, x) == (x @ x.T >= 0.9)).all()
