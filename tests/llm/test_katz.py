import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from dropforge.llm import katz


def brute(docs):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), 1]
    uni, bi = Counter(), Counter()
    for i, t in docs:
        if not held(i):
            w = tokens(t)
            uni.update(w)
            bi.update(zip([2, *w], w))
    context = Counter()
    for (v, _), c in bi.items():
        context[v] += c
    n, k = sum(uni.values()), katz.K
    d1, d2 = (katz.discounts([0, *[sum(c == r for c in x.values()) for r in range(1, k + 2)]]) for x in (uni, bi))
    mass = lambda c, d: c * (d[c] if c <= k else 1)
    left = n - sum(mass(c, d1) for c in uni.values())
    total, unknown = (n, left / n) if left > 1e-9 else (n + 1, 1 / (n + 1))
    p1 = lambda w: mass(uni[w], d1) / total if uni[w] else unknown
    after = defaultdict(list)
    for (v, w), _ in bi.items():
        after[v].append(w)

    def p2(v, w):
        if not context[v]:
            return p1(w)
        left = context[v] - sum(mass(bi[v, x], d2) for x in after[v])
        m = 0 if left > 1e-9 else 1
        if bi[v, w]:
            return mass(bi[v, w], d2) / (context[v] + m)
        return (left + m) / (context[v] + m) / (1 - sum(p1(x) for x in after[v])) * p1(w)

    for v in list(context)[:40]:  # exactly normalised over the known words and the unknown one
        assert abs(sum(p2(v, w) for w in uni) + p2(v, "never seen") - 1) < 1e-9
    out = []
    for i, t in docs:
        w = tokens(t)
        out.append((-1 if i is None else i, held(i), len(w), sum(uni[x] > 0 for x in w), n,
                    sum(math.log10((uni[x] + 1) / (n + len(uni) + 1)) for x in w), sum(math.log10(p2(v, x)) for v, x in zip([2, *w], w))))
    return sorted(out)


@pytest.mark.parametrize("block_rows", [2500, 7])
def test_scores_equal_brute_force(spark, monkeypatch, block_rows):
    monkeypatch.setattr(katz, "blocked", lambda d, label: __import__("dropforge.llm.keyed", fromlist=["x"]).blocked(d, label, block_rows))
    rnd = random.Random(5)
    vocabulary = [f"W{i}" for i in range(80)]
    docs = [(i, " ".join(vocabulary[min(79, int(rnd.expovariate(0.08)))] for _ in range(rnd.randrange(60)))) for i in range(90)]
    docs += [(None, None), (200, ""), (201, " \n "), (202, "never seen words é"), (5, docs[5][1]), (5, docs[5][1])]
    d = spark.createDataFrame([(t, i, 0.0) for i, t in docs], "text string, doc_id long, score double").repartition(3)
    found = sorted(tuple(-1 if x is None else x for x in r) for r in katz.katz_scores(d).collect())
    want = brute(docs)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    for f, w in zip(found, want, strict=True):
        assert f[5:] == pytest.approx(w[5:], abs=1e-6)
    assert katz.katz_scores(d.limit(0)).collect() == []
