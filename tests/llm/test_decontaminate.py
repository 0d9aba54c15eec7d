import itertools
import random
import re

import pytest

from dropforge.llm.decontaminate import WINDOW, _needed, decontaminate, find_overlaps, masks


@pytest.mark.parametrize("length", range(5, WINDOW + 1))
def test_masks_leave_no_gap(length):
    chosen = masks(length, length - _needed(length))
    for faults in itertools.combinations(range(length), length - _needed(length)):
        assert any(not {p + at for p in m} & set(faults) for m in chosen for at in range(length - m[-1]))


def brute(docs, items):
    found = set()
    for d, text in docs:
        w = re.findall(r"[^\W_]+", (text or "").lower())
        for i, item in items:
            v = re.findall(r"[^\W_]+", (item or "").lower())
            n = min(len(v), WINDOW)
            if n < 5:
                continue
            if any(sum(a == b for a, b in zip(w[x : x + n], v[y : y + n], strict=True)) >= _needed(n)
                   for x in range(len(w) - n + 1) for y in range(len(v) - n + 1)):
                found.add((d, i))
    return found


def test_overlaps_equal_brute_force(spark):
    rnd = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rnd.choice([3, 5, 8, 13, 20, 40])))) for i in range(25)] + [(90, None), (91, ""), (None, "One two three, four five six")]
    docs = [(i, " ".join(text(rnd.choice([4, 30, 200])))) for i in range(40)]
    for k, (i, item) in enumerate(items[:25]):
        w = item.split()
        for _ in range(k % 4):
            w[rnd.randrange(len(w))] = "changed"
        docs.append((100 + k, " ".join(text(20) + w + text(9))))
    docs += [(500, None), (501, ""), (None, "x One TWO three four five six y"), (7, docs[45][1]), (7, docs[45][1])]
    d = spark.createDataFrame([(i, t, "en", 1) for i, t in docs], "doc_id long, text string, item_id string, n_words int")
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    want = brute(docs, items)
    assert len(want) > 15 and (None, None) in want
    for block_words in (10**6, 100):
        rows = find_overlaps(d, b, block_words).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == want
        assert all(r.n_equal >= 0.75 * r.n_words for r in rows)
        left = decontaminate(d, b, block_words)
        assert left.columns == d.columns
        hit = {(i, t) for i, t in docs if brute([(i, t)], items)}
        assert sorted((r.doc_id or -1, r.text or "") for r in left.collect()) == sorted((i or -1, t or "") for i, t in docs if (i, t) not in hit)
    assert find_overlaps(d, b.limit(0)).collect() == [] and find_overlaps(d.limit(0), b).collect() == []
    assert decontaminate(d, b.limit(0)).count() == len(docs)
