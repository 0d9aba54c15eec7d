"""Odd rows through the operators with SQL, the classifiers, the page reader and the pipeline."""

import hashlib
import math
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

import __spark_entry__ as contract
from dropforge.llm import html_extract, line_dedup, quality, source_mix, toxicity
from dropforge.llm.html_blocks import blocks_of, vectors
from dropforge.llm.queries import QUERIES, SQL
from harness.compare import differences, duck

SMALL = contract.SMALL
given = pytest.mark.skipif(not Path(SMALL).exists(), reason="needs the given tables")


@given
@pytest.mark.parametrize("name", SQL)
def test_query_equals_its_sql(spark, name):
    _, found = differences(spark, duck(SMALL), SMALL, QUERIES[name], SQL[name])
    assert not found


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def brute_lines(docs):
    rows = sorted({(2**63 - 1 if i is None else i, t or "") for i, t in docs})
    seen, out = set(), {}
    for i, t in rows:
        lines = t.split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if w in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        out[i, t] = (len(lines), len(gone), sum(k - 1 not in gone for k in gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return sorted(((-1 if i is None else i, *out[2**63 - 1 if i is None else i, t or ""]) for i, t in docs))


def test_line_dedup_of_odd_rows(spark):
    docs = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "b\nc\nd\n"), (4, None), (5, ""), (6, "a\nb"), (7, "q\nq\nq\nq\nq"), (None, "a\nb\nc"),
            (9, "a\nb\nc\nd"), (9, "a\nb\nc\nd"), (0, "\n\n\n\nend"), (12, "\n\n\n")]
    d = spark.createDataFrame([(t, i, 5) for i, t in docs], "text string, doc_id long, n_lines int")
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_removed, r.n_spans, r.kept_text) for r in line_dedup.dedup_lines(d).collect())
    assert found == brute_lines(docs)
    assert line_dedup.dedup_lines(d.limit(0)).collect() == []


def test_mix_comes_near_its_targets(spark):
    rows = [(i, "w " * (i % 40 + 1), s) for i, s in enumerate(["hot"] * 400 + ["b"] * 90 + ["c"] * 10 + [None] * 30)]
    rows += [(900, None, "b"), (901, "", "b"), (902, " \t", "empty"), (None, "a b", "c"), (3, "w w", "hot"), (3, "w w", "hot")]
    d = spark.createDataFrame([(t, i, s, 1) for i, t, s in rows], "text string, doc_id long, source string, taken int")
    for bins in (4096, 1, 7):
        found = source_mix.mix(d, bins=bins)
        assert found.columns == ["text", "doc_id", "source", "size", "source_size", "target", "copies", "taken"]
        got = found.collect()
        assert len(got) == len(rows)
        by = defaultdict(list)
        for r in got:
            by[r.source].append(r)
        for own in by.values():
            assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
            assert sum(r.size for r in own) == own[0].source_size and all(r.taken <= 2 * r.size for r in own)
        assert math.isclose(sum(own[0].target for own in by.values()), 1.5 * sum(r.size for r in got))
        keys = [Counter((r.doc_id, r.size, r.taken) for r in x) for x in (got, source_mix.mix(d.repartition(5), bins=bins).collect())]
        assert keys[0] == keys[1]
    assert source_mix.mix(d.limit(0)).collect() == []


ODD = [(None, None), (-5, ""), (1, " "), (2, "x" * 30_000), (3, "word " * 20_000), (4, "é ß"), (4, "é ß")]


def labelled(spark, toxic):
    rnd = np.random.default_rng(8)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = list(ODD), []
    for i in range(10, 500):
        bad = i % 3 == 0
        w = [str(rnd.choice(plain)) for _ in range(rnd.integers(20, 60))]
        if bad:
            w = [x + "!!!" for x in w] if not toxic else w[:5] + [f"zzqx{k}" if i % 2 else "moron" for k in range(3)] + w[5:]
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad if toxic else not bad), int(bad if toxic else not bad)))
    labels += [(None, 1, 1), (11, None, None), (12, 1 - labels[2][1], 0)]
    docs = spark.createDataFrame([(t, i, 1.5, len(t or "")) for i, t in rows], "text string, doc_id long, score double, n_chars long")
    return rows, docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module, score, toxic", [(toxicity, toxicity.score_toxicity, True), (quality, quality.score_quality, False)])
def test_classifiers(spark, module, score, toxic):
    rows, docs, labels = labelled(spark, toxic)
    found = score(docs, labels)
    assert found.columns == ["text", "doc_id", "n_chars", "held_out", "score", "predicted"]
    got = found.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    cut = 0.5 if toxic else quality.CUT
    right = total = 0
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % module.FOLDS == module.KEPT_OUT)
        if r.held_out and r.doc_id is not None and r.doc_id >= 10:
            total += 1
            right += r.predicted == int((r.doc_id % 3 == 0) == toxic)
    assert right >= 0.95 * total
    again = {(r.doc_id, r.text): r.score for r in score(docs.repartition(5), labels).collect()}
    assert all(math.isclose(again[r.doc_id, r.text], r.score, abs_tol=1e-9) for r in got)
    assert score(docs.limit(0), labels).collect() == []
    assert len(score(docs, labels.limit(0)).collect()) == len(rows)


def test_blocks_of_bad_markup():
    page = "<p>a &amp;amp; b<p><b>c<br>d\n  e</b><script>x='</p>'</script><ul><li>f<li>g</ul>tail<!-- no --></div>&copy;&nbsp;h<style>p{}</style>"
    assert [b.text for b in blocks_of(page)] == ["a &amp; b", "c", "d e", "f", "g", "tail© h"]
    assert blocks_of(None) == [] and blocks_of("") == [] and blocks_of("<<<>&#0;&#x110000;") is not None
    assert len(blocks_of("<div>" * 3000 + "deep" + "<p>x" * 2000)) == 2001


def test_pages_of_unseen_layouts(spark):
    layouts = html_extract.Layouts(77)
    texts = [" ".join(f"{layouts.pick('la', 'mo', 'ti', 'ers')}{k}" for k in range(n)) + "." for n in range(3, 40)]
    rows, want = [], {}
    for k in range(120):
        article = [layouts.pick(*texts) for _ in range(layouts.rnd.integers(1, 20))]
        rows.append((k, f"http://h/{k}", layouts.page(article, texts).replace(" data-own=1", "")))
        want[k] = "\n".join(article)
    rows += [(500, None, None), (501, "u", ""), (502, "u", "<nav>menu</nav>"), (None, "u", rows[0][2]), (0, "http://h/0", rows[0][2])]
    d = spark.createDataFrame([(h, i, u, 1) for i, u, h in rows], "html string, page_id long, url string, text int")
    got = html_extract.extract(d).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert sum(r.text != want[r.page_id] for r in got if r.page_id in want) <= 6
    assert {r.text for r in got if r.page_id in (500, 501)} == {""}
    assert len({r.text for r in got if r.page_id in (None, 0)}) == 1
    assert html_extract.extract(d.limit(0)).collect() == []


@given
def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "src0", 0), (-2, "moron idiot scum stupid trash", "en", "src0", 29)], docs.schema)
    rows = docs.unionByName(odd)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {hashlib.md5(repr(r.doc_id).encode()).hexdigest() for r in rows.collect()}
        rows = spark.createDataFrame(stage(spark, rows, SMALL).collect() or [], stage(spark, rows, SMALL).schema)
        assert n == 4 or rows.schema == docs.schema
        assert {hashlib.md5(repr(r.doc_id).encode()).hexdigest() for r in rows.collect()} <= before
    left = rows.collect()
    assert left and all(r.copies in (1, 2, 3) and r.doc_id != -2 for r in left)
    assert rows.columns == [*docs.columns, "copies", "taken"]


@pytest.mark.parametrize("odd", ["<![ if x]>", "<![1]>", "<![foo[bar]]>", "<![", "<![ if", "<![CDATA[a]]>", "<![endif]-->", "<!x", "<?php"])
def test_odd_declarations_are_no_failure(odd):
    found = [b.text for b in blocks_of(f"<p>before</p>{odd}<p>after</p>")]
    assert found[0] == "before"


def test_pages_that_are_copies_still_train(spark):
    layouts = html_extract.Layouts()
    texts = [f"Sentence {k} of the article, with commas, and words enough to be one." for k in range(12)]
    own = [layouts.page([layouts.pick(*texts) for _ in range(6)], texts) for _ in range(3)]
    schema = "page_id long, url string, html string"
    alone = {r.url: r.text for r in html_extract.extract(spark.createDataFrame([(k, f"u{k}", own[k]) for k in range(3)], schema)).collect()}
    copies = html_extract.extract(spark.createDataFrame([(k, f"u{k % 3}", own[k % 3]) for k in range(9000)], schema))
    assert {(r.url, r.text) for r in copies.select("url", "text").distinct().collect()} == set(alone.items()) and any(alone.values())


@pytest.mark.parametrize("page", ["<div>x" * 20_000, "<ul><li><ul>" + "<div><li>x</li>" * 20_000, "<div>x</q>" * 20_000, "<table><tr><td><b>" + "<i><td>x" * 20_000])
def test_deep_pages_take_time_in_proportion(page):
    began = time.process_time()
    found = blocks_of(page)
    assert len(found) == 20_000 and np.isfinite(vectors(found)).all()
    assert time.process_time() - began < 5


@pytest.mark.parametrize("page, texts", [
    ("a<p>b<!-- c <p>d", ["a", "b"]), ("a<p>b<a <a", ["a", "b"]), ('a<p>b <a href="x>c<p>d', ["a", "b c", "d"]),
    ("a<!DOCTYPE", ["a"]), ("a<?php x", ["a"]), ("a</b", ["a"]), ("a <", ["a <"]), ("1 < 2 &am", ["1 < 2 &am"]),
    ("so <math><mi>x</mi><annotation>y</annotation></math> is", ["so x is"]),
])
def test_what_is_open_at_the_end_is_no_text(page, texts):
    assert [b.text for b in blocks_of(page)] == texts


def test_all_words_and_all_names_of_a_block_are_read():
    tail = [blocks_of(f"<p>{'same ' * 60}{w}</p>") for w in ("cookies", "mountain")]
    assert not np.array_equal(*[vectors(b) for b in tail])
    names = " ".join(f"x{chr(97 + k)}" for k in range(20))
    assert html_extract.element_label(blocks_of(f'<main><p class="{names} sidebar">x</p></main>')[0].element) == 0
    assert html_extract.element_label(blocks_of("<main><p>x</p></main>")[0].element) == 1
