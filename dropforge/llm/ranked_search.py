"""Ranked lexical search: the best documents for every query text, by weighted terms with saturated frequencies.

Documents are dealt into shards where they lie. A shard has one posting list per query term: documents and the impact the
term has in them, with a range-maximum table that names the posting of largest impact in any part of the list. For a
query, an interval of documents is bounded by the sum over its terms of the largest impact in the interval, times the
term's weight. Intervals are taken best first; each is split at the document in which its most promising term is
strongest. That document is scored exactly, the two intervals beside it get bounds of their own, and what is bounded
below the last of the best scores so far is dropped. So every document is either scored or proven to rank too low:
the result is exact. Intervals are worked on some hundred at a time, with whole-array operations.

Within a shard documents are numbered so that neighbours share their most frequent query term and are of like length,
which keeps bounds close. Terms are compared as bytes, not as hashes. Documents are read twice, once to count (terms in
all documents, documents that hold a query term) and once to search; nothing of them is shuffled. A task hands on the
best documents of all its shards, at most as many per query as the result has, and those of all tasks are ranked with a
limit below the exchange.

Queries are stated rows: they are taken ``at_once`` at a time, and the pass is repeated for the next ones, so what a
task holds of them is bounded. The driver sees the queries of one block and one count per query term.

* Terms are maximal runs of ASCII letters and digits and of any other characters beyond ASCII; only A-Z are lower-cased.
  A null text has no terms. A document without terms is not counted; a query without terms finds nothing.
* Every row of the documents is one of its own, repeated ones and those without id too; equal scores are ordered by id,
  a missing one last. Every row of the queries is a query; its id is handed on, null or repeated.
* Scores are whole numbers; a term that nearly all documents hold weighs nothing. Only scores above 0 count.
* Without documents or queries the result is empty. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropforge.llm.tables import table, written
from dropforge.llm.words import _WORD, ascii_lower, spans_array, text_bytes, text_slices, word_spans

TOP = 50
QUERIES_AT_ONCE = 2000
SHARD_DOCS, SHARD_POSTINGS = 16_384, 2_500_000
BATCH = 512
DOCUMENTS, TERMS = -1, -2  # numbers under which counts of all documents and terms travel


def term_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of the texts, start and end of each term, and how many terms precede each text."""
    raw, offsets = text_bytes(texts)
    raw = ascii_lower(raw)
    return raw, *word_spans(raw, offsets, _WORD)


def terms_of(texts: pa.Array) -> list[list[bytes]]:
    """The distinct terms of each text."""
    raw, first, last, before = term_spans(texts)
    every = spans_array(raw, first, last).to_pylist()[::2]
    return [list(dict.fromkeys(every[a:b])) for a, b in zip(before[:-1], before[1:], strict=True)]


def postings_of(texts: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, number of the term in ``known`` and frequency of every posting, ordered by text and term; terms of each text."""
    raw, first, last, before = term_spans(texts)
    counts = np.diff(before)
    if not len(first) or not len(known):
        return *[np.zeros(0, np.int64)] * 3, counts
    number = pc.fill_null(pc.index_in(spans_array(raw, first, last), value_set=known), -1).to_numpy()[::2]
    hit = np.flatnonzero(number >= 0)
    text = np.searchsorted(before, hit, "right") - 1
    key, tf = np.unique(text * np.int64(len(known)) + number[hit], return_counts=True)
    return key // len(known), key % len(known), tf, counts


def count_terms(docs: DataFrame, known: list[bytes]) -> DataFrame:
    """``number, n``: documents that hold each known term, and under ``DOCUMENTS`` and ``TERMS`` the sizes of the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(known, pa.binary())
        held, total = np.zeros(len(known), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for part in text_slices(batch):
                _, term, _, counts = postings_of(part.column(0), terms)
                held += np.bincount(term, minlength=len(known))
                total += [(counts > 0).sum(), counts.sum()]
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append([DOCUMENTS, TERMS], some).astype(np.int32)), pa.array(np.append(total, held[some]))], ["number", "n"]
        )

    return docs.select("text").mapInArrow(count, "number int, n long").groupBy("number").agg(F.sum("n").alias("n"))


def weights(held: np.ndarray, documents: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * held.astype(np.float64) + 1))).astype(np.int64)


def impacts(tf: np.ndarray, size: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term adds per unit of weight, by its frequency and the size of the document."""
    m = 100 - 50 + (50 * size * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Best:
    """The best documents of one query so far."""

    def __init__(self, top: int) -> None:
        self.top, self.least = top, 1
        self.score, self.missing, self.ids = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> None:
        fit = score >= self.least
        if not fit.any():
            return
        self.score = np.concatenate([self.score, score[fit]])
        self.missing, self.ids = np.concatenate([self.missing, missing[fit]]), np.concatenate([self.ids, ids[fit]])
        if len(self.score) >= self.top:
            own = np.lexsort((self.ids, self.missing, -self.score))[: self.top]
            self.score, self.missing, self.ids = self.score[own], self.missing[own], self.ids[own]
            self.least = max(1, int(self.score[-1]))


class Shard:
    """Posting lists end to end, each in order of documents, with a table of the strongest posting of any part."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, size: np.ndarray, known: int, documents: int, terms: int) -> None:
        n = self.n = len(size)
        strongest = np.full(n, known, np.int64)
        order = np.lexsort((term, -tf, doc))
        opens = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
        strongest[doc[opens]] = term[opens]
        self.original = np.lexsort((size, strongest))  # by new number
        number = np.empty(n, np.int64)
        number[self.original] = np.arange(n)
        key = term * np.int64(n) + number[doc]
        own = np.argsort(key)
        self.key, self.doc = key[own], number[doc][own]
        self.impact = impacts(tf, size[doc], documents, terms)[own]
        self.cuts = np.searchsorted(self.key, np.arange(known + 1) * np.int64(n))
        longest = int(np.diff(self.cuts).max(initial=0))
        # Parts of a list never reach into the next one, so one table serves all lists.
        levels = [np.arange(len(own), dtype=np.int32)]
        while (1 << len(levels)) <= longest:
            half = 1 << (len(levels) - 1)
            last = levels[-1]
            other = last[half:]
            upper = last.copy()
            upper[: len(other)] = np.where(self.impact[other] > self.impact[last[: len(other)]], other, last[: len(other)])
            levels.append(upper)
        self.table = np.stack(levels)
        self.log = np.zeros(longest + 1, np.int8)
        for k in range(1, len(levels)):
            self.log[1 << k :] = k

    def strongest(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posting of largest impact between ``a`` and ``b``, and that impact; 0 where there is none."""
        size = b - a
        some = size > 0
        level = self.log[size]
        low = np.where(some, a, 0)
        p, q = self.table[level, low], self.table[level, np.where(some, b - (1 << level.astype(np.int64)), 0)]
        x, y = self.impact[p], self.impact[q]
        return np.where(y > x, q, p), np.where(some, np.maximum(x, y), 0)

    def search(self, terms: np.ndarray, weight: np.ndarray, best: Best, missing: np.ndarray, ids: np.ndarray) -> int:
        """Adds the documents that may be among the best; gives the number that was scored."""
        own = self.cuts[terms + 1] > self.cuts[terms]
        terms, weight = terms[own], weight[own]
        if not len(terms):
            return 0
        a, b = self.cuts[terms][None, :], self.cuts[terms + 1][None, :]
        bound, split = self._bounds(a, b, weight)
        scored, batch = 0, 64
        while True:
            fit = bound >= best.least
            if not fit.all():
                a, b, bound, split = a[fit], b[fit], bound[fit], split[fit]
            if not len(bound):
                return scored
            taken = np.ones(len(bound), bool)
            if len(bound) > batch:
                taken[:] = False
                taken[np.argpartition(-bound, batch)[:batch]] = True
            at, lo, hi = split[taken], a[taken], b[taken]
            wanted = terms[None, :] * np.int64(self.n) + at[:, None]
            p = np.searchsorted(self.key, wanted)
            inside = np.minimum(p, len(self.key) - 1)
            held = (p < hi) & (self.key[inside] == wanted)
            score = (np.where(held, self.impact[inside], 0) * weight).sum(1)
            document = self.original[at]
            best.add(score, missing[document], ids[document])
            scored += len(at)
            rest = ~taken
            na, nb = np.concatenate([lo, p + held]), np.concatenate([p, hi])
            nbound, nsplit = self._bounds(na, nb, weight)
            fit = nbound >= best.least
            a, b = np.concatenate([a[rest], na[fit]]), np.concatenate([b[rest], nb[fit]])
            bound, split = np.concatenate([bound[rest], nbound[fit]]), np.concatenate([split[rest], nsplit[fit]])
            batch = BATCH

    def _bounds(self, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        posting, impact = self.strongest(a, b)
        parts = impact * weight
        leading = parts.argmax(1)
        return parts.sum(1), self.doc[posting[np.arange(len(a)), leading]]


def search_block(docs: DataFrame, queries: list[list[bytes]], top: int) -> DataFrame:
    """``query, doc_id, score`` of the best documents that each task finds for each query."""
    known = sorted({t for q in queries for t in q})
    number = {t: k for k, t in enumerate(known)}
    counted = {r["number"]: r["n"] for r in count_terms(docs, known).collect()}  # one row per query term of this block
    documents, terms = counted.get(DOCUMENTS, 0), counted.get(TERMS, 0)
    weight = weights(np.array([counted.get(k, 0) for k in range(len(known))], np.int64), documents)
    wanted = [np.array([number[t] for t in q if weight[number[t]] > 0], np.int64) for q in queries]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(known, pa.binary())
        best = [Best(top) for _ in wanted]
        parts, docs_held, held = [], 0, 0

        def finish():
            sizes = np.concatenate([p[3] for p in parts])
            base = np.cumsum([0, *(len(p[3]) for p in parts)])
            doc = np.concatenate([p[0] + b for p, b in zip(parts, base, strict=False)])
            term, tf = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
            missing, ids = (np.concatenate([p[k] for p in parts]) for k in (4, 5))
            if len(term):
                shard = Shard(doc, term, tf, sizes, len(known), documents, terms)
                for q, b in zip(wanted, best, strict=True):
                    shard.search(q, weight[q], b, missing, ids)

        for batch in batches:
            for part in text_slices(batch):
                ids = part.column(0)
                parts.append((
                    *postings_of(part.column(1), vocabulary),
                    ids.is_null().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64),
                ))
                docs_held, held = docs_held + len(part), held + len(parts[-1][0])
                if docs_held >= SHARD_DOCS or held >= SHARD_POSTINGS:
                    finish()
                    parts, docs_held, held = [], 0, 0
        if parts:
            finish()
        many = [len(b.score) for b in best]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(best)), many).astype(np.int32)),
            pa.array(np.concatenate([b.ids for b in best] or [[]]).astype(np.int64), mask=np.concatenate([b.missing for b in best] or [[]]).astype(bool)),
            pa.array(np.concatenate([b.score for b in best] or [[]]).astype(np.int64)),
        ], ["query", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(search, "query int, doc_id long, score long")


def ranked_search(docs: DataFrame, queries: DataFrame, key: str = "item_id", top: int = TOP, at_once: int = QUERIES_AT_ONCE) -> DataFrame:
    """``<key>, rank, doc_id, score``: the ``top`` best documents for each row of ``queries`` (``key``, ``text``)."""
    spark = docs.sparkSession
    kind = queries.schema[key].dataType
    found = spark.createDataFrame([], f"`{key}` {kind.simpleString()}, rank int, doc_id long, score long")
    # One block of queries is with the driver at a time; the best documents of each are written before the next one.
    block: list = []

    def ranked(rows: list) -> DataFrame:
        hits = search_block(docs, terms_of(pa.array([r["text"] for r in rows], pa.string())), top)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ids = spark.createDataFrame([(k, r[key]) for k, r in enumerate(rows)], f"query int, `{key}` {kind.simpleString()}")
        best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        return best.join(ids, "query").select(key, "rank", "doc_id", "score")

    ahead = queries.select(key, "text").toLocalIterator()
    for row in ahead:
        block.append(row)
        if len(block) == at_once:
            found = found.unionByName(written(ranked(block), "ranked"))
            block = []
    return found.unionByName(ranked(block)) if block else found


def op11_ranked_search(spark, sf_dir) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sizes AS (SELECT doc_id, d, terms, CAST(len(terms) AS BIGINT) AS n FROM t WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS every FROM sizes),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, d, n, term, count(*) AS tf FROM (SELECT doc_id, d, n, unnest(terms) AS term FROM sizes) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, corpus GROUP BY term),
scores AS (SELECT item_id, doc_id, d, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // every)))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN w USING (term), corpus GROUP BY item_id, doc_id, d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score > 0)
SELECT item_id, CAST(r AS INT) AS rank, doc_id, score FROM ranked WHERE r <= 50
"""
