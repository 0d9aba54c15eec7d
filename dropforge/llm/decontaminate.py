"""Benchmark decontamination by spaced-seed hashing.

Texts are lower-cased words. A mask is a fixed pattern of positions that count and positions that don't; laid on a text
at every word, it gives a hash of the words it looks at. Equal hashes of a document and a benchmark item under one mask
are a hit; the hit fixes how the two texts lie against each other, and along that diagonal the words are compared one
by one. A document is contaminated by an item if some window of ``WINDOW`` words around a hit (the whole item if it is
shorter) agrees in at least ``SIMILARITY`` of its words. The masks are chosen by rule so that no such window escapes
all of them: ``masks(length, changes)`` covers every way to place the tolerated substitutions.

The benchmark is the small side but is not taken to be bounded: it is cut into blocks of about ``BLOCK_WORDS`` words,
each sent to the tasks once and run against all documents, so memory never depends on its size and nothing is shuffled.

* A null or empty text, of either side, matches nothing. Items of fewer than ``LEAST_WORDS`` words (5) are not searched:
  texts that short agree by chance.
* Repeated documents give repeated rows; items that are equal give a row each; a null id stays null.
* Without documents, items or matches the result is empty. Other columns of either table are not looked at.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.llm.tables import table, written
from dropforge.llm.words import mixed, text_slices, words

WINDOW = 13
SIMILARITY = 0.8
LEAST_WORDS = 5
BLOCK_WORDS = 200_000
MOST_MASKS = 4
_FILTER_BITS = 20


@lru_cache
def masks(length: int, changes: int) -> tuple[tuple[int, ...], ...]:
    """At most ``MOST_MASKS`` position lists, as heavy as possible, of which one fits unhurt into any window of
    ``length`` words with ``changes`` substitutions."""
    faults = [set(c) for c in itertools.combinations(range(length), changes)]
    for weight in range(length - changes, 0, -1):
        shapes = [(0, *rest) for rest in itertools.combinations(range(1, length), weight - 1)]
        survived = {
            s: frozenset(i for i, f in enumerate(faults) if any(not f & {p + at for p in s} for at in range(length - s[-1]))) for s in shapes
        }
        chosen, open_ = [], set(range(len(faults)))
        while open_ and len(chosen) < MOST_MASKS:
            best = max(shapes, key=lambda s: len(survived[s] & open_))
            if not survived[best] & open_:
                break
            chosen.append(best)
            open_ -= survived[best]
        if not open_:
            return tuple(chosen)
    raise ValueError("no mask fits")


def _needed(length: int) -> int:
    return -int(-length * SIMILARITY // 1)


def _seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The mask's hash at every word where it fits into the array, text borders not minded."""
    n = max(0, len(hashes) - mask[-1])
    out = np.full(n, np.uint64(len(mask)))
    for p in mask:
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[p : p + n]
    return mixed(out)


class Block:
    """Benchmark items ready to be searched for: sorted seed hashes for each window length and mask."""

    def __init__(self, items: list[tuple]):
        self.ids = [i for i, _ in items]
        self.hashes, self.before = words(pa.array([t for _, t in items], pa.string()))
        lengths = np.diff(self.before)
        self.window = np.minimum(lengths, WINDOW)
        self.tables = []
        for window in sorted({int(w) for w in self.window if w >= LEAST_WORDS}):
            for mask in masks(window, window - _needed(window)):
                seeds = _seeds(self.hashes, mask)
                at = np.concatenate([np.zeros(0, np.int64), *[
                    np.arange(self.before[i], self.before[i + 1] - mask[-1]) for i in np.flatnonzero(self.window == window)
                ]]).astype(np.int64)
                order = np.argsort(seeds[at], kind="stable")
                keys = seeds[at][order]
                known = np.zeros(1 << _FILTER_BITS, bool)
                known[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
                self.tables.append((mask, keys, at[order], known))
        self.item_of = np.repeat(np.arange(len(items)), lengths)

    def overlaps(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text, item, first word in the text, first word in the item, words covered, equal words among them)."""
        hashes, before = words(texts)
        text_of = np.repeat(np.arange(len(texts)), np.diff(before))
        diagonals = set()
        for mask, keys, at, known in self.tables:
            seeds = _seeds(hashes, mask)
            if not len(seeds) or not len(keys):
                continue
            near = np.flatnonzero(known[(seeds >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            near = near[text_of[near] == text_of[near + mask[-1]]]
            low, high = np.searchsorted(keys, seeds[near], "left"), np.searchsorted(keys, seeds[near], "right")
            near, low, high = near[high > low], low[high > low], high[high > low]
            where = np.repeat(near, high - low)
            first = np.cumsum(high - low) - (high - low)
            found = at[np.repeat(low - first, high - low) + np.arange(len(where))]
            item = self.item_of[found]
            places = np.stack([text_of[where], item, (where - before[text_of[where]]) - (found - self.before[item])], 1)
            diagonals.update(map(tuple, np.unique(places, axis=0).tolist()))
        for text, item, shift in sorted(diagonals):
            own, other = hashes[before[text] : before[text + 1]], self.hashes[self.before[item] : self.before[item + 1]]
            start, stop = max(0, -shift), min(len(other), len(own) - shift)
            window = int(self.window[item])
            if stop - start < window:
                continue
            equal = own[start + shift : stop + shift] == other[start:stop]
            sums = np.cumsum(np.concatenate([[0], equal]))
            good = np.flatnonzero(sums[window:] - sums[:-window] >= _needed(window))
            if len(good):
                covered = np.zeros(len(equal), bool)
                for k in range(window):
                    covered[good + k] = True
                yield text, item, start + shift + int(good[0]), start + int(good[0]), int(covered.sum()), int((covered & equal).sum())


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    """The items in lists of about ``block_words`` words, one list in memory at a time."""
    sized = written(benchmark.select("item_id", "text", F.size(F.split("text", r"\s+")).cast("long").alias("_n")).where("text IS NOT NULL"), "benchmark")
    total = sized.agg(F.sum("_n")).first()[0] or 0
    count = max(1, -(-total // block_words))
    for k in range(count):
        yield [tuple(r) for r in sized.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(count)) == k).select("item_id", "text").orderBy("item_id", "text").collect()]


def find_overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, doc_word, item_word, n_words, n_equal``: for each document and item that overlap, where their
    longest overlap starts in either, how many words it covers and how many of them are equal."""
    doc_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, doc_word long, item_word long, n_words long, n_equal long"
    slim, out = docs.select("doc_id", "text"), None
    for items in blocks(benchmark, block_words):
        sent = slim.sparkSession.sparkContext.broadcast(items)

        def search(batches, sent=sent):
            block = Block(sent.value)
            for batch in batches:
                for part in text_slices(batch):
                    best = {}
                    for text, item, *rest in block.overlaps(part.column(1)):
                        if (text, item) not in best or rest[2] > best[text, item][2]:
                            best[text, item] = rest
                    ids = part.column(0).to_pylist() if best else []
                    rows = [(ids[t], block.ids[i], *r) for (t, i), r in best.items()]
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(("doc_id", "item_id", "doc_word", "item_word", "n_words", "n_equal"), r, strict=True)) for r in rows],
                        schema=pa.schema([("doc_id", part.schema.field(0).type), ("item_id", id_type), *((n, pa.int64()) for n in ("doc_word", "item_word", "n_words", "n_equal"))]),
                    )

        id_type = {"string": pa.string(), "int": pa.int32()}.get(item_type.simpleString(), pa.int64())
        found = slim.mapInArrow(search, schema)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that overlap with no item, all columns kept."""
    for items in blocks(benchmark, block_words):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def clean(batches, sent=sent):
            block = Block(sent.value)
            for batch in batches:
                for part in text_slices(batch):
                    keep = np.ones(part.num_rows, bool)
                    for text, *_ in block.overlaps(part.column(part.schema.names.index("text"))):
                        keep[text] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op8_decontaminate(spark, sf_dir) -> DataFrame:
    return find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
