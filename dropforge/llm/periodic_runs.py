"""Periodic runs: stretches of consecutive words that repeat with a period, at least four times over.

Positions a period apart agree over a whole run, for three periods or more, so every run of period q holds a position of
the grid 0, 3q, 6q, …: over all periods these grids have n log n / 3 positions (the harmonic sum). From each of them that
agrees with its partner one period on, the agreement is extended in both directions by longest common extensions (LCE);
the ends it finds are those of the run. Equal stretches found with several periods keep the smallest, which divides the
others.

LCEs of few words are compared word by word. Longer ones go through a difference cover: of the positions modulo v only
those in the cover are sampled, and any two positions reach samples within v - 1 words, so only sampled suffixes are
sorted (blocks of v words, then doubling) and a sparse table over the common prefixes of neighbours in that order
answers the rest. Texts stand end to end in one array, each between two marks of its own that stop every extension, so
the steps run over whole slices of a batch; suffixes are sorted only of texts in which an extension got that far.

Each text is worked on by itself, where it lies: there is no shuffle and nothing to be skewed. Memory is some ten numbers
per word of a slice (a megabyte of texts, or one longer text) and, for texts that need the sorted samples, about as many
again per level of the table; the cover gets sparser where a text is very long.

* A null text is the empty text and has no words, no runs and an empty collapsed text.
* Runs are in order of start, then period. Repeated rows get the same result each; without rows the result is empty.
* Columns of the input named like an added one are replaced; all others are handed on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.llm.tables import table, unpacked, whole_row
from dropforge.llm.words import WHITE_SPACE, exact_words, joined_words, text_bytes, text_slices, word_spans

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
PAIRS_AT_ONCE = 1 << 20
#: Difference covers by period: every difference modulo the period occurs between two of its numbers.
COVERS = {13: (0, 1, 3, 9), 31: (1, 5, 11, 24, 25, 27), 133: (0, 1, 9, 19, 24, 31, 52, 56, 58, 69, 72, 98)}
ADDED = ("n_words", "runs", "collapsed")
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def cover_for(words: int) -> int:
    """Period of the cover for arrays of that many words: samples stay within a few million."""
    return 13 if words < 8_000_000 else 31 if words < 30_000_000 else 133


def agreed(words: np.ndarray, x: np.ndarray, y: np.ndarray, step: int, most: np.ndarray | int) -> np.ndarray:
    """How many words from ``x`` and ``y`` on agree, going by ``step``; looks at ``most`` at most."""
    out = np.zeros(len(x), np.int64)
    left = np.arange(len(x)) if np.isscalar(most) else np.flatnonzero(most > 0)
    t = 0
    while len(left):
        left = left[words[x[left] + step * t] == words[y[left] + step * t]]
        t += 1
        out[left] = t
        left = left[t < (most if np.isscalar(most) else most[left])]
    return out


class Extensions:
    """Longest common extensions of positions of ``words``, in which every text ends with a number of its own."""

    def __init__(self, words: np.ndarray, period: int | None = None) -> None:
        v = self.v = period or cover_for(len(words))
        cover = np.array(COVERS[v])
        n = len(words)
        # Marks of their own behind the end, so that every block of v words is there.
        self.words = words = np.concatenate([words, words.max(initial=0) + 1 + np.arange(v)])
        pairs = (cover[None, :] - cover[:, None]) % v
        self.meets = np.zeros(v, np.int64)
        self.meets[pairs.ravel()] = np.repeat(cover, len(cover))  # x in the cover with x + difference in it, too
        sampled = np.zeros(n, bool)
        for c in cover:
            sampled[c::v] = True
        at = np.flatnonzero(sampled)
        self.place = np.full(n + v, -1, np.int64)
        self.place[at] = np.arange(len(at))
        self.levels = [self._blocks(at)]
        while self.levels[-1].max(initial=-1) + 1 < len(at):
            last, reach = self.levels[-1], v << (len(self.levels) - 1)
            ahead = at + reach
            there = ahead < n
            second = np.full(len(at), -1, np.int64)
            second[there] = last[self.place[ahead[there]]]
            self.levels.append(np.unique(last * np.int64(len(at) + 1) + second + 1, return_inverse=True)[1])
        self.rank = self.levels[-1]
        order = np.empty(len(at), np.int64)
        order[self.rank] = np.arange(len(at))
        common = np.zeros(len(at), np.int64)
        common[1:] = self._common(at[order[:-1]], at[order[1:]])
        self.table = [common]
        while (1 << len(self.table)) < len(at):
            half = 1 << (len(self.table) - 1)
            lower = self.table[-1]
            self.table.append(np.minimum(lower[:-half], lower[half:]))

    def _blocks(self, at: np.ndarray) -> np.ndarray:
        """Rank of the v words at each sampled position; words are packed so that few columns are sorted."""
        v, words = self.v, self.words
        bits = max(1, int(words.max()).bit_length())
        each = max(1, 63 // bits)
        columns = []
        for start in range(0, v, each):
            packed = np.zeros(len(at), np.int64)
            for k in range(start, min(v, start + each)):
                packed = (packed << bits) | words[at + k]
            columns.append(packed)
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(at), bool)
        for c in columns:
            new[1:] |= c[order[1:]] != c[order[:-1]]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Common prefixes of sampled suffixes: equal blocks of halving length, then words."""
        x, y = x.copy(), y.copy()
        begin = x.copy()
        for k in reversed(range(len(self.levels))):
            same = self.levels[k][self.place[x]] == self.levels[k][self.place[y]]
            x[same] += self.v << k
            y[same] += self.v << k
        return x - begin + agreed(self.words, x, y, 1, self.v)

    def lce(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Words that agree from ``x`` and ``y`` on, two different positions of one text."""
        ahead = (self.meets[(y - x) % self.v] - x) % self.v
        out = agreed(self.words, x, y, 1, ahead)
        far = np.flatnonzero(out == ahead)
        a, b = (self.rank[self.place[p[far] + ahead[far]]] for p in (x, y))
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.log2(high - low + 1).astype(np.int64)
        for k in np.unique(level):
            own = level == k
            least = self.table[k]
            out[far[own]] += np.minimum(least[low[own]], least[high[own] - (1 << k) + 1])
        return out


def _grid(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, position and period of all grid positions, some at a time."""
    most = np.where(sizes >= LEAST_LENGTH, sizes // LEAST_EXPONENT, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (LEAST_EXPONENT - 1) * period
    many = (sizes[text] - 1 - period) // step + 1
    ends, start = np.cumsum(many), 0
    while start < len(text):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, "right")))
        own = slice(start, stop)
        n = many[own]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(text[own], n), k * np.repeat(step[own], n), np.repeat(period[own], n)
        start = stop


def _marked(words: np.ndarray, before: np.ndarray, texts: np.ndarray, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The chosen texts, each between marks of its own, and where each one starts; forwards and, if asked, backwards."""
    sizes = np.diff(before)[texts]
    starts = 1 + np.cumsum(sizes + 1) - (sizes + 1)
    total = int((sizes + 1).sum()) + 1
    out = np.zeros(total, np.int64)
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    own = np.repeat(before[texts] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    out[at] = words[own]
    free = np.ones(total, bool)
    free[at] = False
    first = int(words.max(initial=0)) + 1
    out[free] = first + np.arange(free.sum())
    if reverse:
        back = out[::-1].copy()
        back[free[::-1]] += free.sum()
        out = np.concatenate([out, back])
    return out, starts


def runs_of(words: np.ndarray, before: np.ndarray, period: int | None = None) -> np.ndarray:
    """``text, start, length, period`` of all runs of the texts whose numbered words stand in ``before[k] : before[k + 1]``."""
    sizes = np.diff(before)
    found = []
    line, starts = _marked(words, before, np.arange(len(sizes)))
    few = min(COVERS)
    for text, at, q in _grid(sizes):
        x = starts[text] + at
        hit = line[x] == line[x + q]
        text, x, q = text[hit], x[hit], q[hit]
        ahead, behind = agreed(line, x, x + q, 1, few), agreed(line, x - 1, x + q - 1, -1, few)
        far = (ahead == few) | (behind == few)
        if far.any():
            # Only texts with a long agreement get their samples sorted.
            chosen, own = np.unique(text[far], return_inverse=True)
            both, begins = _marked(words, before, chosen, reverse=True)
            lce = Extensions(both, period)
            p = begins[own] + (x - starts[text])[far]
            ahead[far] = lce.lce(p, p + q[far])
            mirror = len(both) - p  # of the word before p
            behind[far] = lce.lce(mirror, mirror - q[far])
        length = ahead + behind + q
        run = length >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * q)
        found.append(np.stack([text[run], (x - starts[text] - behind)[run], length[run], q[run]], 1))
    every = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    every = every[np.lexsort(every.T[::-1])]
    fresh = np.ones(len(every), bool)
    fresh[1:] = (every[1:, :3] != every[:-1, :3]).any(1)
    every = every[fresh]
    return every[np.lexsort((every[:, 3], every[:, 1], every[:, 0]))]


def kept_words(runs: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Whether each word stays: not if a run holds it after its first period."""
    turns = np.zeros(before[-1] + 1, np.int64)
    base = before[runs[:, 0]] + runs[:, 1]
    np.add.at(turns, base + runs[:, 3], 1)
    np.add.at(turns, base + runs[:, 2], -1)
    return np.cumsum(turns)[:-1] == 0


def find_runs(docs: DataFrame) -> DataFrame:
    """The documents with ``n_words``, ``runs`` (start, length, period) and ``collapsed``, the kept words joined by spaces."""
    base = docs.select(whole_row(docs, ADDED).alias("row"), "text")
    schema = T.StructType([
        base.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                raw, offsets = text_bytes(part.column(1))
                first, last, before = word_spans(raw, offsets, ~WHITE_SPACE)
                runs = runs_of(exact_words(raw, first, last), before)
                cuts = np.searchsorted(runs[:, 0], np.arange(len(offsets)))
                rows = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], ["start", "length", "period"])
                added = [
                    pa.array(np.diff(before)),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows),
                    joined_words(raw, first, last, before, kept_words(runs, before)),
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *added], ["row", *ADDED])

    return unpacked(base.mapInArrow(work, schema), "row", *ADDED)


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document by its id's checksum goes over to repeating a stretch of its words."""
    key = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    base = docs.select("doc_id", "text", (key % 10 == 0).alias("chosen"), F.floor(key / 10).alias("g"))
    told = base.select("doc_id", "text", "chosen", "g", F.when(F.col("chosen"), words).alias("words"))
    n = F.size("words")
    a = F.col("g") % n
    p = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    placed = told.withColumn("a", F.when(n > 0, a)).withColumn("p", p)
    again = F.transform(
        F.sequence(F.lit(0).cast("long"), n.cast("long") - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    return placed.select("doc_id", F.when(n > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir) -> DataFrame:
    found = find_runs(planted(table(spark, sf_dir, "documents")))
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    nothing = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", nothing, lambda b, r: F.when(more(b, r), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), lines.alias("lines")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
