"""Language-model scores by Katz backoff over words and word pairs.

Tokens are the words between white space, A-Z lower-cased, and one end per text. The model is
``P(w | v) = d(c(v w)) c(v w) / c(v)`` where the pair was seen in training, else ``a(v) P(w)``, and likewise
``P(w) = d(c(w)) c(w) / N`` with what the discounts leave for the unknown word. ``d`` is the Good-Turing discount of
counts up to ``K``, and ``a(v)`` is the mass left after ``v`` over the mass of the words not seen after it, so that
``P(. | v)`` sums to one exactly. A context whose counts are all above ``K`` has no discount; its total counts one more,
and that one is its mass left. Before the first word stands a start, which is a context only.

The counts are tables by ranges of hashed keys. Each block of documents asks for the totals of its own words, then of
its own pairs; every pair is owned by the first block that saw it in training, which adds it to the sums of its context
(how many pairs of each small count, the counts of the words that follow), and the context's sums give its ``a``. All
sums are whole numbers, so reruns agree. Words are 64-bit hashes; pair keys have ``KEY_ROOM`` bits more than it takes
to number all tokens, so that at any size one pair in two million meets another's key.

The model holds all pairs of all training texts and has order two: for 0.5 GB of texts the pairs alone move 0.4 GB.

* A null text is the empty text: one end token. A null id counts as the empty text for its fold.
* Repeated rows get equal scores (and are all counted). Without training texts every token is unknown.
* Without documents the result is empty; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.llm.features import fold
from dropforge.llm.keyed import ASKED, answers, blocked, per_block, question, text_parts, told, totals, with_answers
from dropforge.llm.tables import table, whole_text, written
from dropforge.llm.words import mixed, spaced_words

FOLDS, KEPT_OUT = 7, 2
K = 5
KEY_ROOM = 21
END, START = np.uint64(1), np.uint64(2)


def discounts(n: list[int]) -> np.ndarray:
    """``d[0..K]`` from the numbers ``n[1..K+1]`` of types that occur so often; 1 where Good-Turing gives no discount."""
    d = np.ones(K + 1)
    if n[1]:
        rest = (K + 1) * n[K + 1] / n[1]
        for r in range(1, K + 1):
            if n[r] and rest < 1:
                found = ((r + 1) * n[r + 1] / (n[r] * r) - rest) / (1 - rest)
                d[r] = found if 0 < found < 1 else 1.0
        if (d == 1).all():
            d[1] = 0.5  # too few texts to tell: half of what was seen once
    return d


class Tokens:
    """The tokens of a block of documents, its distinct words and pairs."""

    def __init__(self, rows: pa.Table):
        hashes, counts = [], []
        for part in text_parts(rows):
            h, before = spaced_words(part.column(part.schema.names.index("text")))
            hashes.append(h)
            counts.append(np.diff(before))
        counts = np.concatenate(counts)
        n = len(counts)
        self.starts = np.concatenate([[0], np.cumsum(counts + 1)])
        self.tokens = np.full(self.starts[-1], END)
        inside = np.ones(self.starts[-1], bool)
        inside[self.starts[1:] - 1] = False
        self.tokens[inside] = np.concatenate(hashes)
        self.training = np.repeat(~rows["held_out"].to_numpy(), counts + 1)
        self.words, at = np.unique(np.append(self.tokens, START), return_inverse=True)
        self.at = at[:-1]
        self.start_at = at[-1]
        self.counts = np.bincount(self.at[self.training], minlength=len(self.words))
        self.counts[self.start_at] = n - int(rows["held_out"].to_numpy().sum())
        self.before = np.empty_like(self.at)
        self.before[1:] = self.at[:-1]
        self.before[self.starts[:-1]] = self.start_at

    def pairs(self, bits: int):
        """Sorted distinct pair keys, where each is first seen, the key number of every token, training counts."""
        with np.errstate(over="ignore"):
            keys = mixed(mixed(self.words[self.before] + np.uint64(0x9E37)) ^ self.tokens) >> np.uint64(64 - bits)
        distinct, first, at = np.unique(keys, return_index=True, return_inverse=True)
        return distinct, first, at, np.bincount(at[self.training], minlength=len(distinct))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts[:-1])


def _count_words(keys, owner, columns):
    distinct, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, columns[0].astype(np.float64), len(distinct)).astype(np.int64)
    own = total[distinct != START]
    return [total[at]], [int(own.sum()), int((own > 0).sum()), *[int((own == r).sum()) for r in range(1, K + 2)]]


def _count_pairs(keys, owner, columns):
    distinct, at = np.unique(keys, return_inverse=True)
    counts = columns[0].astype(np.int64)
    total = np.bincount(at, counts.astype(np.float64), len(distinct)).astype(np.int64)
    seen = np.flatnonzero(counts > 0)
    _, first = np.unique(at[seen], return_index=True)  # askers come in order of their blocks
    owned = np.zeros(len(keys), np.int64)
    owned[seen[first]] = 1
    return [total[at] * 2 + owned], [int((total == r).sum()) for r in range(1, K + 2)]


def _mass(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return counts * d[np.where(counts <= K, counts, 0)]


def _weigh_contexts(n_train: int, word_d: np.ndarray, word_total: float, pair_d: np.ndarray):
    """The reply to contexts: their ``a``, from all blocks' sums."""
    # columns: the context's count, pairs of count 1..K, following words of count 1..K, sum of larger following counts

    def reply(keys, owner, columns):
        distinct, at = np.unique(keys, return_inverse=True)
        count = np.zeros(len(distinct))
        np.maximum.at(count, at, columns[0].astype(np.float64))
        sums = [np.bincount(at, c.astype(np.float64), len(distinct)) for c in columns[1:]]
        saved = sum(r * (1 - pair_d[r]) * sums[r - 1] for r in range(1, K + 1))
        more = np.where(saved > 0, 0.0, 1.0)
        left = (saved + more) / (count + more)
        taken = (sum(r * word_d[r] * sums[K + r - 1] for r in range(1, K + 1)) + sums[2 * K]) / word_total
        a = np.where(count > 0, left / np.maximum(1 - taken, 1e-300), 1.0)
        # The sign tells the blocks which total to divide by.
        return [np.where((count > 0) & (more > 0), -a, a)[at]], [len(distinct)]

    return reply


def katz_scores(docs: DataFrame, folds: int = FOLDS, kept_out: int = KEPT_OUT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    slim = docs.select("doc_id", whole_text().alias("text"), (fold(F.col("doc_id"), folds) == kept_out).alias("held_out"))
    blocks, ranges = blocked(slim, "katz")

    def ask_words(block, rows):
        t = Tokens(rows)
        yield question(block, t.words, [t.counts], ranges, 64)

    words = written(answers(per_block(blocks.select("block", "text", "held_out"), ask_words, ASKED), _count_words, K + 3), "katz-words")
    n_train, n_types, *often = totals(words, K + 3)
    word_d = discounts([0, *often])
    saved = sum(r * (1 - word_d[r]) * often[r - 1] for r in range(1, K + 1))
    more = 0.0 if saved > 0 else 1.0
    word_total, unknown = n_train + more, (saved + more) / (n_train + more)
    bits = min(64, KEY_ROOM + max(1, math.ceil(math.log2(n_train + 2))))

    def ask_pairs(block, rows, got):
        t = Tokens(rows)
        keys, _, _, counts = t.pairs(bits)
        yield question(block, keys, [counts], ranges, bits)

    texts = blocks.select("block", "text", "held_out")
    pairs = written(answers(per_block(texts, lambda b, r: ask_pairs(b, r, None), ASKED), _count_pairs, K + 1), "katz-pairs")
    pair_d = discounts([0, *totals(pairs, K + 1)])

    def ask_contexts(block, rows, got):
        t = Tokens(rows)
        _, first, _, _ = t.pairs(bits)
        of_word, of_pair = told(got, 0)[0].astype(np.int64), told(got, 1)[0].astype(np.int64)
        mine = np.flatnonzero(of_pair & 1)
        context, follower, c = t.before[first[mine]], of_word[t.at[first[mine]]], of_pair[mine] >> 1
        n = len(t.words)
        columns = [of_word, *[np.bincount(context[c == r], minlength=n) for r in range(1, K + 1)]]
        columns += [np.bincount(context[follower == r], minlength=n) for r in range(1, K + 1)]
        large = follower > K
        columns.append(np.bincount(context[large], follower[large].astype(np.float64), n).astype(np.int64))
        yield question(block, t.words, columns, ranges, 64)

    contexts = answers(with_answers(texts, [words, pairs], ask_contexts, ASKED), _weigh_contexts(n_train, word_d, word_total, pair_d))

    def score(block, rows, got):
        t = Tokens(rows)
        _, _, at, _ = t.pairs(bits)
        of_word, of_pair = told(got, 0)[0].astype(np.int64), told(got, 1)[0].astype(np.int64) >> 1
        a = told(got, 2)[0]
        single = np.where(of_word > 0, _mass(of_word, word_d) / word_total, unknown)
        context_total = of_word + (a < 0)
        c = of_pair[at]
        p = np.where(c > 0, _mass(c, pair_d) / np.maximum(context_total[t.before], 1), np.abs(a)[t.before] * single[t.at])
        known = of_word[t.at] > 0
        base = np.log10((of_word[t.at] + 1.0) / (n_train + n_types + 1.0))
        n = len(t.starts) - 1
        yield pa.RecordBatch.from_arrays([
            rows["doc_id"].combine_chunks(), rows["held_out"].combine_chunks(), pa.array(np.diff(t.starts)), pa.array(t.per_text(known.astype(np.int64))),
            pa.array(np.full(n, n_train)), pa.array(t.per_text(base)), pa.array(t.per_text(np.log10(p))),
        ], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return with_answers(blocks, [words, pairs, contexts], score, schema)


def op9_katz(spark, sf_dir) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))
