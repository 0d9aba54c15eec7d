"""What the two classifiers share: folds, bounded training samples, hashed words and structure statistics of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dropforge.llm.words import text_bytes, words

WORD_FEATURES = 1 << 15
STEPS = 10
STATISTICS = 14
STRUCTURE_FEATURES = STATISTICS * STEPS

_UPPER, _LOWER, _DIGIT, _HIGH, _SPACES, _SIGN = (np.zeros(256, bool) for _ in range(6))
_UPPER[0x41:0x5B] = _LOWER[0x61:0x7B] = _DIGIT[0x30:0x3A] = _HIGH[0x80:] = True
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_SIGN[0x21:0x7F] = True
_SIGN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *b".,;:'-()"]] = False


def fold(doc_id: Column, parts: int) -> Column:
    """The fold of a document; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def training_sample(labels: DataFrame, label: str, parts: int, kept_out: int, most_rows: int) -> DataFrame:
    """``_label_id, _label`` of about ``most_rows`` labelled ids at most outside the fold that is kept out.

    Which ids depends on hashes of the id only, as finely as a double can tell shares apart. A row without id or label
    teaches nothing; of several labels of one id the largest counts. The result has a bounded size whatever the table,
    so it can be sent to all tasks.
    """
    rows = labels.select(F.col("doc_id").alias("_label_id"), F.col(label).cast("double").alias("_label"))
    rows = rows.where(F.col("_label_id").isNotNull() & F.col("_label").isin(0.0, 1.0) & (fold(F.col("_label_id"), parts) != kept_out))
    rows = rows.groupBy("_label_id").agg(F.max("_label").alias("_label"))
    found = rows.count()
    return rows.where(_place(F.col("_label_id")) < min(1.0, most_rows / max(1, found)))


def _place(row_id: Column) -> Column:
    """A number from 0 to below 1 that follows from hashes of an id: the millionth, and the place within it."""
    within = F.pmod(F.xxhash64(row_id, F.lit(18)), F.lit(1 << 32)) / float(1 << 32)
    return (F.pmod(F.xxhash64(row_id, F.lit(17)), F.lit(1_000_000)) + within) / 1e6


def labelled(docs: DataFrame, chosen: DataFrame, *columns: str) -> DataFrame:
    """``columns`` (the text first) and ``_label`` of the documents in a sample of ids: one document of each id.

    Of documents that share an id the one with the smallest digest counts, whatever their number, so that the rows are
    as bounded as the ids.
    """
    rows = docs.select("doc_id", *columns).join(F.broadcast(chosen), F.col("doc_id") == F.col("_label_id"))
    one = F.min(F.struct(F.xxhash64(columns[0]).alias("_digest"), *columns)).alias("_one")
    rows = rows.groupBy("_label_id").agg(one, F.max("_label").alias("_label"))
    return rows.select(*[F.col("_one")[c].alias(c) for c in columns], "_label")


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def word_features(hashes: np.ndarray, before: np.ndarray, size: int = WORD_FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each text, how many precede each text, and their counts."""
    owner = np.repeat(np.arange(len(before) - 1), np.diff(before))
    keys, counts = np.unique(owner * size + (hashes % np.uint64(size)).astype(np.int64), return_counts=True)
    return (keys % size).astype(np.int32), np.searchsorted(keys // size, np.arange(len(before))), counts


def structure(texts: pa.Array, hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """``STATISTICS`` numbers per text, each from 0 to 1: shares of kinds of characters and lines, lengths, repetition."""
    raw, offsets = text_bytes(texts)
    size = np.maximum(np.diff(offsets), 1)
    n_words = np.maximum(np.diff(before), 1)
    owner = np.repeat(np.arange(len(texts)), np.diff(before))
    shares = [_per_text(kind[raw], offsets) / size for kind in (_UPPER, _LOWER, _DIGIT, _HIGH, _SPACES, _SIGN)]
    lines = _per_text(raw == 0x0A, offsets) + 1
    bars = np.minimum(1, _per_text(raw == 0x7C, offsets) / n_words)
    stops = np.minimum(1, _per_text((raw == 0x2E) | (raw == 0x3F) | (raw == 0x21), offsets) / n_words)
    made, first, counts = word_features(hashes, before, 1 << 24)
    distinct = np.diff(first) / n_words
    repeats = np.zeros(len(hashes))
    if len(hashes) > 1:
        repeats[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    most = np.zeros(len(texts))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        most[full] = np.maximum.reduceat(counts, first[:-1][full]) / n_words[full]
    log = lambda x, top: np.minimum(1, np.log2(1 + x) / top)
    return np.stack([
        *shares, bars, stops, distinct, _per_text(repeats, before) / n_words, most,
        log(n_words, 16), log(size / n_words, 6), log(n_words / lines, 10),
    ], 1)


def steps(statistics: np.ndarray) -> np.ndarray:
    """The step each statistic falls in, as a feature number. Steps are finer near zero, where most shares are."""
    level = np.minimum((np.sqrt(np.clip(statistics, 0, 1)) * STEPS).astype(np.int32), STEPS - 1)
    return level + np.arange(statistics.shape[1], dtype=np.int32) * STEPS


def lengths_step(n_chars: pa.Array) -> np.ndarray:
    """The step of the recorded length, the last one where it is missing."""
    n = pc.fill_null(pc.cast(n_chars, pa.float64()), -1).to_numpy(zero_copy_only=False)
    return np.where(n < 0, STEPS - 1, np.minimum(np.log2(1 + np.maximum(n, 0)) / 2, STEPS - 2)).astype(np.int32)


def hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return words(texts)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and offset that make ``sigmoid(slope * z + offset)`` fit the labels, by Newton steps."""
    if len(z) == 0 or y.min() == y.max():
        return 1.0, 0.0
    scale = z.std() or 1.0
    x = np.stack([z / scale, np.ones(len(z))], 1)
    w = np.zeros(2)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        p = sigmoid(x @ w)
        grad = x.T @ (p - target) + 1e-3 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 1e-3) / scale), float(w[1])
