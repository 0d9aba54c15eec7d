"""Quality by a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its distinct hashed words (one over the root of their number each), the step each structure
statistic falls in, and the step of its recorded length. The score is ``w0 + sum(w x) + pairs``, where the pair term
``sum over i < j of <v_i, v_j> x_i x_j`` with ``RANK`` factors per feature is computed in linear time as half the square
of the sum less the sum of the squares, factor by factor. It is fitted by logistic loss on a bounded sample of labelled
rows (about ``SAMPLE_ROWS`` at most, a documented bound) and calibrated on them, so that even odds stand at ``CUT``.

* A null text is the empty text and gets a score like any other; a missing length is a step of its own.
* A null id is in the fold of the empty text. Without usable labels every score is the same, the cut.
* Without documents the result is empty; columns of the input named like an added one are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.llm.features import (
    STEPS, STRUCTURE_FEATURES, WORD_FEATURES, calibrated, fold, hashed, labelled, lengths_step, sigmoid, steps, structure, training_sample, word_features,
)
from dropforge.llm.tables import table
from dropforge.llm.words import binary_array, text_slices

FOLDS, KEPT_OUT = 4, 2
SAMPLE_ROWS = 8_000
CUT = 0.7
RANK = 6
ROUNDS = 12
FEATURES = WORD_FEATURES + STRUCTURE_FEATURES + STEPS
ADDED = ("held_out", "score", "predicted")


def features(texts: pa.Array, n_chars: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values of all texts, and where each text's begin."""
    hashes, before = hashed(texts)
    made, starts, _ = word_features(hashes, before)
    n = np.diff(starts)
    rest = np.concatenate([WORD_FEATURES + steps(structure(texts, hashes, before)), (WORD_FEATURES + STRUCTURE_FEATURES + lengths_step(n_chars))[:, None]], 1)
    width = rest.shape[1]
    out_starts = starts + np.arange(len(starts)) * width
    index, value = np.zeros(out_starts[-1], np.int32), np.full(out_starts[-1], 1 / np.sqrt(width))
    at = np.arange(len(made)) + np.repeat(np.arange(len(n)) * width, n)
    index[at], value[at] = made, np.repeat(1 / np.sqrt(np.maximum(n, 1)), n)
    tail = (out_starts[1:, None] - width) + np.arange(width)
    index[tail] = rest
    return index, value, out_starts


class Machine:
    """A factorisation machine of rank ``RANK``."""

    def __init__(self):
        self.offset, self.linear = 0.0, np.zeros(FEATURES)
        self.factors = np.random.default_rng(5).normal(0, 0.05, (FEATURES, RANK))
        self.slope, self.shift = 1.0, 0.0

    def _sums(self, index, value, starts):
        vx = self.factors[index] * value[:, None]
        return vx, np.add.reduceat(vx, starts[:-1]), np.add.reduceat(vx * vx, starts[:-1])

    def raw(self, index, value, starts) -> np.ndarray:
        """Every text has its structure features, so no segment is empty."""
        if len(starts) < 2:
            return np.zeros(0)
        _, s, q = self._sums(index, value, starts)
        return self.offset + np.add.reduceat(self.linear[index] * value, starts[:-1]) + 0.5 * (s * s - q).sum(1)

    def score(self, index, value, starts) -> np.ndarray:
        return sigmoid(self.slope * self.raw(index, value, starts) + self.shift + np.log(CUT / (1 - CUT)))

    def fit(self, index, value, starts, y, rounds: int = ROUNDS, batch: int = 64, rate: float = 0.1):
        """Small batches in a fixed random order, steps scaled by their past (Adagrad), only the features at hand move."""
        rnd = np.random.default_rng(11)
        past_linear, past_factors = np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6)
        for _ in range(rounds):
            for rows in np.array_split(rnd.permutation(len(y)), max(1, len(y) // batch)):
                n = starts[rows + 1] - starts[rows]
                own = np.concatenate([[0], np.cumsum(n)])
                at = np.repeat(starts[rows] - own[:-1], n) + np.arange(own[-1])
                i, x = index[at], value[at]
                vx, s, q = self._sums(i, x, own)
                z = self.offset + np.add.reduceat(self.linear[i] * x, own[:-1]) + 0.5 * (s * s - q).sum(1)
                error = np.repeat((sigmoid(z) - y[rows]) / len(rows), n)
                ids, inverse = np.unique(i, return_inverse=True)
                grad = np.bincount(inverse, error * x, len(ids)) + 1e-6 * self.linear[ids]
                pair = (error * x)[:, None] * (np.repeat(s, n, axis=0) - vx)
                pair = np.stack([np.bincount(inverse, pair[:, f], len(ids)) for f in range(RANK)], 1) + 1e-6 * self.factors[ids]
                past_linear[ids] += grad * grad
                past_factors[ids] += pair * pair
                self.linear[ids] -= rate * grad / np.sqrt(past_linear[ids])
                self.factors[ids] -= 0.3 * rate * pair / np.sqrt(past_factors[ids])
                self.offset -= 0.02 * rate * error.sum()
        return self


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Machine:
    chosen = training_sample(labels, "quality", FOLDS, KEPT_OUT, sample_rows)
    sample = labelled(docs, chosen, "text", "n_chars")

    def look(batches):
        for batch in batches:
            for part in text_slices(batch):
                index, value, starts = features(part.column(0), part.column(1))
                cut = list(zip(starts[:-1], starts[1:], strict=True))
                yield pa.RecordBatch.from_arrays([
                    part.column(2), binary_array([index[a:b].tobytes() for a, b in cut]), binary_array([value[a:b].astype(np.float32).tobytes() for a, b in cut]),
                ], ["label", "made", "value"])

    seen = sample.select("text", "n_chars", "_label").mapInArrow(look, "label double, made binary, value binary").collect()
    machine = Machine()
    y = np.array([r["label"] for r in seen])
    if not len(y) or y.min() == y.max():
        machine.slope, machine.factors[:] = 0.0, 0
        return machine
    seen.sort(key=lambda r: (r["label"], bytes(r["made"])))  # whatever order the rows came in
    y = np.array([r["label"] for r in seen])
    parts = [np.frombuffer(bytes(r["made"]), np.int32) for r in seen]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    index, value = np.concatenate(parts), np.concatenate([np.frombuffer(bytes(r["value"]), np.float32) for r in seen]).astype(np.float64)
    del seen, parts
    machine.fit(index, value, starts, y)
    machine.slope, machine.shift = calibrated(machine.raw(index, value, starts), y)
    return machine


def score_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with ``held_out, score, predicted``."""
    if "n_chars" not in docs.columns:
        docs = docs.withColumn("n_chars", F.lit(None).cast("long"))
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))
    base = docs.drop(*ADDED).withColumn("held_out", fold(F.col("doc_id"), FOLDS) == KEPT_OUT)
    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches):
        machine = sent.value
        for batch in batches:
            for part in text_slices(batch):
                names = part.schema.names
                p = machine.score(*features(part.column(names.index("text")), part.column(names.index("n_chars"))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= CUT).astype(np.int32))], [*names, "score", "predicted"])

    return base.mapInArrow(score, schema)


def op7_quality(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return score_quality(docs, table(spark, sf_dir, "labels")).select("doc_id", *ADDED)
