"""Toxicity by weak supervision: many voters, a generative label model, and a linear classifier on its posteriors.

1. **Voters.** Lexicon voters hold fixed insults, one word each. Pattern voters hold word and word-beginning patterns
   that are far more frequent in toxic than in other rows of the training sample; a pattern's support is the number of
   different texts it occurs in (copies count once, by a sample of their shingles). A voter votes toxic when one of its
   patterns occurs and abstains otherwise.
2. **Label model.** From how often voters vote, alone and in pairs, over *all* documents, a two-class generative model is
   solved by moments: for independent voters the covariance is ``a_i * a_j``, so every triplet gives ``a_i``; the
   median over the triplets withstands the dependent ones. Pairs whose covariance is far from the product are taken as
   correlated; they leave the triplets, and their votes count less in the posterior. Labels give only the class prior.
3. **Classifier.** A logistic regression on votes, vote counts and hashed words is fitted to the posteriors of the
   training sample, and its score is calibrated on the sample's labels.

The sample has about ``SAMPLE_ROWS`` labelled rows at most, a documented bound; everything else covers all data. Scores
come from the text alone. Nothing is shuffled but the table of pattern counts of the sample.

* A null text is the empty text and gets a score like any other. A null id is in the fold of the empty text.
* Without usable labels the prior is ``PRIOR`` and only the lexicon votes. Repeated rows get equal scores.
* Without documents the result is empty; columns of the input named like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dropforge.llm.features import WORD_FEATURES, calibrated, fold, labelled, sigmoid, training_sample, word_features
from dropforge.llm.tables import table
from dropforge.llm.words import _WORD, binary_array, hash_spans, shingles, text_bytes, text_slices, word_spans

FOLDS, KEPT_OUT = 5, 0
SAMPLE_ROWS = 12_000
MOST_PATTERNS = 192
PATTERN_VOTERS = 12
LEAST_ODDS = 3.0
PRIOR = 0.05
BEGINNINGS = (4, 5, 6)
#: Fixed lexicon: insults.
INSULTS = (
    "idiot moron stupid loser pathetic worthless scum disgusting trash clown dumb jerk filth filthy fool imbecile vermin"
    " garbage hate ugly"
).split()
ADDED = ("held_out", "score", "predicted")


def _keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its hash and the hashes of its beginnings (kinds told apart), and how many words precede each text."""
    raw, offsets = text_bytes(pc.utf8_lower(texts))
    first, last, before = word_spans(raw, offsets, _WORD)
    kinds = [hash_spans(raw, first, last)]
    for n in BEGINNINGS:
        cut = np.minimum(last, first + n)
        kinds.append(np.where(last - first > n, hash_spans(raw, first, cut) ^ np.uint64(n), np.uint64(0)))
    return np.stack(kinds), before, offsets


def lexicon() -> np.ndarray:
    raw, offsets = text_bytes(pa.array(INSULTS))
    return hash_spans(raw, offsets[:-1], offsets[1:])


def pattern_counts(sample: DataFrame) -> DataFrame:
    """``key, label, n``: in how many different texts with that label each pattern occurs."""

    def emit(batches):
        for batch in batches:
            for part in text_slices(batch):
                keys, before, _ = _keys(part.column(0))
                runs, at = shingles(keys[0], before, 5)
                sketch = np.zeros(part.num_rows, np.uint64)
                full = np.flatnonzero(np.diff(at))
                if len(full):
                    sketch[full] = np.minimum.reduceat(runs, at[:-1][full])
                owner = np.repeat(np.arange(part.num_rows), np.diff(before))
                for kind in keys:
                    pairs = np.unique(np.stack([owner[kind != 0].astype(np.uint64), kind[kind != 0]]), axis=1)
                    at_text = pairs[0].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(pairs[1].view(np.int64)), part.column(1).take(pa.array(at_text)), pa.array(sketch[at_text].view(np.int64)),
                    ], ["key", "label", "sketch"])

    pairs = sample.select("text", "_label").mapInArrow(emit, "key long, label double, sketch long")
    return pairs.distinct().groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))


def patterns(sample: DataFrame) -> np.ndarray:
    """At most ``MOST_PATTERNS`` keys that tell toxic texts, best first."""
    counts = pattern_counts(sample)
    sizes = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = sizes.get(1.0, 0), sizes.get(0.0, 0)
    if not toxic or not other:
        return np.zeros(0, np.uint64)
    per = counts.groupBy("key").agg(*[F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(c) for c, v in (("p", 1.0), ("q", 0.0))])
    odds = F.log((F.col("p") + 0.5) / toxic) - F.log((F.col("q") + 0.5) / other)
    best = per.where(F.col("p") >= max(3, 0.015 * toxic)).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    rows = best.orderBy((F.col("p") * F.col("odds")).desc(), "key").limit(MOST_PATTERNS).collect()
    return np.array([r["key"] for r in rows], np.int64).view(np.uint64)


class Voters:
    """Which keys belong to which voter: an insult each, then the patterns dealt by rank."""

    def __init__(self, found: np.ndarray):
        own = lexicon()
        found = found[~np.isin(found, own)]
        keys = np.concatenate([own, found])
        voter = np.concatenate([np.arange(len(own)), len(own) + np.arange(len(found)) % PATTERN_VOTERS])
        order = np.argsort(keys)
        self.keys, self.voter = keys[order], voter[order]
        self.n = len(own) + PATTERN_VOTERS

    def votes(self, keys: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How many words each voter finds in each text."""
        n = len(before) - 1
        out = np.zeros(n * self.n)
        owner = np.repeat(np.arange(n), np.diff(before))
        for kind in keys:
            at = np.minimum(np.searchsorted(self.keys, kind), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == kind)
            out += np.bincount(owner[hit] * self.n + self.voter[at[hit]], minlength=n * self.n)
        return out.reshape(n, self.n)


def vote_moments(docs: DataFrame, voters: Voters) -> tuple[np.ndarray, int]:
    """How often each pair of voters votes together over all documents (itself on the diagonal), and the rows."""
    sent = docs.sparkSession.sparkContext.broadcast(voters)

    def count(batches):
        total, rows = np.zeros((sent.value.n, sent.value.n)), 0
        for batch in batches:
            for part in text_slices(batch):
                keys, before, _ = _keys(part.column(0))
                v = (sent.value.votes(keys, before) > 0).astype(np.float64)
                total, rows = total + v.T @ v, rows + part.num_rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([0]), binary_array([total.tobytes()]), pa.array([rows])], ["part", "sums", "rows"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = 0, None
        for batch in batches:
            for sums, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                one = np.frombuffer(sums)
                total, rows = (one if total is None else total + one), rows + n
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0]), binary_array([total.tobytes()]), pa.array([rows])], ["part", "sums", "rows"])

    # Two steps: many tasks add up shares of the small matrices, then one adds up at most 64 of them.
    schema = "part long, sums binary, rows long"
    each = docs.select("text").mapInArrow(count, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)).cast("long"))
    found = each.groupBy("part").applyInArrow(add, schema).collect()
    total = reduce(np.add, [np.frombuffer(bytes(r["sums"])) for r in found], np.zeros(voters.n**2))
    return total.reshape(voters.n, voters.n), sum(r["rows"] for r in found)


class LabelModel:
    """Two-class generative model of the votes, solved by moments."""

    def __init__(self, together: np.ndarray, rows: int, prior: float):
        n = len(together)
        rows = max(rows, 1)
        self.prior = min(max(prior, 1e-3), 0.5)
        rate = np.diag(together) / rows
        cov = together / rows - np.outer(rate, rate)
        self.correlated = np.zeros((n, n), bool)
        strength = np.zeros(n)
        live = np.flatnonzero(np.diag(together) >= 2)
        for _ in range(2):
            for i in live:
                others = [j for j in live if j != i and not self.correlated[i, j] and cov[i, j] > 0]
                found = [cov[i, j] * cov[i, k] / cov[j, k] for x, j in enumerate(others) for k in others[x + 1 :] if not self.correlated[j, k] and cov[j, k] > 0]
                strength[i] = np.sqrt(np.median(found)) if found else 0.0
            deviation = np.sqrt(np.maximum(rate * (1 - rate), 1e-12))
            self.rest = (cov - np.outer(strength, strength)) / np.outer(deviation, deviation)
            np.fill_diagonal(self.rest, 0)
            self.correlated = np.abs(self.rest) > 0.15
        # From the strengths to the chances to vote in either class; a voter of unknown strength is believed to be right
        # four times in five.
        spread = np.sqrt(self.prior * (1 - self.prior))
        gap = strength / spread
        low = 0.1 / rows
        self.other = np.clip(rate - self.prior * gap, low, 0.999)
        self.toxic = np.clip(rate + (1 - self.prior) * gap, low, 0.999)
        known = strength > 0
        self.other = np.where(known, self.other, np.clip(0.2 * rate / (1 - self.prior), low, 0.999))
        self.toxic = np.where(known, self.toxic, np.clip(0.8 * rate / self.prior, low, 0.999))
        # Votes that come together for other reasons than the class share one voice.
        self.share = 1 / (1 + np.where(self.correlated, np.clip(self.rest, 0, 1), 0).sum(1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes = np.log(self.toxic / self.other) * self.share
        no = np.log((1 - self.toxic) / (1 - self.other)) * self.share
        return sigmoid(np.log(self.prior / (1 - self.prior)) + votes @ yes + (1 - votes) @ no)


def _numbers(counts: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Dense features: each vote, and how many and how dense the found words are."""
    found = counts.sum(1)
    return np.concatenate([counts > 0, np.log1p(found)[:, None], np.sqrt(found / np.maximum(n_words, 1))[:, None], ((counts > 0).sum(1) >= 2)[:, None]], 1).astype(np.float64)


class Linear:
    """Logistic regression on dense numbers and hashed words, fitted to soft labels."""

    def __init__(self, n_dense: int):
        self.dense, self.words, self.offset, self.slope, self.shift = np.zeros(n_dense), np.zeros(WORD_FEATURES), 0.0, 1.0, 0.0

    def raw(self, dense, made, starts) -> np.ndarray:
        sums = np.zeros(len(made) + 1)
        np.cumsum(self.words[made], out=sums[1:])
        n = np.diff(starts)
        return dense @ self.dense + (sums[starts[1:]] - sums[starts[:-1]]) / np.sqrt(np.maximum(n, 1)) + self.offset

    def score(self, dense, made, starts) -> np.ndarray:
        return sigmoid(self.slope * self.raw(dense, made, starts) + self.shift)

    def fit(self, dense, made, starts, target, rounds: int = 300, rate: float = 0.5):
        """Full-gradient steps scaled by their past (Adagrad), with a small pull towards zero on the words."""
        n = np.diff(starts)
        owner, value = np.repeat(np.arange(len(n)), n), np.repeat(1 / np.sqrt(np.maximum(n, 1)), n)
        past = [np.full(len(self.dense), 1e-8), np.full(WORD_FEATURES, 1e-8), 1e-8]
        for _ in range(rounds):
            error = (sigmoid(self.raw(dense, made, starts)) - target) / max(len(n), 1)
            grads = [dense.T @ error + 1e-5 * self.dense, np.bincount(made, error[owner] * value, WORD_FEATURES) + 1e-4 * self.words, error.sum()]
            past = [p + g * g for p, g in zip(past, grads, strict=True)]
            self.dense -= rate * grads[0] / np.sqrt(past[0])
            self.words -= 0.1 * rate * grads[1] / np.sqrt(past[1])
            self.offset -= rate * grads[2] / np.sqrt(past[2])
        return self


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Voters, Linear, LabelModel]:
    chosen = training_sample(labels, "toxic", FOLDS, KEPT_OUT, sample_rows)
    sample = labelled(docs, chosen, "text")
    voters = Voters(patterns(sample))
    together, rows = vote_moments(docs, voters)

    def look(batches):
        for batch in batches:
            for part in text_slices(batch):
                keys, before, _ = _keys(part.column(0))
                made, starts, _ = word_features(keys[0], before)
                counts = voters.votes(keys, before)
                yield pa.RecordBatch.from_arrays([
                    part.column(1), pa.array(np.diff(before).astype(np.int64)), binary_array([c.astype(np.float32).tobytes() for c in counts]),
                    binary_array([made[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]),
                ], ["label", "n", "votes", "made"])

    seen = sample.select("text", "_label").mapInArrow(look, "label double, n long, votes binary, made binary").collect()
    seen.sort(key=lambda r: (r["label"], r["n"], bytes(r["votes"]), bytes(r["made"])))  # whatever order the rows came in
    y = np.array([r["label"] for r in seen])
    model = LabelModel(together, rows, float(y.mean()) if len(y) and y.max() > 0 else PRIOR)
    counts = np.array([np.frombuffer(bytes(r["votes"]), np.float32) for r in seen]).reshape(len(seen), voters.n)
    parts = [np.frombuffer(bytes(r["made"]), np.int32) for r in seen]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    made = np.concatenate([np.zeros(0, np.int32), *parts])
    dense = _numbers(counts, np.array([r["n"] for r in seen]))
    linear = Linear(voters.n + 3)
    if len(y):
        linear.fit(dense, made, starts, model.posterior((counts > 0).astype(float)))
        linear.slope, linear.shift = calibrated(linear.raw(dense, made, starts), y)
    if not len(y) or y.min() == y.max():
        linear.dense[: voters.n], linear.offset, linear.slope, linear.shift = 2.0, -1.5, 1.0, 0.0  # any insult decides
        linear.dense[voters.n :] = 0
        linear.words[:] = 0
    return voters, linear, model


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents with ``held_out, score, predicted``."""
    voters, linear, _ = train(docs, labels, sample_rows)
    sent = docs.sparkSession.sparkContext.broadcast((voters, linear))
    base = docs.drop(*ADDED).withColumn("held_out", fold(F.col("doc_id"), FOLDS) == KEPT_OUT)
    schema = T.StructType([*base.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches):
        voters, linear = sent.value
        for batch in batches:
            for part in text_slices(batch):
                keys, before, _ = _keys(part.column(part.schema.names.index("text")))
                made, starts, _ = word_features(keys[0], before)
                p = linear.score(_numbers(voters.votes(keys, before), np.diff(before)), made, starts)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*part.schema.names, "score", "predicted"])

    return base.mapInArrow(score, schema)


def op5_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, table(spark, sf_dir, "labels")).select("doc_id", *ADDED)
