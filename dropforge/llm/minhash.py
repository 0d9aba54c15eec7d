"""MinHash near-dedup by improved consistent weighted sampling.

A text is its five-word shingles with TF-IDF weights: ``tf * (1 + idf / idf_most)``. Document frequencies are counted over
all documents for ``FEATURES`` hashed shingle features, as hashed TF-IDF does; the table of counts has a fixed size
whatever the corpus. The idf is scaled to stay between one and two times the plain count, so that what a large group of
copies shares can't be outweighed by one changed sentence.

``BANDS`` x ``ROWS`` consistent weighted samples of each text make its bands. Per sample and shingle the random numbers
(two gamma, one uniform) are read from a fixed table at a hashed place; the sample is the shingle of the smallest value
with its quantised weight. Texts of equal words are one class first, represented by the row of the smallest doc_id;
representatives that share a band are candidates. A band's group is not turned into all its pairs: it is compared with its most connected
member, and what is not linked by that, with the next one, for ``STAR_ROUNDS`` rounds. Texts of groups that still hold
several parts are gathered into regions, and there everything outside the region's main part is compared with everything
it shares a band with, block against block of ``BLOCK`` texts, each pair of blocks in a task of its own that gives back
only the links it finds. Every link is verified by the exact weighted Jaccard similarity of the two whole texts, at least
``SIMILARITY``. Classes are the connected components.

* A text of fewer than five words is one shingle of all its words; one without words (null, empty) is alone in its class.
* A null id comes after all others; its class is that of its text. Every row is a document of its own, also of a null or
  repeated id: exactly one row of each class is kept, one of those with the class's smallest id.
* Without documents the result is empty; other columns are passed through and never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from dropforge.llm.components import components
from dropforge.llm.tables import LAST_ID, ordered_id, table, written
from dropforge.llm.words import binary_array, mixed, shingles, text_slices, words

SHINGLE = 5
SIMILARITY = 0.8
FEATURES = 1 << 16
BANDS, ROWS = 16, 5
STAR_ROUNDS = 2
BLOCK = 256
_PARTS = 16
_TABLE = 1 << 16


def _random_table() -> tuple[np.ndarray, ...]:
    """Gamma(2, 1) ``r`` and ``c`` and uniform ``b`` for ``_TABLE`` places, as 1/r, r, ln c and b."""
    rnd = np.random.default_rng(20250601)
    r, c = rnd.gamma(2.0, 1.0, _TABLE), rnd.gamma(2.0, 1.0, _TABLE)
    return (1 / r).astype(np.float32), r.astype(np.float32), np.log(c).astype(np.float32), rnd.random(_TABLE).astype(np.float32)


def weighted_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in order of their hash, their counts, how many precede each text, word digests."""
    hashes, before = words(texts)
    made, at = shingles(hashes, before, SHINGLE)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    order = np.lexsort((made, owner))
    made, owner = made[order], owner[order]
    new = np.ones(len(made), bool)
    new[1:] = (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(made)))
    starts = np.searchsorted(owner[first], np.arange(len(texts) + 1))
    # The digest tells texts of other words or another order apart: words times powers of their place.
    place = np.arange(len(hashes)) - np.repeat(before[:-1], np.diff(before))
    digests = np.zeros((len(texts), 2), np.uint64)
    full = np.flatnonzero(np.diff(before))
    for k, salt in enumerate((0x51, 0xA7)):
        terms = mixed(hashes ^ mixed(place.astype(np.uint64) * np.uint64(2) + np.uint64(salt << 40)))
        if len(full):
            digests[full, k] = np.add.reduceat(terms, before[:-1][full])
    return made[first], counts, starts, digests, np.diff(before)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each hashed feature occurs, and how many documents there are."""
    width = FEATURES // _PARTS

    def count(batches):
        seen, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for part in text_slices(batch):
                made, _, starts, _, _ = weighted_shingles(part.column(0))
                owner = np.repeat(np.arange(part.num_rows), np.diff(starts))
                features = np.unique(owner * FEATURES + (made % np.uint64(FEATURES)).astype(np.int64)) % FEATURES
                seen += np.bincount(features, minlength=FEATURES)
                rows += part.num_rows
        yield pa.RecordBatch.from_arrays([
            pa.array(range(_PARTS), pa.int32()), binary_array([seen[k * width : (k + 1) * width].tobytes() for k in range(_PARTS)]),
            pa.array([rows] * _PARTS, pa.int64()),
        ], ["part", "counts", "rows"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows, part = np.zeros(width, np.int64), 0, None
        for batch in batches:
            for p, c, n in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                total, rows, part = total + np.frombuffer(c, np.int64), rows + n, p
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), binary_array([total.tobytes()]), pa.array([rows], pa.int64())], ["part", "counts", "rows"])

    schema = "part int, counts binary, rows long"
    rows = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    total = np.zeros(FEATURES, np.int64)
    for r in rows:
        total[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(bytes(r["counts"]), np.int64)
    return total, max((r["rows"] for r in rows), default=0)


def feature_weights(counts: np.ndarray, rows: int) -> np.ndarray:
    most = np.log(rows + 1.0) or 1.0
    return (1 + np.log((rows + 1.0) / (counts + 1.0)) / max(most, 1e-9)).astype(np.float64)


def band_hashes(made: np.ndarray, counts: np.ndarray, starts: np.ndarray, weights: np.ndarray, tables) -> np.ndarray:
    """One row per text that has shingles, one 64-bit hash per band."""
    full = np.flatnonzero(np.diff(starts))
    out = np.zeros((len(full), BANDS), np.uint64)
    if not len(full):
        return out
    inverse, r, log_c, b = tables
    log_w = np.log(counts * weights[(made % np.uint64(FEATURES)).astype(np.int64)]).astype(np.float32)
    first, sizes = starts[:-1][full], np.diff(starts)[full]
    for k in range(BANDS * ROWS):
        at = (mixed(np.array([k + 1], np.uint64))[0] ^ made) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)
        at = at.astype(np.int64)
        own_b, own_r = b[at], r[at]
        step = np.floor(log_w * inverse[at] + own_b)
        value = log_c[at] - own_r * (step - own_b + np.float32(1))
        hit = np.flatnonzero(value == np.repeat(np.minimum.reduceat(value, first), sizes))
        pick = hit[np.searchsorted(hit, first)]  # of equal values the shingle of the smallest hash
        sample = mixed(made[pick] ^ mixed(step[pick].astype(np.int64).astype(np.uint64)))
        out[:, k // ROWS] = mixed(out[:, k // ROWS] * np.uint64(0x9E3779B97F4A7C15) + sample + np.uint64(k // ROWS + 1))
    return out


def signatures(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``id, node, row, d0, d1, n_words, bands`` of every document: a number of its own, and the document beside it."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    named = docs.select(ordered_id().alias("id"), F.monotonically_increasing_id().alias("node"), F.struct(*docs.columns).alias("row"))
    schema = StructType([*named.schema, *[StructField(c, LongType()) for c in ("d0", "d1", "n_words")], StructField("bands", ArrayType(LongType()))])

    def sign(batches):
        tables = _random_table()
        for batch in batches:
            batch = batch.append_column("text", pc.struct_field(batch.column(2), "text"))
            for part in text_slices(batch):
                made, counts, starts, digests, n_words = weighted_shingles(part.column(3))
                bands = band_hashes(made, counts, starts, sent.value, tables)
                offsets = np.concatenate([[0], np.cumsum((n_words > 0) * BANDS)]).astype(np.int32)
                signed = digests.view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:3], pa.array(signed[:, 0]), pa.array(signed[:, 1]), pa.array(n_words.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.ravel().view(np.int64))),
                ], schema.names)

    return named.mapInArrow(sign, schema)


def similarities(pairs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``a, b, similarity`` for pairs with both whole texts (``a, text_a, b, text_b``)."""
    sent = pairs.sparkSession.sparkContext.broadcast(weights)

    def compare(batches):
        for batch in batches:
            for half in text_slices(batch, "text_a"):
                for part in text_slices(half, "text_b"):
                    sides = [weighted_shingles(part.column(k)) for k in (1, 3)]
                    owner = np.concatenate([np.repeat(np.arange(part.num_rows), np.diff(s[2])) for s in sides])
                    made = np.concatenate([s[0] for s in sides])
                    ours = np.concatenate([sides[0][1], np.zeros(len(sides[1][0]), np.int64)])
                    theirs = np.concatenate([np.zeros(len(sides[0][0]), np.int64), sides[1][1]])
                    order = np.lexsort((made, owner))
                    made, owner, ours, theirs = made[order], owner[order], ours[order], theirs[order]
                    new = np.ones(len(made), bool)
                    new[1:] = (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])
                    first = np.flatnonzero(new)
                    ours, theirs = (np.add.reduceat(x, first) if len(first) else x for x in (ours, theirs))
                    w = sent.value[(made[first] % np.uint64(FEATURES)).astype(np.int64)]
                    less = np.bincount(owner[first], w * np.minimum(ours, theirs), part.num_rows)
                    more = np.bincount(owner[first], w * np.maximum(ours, theirs), part.num_rows)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(less / np.maximum(more, 1e-300))], ["a", "b", "similarity"])

    return pairs.select("a", "text_a", "b", "text_b").mapInArrow(compare, "a long, b long, similarity double")


def _verified(pairs: DataFrame, texts: DataFrame, weights: np.ndarray, label: str) -> DataFrame:
    sides = [texts.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab"]
    return written(similarities(pairs.join(sides[0], "a").join(sides[1], "b"), weights).where(F.col("similarity") >= SIMILARITY), label)


def _across_parts(state: DataFrame, texts: DataFrame, weights: np.ndarray) -> DataFrame:
    """Links ``a, b`` between texts of different parts that share a band, block by block."""
    lowest = state.groupBy("band", "hash").agg(F.min("id").alias("b"))
    regions = components(state.join(lowest, ["band", "hash"]).select(F.col("id").alias("a"), "b"))
    inside = written(state.select("id", "part").distinct().join(regions, "id").withColumnRenamed("component", "region"), "minhash-regions")
    sizes = inside.groupBy("region", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("region").agg(F.max(F.struct("n", "part")).alias("m"), F.sum("n").alias("all"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    inside = inside.join(sizes.select("region", F.col("m.part").alias("main"), blocks(F.col("all") - F.col("m.n")).alias("lefts"), blocks(F.col("all")).alias("rights")), "region")
    slot = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = inside.where("part <> main").select("region", "id", "part", "main", slot("lefts").alias("l"), every("rights").alias("r"), F.lit(0).alias("side"))
    right = inside.select("region", "id", "part", "main", every("lefts").alias("l"), slot("rights").alias("r"), F.lit(1).alias("side"))
    sent = state.sparkSession.sparkContext.broadcast(weights)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks()  # at most two blocks
        side, ids, part, main = (rows[c].to_numpy() for c in ("side", "id", "part", "main"))
        made, counts, starts, _, _ = weighted_shingles(rows["text"].combine_chunks())
        w = counts * sent.value[(made % np.uint64(FEATURES)).astype(np.int64)]
        mass = np.bincount(np.repeat(np.arange(len(ids)), np.diff(starts)), w, len(ids))
        shared = np.array(rows["bands"].to_pylist(), np.int64).reshape(len(ids), -1)
        others, label, a, b = np.flatnonzero(side == 1), dict(zip(part.tolist(), part.tolist(), strict=True)), [], []

        def root(x):
            while label[x] != x:
                x = label[x]
            return x

        for i in np.flatnonzero(side == 0):
            # Two texts outside the main part meet twice; the smaller id looks.
            js = others[(part[others] != part[i]) & ((part[others] == main[i]) | (ids[others] > ids[i])) & (shared[others] == shared[i]).any(1)]
            js = js[np.minimum(mass[js], mass[i]) >= SIMILARITY * np.maximum(mass[js], mass[i])]
            if not len(js):
                continue
            own = slice(starts[i], starts[i + 1])
            sizes = starts[js + 1] - starts[js]
            at = np.repeat(starts[js] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            place = np.minimum(np.searchsorted(made[own], made[at]), sizes.dtype.type(own.stop - own.start - 1))
            both = np.where(made[own][place] == made[at], np.minimum(w[own][place], w[at]), 0.0)
            low = np.bincount(np.repeat(np.arange(len(js)), sizes), both, len(js))
            for j in js[low / (mass[i] + mass[js] - low) >= SIMILARITY].tolist():
                x, y = root(int(part[i])), root(int(part[j]))
                if x != y:  # one link between two parts is enough
                    label[x] = y
                    a.append(int(ids[i]))
                    b.append(int(ids[j]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return left.unionByName(right).join(texts, "id").groupBy("region", "l", "r").applyInArrow(compare, "a long, b long")


def classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every document as a written ``row`` with its ``node``; ``node, id, d0, d1, n_words, class_id, kept`` of each.

    ``id`` is the doc_id, the largest number for a null one; ``node`` tells all rows apart, whatever their ids.
    """
    weights = feature_weights(*document_frequencies(docs))
    signed = written(signatures(docs, weights), "minhash-signatures")
    same = signed.where("n_words > 0").groupBy("d0", "d1").agg(F.min(F.struct("id", "node", "bands")).alias("s"))
    representatives = written(same.select("d0", "d1", "s.node", F.col("s.id").alias("rep"), "s.bands"), "minhash-classes")
    members = representatives.select(F.col("node").alias("id"), F.posexplode("bands").alias("band", "hash"))
    groups = members.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(members.join(groups, ["band", "hash"]), "minhash-bands")
    popularity = members.groupBy("id").agg(F.sum("n").alias("popular"))
    members = written(members.join(popularity, "id").select("band", "hash", "id", "popular").withColumn("part", F.col("id")), "minhash-members")

    inside = signed.select(F.col("node").alias("id"), F.col("row.text").alias("text"), "bands")
    # The texts to look at grow with the corpus: their numbers are never sent to all tasks.
    texts = written(inside.join(members.select("id").distinct().hint("merge"), "id"), "minhash-texts")
    links, used, parts = None, None, None
    for turn in range(STAR_ROUNDS + 1):
        state = members
        if links is not None:
            parts = parts if parts is not None else components(links)
            state = written(members.drop("part").join(parts.withColumnRenamed("component", "c"), "id", "left").withColumn("part", F.coalesce("c", "id")).drop("c"), "minhash-state")
        apart = state.groupBy("band", "hash").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("band", "hash")
        state = written(state.join(apart, ["band", "hash"]), "minhash-apart")
        if state.isEmpty():
            break
        if turn == STAR_ROUNDS:
            found = written(_across_parts(state, texts, weights), "minhash-links")
        else:
            centres = state if used is None else state.join(used, ["band", "hash", "id"], "left_anti")
            centres = centres.groupBy("band", "hash").agg(F.max(F.struct("popular", "id", "part")).alias("c"))
            centres = centres.select("band", "hash", F.col("c.id").alias("centre"), F.col("c.part").alias("centre_part"))
            pairs = state.join(centres, ["band", "hash"]).where("part <> centre_part").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
            now = centres.select("band", "hash", F.col("centre").alias("id"))
            used = written(now if used is None else used.unionByName(now), "minhash-centres")
            found = _verified(written(pairs.distinct(), "minhash-pairs"), texts, weights, "minhash-links")
        if links is None:
            links = found.select("a", "b")
        elif not found.isEmpty():
            links, parts = written(links.unionByName(found.select("a", "b")), "minhash-links"), None
    own = representatives.select("d0", "d1", "node", F.struct("rep", "node").alias("first"))
    if links is not None:
        parts = parts if parts is not None else components(links)
        joined = parts.withColumnRenamed("id", "node").join(own.select("node", "first"), "node")
        smallest = joined.groupBy("component").agg(F.min("first").alias("least"))
        named = joined.join(smallest, "component").select("node", "least")
        own = own.join(named, "node", "left").withColumn("first", F.coalesce("least", "first")).drop("least")
    own = own.select(F.col("d0").alias("e0"), F.col("d1").alias("e1"), "first")
    out = signed.select("node", "id", "d0", "d1", "n_words").join(own, (F.col("d0") == F.col("e0")) & (F.col("d1") == F.col("e1")) & (F.col("n_words") > 0), "left")
    first = F.coalesce("first", F.struct(F.col("id").alias("rep"), "node"))
    return signed.select("node", "row"), out.select("node", "id", "d0", "d1", "n_words", first["rep"].alias("class_id"), (first["node"] == F.col("node")).alias("kept"))


def classes(docs: DataFrame) -> DataFrame:
    """``id, d0, d1, n_words, class_id, kept`` for every document; ``id`` is the doc_id, the largest number for a null one."""
    return classified(docs)[1].drop("node")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those that are not the one kept of their class; all columns kept."""
    rows, found = classified(docs)
    return rows.join(found.where("NOT kept").select("node"), "node", "left_anti").select("row.*")


def op4_minhash(spark, sf_dir) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return found.select(shown("id").alias("doc_id"), shown("class_id").alias("class_id"), "n_words", "kept")
