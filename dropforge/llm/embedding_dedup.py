"""Embedding near-dedup with randomised-rotation binary codes.

A unit vector is turned by a fixed random rotation and coded by the signs of its coordinates. With the stored factor
``f`` (how far the code points along the vector) the inner product of two vectors is estimated without bias as the
product of one's code with the other's rotated vector, over ``f``; it is off by more than
``SURE * sqrt(1 / f**2 - 1) / sqrt(dimension - 1)`` only with negligible chance. A pair whose upper bound is below
``LEAST`` is given up; every other pair is recomputed exactly in double precision.

Pairs are looked for among vectors that agree in ``bits`` signs in one of ``tables`` tables; both numbers follow from
the number of vectors, so that cells stay small and a pair at the threshold is met with chance ``RECALL`` or more. Equal
vectors are one node first, with a count. Cells of more than ``BLOCK`` vectors are compared block by block, each pair of
blocks in a task of its own; only link counts and one edge per vector and block pair come out of a task, never the
pairs. A pair is counted in the first table it meets in.

* Null, empty, zero vectors and vectors that hold a null or non-finite number link with nothing: 0 links, alone, kept.
* Vectors of different dimensions never link. Equal vectors link with each other.
* A null id comes after all others (shown as null; its component may be another's). Ids tell no vectors apart and join
  none: different vectors of one id are different nodes, and a component is named by its smallest id at the end.
* Exactly one row of each component is kept, one of those with the smallest id.
* Without vectors the result is empty; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.llm.components import components
from dropforge.llm.tables import LAST_ID, ordered_id, table, written
from dropforge.llm.words import binary_array

LEAST = 0.9
RECALL = 0.99
CELL = 64
BLOCK = 1024
SURE = 5.0


@lru_cache(maxsize=8)
def rotation(dimension: int, turn: int) -> np.ndarray:
    """A random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng([dimension, turn]).normal(size=(dimension, dimension)))
    return q * np.sign(np.diag(r))


def plan(vectors: int) -> tuple[int, int]:
    """Signs per table and number of tables for so many different vectors."""
    bits = min(60, max(1, math.ceil(math.log2(max(2, vectors) / CELL))))
    meet = (1 - math.acos(LEAST) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - meet)))


def usable(vectors: pa.Array) -> list[bytes | None]:
    """Each vector as the bytes of its numbers in double precision; None where it links with nothing."""
    vectors = pc.cast(vectors, pa.large_list(pa.float64()))
    out = []
    for v in vectors:
        x = pc.fill_null(v.values, math.nan).to_numpy(zero_copy_only=False) + 0.0 if v.is_valid else np.zeros(0)
        good = len(x) and np.isfinite(x).all() and x.any()
        out.append(x.tobytes() if good else None)
    return out


def unit(keys: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(keys)).reshape(len(keys), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cell_keys(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The table keys of unit vectors: ``bits`` signs each, from as many rotations as it takes."""
    d = x.shape[1]
    signs = np.concatenate([x @ rotation(d, 1 + t) > 0 for t in range(-(-bits * tables // d))], 1)[:, : bits * tables]
    return signs.reshape(len(x), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def links_between(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of unit vectors have an inner product of at least ``LEAST``: estimate, bound, exact recomputation."""
    d = x.shape[1]
    turn = rotation(d, 0)
    rx, ry = (x @ turn).astype(np.float32), (y @ turn).astype(np.float32)
    code = np.where(ry > 0, np.float32(1), np.float32(-1)) / np.float32(math.sqrt(d))
    factor = (code * ry).sum(1)
    error = SURE * np.sqrt(np.maximum(0, 1 / factor.astype(np.float64) ** 2 - 1)) / math.sqrt(d - 1) if d > 1 else np.full(len(y), np.inf)
    estimate = rx @ (code / factor[:, None]).T
    a, b = np.nonzero(estimate + error[None, :] >= LEAST - 1e-4)
    linked = np.zeros((len(x), len(y)), bool)
    for k in range(0, len(a), 1 << 16):
        i, j = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
        linked[i, j] = (x[i] * y[j]).sum(1) >= LEAST
    return linked


def _local_parts(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest row (of x, then of y) each side reaches over the links of one block pair; -1 without links."""
    n, m = linked.shape
    left = np.where(linked.any(1), np.arange(n), n + m)
    right = np.full(m, n + m)
    while True:
        new_right = np.where(linked, left[:, None], n + m).min(0, initial=n + m)
        new_left = np.minimum(left, np.where(linked, new_right[None, :], n + m).min(1, initial=n + m))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one block pair of one cell: per vector the other vectors newly linked, and an edge to what it reaches."""
    rows = pa.Table.from_batches(list(batches)).to_pydict()  # at most two blocks
    slot, first = np.array(rows["slot"]), rows["low"][0]
    one = rows["high"][0] == first
    x_at = np.flatnonzero(slot == first)
    y_at = x_at if one else np.flatnonzero(slot != first)
    if not len(x_at) or not len(y_at):
        return
    vectors = unit(rows["key"])
    linked = links_between(vectors[x_at], vectors[y_at])
    nodes, copies = np.array(rows["node"]), np.array(rows["copies"])
    if one:
        linked |= linked.T
        np.fill_diagonal(linked, False)
    a, b = np.nonzero(linked)
    cells = np.array([np.frombuffer(c, np.int64)[: rows["turn"][0]] for c in rows["cells"]]).reshape(len(nodes), -1)
    new = np.zeros(len(a), bool)
    for k in range(0, len(a), 1 << 16):
        part = slice(k, k + (1 << 16))
        new[part] = ~(cells[x_at[a[part]]] == cells[y_at[b[part]]]).any(1)
    counts = np.zeros(len(nodes), np.int64)
    np.add.at(counts, x_at[a[new]], copies[y_at[b[new]]])
    if not one:
        np.add.at(counts, y_at[b[new]], copies[x_at[a[new]]])
    left, right = _local_parts(linked)
    n = len(x_at) + len(y_at)
    edges = {}
    for at, parts in ((x_at, left), (y_at, right)):
        for i, p in zip(at[parts < n].tolist(), parts[parts < n].tolist(), strict=True):
            edges[i] = x_at[p]
    touched = sorted(edges)
    if touched:
        yield pa.RecordBatch.from_arrays([
            pa.array(nodes[touched]), pa.array(nodes[[edges[i] for i in touched]]), pa.array(counts[touched]),
        ], ["a", "b", "links"])


def marked_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, n_links, component, kept``, one row per row; ``id`` is the largest number for a null one."""

    def prepare(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], binary_array(usable(batch.column(2)))], ["id", "row", "key"])

    numbered = vectors.select(ordered_id(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(vector_col))
    base = written(numbered.mapInArrow(prepare, "id long, row long, key binary"), "vectors")
    # A node is a distinct vector, numbered by its row of the smallest id.
    nodes = base.where("key IS NOT NULL").groupBy("key").agg(F.min(F.struct("id", "row")).alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = written(nodes.select("key", F.col("first.row").alias("node"), "first", "copies"), "vectors-nodes")
    bits, tables = plan(nodes.count())

    def cells(batches):
        for batch in batches:
            keys = batch.column(0).to_pylist()
            found = [None] * len(keys)
            for size in {len(k) for k in keys}:
                at = [i for i, k in enumerate(keys) if len(k) == size]
                for i, c in zip(at, cell_keys(unit([keys[i] for i in at]), bits, tables), strict=True):
                    found[i] = c.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(k) // 8 for k in keys], pa.int32()), binary_array(found)], ["key", "node", "copies", "dimension", "cells"])

    coded = written(nodes.select("key", "node", "copies").mapInArrow(cells, "key binary, node long, copies long, dimension int, cells binary"), "vectors-codes")

    def spread(batches):
        for batch in batches:
            found = [np.frombuffer(c, np.int64) for c in batch.column(2).to_pylist()]
            n = len(found)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column(0).to_numpy(), tables)), batch.column(1).take(pa.array(np.repeat(np.arange(n), tables))),
                pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(np.concatenate(found) if n else np.zeros(0, np.int64)),
            ], ["node", "dimension", "turn", "cell"])

    place = ["turn", "dimension", "cell"]
    members = coded.select("node", "dimension", "cells").mapInArrow(spread, "node long, dimension int, turn int, cell long")
    sizes = members.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = members.join(sizes, place).withColumn("blocks", blocks).withColumn("slot", F.pmod(F.xxhash64("node", "turn"), F.col("blocks")).cast("int"))
    # Every pair of blocks once: a member goes to the pairs its own block is in.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    members = members.select("node", *place, "slot", other).select("node", *place, "slot", F.least("slot", "other").alias("low"), F.greatest("slot", "other").alias("high"))
    compared = (
        members.join(coded.select("node", "key", "copies", "cells"), "node")
        .groupBy(*place, "low", "high").applyInArrow(_compare, "a long, b long, links long")
    )
    compared = written(compared, "vectors-links")
    counts = compared.groupBy("a").agg(F.sum("links").alias("links"))
    parts = components(compared.where("a <> b").select("a", "b")).withColumnRenamed("id", "node")
    smallest = parts.join(nodes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("least"))
    named = parts.join(smallest, "component").select("node", "least")
    known = nodes.join(counts.withColumnRenamed("a", "node"), "node", "left").join(named, "node", "left").select(
        "key", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("least", "first").alias("first")
    )
    first = F.coalesce("first", F.struct("id", "row"))
    return base.join(known, "key", "left").select(
        "id", F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        first["id"].alias("component"), (first["row"] == F.col("row")).alias("kept"),
    )


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, n_links, component`` of ``marked_vectors``."""
    return marked_vectors(vectors, id_col, vector_col).drop("kept")


def op10_embedding_dedup(spark, sf_dir) -> DataFrame:
    found = marked_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    shown = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return found.select(shown("id").alias("vec_id"), "n_links", shown("component").alias("component_id"), "kept")
