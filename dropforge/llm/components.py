"""Connected components of links between ids, by repeated joins; no node's links meet in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.llm.tables import written

#: Links that a task contracts at once.
CHUNK = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as stars: every id but the smallest of its component among these links, beside that smallest one."""
    ids, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    label = np.arange(len(ids))
    while True:
        x, y = label[a], label[b]
        low = np.minimum(x, y)
        if (x == y).all():
            break
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]


def _contracted(links: DataFrame) -> DataFrame:
    """Links ``u > v`` of the same components, fewer of them: each task turns what it holds into stars, chunk by chunk."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flush():
            u, v = stars(*[np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(2)])
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= CHUNK:
                yield flush()
                held, rows = [], 0
        if held:
            yield flush()

    return links.mapInArrow(contract, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """``id, component``: the smallest id reachable over ``links`` (``a``, ``b``), for ids that have a link.

    Tasks contract the links they hold; then the large-star and small-star steps alternate: every node hands its larger,
    then its smaller neighbours over to the smallest one it knows. The smallest neighbour is a partially aggregated
    minimum, and handing over is a join, so a node with a third of all links is split like any hot key. Ends when every
    node has one smaller neighbour at most, which has none, or when no more links are left than a task contracts at once:
    those are contracted together, without any shuffle.
    """
    edges = written(_contracted(links.where("a <> b").select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v"))), "links")
    if edges.count() > CHUNK:
        edges = written(edges.distinct(), "links")
    while edges.count() > CHUNK and not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "links")
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(_contracted(small.unionByName(down.select("u", F.col("m").alias("v")))).distinct(), "links")
    if edges.count() <= CHUNK:
        edges = written(_contracted(edges.coalesce(1)), "links")
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(ids.select(F.col("component").alias("id"), "component").distinct())


def _settled(edges: DataFrame) -> bool:
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR (up = 1 AND down = 1)").agg(F.count(F.lit(1))).first()[0] == 0
