"""Questions about 64-bit keys of all documents, asked and answered in packed columns.

Documents are kept in blocks: a table bucketed by block, so that the texts are written once and never shuffled again.
Each block asks about its own distinct keys; all blocks' questions about a range of keys meet in one task per range,
which answers every block in the order it asked. What travels are sorted key differences and byte planes, a few bytes
per key, in rows of one block and one range. Hashed keys fill the ranges evenly, and a key occurs once per block
however often its documents hold it, so no key is hot.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.llm.tables import blocks_for, written
from dropforge.llm.words import SLICE_BYTES, binary_array, text_slices
from dropforge.session import scratch

BLOCK_ROWS = 2500
BLOCK_BYTES = 6 << 20
MANY = 20_000
LARGEST = 40


def blocked(docs: DataFrame, label: str, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """``docs`` with a ``block`` number, bucketed by it, and the number of key ranges to use.

    A block is some thousand neighbouring rows of one scan task; the write moves no row to another task. Every block
    writes a row for every range, so beyond ``MANY`` blocks (about 120 GB) both grow with the input instead, up to
    ``LARGEST`` times, which takes executors of a few GB per core.
    """
    spark = docs.sparkSession
    times = min(LARGEST, max(1, blocks_for(docs, BLOCK_BYTES) // MANY))
    block_rows *= times
    ranges = max(blocks_for(docs, times * BLOCK_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    row = F.monotonically_increasing_id()
    numbered = docs.withColumn("block", F.shiftright(row, 33) * F.lit(1 << 20) + F.floor(row.bitwiseAND((1 << 33) - 1) / block_rows))
    name = f"{label}_{uuid.uuid4().hex}"
    writer = numbered.write.bucketBy(min(ranges, 50_000), "block").option("path", scratch(spark, label)).option("compression", "zstd")
    writer.saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: only its name goes
    return table, ranges


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on as byte planes, no wider than the largest; doubles as they are."""
    if values.dtype.kind == "f":
        return b"f" + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()
    values = values.astype(np.uint64)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    width = 8 if data[:1] == b"f" else data[0]
    planes = np.frombuffer(data, np.uint8, width * n, 1).reshape(width, n)
    full = np.zeros((n, 8), np.uint8)
    full[:, :width] = planes.T
    return full.reshape(-1).view(np.float64 if data[:1] == b"f" else np.uint64)


def _joined(parts: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _split(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def edges(ranges: int, bits: int) -> np.ndarray:
    """First key of each range but the first, of keys of ``bits`` bits."""
    return np.array([(k << bits) // ranges for k in range(1, ranges)], np.uint64)


ASKED = "block long, span int, n long, payload binary"


def question(block: int, keys: np.ndarray, columns: list[np.ndarray], ranges: int, bits: int) -> pa.RecordBatch:
    """The rows that ask about sorted distinct ``keys`` of ``bits`` bits, with ``columns`` of whole numbers."""
    cuts = np.concatenate([[0], np.searchsorted(keys, edges(ranges, bits)), [len(keys)]])
    spans = np.flatnonzero(np.diff(cuts))
    payload = []
    for k in spans:
        a, b = cuts[k], cuts[k + 1]
        own = keys[a:b]
        payload.append(_joined([packed(np.concatenate([own[:1], np.diff(own)])), *[packed(c[a:b]) for c in columns]]))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(spans), block)), pa.array(spans.astype(np.int32)), pa.array(np.diff(cuts)[spans]), binary_array(payload),
    ], ["block", "span", "n", "payload"])


def answers(asked: DataFrame, reply: Callable, sums: int = 1, pick: str = "first") -> DataFrame:
    """``block, span, n, payload, s0..``: the replies to every block, and per span one row of block -1 with ``sums`` totals.

    ``reply(keys, owner, columns)`` gets all keys asked about in a span, who asks (a running number, in order of the
    blocks) and the columns; it returns reply columns in the same order and the totals.
    """
    schema = ASKED + "".join(f", s{k} long" for k in range(sums))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).sort_by("block")
        if not rows.num_rows:
            return
        counts = rows["n"].to_numpy()
        cuts = np.concatenate([[0], np.cumsum(counts)])
        keys, columns = np.zeros(cuts[-1], np.uint64), None
        for k, data in enumerate(rows["payload"]):
            found = [unpacked(p, int(counts[k])) for p in _split(data.as_py())]
            keys[cuts[k] : cuts[k + 1]] = np.cumsum(found[0], dtype=np.uint64)
            columns = columns or [np.zeros(cuts[-1], f.dtype) for f in found[1:]]
            for c, f in zip(columns, found[1:], strict=True):
                c[cuts[k] : cuts[k + 1]] = f
        replies, totals = reply(keys, np.repeat(np.arange(len(counts)), counts), columns)
        span = int(rows["span"][0].as_py())
        payload = [_joined([packed(r[cuts[k] : cuts[k + 1]]) for r in replies]) for k in range(len(counts))]
        blocks = rows["block"].to_numpy()
        empty = np.zeros((len(counts), sums), np.int64)
        every = np.concatenate([empty, np.array([totals], np.int64).reshape(1, sums)])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append(blocks, -1)), pa.array(np.full(len(counts) + 1, span, np.int32)), pa.array(np.append(counts, 0)), binary_array([*payload, b""]),
            *[pa.array(every[:, k]) for k in range(sums)],
        ], [f.split()[0] for f in schema.split(", ")])
        _hand_back()

    return asked.groupBy("span").applyInArrow(answer, schema)


def told(rows: pa.Table, tag: int, columns: int = 1) -> list[np.ndarray]:
    """The reply columns to one block, in the order of its keys; empty ones to a block that asked nothing."""
    own = rows.filter(pc.equal(rows["tag"], tag)).sort_by("span")
    parts = [[unpacked(p, n.as_py()) for p in _split(data.as_py())] for n, data in zip(own["n"], own["payload"], strict=True)]
    return [np.concatenate(c) for c in zip(*parts, strict=True)] or [np.zeros(0, np.uint64)] * columns


def tagged(replies: list[DataFrame]) -> DataFrame:
    out = None
    for tag, r in enumerate(replies):
        own = r.where("block >= 0").select("block", "span", "n", "payload", F.lit(tag).alias("tag"))
        out = own if out is None else out.unionByName(own)
    return out


def totals(replies: DataFrame, sums: int) -> list[int]:
    row = replies.where("block < 0").agg(*[F.sum(f"s{k}") for k in range(sums)]).first()
    return [int(x or 0) for x in row]


def _hand_back() -> None:
    """Give freed memory back to the system: the next block may be in another worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def per_block(blocks: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function(block, rows)`` on every block; it yields record batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        if rows.num_rows:
            yield from function(int(rows["block"][0].as_py()), rows)
        _hand_back()

    return blocks.groupBy("block").applyInArrow(run, schema)


def with_answers(blocks: DataFrame, replies: list[DataFrame], function: Callable, schema: str) -> DataFrame:
    """``function(block, rows, replies)`` on every block beside what it was told."""

    def run(rows: pa.Table, got: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return pa.Table.from_batches([], schema=_arrow(schema, rows))
        out = list(function(int(rows["block"][0].as_py()), rows, got))
        _hand_back()
        return pa.Table.from_batches(out) if out else pa.Table.from_batches([], schema=_arrow(schema, rows))

    return blocks.groupBy("block").cogroup(tagged(replies).groupBy("block")).applyInArrow(run, schema)


def _arrow(schema: str, rows: pa.Table) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(f.split()[0], kinds.get(f.split()[1], pa.int64())) for f in schema.split(", ")])


def text_parts(rows: pa.Table, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in rows.combine_chunks().to_batches():
        yield from text_slices(batch, column, most)


__all__ = ["answers", "blocked", "packed", "per_block", "question", "text_parts", "told", "totals", "unpacked", "with_answers", "written", "ASKED"]
