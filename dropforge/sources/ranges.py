"""Records of delimited files with quoted newlines, read by all cores: byte ranges whose state at the start is worked out.

A newline inside quotes does not end a record, so where a record ends depends on everything before it in the file. Between
lines there are only two states: outside quotes, where a line begins a record, and inside. Each range of a file (a scan
split) maps the state it starts in to the one it ends in; composing those maps from range to range, a window over one row
per range, gives every range its state. Then each range finds its own records, and what reaches over a boundary is put
together from the few fragments at the ends of ranges.

The file is scanned twice, the first time only for lines with a quote, and a third time for the fragments if a range starts
inside quotes. Nothing of the lines is shuffled but the fragments. The driver gets the states, a few bytes for every scan split that
starts or ends inside quotes or holds a quote; it holds more than that of every split it makes a task of.

What a quote means is what the CSV reader makes of it: it opens a field only as its first character; inside, a doubled one
stands for itself, and any other closes it, after which the rest of the field is unquoted. A record that is still open
when its file ends is the last one, without the file's last line end (the CSV reader keeps that one).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUTSIDE, INSIDE = 0, 1
WHOLE, HEAD, THROUGH, TAIL = range(4)


def state_after(line: str, state: int, sep: str, quote: str = '"') -> int:
    """The state at the end of a line that starts outside or inside quotes."""
    at = 0
    while True:
        if state == INSIDE:
            at = line.find(quote, at)
            if at < 0:
                return INSIDE
            if line.startswith(quote, at + 1):
                at += 2
                continue
            # Closed; what is left of the field is unquoted.
            at = line.find(sep, at + 1)
            if at < 0:
                return OUTSIDE
            at, state = at + len(sep), OUTSIDE
        if not line.startswith(quote, at):
            at = line.find(sep + quote, at)
            if at < 0:
                return OUTSIDE
            at += len(sep)
        at, state = at + len(quote), INSIDE


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, line``: the lines of each scan split in order. ``file`` is a digest of its path.

    Lines end at newlines; a carriage return before one stays with its line.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch, bool]]:
    """Key, rows of one range, and whether the range begins with them. The rows of a range stand together."""
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, start = (batch.column(k).to_numpy() for k in (0, 1))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, n], strict=True):
            key = (int(file[a]), int(start[a]))
            yield key, batch.slice(a, b - a), key != last
            last = key


def range_states(lines: DataFrame, sep: str, quote: str = '"') -> DataFrame:
    """``file, start, state, following``: the state each range with a quote starts in, and the one after it.

    Ranges without a quote are not in it; they go on with the state they find.
    """

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends, found = None, (OUTSIDE, INSIDE), []
        for at, part, begins in _by_range(batches):
            if begins:
                if key:
                    found.append((*key, *ends))
                key, ends = at, (OUTSIDE, INSIDE)
            for line in part.column(2).to_pylist():
                step = (state_after(line, OUTSIDE, sep, quote), state_after(line, INSIDE, sep, quote))
                ends = (step[ends[0]], step[ends[1]])
        if key:
            found.append((*key, *ends))
        columns = [pa.array([f[k] for f in found], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["file", "start", "outside", "inside"])

    quoted = lines.where(F.col("line").contains(quote))
    found = quoted.mapInArrow(maps, "file long, start long, outside int, inside int")
    # A map keeps the state, swaps it, or sets it: the state before a range is the last one that was set, swapped as
    # often as there were swaps since.
    sets = F.col("outside") == F.col("inside")
    swaps = F.sum((F.col("outside") > F.col("inside")).cast("int"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = found.withColumns({
        "earlier": F.coalesce(swaps.over(before), F.lit(0)),
        "mark": F.when(sets, F.struct(F.col("outside").alias("state"), swaps.over(upto).alias("swaps"))),
    })
    last = F.last("mark", ignorenulls=True).over(before)
    told = counted.withColumn("last", last)
    state = (F.coalesce("last.state", F.lit(OUTSIDE)) + F.col("earlier") - F.coalesce("last.swaps", F.lit(0))) % 2
    known = told.select("file", "start", state.cast("int").alias("state"), "outside", "inside")
    return known.select("file", "start", "state", F.when(F.col("state") == INSIDE, F.col("inside")).otherwise(F.col("outside")).alias("following"))


@dataclass(frozen=True)
class States:
    """The states of the ranges that hold a quote, in order of file and start."""

    file: np.ndarray
    start: np.ndarray
    state: np.ndarray
    following: np.ndarray

    @staticmethod
    def of(found: DataFrame) -> States:
        rows = sorted((r.file, r.start, r.state, r.following) for r in found.collect())  # one small row per scan split
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return States(*[np.array(c, np.int64) for c in columns])

    def around(self, file: int, start: int) -> tuple[int, int]:
        """The states before and after a range: one without a quote keeps what the last one before it ended in."""
        a, b = np.searchsorted(self.file, file), np.searchsorted(self.file, file, "right")
        k = a + int(np.searchsorted(self.start[a:b], start))
        if k < b and self.start[k] == start:
            return int(self.state[k]), int(self.following[k])
        return (int(self.following[k - 1]),) * 2 if k > a else (OUTSIDE, OUTSIDE)

    @property
    def fragments(self) -> bool:
        return bool((self.state == INSIDE).any() or (self.following == INSIDE).any())


FOUND = "file long, start long, kind int, first boolean, record string"


def _finder(states: States, sep: str, quote: str, fragments: bool = False):
    """Rows ``FOUND`` of the lines of ranges: whole records, or the fragments at the ends of ranges.

    Lines up to the first that begins a record are a ``HEAD``, or ``THROUGH`` where none begins; the last record is a
    ``TAIL`` if it is open at the end; the others are ``WHOLE``.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, pending, headless, header, skipped = None, OUTSIDE, [], False, False, False

        def rows(kind, records):
            """Blank records go; the first other one of a file is its header."""
            nonlocal header
            if kind == WHOLE:
                records = records.filter(pc.invert(pc.is_in(records, value_set=pa.array(["", "\r"]))))
            first = np.zeros(len(records), bool)
            if header and len(records):
                first[0], header = True, False
            if fragments == (kind == WHOLE):
                records, first = records.slice(0, 0), first[:0]
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])), pa.array(np.full(n, kind, np.int32)), pa.array(first), records],
                [field.split()[0] for field in FOUND.split(", ")],
            )

        def close():
            """What is pending at the end of a range."""
            if pending:
                kind = (THROUGH if state == INSIDE else HEAD) if headless else (TAIL if state == INSIDE else WHOLE)
                yield rows(kind, pa.array(["\n".join(pending)], pa.string()))

        for at, part, begins in _by_range(batches):
            if begins:
                yield from close()
                key, pending, (state, following) = at, [], states.around(*at)
                headless, header = state == INSIDE, at[1] == 0
                skipped = fragments and INSIDE not in (state, following)
            if skipped:
                continue
            lines = part.column(2)
            n = len(lines)
            opens = np.ones(n, bool)  # whether each line begins a record
            quoted = np.flatnonzero(pc.match_substring(lines, quote).to_numpy(zero_copy_only=False))
            reached = 0
            for k, line in zip(quoted, lines.take(pa.array(quoted)).to_pylist(), strict=True):
                opens[reached : k + 1] = state == OUTSIDE
                state = state_after(line, state, sep, quote)
                reached = k + 1
            opens[reached:] = state == OUTSIDE
            first = np.flatnonzero(opens)
            if not len(first):
                pending += lines.to_pylist()
                continue
            pending += lines.slice(0, int(first[0])).to_pylist()
            if pending:
                yield rows(HEAD if headless else WHOLE, pa.array(["\n".join(pending)], pa.string()))
            headless = False
            sizes = np.diff(first)
            long = np.flatnonzero(sizes > 1)
            if header or not len(long):
                # Header rows are told by their place, so here the order stays.
                every = lines.to_pylist() if len(long) else None
                joined = every and ["\n".join(every[a : a + size]) for a, size in zip(first[:-1], sizes, strict=True)]
                yield rows(WHOLE, pa.array(joined, pa.string()) if joined else lines.slice(int(first[0]), len(sizes)).cast(pa.string()))
            else:
                yield rows(WHOLE, lines.take(pa.array(first[:-1][sizes == 1])).cast(pa.string()))
                parts = [lines.slice(int(first[k]), int(sizes[k])).to_pylist() for k in long]
                yield rows(WHOLE, pa.array(["\n".join(p) for p in parts], pa.string()))
            pending = lines.slice(int(first[-1])).to_pylist()  # the last record may go on
        yield from close()

    return find


def _joined(fragments: DataFrame) -> DataFrame:
    """Records from their fragments: a tail, what goes through, and the head of the range where the record ends."""
    order = Window.partitionBy("file").orderBy("start", "kind")
    numbered = fragments.withColumn("number", F.sum((F.col("kind") == TAIL).cast("long")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "record")))
    joined = numbered.groupBy("file", "number").agg(F.bool_or("first").alias("first"), parts.alias("parts"))
    return joined.select("first", F.array_join("parts.record", "\n").alias("record"))


def records(spark: SparkSession, path: str, sep: str, quote: str = '"') -> DataFrame:
    """``first, record``: every record of a file or folder, line ends inside quotes and all; ``first`` marks those of headers.

    Blank lines outside quotes are no records. A carriage return before the newline that ends a record stays with it.
    """
    lines = read_lines(spark, path)
    states = States.of(range_states(lines, sep, quote))
    whole = lines.mapInArrow(_finder(states, sep, quote), FOUND).select("first", "record")
    if not states.fragments:
        return whole
    return whole.unionByName(_joined(lines.mapInArrow(_finder(states, sep, quote, fragments=True), FOUND)))
