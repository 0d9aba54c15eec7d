"""Hashed words of Arrow text columns, computed for a slice of rows at a time with whole-array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII letters and digits and every byte of other characters belong to a word.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * SLICE_BYTES)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` in order, in parts whose texts have at most ``most`` bytes; a longer text stands alone."""
    texts = batch.column(batch.schema.names.index(column))
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and where each starts, one more for the end; a null text has none."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, belongs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every run of bytes that belong to a word, and how many words precede each text."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = belongs[raw]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]  # texts stand end to end: a word never goes on into the next one
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    starts[cuts] = inside[1:-1][cuts]
    ends[cuts - 1] = inside[1:-1][cuts - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(first, offsets)


def hash_spans(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    up, down = _power_tables(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
        return mixed((sums[last] - sums[first]) * down[first])


def spans_array(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The byte spans and, between each two of them, what lies between: values over the same bytes, not copied."""
    if not len(first):
        return pa.array([], pa.binary())
    cuts = np.stack([first, last], 1).ravel().astype(np.int32 if len(raw) < 2**31 else np.int64)
    kind = pa.binary() if cuts.dtype == np.int32 else pa.large_binary()
    return pa.Array.from_buffers(kind, len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(raw))])


def exact_words(raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Numbers of the byte spans, equal for equal bytes: from a dictionary, not from hashes."""
    if not len(first):
        return np.zeros(0, np.int64)
    return spans_array(raw, first, last).dictionary_encode().indices.to_numpy()[::2].astype(np.int64)


def joined_words(raw: np.ndarray, first: np.ndarray, last: np.ndarray, before: np.ndarray, kept: np.ndarray) -> pa.Array:
    """Per text its kept words joined by one space."""
    own = np.flatnonzero(kept)
    sizes = last[own] - first[own] + 1
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    padded = np.append(raw, np.uint8(0x20))
    out = padded[np.repeat(first[own] - (ends - sizes), sizes) + np.arange(total)]
    out[ends - 1] = 0x20
    many = np.concatenate([[0], np.cumsum(kept)])[before]  # kept words before each text
    cuts = np.concatenate([[0], ends])[many]
    full = np.diff(cuts) > 0
    stays = np.ones(total, bool)
    stays[cuts[1:][full] - 1] = False  # no space behind the last word of a text
    sizes = np.diff(cuts) - full
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    kind, width = (pa.string(), np.int32) if offsets[-1] < 2**31 else (pa.large_string(), np.int64)
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(out[stays])])


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 0x41) & (raw <= 0x5A), raw + np.uint8(32), raw).astype(np.uint8)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (letters, digits, non-ASCII characters), and how many precede each text."""
    raw, offsets = text_bytes(pc.utf8_lower(texts))
    first, last, before = word_spans(raw, offsets, _WORD)
    return hash_spans(raw, first, last), before


def spaced_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of what stands between white space, A-Z lower-cased, and how many precede each text."""
    raw, offsets = text_bytes(texts)
    raw = ascii_lower(raw)
    first, last, before = word_spans(raw, offsets, ~WHITE_SPACE)
    return hash_spans(raw, first, last), before


def shingles(hashes: np.ndarray, before: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``length`` consecutive words; a text of fewer words has one of all its words, one without has none."""
    n = len(hashes)
    counts = np.diff(before)
    with np.errstate(over="ignore"):
        runs = np.zeros(n, np.uint64)
        for k in range(length):  # the words from each position, as far as they go
            shifted = np.zeros(n, np.uint64)
            shifted[: max(0, n - k)] = hashes[k:]
            runs = runs * np.uint64(_BASE) + shifted
        made = np.where(counts == 0, 0, np.maximum(counts - length + 1, 1))
        out_before = np.zeros(len(before), np.int64)
        np.cumsum(made, out=out_before[1:])
        at = np.repeat(before[:-1] - out_before[:-1], made) + np.arange(out_before[-1])
        out = runs[at] if len(at) else np.zeros(0, np.uint64)
        for i in np.flatnonzero((counts > 0) & (counts < length)):  # few texts are that short
            h = np.uint64(0)
            for w in hashes[before[i] : before[i + 1]]:
                h = h * np.uint64(_BASE) + w
            out[out_before[i]] = h + np.uint64(counts[i])
    return mixed(out), out_before


def binary_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
