"""Suffix dedup by prefix-free parsing: bytes covered by a long string that starts in an earlier document go.

Every text is cut into phrases by a rolling hash. A trigger is the window of ``GRAM`` bytes whose rolling hash is the
smallest in some string of ``LENGTH`` bytes (the leftmost of equals). Plain modulus triggers would leave phrases of any
length; this rule puts a trigger into every string of ``LENGTH`` bytes, chosen by its bytes alone. The phrase of a trigger
holds all strings that chose it: from the first of their starts to the end of the last one, so phrases overlap by
``LENGTH - 1`` bytes, every string lies in one phrase, and equal strings lie in phrases of equal triggers.

Corpus order is needed to bring suffixes together that agree in their first ``LENGTH`` bytes, and that is read off the
sorted dictionary: distinct phrases are sorted by trigger and content over all blocks, in ranges, each with the smallest
document it occurs in. A phrase whose trigger stands in no other phrase is decided by that alone, for all its suffixes at
once, which is what makes repetitive text cheap. Only suffixes of phrases that share their trigger with other phrases
are sorted one by one to depth ``LENGTH``, and equal neighbours get the smallest document of all their phrases. The parse
(each document's run of phrases) then carries the answers back to the texts. The order within a range is that of 64-bit
keys, not of bytes: equal prefixes stand together, which is all that is asked.

What is removed from a document: each byte covered by a string of ``LENGTH`` bytes that also starts in a document of
smaller id; strings are judged on the input and never cross documents.

* A null text is the empty text. Texts of fewer than ``LENGTH`` bytes keep all bytes, whatever their copies.
* A null id comes after all others; documents of equal id do not remove from each other.
* Without documents the result is empty; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropforge.llm.keyed import ASKED, answers, blocked, per_block, question, text_parts, told, with_answers
from dropforge.llm.tables import LAST_ID, ordered_id, table, whole_text, written
from dropforge.llm.words import hash_spans, mixed, text_bytes

LENGTH = 50
GRAM = 24
TRIGGER_BITS, CONTENT_BITS = 56, 64  # a phrase is told by both; those of one hot trigger by the content alone
BLOCK_ROWS = 1250
_AGAIN = 0x5851F42D4C957F2D


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """The mixed rolling hash of every ``gram`` bytes, put together from those of 1, 2, 4, .. bytes."""
    part, base, width = raw.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    whole, done = None, 0
    while True:
        if gram & width:
            n = len(raw) - done - width + 1
            whole = part[:n] if whole is None else whole[:n] * np.uint64(base) + part[done : done + n]
            done += width
        if 2 * width > gram:
            return mixed(whole)
        part = part[: len(part) - width] * np.uint64(base) + part[width:]
        base, width = base * base % 2**64, 2 * width


def cut(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The phrases of texts standing end to end: first start, last start, trigger place, text number, trigger hash."""
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return none, none, none, none, np.zeros(0, np.uint64)
    grams = gram_hashes(raw)
    shift = np.uint64(max(1, int(len(raw)).bit_length()))
    best = (grams >> shift << shift) | np.arange(len(grams), dtype=np.uint64)
    width, steps = 1, LENGTH - GRAM + 1
    while 2 * width <= steps:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    rest = steps - width
    if rest:
        best = np.minimum(best[:-rest], best[rest:])
    trigger = (best & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    # A start is valid if its string ends within the text; runs of valid starts with one trigger are phrases.
    inside = np.zeros(len(trigger) + 1, np.int8)
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= LENGTH)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long + 1] - LENGTH + 1, -1)
    valid = np.cumsum(inside[:-1]) > 0
    change = np.ones(len(trigger), bool)
    change[1:] = (trigger[1:] != trigger[:-1]) | (valid[1:] != valid[:-1])
    change[offsets[long]] = True
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(trigger)) - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    at = trigger[first]
    return first, last, at, np.searchsorted(offsets, first, "right") - 1, grams[at]


def _signed(ids: np.ndarray) -> np.ndarray:
    """Ids as whole numbers from 0 on, small for small ids."""
    return ((ids << 1) ^ (ids >> 63)).view(np.uint64)


def _ids(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.uint64)
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


class Parse:
    """The phrases of a block: its parse, and its dictionary of distinct phrases with their smallest documents."""

    def __init__(self, rows: pa.Table):
        ids = rows["id"].to_numpy()
        self.parts, starts, done = [], [], 0
        columns = ([], [], [], [], [], [])
        for part in text_parts(rows):
            raw, offsets = text_bytes(part.column(part.schema.names.index("text")))
            first, last, at, text, gram = cut(raw, offsets)
            content = (hash_spans(raw, first, last + LENGTH) ^ mixed((at - first).astype(np.uint64))) >> np.uint64(64 - CONTENT_BITS)
            self.parts.append((raw, offsets, done, len(first)))
            # Triggers have small hashes, being the smallest of many: mixed once more they fill the key ranges evenly.
            key = mixed(gram ^ np.uint64(_AGAIN)) >> np.uint64(64 - TRIGGER_BITS)
            for c, v in zip(columns, (key, content, ids[done + text], first, last, np.full(len(first), len(self.parts) - 1)), strict=True):
                c.append(v)
            starts.append(len(first))
            done += part.num_rows
        self.gram, self.content, self.doc, self.first, self.last, self.part = (np.concatenate(c) for c in columns)
        order = np.lexsort((self.doc, self.content, self.gram))
        new = np.ones(len(order), bool)
        g, c = self.gram[order], self.content[order]
        new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.sample = order[new]  # of each distinct phrase the occurrence in its smallest document
        self.smallest = self.doc[self.sample]

    def suffixes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of all strings of the given distinct phrases in order, the phrase of each, and its place in it."""
        keys, owner, place = [], [], []
        chosen = self.sample[entries]
        for k, (raw, _, _, _) in enumerate(self.parts):
            own = np.flatnonzero(self.part[chosen] == k)
            n = self.last[chosen[own]] - self.first[chosen[own]] + 1
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = np.repeat(self.first[chosen[own]], n) + within
            keys.append(hash_spans(raw, start, start + LENGTH))
            owner.append(np.repeat(own, n))
            place.append(within)
        return tuple(np.concatenate(x) for x in (keys, owner, place))


def _reply_phrases(keys, owner, columns):
    """For every phrase: the smallest document it occurs in, if that is another block's, and whether its trigger stands
    in other phrases too."""
    content, docs = columns[0], _ids(columns[1])
    order = np.lexsort((docs, content, keys))
    k, c, d = keys[order], content[order], docs[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    least = d[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    trigger = np.ones(len(order), bool)
    trigger[1:] = k[1:] != k[:-1]
    group = np.cumsum(trigger) - 1
    several = (np.bincount(group[new]) > 1)[group] if len(order) else np.zeros(0, bool)
    out = np.zeros((2, len(order)), np.uint64)
    out[0, order] = np.where(least < d, _signed(least) + np.uint64(1), np.uint64(0))
    out[1, order] = several
    return [out[0], out[1]], [len(order)]


def _reply_suffixes(keys, owner, columns):
    docs = _ids(columns[0])
    order = np.lexsort((docs, keys))
    k, d = keys[order], docs[order]
    new = np.ones(len(order), bool)
    new[1:] = k[1:] != k[:-1]
    least = d[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    out = np.zeros(len(order), np.uint64)
    out[order] = np.where(least < d, _signed(least) + np.uint64(1), np.uint64(0))
    return [out], [len(order)]


def _earlier(reply: np.ndarray, own: np.ndarray) -> np.ndarray:
    return np.where(reply > 0, _ids(reply - np.uint64(1)), own)


def dedup_suffixes(docs: DataFrame, with_bytes: bool = True) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every document and, if asked for, the ``kept`` bytes."""
    slim = docs.select(ordered_id().alias("id"), whole_text().alias("text"))
    blocks, ranges = blocked(slim, "suffix", BLOCK_ROWS)

    def ask_phrases(block, rows):
        p = Parse(rows)
        yield question(block, p.gram[p.sample], [p.content[p.sample], _signed(p.smallest)], ranges, TRIGGER_BITS)

    phrases = written(answers(per_block(blocks, ask_phrases, ASKED), _reply_phrases), "suffix-phrases")

    def suffixes_of(p, got):
        least, several = told(got, 0, 2)
        smallest = _earlier(least, p.smallest)
        entries = np.flatnonzero(several)
        keys, owner, place = p.suffixes(entries)
        order = np.lexsort((smallest[entries[owner]], keys))
        new = np.ones(len(order), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(new) - 1
        return smallest, several, entries, owner, place, keys[order[new]], at, smallest[entries[owner[order[new]]]]

    def ask_suffixes(block, rows, got):
        *_, keys, _, own = suffixes_of(Parse(rows), got)
        yield question(block, keys, [_signed(own)], ranges, 64)

    # The replies are read next to the texts only: no need to write them.
    suffixes = answers(with_answers(blocks, [phrases], ask_suffixes, ASKED), _reply_suffixes)

    def remove(block, rows, got):
        p = Parse(rows)
        smallest, several, entries, owner, place, keys, at, own = suffixes_of(p, got)
        reply = told(got, 1)[0]
        of_suffix = _earlier(reply, own)[at]  # the smallest document of each suffix of each shared phrase
        first_suffix = np.zeros(len(p.smallest) + 1, np.int64)
        lengths = np.zeros(len(p.smallest), np.int64)
        lengths[entries] = np.bincount(owner, minlength=len(entries))
        first_suffix[1:] = np.cumsum(lengths)
        sorted_suffixes = of_suffix[np.lexsort((place, owner))]
        gone_phrase = smallest[p.entry] < p.doc
        ids = rows["id"].to_numpy()
        out = ([], [], [], [], [])
        for k, (raw, offsets, done, _) in enumerate(p.parts):
            cover = np.zeros(len(raw) + 1, np.int32)
            mine = np.flatnonzero(p.part == k)
            whole = mine[gone_phrase[mine]]
            np.add.at(cover, p.first[whole], 1)
            np.add.at(cover, p.last[whole] + LENGTH, -1)
            shared = mine[~gone_phrase[mine] & (several[p.entry[mine]] > 0)]
            n = lengths[p.entry[shared]]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hit = sorted_suffixes[np.repeat(first_suffix[p.entry[shared]], n) + within] < np.repeat(p.doc[shared], n)
            start = (np.repeat(p.first[shared], n) + within)[hit]
            np.add.at(cover, start, 1)
            np.add.at(cover, start + LENGTH, -1)
            gone = np.cumsum(cover[:-1]) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = offsets[:-1][(offsets[:-1] < len(raw)) & (np.diff(offsets) > 0)]
            opens[inner] = gone[inner]
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (gone, opens)]
            for i in range(len(offsets) - 1):
                a, b = offsets[i], offsets[i + 1]
                kept = raw[a:b][~gone[a:b]].tobytes() if sums[0][b] > sums[0][a] else raw[a:b].tobytes()
                values = (int(b - a), int(sums[0][b] - sums[0][a]), int(sums[1][b] - sums[1][a]), hashlib.sha256(kept).hexdigest(), kept)
                for o, v in zip(out, values, strict=True):
                    o.append(v)
                if not with_bytes:
                    out[4].pop()
        columns = [pa.array(ids), *[pa.array(o, pa.int64()) for o in out[:3]], pa.array(out[3], pa.string())]
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_bytes:
            columns, names = [*columns, pa.array(out[4], pa.binary())], [*names, "kept"]
        yield pa.RecordBatch.from_arrays(columns, names)

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return with_answers(blocks, [phrases, suffixes], remove, schema)


def op2_suffix_dedup(spark, sf_dir) -> DataFrame:
    found = dedup_suffixes(table(spark, sf_dir, "documents").select("doc_id", "text"), with_bytes=False)
    return found.select(F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
