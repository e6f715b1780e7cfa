"""Exact substring removal by longest previous factors in suffix order (operator 10).

A byte goes when a string of ``length`` bytes that covers it also starts in
a document with a smaller id.  The corpus is never sorted whole:

1. Every string of ``length`` bytes is represented by its anchor, the
   smallest (by hash) of its ``gram``-byte substrings; equal strings have
   equal anchors at equal places.  A task gathers the anchors of a bounded
   amount of text (a flush) and sends each distinct one once.
2. Anchors that only one document has are dropped.  The others go back to
   the flushes, and from there to their documents.
3. Documents send the regions around shared anchors, again each distinct
   one once in a flush; equal regions inside a flush are settled there.
4. Regions with one anchor meet.  Equal ones count once, with their smallest
   id.  The others are put in suffix order from the anchor on; going left byte
   by byte, that order is refined, so that at each step the strings that start
   there are in suffix order among those with the same bytes left of the
   anchor.  Common-prefix lengths of neighbours and the previous or next
   smaller document id tell how far each string's longest previous factor
   reaches; where it reaches ``length``, the string is a later copy.
5. The ranges of later copies go back to the documents and are cut out.

An anchor of very many documents would bring all their regions together.
Of such an anchor the strings travel one by one and are grouped by their own
128-bit hash, with no suffix order: those that many documents share are few in
each flush, and the others spread over all tasks.

Results: a null text is empty; a null id is neither smaller nor larger than
any, so such rows are kept whole and remove nothing; rows with the same id
are one document, so they don't remove each other's text, and repeated rows
get equal results; shorter texts than ``length`` are kept; further columns
are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimspark.llm.arrowtext import ragged, ragged_take, resting, text_slices, utf8_bytes, with_columns
from claimspark.llm.store import unused, written

FLUSH_BYTES = 12 << 20
#: Anchors of more documents or flush entries than this travel as single strings; the regions of any other anchor
#: take less than half a megabyte of a task.
CROWD = 4096
#: Regions put in suffix order at a time (whole anchors).
TOGETHER = 1 << 16
BUCKET_BYTES = 16 << 20

_U64 = np.uint64
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def rolling_hash(data: np.ndarray, size: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Hash of every ``size`` bytes (along the last axis), by doubling: two halves make the whole."""
    n = data.shape[-1]
    if n < size:
        return np.zeros((*data.shape[:-1], 0), np.uint64)
    power, have, h = base, 1, data.astype(np.uint64) + np.uint64(1)
    out, covered = None, 0
    while True:
        if size & have:
            left = n - covered - have + 1
            out = h[..., :left] if out is None else out[..., :left] * power + h[..., covered:covered + left]
            covered += have
        if covered == size:
            return _mixed(out)
        h = h[..., :-have] * power + h[..., have:]
        have, power = 2 * have, _U64(int(power) ** 2 % (1 << 64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x, have = np.minimum(x[:-have], x[have:]), 2 * have
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


@dataclass(frozen=True)
class Anchors:
    """``at``: byte of each anchor; the strings it stands for start at ``first`` to ``last``; ``doc``: its text."""

    at: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    last: np.ndarray
    doc: np.ndarray

    def only(self, keep: np.ndarray) -> Anchors:
        return Anchors(self.at[keep], self.hash[keep], self.first[keep], self.last[keep], self.doc[keep])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Anchors:
    """Anchors of every string of ``length`` bytes inside the texts ``data[offsets[i]:offsets[i + 1]]``."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return Anchors(none, none.astype(np.uint64), none, none, none)
    h = rolling_hash(data, gram)
    # Hash above, place below: the least of a window is its anchor, the first one where hashes are equal.
    keyed = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    at = (sliding_min(keyed, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(_inside(offsets, len(data), length)[:len(at)])
    at = at[starts]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))) \
        if len(at) else none
    last = np.concatenate((new[1:], [len(at)])).astype(np.int64) - 1 if len(new) else none
    at, first, last = at[new], starts[new], starts[last]
    return Anchors(at, h[at], first, last, np.searchsorted(offsets, first, side="right") - 1)


def _inside(offsets: np.ndarray, size: int, length: int) -> np.ndarray:
    """Whether a string of ``length`` bytes from each byte stays in its text."""
    change = np.zeros(size + 1, dtype=np.int64)
    long = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(change, offsets[long], 1)
    np.add.at(change, offsets[long + 1] - length + 1, -1)
    return np.cumsum(change[:size]) > 0


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each two rows of bytes."""
    equal = a == b
    return np.where(equal.all(axis=1), a.shape[1], equal.argmin(axis=1)) if len(a) else np.zeros(0, np.int64)


def later_starts(body: np.ndarray, place: np.ndarray, size: np.ndarray, anchor: np.ndarray, ids: np.ndarray,
                 length: int, most_left: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start in each region of a string whose longest previous factor is ``length`` (-1: there is none).

    ``body`` holds ``size`` bytes of a region in each row; ``place`` (at most
    ``most_left``) says where its anchor is, ``anchor`` which one.  The suffixes from the
    anchors on are sorted, with the common-prefix lengths of neighbours.  A
    step to the left is a stable sort by one more byte: it splits classes of
    equal left contexts and keeps the order inside them, so a class is
    always in suffix order.  A class of one region has no more factors.
    """
    least_start, last_start = np.full(len(body), -1), np.full(len(body), -1)
    right = body[np.arange(len(body))[:, None], place[:, None] + np.arange(length)]
    words = np.zeros((len(body), -(-length // 8) * 8), np.uint8)
    words[:, :length] = right
    order = np.lexsort((*words.view(">u8").astype(np.uint64).T[::-1], anchor))
    new = np.concatenate(([True], anchor[order][1:] != anchor[order][:-1]))
    prefix = np.concatenate(([0], common(right[order[:-1]], right[order[1:]])))
    for left in range(most_left + 1):
        # Neighbours that share the ``left`` bytes and ``length - left`` more have a factor of ``length`` in common.
        there = size[order] - place[order] >= length - left
        begins = new | (prefix < length - left)
        own = np.where(there, ids[order], np.iinfo(np.int64).max)
        # A string with a previous or next smaller id inside its run has an id above the least of the run.
        least = np.minimum.reduceat(own, np.flatnonzero(begins))[np.cumsum(begins) - 1]
        later = order[there & (own > least)]
        least_start[later] = place[later] - left
        last_start[later] = np.maximum(last_start[later], place[later] - left)

        spot = np.flatnonzero(place[order] > left)
        byte = body[order[spot], place[order[spot]] - left - 1]
        key = (np.cumsum(new)[spot] << 8) + byte
        sort = np.argsort(key, kind="stable")
        spot, key = spot[sort], key[sort]
        new = np.concatenate(([True], key[1:] != key[:-1]))[:len(key)]
        several = ~(new & np.concatenate((new[1:], [True]))[:len(key)])
        spot, new = spot[several], new[several]
        if not len(spot):
            break
        order, prefix = order[spot], prefix[spot]
        apart = np.flatnonzero(~new & (np.diff(spot, prepend=-2) != 1))
        prefix[apart] = common(right[order[apart - 1]], right[order[apart]])
    return least_start, last_start


def above_least(order: np.ndarray, same: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether a row's id is above the least of the rows equal to it; ``same``: as the one before it in ``order``."""
    out = np.zeros(len(order), dtype=bool)
    if not len(order):
        return out
    least = np.minimum.reduceat(ids[order], np.flatnonzero(~same))
    out[order] = ids[order] > least[np.cumsum(~same) - 1]
    return out


def equal_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows (of whole 64-bit words) are neighbours, and whether each equals the one before."""
    words = np.ascontiguousarray(rows).view("<u8")
    name = np.zeros(len(rows), np.uint64)
    for column in words.T:
        name = (name ^ column) * _BASE
        name ^= name >> np.uint64(32)
    order = np.argsort(name)
    same = np.concatenate(([False], name[order[1:]] == name[order[:-1]]))[:len(rows)]
    near = np.flatnonzero(same)
    same[near] = (words[order[near]] == words[order[near - 1]]).all(axis=1)
    return order, same


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges joined where they overlap or touch, in order of document and place."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    top = int(end.max()) + 1
    reach = np.maximum.accumulate(doc * top + end) - doc * top
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])))
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.concatenate((first[1:], [len(doc)])) - 1]


# One row carries arrays of one flush for one bucket.
_PARTS = "kind int, bucket int, flush string, a binary, b binary, c binary, d binary, e binary"
_KEYS, _LOCAL, _TABLE, _STRINGS, _RANGES = range(5)


def _small(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _whole(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _steps(x: np.ndarray) -> bytes:
    """Whole numbers below 2^32 in ascending order, as their differences."""
    return _small(np.diff(x, prepend=0).astype("<u4"))


def _summed(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.cumsum(np.frombuffer(_whole(p), "<u4").astype(np.int64))
                                                    for p in parts)])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["kind", "bucket", "flush", "a", "b", "c", "d", "e"]
    kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 5]
    columns = list(zip(*[(*r, *[None] * (8 - len(r))) for r in rows], strict=True)) or [[]] * 8
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _table(flush: str, bucket: int, ids: np.ndarray, marks: np.ndarray) -> tuple:
    return _TABLE, bucket, flush, _small(ids.astype("<i8")), _small(marks.astype("<i8"))


#: Texts worked on at a time; a flush gathers what many of them give.
SLICE = 1 << 20


@dataclass
class _Part:
    """Distinct rows of a slice: their numbers in the flush, and their bytes."""

    number: np.ndarray
    data: np.ndarray
    offsets: np.ndarray
    shared: list


class _Flush:
    """Texts taken in until ``FLUSH_BYTES``; exact repeats of a row are left out."""

    def __init__(self, name: str):
        self.name, self.size = name, 0
        self.ids: list[int] = []
        self.marks: list[int] = []
        self.seen: set[tuple[int, int]] = set()

    def take(self, part: pa.RecordBatch) -> _Part:
        rows, start = [], len(self.ids)
        for i, row in enumerate(zip(part.column("doc_id").to_pylist(), part.column("mark").to_pylist(), strict=True)):
            if row not in self.seen:
                self.seen.add(row)
                self.ids.append(row[0])
                self.marks.append(row[1])
                rows.append(i)
        kept = part.take(pa.array(rows, pa.int64()))
        self.size += part.column("text").nbytes
        data, offsets = utf8_bytes(kept.column("text"))
        shared = kept.column("shared").to_pylist() if "shared" in part.schema.names else []
        return _Part(np.arange(start, len(self.ids)), data, offsets, shared)

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.ids, dtype=np.int64), np.array(self.marks, dtype=np.int64)


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Flush, Iterator[_Part]]]:
    """Flushes, each with its parts; a flush's parts must be used up before the next flush."""
    parts = (part for batch in batches for part in text_slices(batch, "text", SLICE))
    number = 0
    for first in parts:
        # The same name for every attempt of a task, so that answers to a lost attempt still fit.
        flush = _Flush(f"{TaskContext.get().partitionId()}-{number}")
        number += 1

        def inside(flush: _Flush = flush, first: pa.RecordBatch = first) -> Iterator[_Part]:
            yield flush.take(first)
            while flush.size < FLUSH_BYTES:
                part = next(parts, None)
                if part is None:
                    return
                yield flush.take(part)

        yield flush, inside()


def _send(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rows by bucket of their key."""
    bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    begin = np.flatnonzero(np.concatenate(([True], bucket[order][1:] != bucket[order][:-1]))) if len(order) else []
    for group in np.split(order, begin[1:]) if len(order) else []:
        yield int(bucket[group[0]]), group


def _joined(parts: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join([_whole(p) for p in parts]), dtype=kind)


def _by_kind(table: pa.Table, kind: int) -> pa.Table:
    return table.filter(pc.equal(table["kind"], kind))


def _lists(table: pa.Table, *names: str) -> list[list]:
    return [table[n].to_pylist() for n in names]


@dataclass(frozen=True)
class _Regions:
    """Regions as rows of bytes (hash, place of the anchor, size, text, filled up with zeros to whole words), with their
    document and place."""

    rows: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @classmethod
    def none(cls, width: int) -> _Regions:
        return cls(np.zeros((0, width), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))

    @classmethod
    def all(cls, several: list[_Regions]) -> _Regions:
        return cls(*(np.concatenate([getattr(r, n) for r in several]) for n in ("rows", "doc", "first")))


@dataclass(frozen=True)
class Remover:
    length: int
    gram: int
    buckets: int
    crowd: int = CROWD

    # Step 1: anchors of the texts.
    def send_anchors(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for taken, parts in _flushes(batches):
            hashes, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for part in parts:
                found = anchors(part.data, part.offsets, self.length, self.gram)
                hashes.append(found.hash)
                docs.append(part.number[found.doc])
            flush, (ids, marks) = taken.name, taken.table
            h, doc = np.concatenate(hashes), np.concatenate(docs)
            order = np.lexsort((doc, h))
            h, doc = h[order], doc[order]
            fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, bool)
            h, doc = h[fresh], doc[fresh]
            begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
            count = np.diff(np.concatenate((begin, [len(h)])))
            several = np.repeat(count > 1, count)
            rows = [_table(flush, zlib.crc32(flush.encode()) % self.buckets, ids, marks)]
            if several.any():
                rows.append((_LOCAL, zlib.crc32(flush.encode()) % self.buckets, flush, _small(h[several]),
                             _small(doc[several].astype("<u4"))))
            key, one, n = h[begin], doc[begin], np.minimum(count, 255)
            for bucket, at in _send(key, self.buckets):
                at = at[np.argsort(one[at], kind="stable")]
                low = key[at] & np.uint64((1 << 40) - 1)
                rows.append((_KEYS, bucket, flush, _small((low & np.uint64(0xFFFFFFFF)).astype("<u4")),
                             _small((low >> np.uint64(32)).astype("u1")), _steps(one[at]),
                             _small(n[at].astype("u1"))))
            yield _rows(rows)

    # Step 2: which of them several documents have.
    def shared_anchors(self, table: pa.Table) -> pa.Table:
        out = [r for k in (_TABLE, _LOCAL) for r in zip(*_lists(_by_kind(table, k), "kind", "bucket", "flush", "a", "b"),
                                                         strict=True)]
        flushes, low, high, doc, n = _lists(_by_kind(table, _KEYS), "flush", "a", "b", "c", "d")
        n = [np.frombuffer(_whole(x), "u1") for x in n]
        size = np.array([len(x) for x in n], dtype=np.int64)
        key = _joined(low, "<u4").astype(np.uint64) | _joined(high, "u1").astype(np.uint64) << np.uint64(32)
        doc, n = _summed(doc), np.concatenate([np.zeros(0, np.int64), *n]).astype(np.int64)
        order = np.argsort(key, kind="stable")
        begin = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1]))) if len(key) else \
            np.zeros(0, np.int64)
        total = np.add.reduceat(n[order], begin) if len(key) else n
        entries = np.diff(np.concatenate((begin, [len(key)])))
        shared, crowd = np.zeros(len(key), bool), np.zeros(len(key), bool)
        shared[order] = np.repeat(total > 1, entries)
        crowd[order] = np.repeat((total > self.crowd) | (entries > self.crowd), entries)
        ends = np.cumsum(size)
        for i, flush in enumerate(flushes):
            at = np.arange(ends[i] - size[i], ends[i])
            at = at[shared[at]]
            if len(at):
                out.append((_KEYS, 0, flush, _small(key[at].astype("<u8")), _steps(doc[at]),
                            _small(crowd[at].astype("u1"))))
        return pa.Table.from_batches([_rows(out)])

    # Back at the flush: the shared anchors of each document (40 bits of their hash, and whether crowded).
    def anchors_of_documents(self, table: pa.Table) -> pa.Table:
        ids, marks = (_joined(x, "<i8") for x in _lists(_by_kind(table, _TABLE), "a", "b"))
        keys, docs, crowded = _lists(_by_kind(table, _KEYS), "a", "b", "c")
        key, doc, crowd = _joined(keys, "<u8"), _summed(docs), _joined(crowded, "u1")
        low = np.uint64((1 << 40) - 1)
        local_key, local_doc = (_joined(x, t) for x, t in zip(
            _lists(_by_kind(table, _LOCAL), "a", "b"), ("<u8", "<u4"), strict=True))
        # A key sent once for several documents of the flush counts for all of them.
        order = np.argsort(key, kind="stable")
        local = local_key & low
        place = np.minimum(np.searchsorted(key[order], local), max(0, len(key) - 1))
        known = (key[order][place] == local) if len(key) else np.zeros(len(local), bool)
        of_local = np.where(known, crowd[order][place], 0) if len(key) else np.zeros(len(local), np.uint8)
        all_key = np.concatenate((key, local))
        all_doc = np.concatenate((doc, local_doc.astype(np.int64)))
        all_crowd = np.concatenate((crowd, of_local)).astype(np.uint64)
        value = np.unique(np.column_stack((all_doc.astype(np.uint64), all_key | all_crowd << np.uint64(40))), axis=0)
        owner = value[:, 0].astype(np.int64)
        begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else []
        groups = np.split(np.arange(len(owner)), begin[1:]) if len(owner) else []
        return pa.table({
            "doc_id": pa.array([int(ids[owner[g[0]]]) for g in groups], pa.int64()),
            "mark": pa.array([int(marks[owner[g[0]]]) for g in groups], pa.int64()),
            "shared": pa.array([value[g, 1].astype("<u8").tobytes() for g in groups], pa.binary()),
        })

    # Step 3: the regions around shared anchors.
    def send_regions(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for taken, parts in _flushes(batches):
            regions = [_Regions.none(self.row)]
            strings = [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for part in parts:
                found, crowd = self._known(part, anchors(part.data, part.offsets, self.length, self.gram))
                regions.append(self._regions(part, found.only(~crowd)))
                strings.append(self._strings(part, found.only(crowd)))
            flush, (ids, marks) = taken.name, taken.table
            rows = [_table(flush, zlib.crc32(flush.encode()) % self.buckets, ids, marks)]
            ranges = [*self._send_regions(rows, flush, ids, _Regions.all(regions)),
                      *self._send_strings(rows, flush, ids, *map(np.concatenate, zip(*strings, strict=True)))]
            if ranges:
                rows.append((_RANGES, zlib.crc32(flush.encode()) % self.buckets, flush,
                             _small(np.concatenate(ranges).astype("<i8"))))
            yield _rows(rows)

    @property
    def width(self) -> int:
        """Longest region: an anchor with all strings it can stand for."""
        return 2 * self.length - self.gram

    @property
    def row(self) -> int:
        return -(-(self.width + 10) // 8) * 8

    @staticmethod
    def _known(part: _Part, found: Anchors) -> tuple[Anchors, np.ndarray]:
        """The shared anchors among those found, and which of them are crowded."""
        known = [np.frombuffer(x, "<u8") for x in part.shared]
        owner = np.repeat(np.arange(len(known)), [len(x) for x in known])
        value = np.concatenate([np.zeros(0, np.uint64), *known])
        low = np.uint64((1 << 40) - 1)
        # (document, key) pairs are looked up in one sorted list of mixed pairs.
        pair = _mixed((value & low) + owner.astype(np.uint64) * _OTHER)
        sort = np.argsort(pair)
        mine = _mixed((found.hash & low) + found.doc.astype(np.uint64) * _OTHER)
        if not len(pair):
            return found.only(np.zeros(len(mine), bool)), np.zeros(0, bool)
        place = np.minimum(np.searchsorted(pair[sort], mine), len(pair) - 1)
        hit = pair[sort][place] == mine
        return found.only(hit), (value[sort][place] >> np.uint64(40) > 0)[hit]

    def _regions(self, part: _Part, found: Anchors) -> _Regions:
        size = found.last + self.length - found.first
        # A region as a row of its own bytes, filled up with zeros, led by where its anchor is.
        padded = np.concatenate((part.data, np.zeros(self.width, np.uint8)))
        region = padded[found.first[:, None] + np.arange(self.width)]
        region[np.arange(self.width) >= size[:, None]] = 0
        lead = np.column_stack((found.hash.view(np.uint8).reshape(-1, 8), (found.at - found.first).astype(np.uint8),
                                size.astype(np.uint8)))
        rest = np.zeros((len(region), self.row - self.width - 10), np.uint8)
        return _Regions(np.concatenate((lead, region, rest), axis=1), part.number[found.doc],
                        found.first - part.offsets[found.doc])

    def _send_regions(self, rows: list, flush: str, ids: np.ndarray, found: _Regions) -> list[np.ndarray]:
        """Of equal regions the one of the smallest id is sent; the ranges of the others are known here."""
        if not len(found.doc):
            return []
        later = above_least(*equal_rows(found.rows), ids[found.doc])
        copies, sent = np.flatnonzero(later), np.flatnonzero(~later)
        hashes = np.ascontiguousarray(found.rows[sent, :8]).view("<u8").reshape(-1)
        for bucket, at in _send(hashes, self.buckets):
            at = np.sort(sent[at])
            rows.append((_KEYS, bucket, flush, _small(found.rows[at]), _small(ids[found.doc[at]].astype("<i8")),
                         _small(found.doc[at].astype("<u4")), _small(found.first[at].astype("<u4"))))
        return [np.column_stack((found.doc[copies], found.first[copies],
                                 found.first[copies] + found.rows[copies, 9]))]

    def _strings(self, part: _Part, found: Anchors) -> tuple[np.ndarray, ...]:
        group, place = ragged(found.last - found.first + 1)
        start, doc = found.first[group] + place, found.doc[group]
        if not len(start):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), start, doc
        one, two = (rolling_hash(part.data, self.length, base)[start] for base in (_BASE, _OTHER))
        return one, two, start - part.offsets[doc], part.number[doc]

    def _send_strings(self, rows: list, flush: str, ids: np.ndarray, one: np.ndarray, two: np.ndarray,
                      place: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
        if not len(one):
            return []
        order = np.lexsort((ids[doc], two, one))
        one, two, place, doc = one[order], two[order], place[order], doc[order]
        new = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
        least = ids[doc[new]][np.cumsum(new) - 1]
        later = ids[doc] > least
        keep = np.flatnonzero(~later)
        for bucket, at in _send(one[keep], self.buckets):
            at = keep[at]
            rows.append((_STRINGS, bucket, flush, _small(one[at]), _small(two[at]), _small(ids[doc[at]].astype("<i8")),
                         _small(doc[at].astype("<u4")), _small(place[at].astype("<u4"))))
        return [np.column_stack(merged(doc[later], place[later], place[later] + self.length))]

    # Step 4: suffix order of the regions with one anchor, and the longest previous factors of their strings.
    def later_copies(self, table: pa.Table) -> pa.Table:
        out = [r for k in (_TABLE, _RANGES) for r in zip(*_lists(
            _by_kind(table, k), "kind", "bucket", "flush", "a", "b"), strict=True)]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        names = table["flush"].unique().to_pylist()
        number = {f: i for i, f in enumerate(names)}

        flushes, whole, ids, doc, first = _lists(_by_kind(table, _KEYS), "flush", "a", "b", "c", "d")
        ids = [np.frombuffer(_whole(x), "<i8") for x in ids]
        size = [len(x) for x in ids]
        whole = _joined(whole, "u1").reshape(-1, self.row)
        flush = np.repeat([number[f] for f in flushes], size).astype(np.int64)
        ids = np.concatenate([np.zeros(0, np.int64), *ids])
        doc, first = _joined(doc, "<u4").astype(np.int64), _joined(first, "<u4").astype(np.int64)
        if len(ids):
            start, end = self._copies(whole, ids)
            some = np.flatnonzero(end)
            found.append((flush[some], doc[some], first[some, None] + np.column_stack((start, end))[some]))

        flushes, one, two, ids, doc, place = _lists(_by_kind(table, _STRINGS), "flush", "a", "b", "c", "d", "e")
        ids = [np.frombuffer(_whole(x), "<i8") for x in ids]
        size = [len(x) for x in ids]
        flush = np.repeat([number[f] for f in flushes], size).astype(np.int64)
        both = np.column_stack((_joined(one, "<u8"), _joined(two, "<u8"))).astype("<u8")
        ids = np.concatenate([np.zeros(0, np.int64), *ids])
        doc, place = _joined(doc, "<u4").astype(np.int64), _joined(place, "<u4").astype(np.int64)
        if len(ids):
            order = np.lexsort((both[:, 1], both[:, 0]))
            same = np.concatenate(([False], (both[order][1:] == both[order][:-1]).all(axis=1)))
            later = above_least(order, same, ids)
            found.append((flush[later], doc[later], np.column_stack((place[later], place[later] + self.length))))

        if found:
            flush, doc = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            span = np.concatenate([f[2] for f in found])
            owner, start, end = merged(flush << 32 | doc, span[:, 0], span[:, 1])
            ranges = np.column_stack((owner & 0xFFFFFFFF, start, end)).astype("<i8")
            begin = np.flatnonzero(np.diff(owner >> 32, prepend=-1))
            for at in np.split(np.arange(len(owner)), begin[1:]) if len(owner) else []:
                out.append((_RANGES, 0, names[owner[at[0]] >> 32], _small(ranges[at])))
        return pa.Table.from_batches([_rows(out)])

    def _copies(self, whole: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end in each region of what is to go (0 and 0: nothing).  All strings of a region overlap, so that
        is one stretch."""
        order, same = equal_rows(whole)
        begin = np.flatnonzero(~same)
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(~same) - 1
        least, one = np.minimum.reduceat(ids[order], begin), order[begin]
        start, end = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
        # Distinct regions by anchor; an anchor with one distinct region has no more to tell.
        anchor = np.ascontiguousarray(whole[one, :8]).view("<u8").reshape(-1)
        sort = np.argsort(anchor)
        new = np.concatenate(([True], anchor[sort][1:] != anchor[sort][:-1]))
        several = ~(new & np.concatenate((new[1:], [True])))
        sort, edge = sort[several], np.flatnonzero(new[several])
        edge = np.concatenate((edge, [len(sort)]))
        cuts = np.unique(edge[np.searchsorted(edge, np.arange(0, len(sort) + TOGETHER, TOGETHER)).clip(0, len(edge) - 1)])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            at = sort[a:b]
            rows = whole[one[at]]
            low, high = later_starts(rows[:, 10:], rows[:, 8].astype(np.int64), rows[:, 9].astype(np.int64), anchor[at],
                                     least[at], self.length, self.length - self.gram)
            start[at], end[at] = np.maximum(low, 0), np.where(high < 0, 0, high + self.length)
        # Of equal regions, the later ones go whole; those of the smallest id lose what their kind loses.
        later = ids > least[kind]
        return np.where(later, 0, start[kind]), np.where(later, whole[:, 9], end[kind])

    # Step 5: back at the flush, the ranges of each document.
    def ranges_of_documents(self, table: pa.Table) -> pa.Table:
        ids, marks = (_joined(x, "<i8") for x in _lists(_by_kind(table, _TABLE), "a", "b"))
        every = _joined(_by_kind(table, _RANGES)["a"].to_pylist(), "<i8").reshape(-1, 3).astype(np.int64)
        doc, start, end = merged(*every.T)
        begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else []
        groups = np.split(np.arange(len(doc)), begin[1:]) if len(doc) else []
        span = np.column_stack((start, end)).astype("<i8")
        return pa.table({
            "doc_id": pa.array([int(ids[doc[g[0]]]) for g in groups], pa.int64()),
            "mark": pa.array([int(marks[doc[g[0]]]) for g in groups], pa.int64()),
            "ranges": pa.array([span[g].tobytes() for g in groups], pa.binary()),
        })


def remove(docs: DataFrame, length: int = 50, gram: int = 24, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``docs`` with ``removed`` (array of byte ranges, end exclusive), ``kept`` (the remaining bytes) and
    ``kept_text`` (the characters that lost no byte)."""
    spark = docs.sparkSession
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    light = (docs.where(F.col(id_col).isNotNull() & (F.octet_length(text_col) >= length))
             .select(F.col(id_col).cast("long").alias("doc_id"), mark.alias("mark"), F.col(text_col).alias("text")))
    total = light.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = Remover(length, gram, max(at_least, -(-total // BUCKET_BYTES)))

    sent = light.mapInArrow(resting(work.send_anchors), _PARTS)
    # Partitions grow with the input, so that what one task reads does not.
    shared = (sent.repartition(work.buckets, "bucket").groupBy("bucket")
              .applyInArrow(lambda t: work.shared_anchors(t), _PARTS)
              .repartition(work.buckets, "flush").groupBy("flush")
              .applyInArrow(lambda t: work.anchors_of_documents(t), "doc_id long, mark long, shared binary")
              .groupBy("doc_id", "mark").agg(F.max("shared").alias("shared")))
    shared = written(shared, "shared-anchors")
    regions = light.join(shared, ["doc_id", "mark"]).sortWithinPartitions("doc_id", "mark")
    ranges = (regions.mapInArrow(resting(work.send_regions), _PARTS)
              .repartition(work.buckets, "bucket").groupBy("bucket")
              .applyInArrow(lambda t: work.later_copies(t), _PARTS)
              .repartition(work.buckets, "flush").groupBy("flush")
              .applyInArrow(lambda t: work.ranges_of_documents(t), "doc_id long, mark long, ranges binary")
              .groupBy("doc_id", "mark").agg(F.max("ranges").alias("ranges")))
    key, own_id, own_mark, spans = unused(docs, "key", "own_id", "own_mark", "ranges")
    ranges = written(ranges, "ranges").toDF(own_id, own_mark, spans)
    marked = docs.withColumn(key, mark)
    joined = marked.join(ranges, (marked[id_col].cast("long") == ranges[own_id]) & (marked[key] == ranges[own_mark]),
                         "left").drop(own_id, own_mark, key)
    return _cut_out(joined, text_col, spans)


def _picked(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """The bytes to keep of each text."""
    left = np.concatenate(([0], np.cumsum(keep)))[offsets]
    kept = data[keep].tobytes()
    return [kept[s:e] for s, e in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]


def _cut_out(df: DataFrame, text_col: str, ranges_col: str) -> DataFrame:
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [f for f in df.schema.fields if f.name not in (ranges_col, "removed", "kept", "kept_text")]
    schema = T.StructType([*fields, T.StructField("removed", T.ArrayType(span)), T.StructField("kept", T.BinaryType()),
                           T.StructField("kept_text", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_col):
                data, offsets = utf8_bytes(part.column(text_col))
                spans = [np.frombuffer(x or b"", "<i8").reshape(-1, 2) for x in part.column(ranges_col).to_pylist()]
                counts = np.array([len(x) for x in spans])
                every = np.concatenate([np.zeros((0, 2), np.int64), *spans])
                base = np.repeat(offsets[:-1], counts)
                gone = np.zeros(len(data), dtype=bool)
                size = every[:, 1] - every[:, 0]
                gone[ragged_take(np.arange(len(data)), every[:, 0] + base, size)] = True
                character = np.cumsum((data & 0xC0) != 0x80)
                whole = ~(np.bincount(character, weights=gone, minlength=1) > 0)[character]
                yield with_columns(
                    part, arrow,
                    removed=pa.array([[{"start": int(s), "end": int(e)} for s, e in x] for x in spans],
                                     arrow.field("removed").type),
                    kept=pa.array(_picked(data, offsets, ~gone), pa.binary()),
                    kept_text=pa.array([x.decode() for x in _picked(data, offsets, whole)], pa.string()))

    return df.mapInArrow(resting(run), schema)
