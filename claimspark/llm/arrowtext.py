"""Helpers for Arrow batches of texts inside tasks.

Texts are handled in slices of bounded bytes, so one Arrow batch of long
documents never multiplies in memory.  Words are maximal runs of characters
other than space and U+0009 to U+000D.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One contiguous array with no offset into its buffers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pa.concat_arrays([column]) if column.offset else column


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``max_bytes`` of text (one row at least)."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + max_bytes, side="right")))
        yield batch.slice(start, end - start)
        start = end


def utf8_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of texts as UTF-8; a null counts as empty."""
    texts = as_array(pc.fill_null(texts, ""))
    if pa.types.is_large_string(texts.type):
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1)
    else:
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32, count=len(texts) + 1)
    offsets = offsets.astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(code of each word, offsets of each text into them, distinct words)."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, offsets = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    offsets = offsets - offsets[0]
    encoded = pc.dictionary_encode(flat)
    codes, words = np.asarray(encoded.indices), encoded.dictionary
    blank = np.flatnonzero(np.asarray(pc.equal(words, "")))
    if len(blank):  # white space at either end of a text splits off an empty string
        keep = codes != blank[0]
        kept = np.concatenate(([0], np.cumsum(keep)))
        codes, offsets = codes[keep], kept[offsets]
    return codes, offsets, words


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes: (group of each element, its place in the group)."""
    counts = np.asarray(counts, dtype=np.int64)
    group = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return group, np.arange(len(group)) - first[group]


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def with_columns(batch: pa.RecordBatch, schema: pa.Schema, **columns: pa.Array) -> pa.RecordBatch:
    """The batch's own columns and new ones, in the order of ``schema``."""
    arrays = [columns[f.name] if f.name in columns else batch.column(f.name) for f in schema]
    return pa.RecordBatch.from_arrays(
        [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


class Remembered:
    """What was worked out for strings before, in bounded memory: the newer half is kept when it is full."""

    def __init__(self, work: Callable[[list[str]], list], most: int):
        self.work, self.half = work, most // 2
        self.new: dict = {}
        self.old: dict = {}

    def __call__(self, names: list[str]) -> list:
        new, old = self.new, self.old
        out = [new.get(n) for n in names]
        missing = []
        for i, x in enumerate(out):
            if x is None:
                x = old.get(names[i])
                if x is None:
                    missing.append(i)
                else:
                    out[i] = new[names[i]] = x
        for i, x in zip(missing, self.work([names[i] for i in missing]) if missing else [], strict=True):
            out[i] = new[names[i]] = x
        if len(new) > self.half:
            self.old, self.new = new, {}
        return out


def rest() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it
        pass


def resting(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, giving freed memory back to the system before and after.

    Python workers live on from stage to stage; without this a stage starts
    beside what the last one's largest arrays left in the allocators.
    """
    def run_and_rest(batches: Iterator) -> Iterator:
        rest()
        try:
            yield from run(batches)
        finally:
            rest()
    return run_and_rest


def ragged_take(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The stretches ``values[start:start + count]``, one after another."""
    before = np.cumsum(counts) - counts
    return values[np.arange(int(np.sum(counts))) + np.repeat(starts - before, counts)]
