"""Byte-level BPE encoding and decoding through a sentencepiece model (operator 9).

The rank file of a byte-level vocabulary is serialised as a sentencepiece
BPE model: every token's bytes are mapped to printable characters, its score
is minus its rank, and normalisation is the identity.  Texts are cut into
pre-tokens by the vocabulary's pattern; a pre-token that is a token itself
has that id, any other is encoded by the model.  Decoding maps the pieces of
the ids back to bytes.

Results: a null text counts as empty and has no ids; ids of a text decode to
exactly its UTF-8 bytes; repeated rows stay repeated; further columns of the
input are kept; an empty table gives an empty table.  An id outside the
vocabulary decodes to nothing.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimspark.llm.arrowtext import as_array, list_array, text_slices, with_columns

#: Pre-token units remembered by one Python worker; beyond it the memory starts anew.
CACHE_UNITS = 100_000


def byte_characters() -> list[str]:
    """A printable character for each byte value: itself where printable, else the next free one from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b) if b in printable else chr(free))
        free += b not in printable
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: a piece for each rank in order, then the unknown piece.

    Ranks must run from 0 without gaps, so that ids are ranks.
    """
    order = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in order] != list(range(len(order))):
        raise ValueError("ranks must be 0, 1, 2 ... without gaps")
    character = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    out = bytearray()
    for rank, token in enumerate(order):
        piece = "".join(character[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, normal))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    trainer = _field(3, bpe) + _field(4, len(order) + 1) + _field(40, len(order))
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, identity))


class Codec:
    """Encoder and decoder of one rank file, with the ids of pre-token units seen before."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(sentencepiece_model(self.ranks))
        self.split = regex.compile(pattern).findall
        self.to_characters = {b: c for b, c in enumerate(byte_characters())}
        back = {c: b for b, c in self.to_characters.items()}
        pieces = [bytes(back[c] for c in self.model.IdToPiece(i)) for i in range(len(self.ranks))]
        self.pieces = pa.array([*pieces, b""], pa.large_binary())
        self.seen: dict[str, list[int]] = {}

    def _encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of texts that are encoded on their own."""
        tokens = [[t.encode() for t in self.split(u)] for u in units]
        rare = list(dict.fromkeys(t for ts in tokens for t in ts if t not in self.ranks))
        mapped = [t.decode("latin-1").translate(self.to_characters) for t in rare]
        encoded = dict(zip(rare, self.model.Encode(mapped) if mapped else [], strict=True))
        return [[i for t in ts for i in ((self.ranks[t],) if t in self.ranks else encoded[t])] for ts in tokens]

    def ids_of(self, units: list[str]) -> list[list[int]]:
        if len(self.seen) > CACHE_UNITS:
            self.seen.clear()
        new = list(dict.fromkeys(u for u in units if u not in self.seen))
        fresh = dict(zip(new, self._encode_units(new), strict=True))
        out = [self.seen[u] if u in self.seen else fresh[u] for u in units]
        self.seen.update(fresh)
        return out

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text.

        A pre-token starts at every space that has no white space on either
        side, so texts are cut there and each distinct unit is encoded once.
        A text where white space meets white space at such a cut is encoded
        whole.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.split_pattern(texts, " ")
        flat, offsets = split.flatten(), np.asarray(split.offsets).astype(np.int64)
        offsets = offsets - offsets[0]
        encoded = pc.dictionary_encode(flat)
        codes, names = np.asarray(encoded.indices).astype(np.int64), encoded.dictionary.to_pylist()
        edge = np.array([not n or not (n[0].isprintable() and n[-1].isprintable()) or n[0].isspace() or n[-1].isspace()
                         for n in names], dtype=bool)
        row = np.repeat(np.arange(len(texts)), np.diff(offsets))
        whole = np.zeros(len(texts), dtype=bool)
        whole[row[edge[codes]]] = True
        first = np.zeros(len(codes), dtype=bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        unit = (codes * 2 + first)[~whole[row]]
        distinct, place = np.unique(unit, return_inverse=True)
        units = [names[u >> 1] if u & 1 else " " + names[u >> 1] for u in distinct.tolist()]
        units_whole = texts.filter(pa.array(whole)).to_pylist()
        # Cuts of a row that is encoded whole are replaced by that one unit.
        lists = self.ids_of(units) + (self._encode_units(units_whole) if units_whole else [])
        counts = np.where(whole, 1, np.diff(offsets))
        starts = np.concatenate(([0], np.cumsum(counts)))
        which = np.empty(starts[-1], dtype=np.int64)
        is_whole = np.repeat(whole, counts)
        which[~is_whole] = place
        which[is_whole] = len(units) + np.arange(len(units_whole))
        sizes = np.array([len(x) for x in lists], dtype=np.int64)
        table = list_array(np.array([i for x in lists for i in x], dtype=np.int32),
                           np.concatenate(([0], np.cumsum(sizes))))
        ids = table.take(pa.array(which)).flatten()
        ends = np.concatenate(([0], np.cumsum(sizes[which])))
        return pa.ListArray.from_arrays(pa.array(ends[starts].astype(np.int32)), ids)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; a null list gives empty bytes."""
        ids = as_array(ids)
        offsets = np.asarray(ids.offsets).astype(np.int64)
        flat = np.asarray(pc.fill_null(ids.flatten(), -1)).astype(np.int64)
        known = len(self.pieces) - 1
        taken = as_array(self.pieces.take(pa.array(np.where((flat >= 0) & (flat < known), flat, known))))
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int64, count=len(taken) + 1) if len(taken) \
            else np.zeros(1, np.int64)
        rows = np.ascontiguousarray(ends[offsets - offsets[0]]).astype(np.int64)
        data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(ids), [None, pa.py_buffer(rows.tobytes()), data])


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each rank file and Python worker."""
    return Codec(path, pattern)


def _mapped(df: DataFrame, columns: list[T.StructField],
            work: Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]]) -> DataFrame:
    """``df`` with ``columns`` added (or replaced), made batch by batch."""
    names = {c.name for c in columns}
    schema = T.StructType([*[f for f in df.schema.fields if f.name not in names], *columns])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, made in work(batch):
                yield with_columns(part, arrow, **made)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, vocabulary: Callable[[], str], pattern: str, text_col: str = "text",
           ids_col: str = "ids", bytes_col: str | None = None) -> DataFrame:
    """Add ``ids_col`` (array of int), the ids of ``text_col``.

    With ``bytes_col`` the ids are also decoded again in the same task.
    ``vocabulary`` gives the rank file's path and is called in the task, so
    each executor finds its own copy.
    """
    def work(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        c = codec(vocabulary(), pattern)
        for part in text_slices(batch, text_col):
            ids = c.encode(part.column(text_col))
            yield part, {ids_col: ids} | ({bytes_col: c.decode(ids)} if bytes_col else {})

    columns = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))]
    return _mapped(df, columns + ([T.StructField(bytes_col, T.BinaryType())] if bytes_col else []), work)


def decode(df: DataFrame, vocabulary: Callable[[], str], pattern: str, ids_col: str = "ids",
           bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col`` (binary), the bytes that the ids stand for."""
    def work(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        if batch.num_rows:
            yield batch, {bytes_col: codec(vocabulary(), pattern).decode(batch.column(ids_col))}

    return _mapped(df, [T.StructField(bytes_col, T.BinaryType())], work)
