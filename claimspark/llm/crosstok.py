"""Alignment of two tokenizers over the same bytes, and how many documents hold each linked pair of ids.

The first tokenizer (A) is byte-level, the second (B) a sentencepiece model.
Offsets where tokens of both end cut a text into groups; an A and a B token
whose bytes overlap are linked.  Neither tokenizer joins bytes over the start
of white space that follows a word (``Aligner`` takes only such white space
as B's pieces allow), so texts are cut there and each distinct stretch is
tokenised and aligned once.

Pairs are counted on two paths.  Most links join an A id to the B id of the
same bytes: one array gives that id for every A id, and their counts are
vectors as long as A's vocabulary, a size that no corpus changes.  All other
links, those of irregular groups, are pairs: each flush of texts adds its
documents up by distinct pair before the shuffle.  To read the sums, a flush
asks for each of its distinct pairs once.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.arrowtext import Remembered, list_array, ragged, ragged_take, text_slices
from claimspark.llm.bpe import byte_characters
from claimspark.llm.store import written

#: Texts aligned together; one flush of counts and one set of questions.
FLUSH_BYTES = 4 << 20
#: Stretches remembered by one Python worker.
CACHE_STRETCHES = 100_000
#: Cuts that may be asked of B, as far as its pieces allow.
SPACES = " \t\n\x0b\x0c\r"

ENCODED = ("flush long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "codes array<int>, links array<int>, same_ids array<int>, same_docs array<int>, "
           "pairs array<long>, pair_docs array<int>")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


class Aligner:
    """Both tokenizers, their ids' bytes, and the array from A ids to B ids of the same bytes (-1: none)."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        entries = self.a.get_vocab(with_added_tokens=False)
        bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            bytes_a[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        usable = [not (self.b.is_control(i) or self.b.is_unknown(i)) for i in range(len(pieces))]
        # Where a byte is a piece as well, B takes the piece.
        b_of = {b: i for i, b in enumerate(bytes_b) if usable[i] and self.b.is_byte(i)}
        b_of.update({b: i for i, b in enumerate(bytes_b) if usable[i] and not self.b.is_byte(i)})
        self.bytes_b = bytes_b
        self.size_a, self.size_b = len(bytes_a), len(bytes_b)
        self.len_a = np.array([len(b) for b in bytes_a], dtype=np.int64)
        self.len_b = np.array([len(b) for b in bytes_b], dtype=np.int64)
        self.identity = np.array([b_of.get(b, -1) for b in bytes_a], dtype=np.int64)
        inside = {c for p in pieces for c in p[1:]}
        inside.update(" " if p.lstrip("▁").find("▁") >= 0 else "" for p in pieces)
        cuts = "".join(re.escape(c) for c in SPACES if c not in inside)
        self.cut = re.compile(rf"(?<=\S)(?=[{cuts}])").split if cuts else lambda text: [text]
        self.prefix = self.b.piece_to_id("▁")
        self.aligned = Remembered(self._align, CACHE_STRETCHES)

    def _align(self, stretches: list[str]) -> list[tuple]:
        """(number of A tokens, of B tokens, of groups, the groups as text, links as A id * size of B + B id) of each;
        None where B's bytes are not the stretch's."""
        a = [e.ids for e in self.a.encode_batch(stretches, add_special_tokens=False)]
        # B puts a space before what it is given: it stands for the stretch's own, or its token is taken off again.
        spaced = [s[0] == " " for s in stretches]
        b = self.b.encode([s[1:] if own else s for s, own in zip(stretches, spaced, strict=True)], num_threads=1)
        b = [(x or [self.prefix]) if own else x[1:] if x and x[0] == self.prefix else None
             for x, own in zip(b, spaced, strict=True)]
        out: list = [None] * len(stretches)
        of = self.bytes_b.__getitem__
        right = [i for i, (s, x) in enumerate(zip(stretches, b, strict=True)) if x and b"".join(map(of, x)) == s.encode()]
        if not right:
            return [self.nothing if x is None else x for x in out]
        n_a, n_b = (np.array([len(x[i]) for i in right], dtype=np.int64) for x in (a, b))
        ids_a, ids_b = (np.fromiter((t for i in right for t in x[i]), dtype=np.int64) for x in (a, b))
        links, n_links, ends_a, ends_b = self._links(ids_a, ids_b, n_a)
        both_a, both_b = np.isin(ends_a, ends_b), np.isin(ends_b, ends_a)
        at_a, at_b, at_l = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b, n_links))
        names_a, names_b = ids_a.astype(str).tolist(), ids_b.astype(str).tolist()
        close_a, close_b = (np.flatnonzero(x) + 1 for x in (both_a, both_b))
        group_ends = np.searchsorted(close_a, at_a[1:], side="right")
        first, pa_, pb_ = 0, 0, 0
        for k, i in enumerate(right):
            texts = []
            for g in range(first, group_ends[k]):
                ea, eb = close_a[g], close_b[g]
                texts.append(",".join(names_a[pa_:ea]) + "|" + ",".join(names_b[pb_:eb]))
                pa_, pb_ = ea, eb
            out[i] = (int(n_a[k]), int(n_b[k]), len(texts), ";".join(texts), links[at_l[k]:at_l[k + 1]].tobytes())
            first = group_ends[k]
        return [self.nothing if x is None else x for x in out]

    #: Stands for a stretch that B's tokens do not give back.
    nothing = (-1, 0, 0, "", b"")

    def _links(self, ids_a, ids_b, n_a):
        """Links of token sequences of the same bytes, laid end to end; (links, links of each, ends of A, of B)."""
        ends_a, ends_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        starts_a, starts_b = ends_a - self.len_a[ids_a], ends_b - self.len_b[ids_b]
        low = np.searchsorted(ends_b, starts_a, side="right")
        high = np.searchsorted(starts_b, ends_a, side="left")
        token, place = ragged(high - low)
        links = ids_a[token] * self.size_b + ids_b[low[token] + place]
        before = np.concatenate(([0], np.cumsum(high - low)))
        return links, np.diff(before[np.concatenate(([0], np.cumsum(n_a)))]), ends_a, ends_b


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One pair of tokenizers for each pair of files and Python worker."""
    return Aligner(path_a, path_b)


def _flush(tools: Aligner, doc_ids: pa.Array, texts: list[str | None], flush: int) -> Iterator[dict]:
    """The documents' rows, then the flush's counts."""
    known: dict[str, int] = {}
    codes: list[int] = []
    offsets = [0]
    for text in texts:
        if text:
            codes += [known.setdefault(s, len(known)) for s in tools.cut(" " + text)]
        offsets.append(len(codes))
    entries = tools.aligned(list(known))
    n_a, n_b, n_groups = (np.array([e[k] for e in entries], dtype=np.int64) for k in range(3))
    n_links = np.array([len(e[4]) for e in entries], dtype=np.int64) // 8
    table = np.frombuffer(b"".join([e[4] for e in entries]), dtype=np.int64)
    # Links as codes: the A id where the B id has its bytes, else the size of A and the pair's place in the flush.
    id_a, id_b = table // tools.size_b, table % tools.size_b
    same = tools.identity[id_a] == id_b
    pairs, place = np.unique(table[~same], return_inverse=True)
    coded = id_a.copy()
    coded[~same] = tools.size_a + place
    offsets = np.array(offsets, dtype=np.int64)
    at = np.array(codes, dtype=np.int64)
    wrong = np.zeros(len(texts), dtype=bool)
    doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
    wrong[doc[n_a[at] < 0]] = True
    at = np.where(wrong[doc], -1, at)
    keep = at >= 0
    at, doc = at[keep], doc[keep]

    def per_doc(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values[at], minlength=len(texts)).astype(np.int64)

    counts = n_links[at]
    linked = ragged_take(coded, (np.cumsum(n_links) - n_links)[at], counts) if len(at) else np.zeros(0, np.int64)
    width = tools.size_a + len(pairs)
    held, times = np.unique(np.repeat(doc, counts) * width + linked, return_counts=True)
    held_doc, held_code = held // width, held % width
    bounds = np.searchsorted(held_doc, np.arange(len(texts) + 1))
    docs = np.bincount(held_code, minlength=width)
    seen = np.flatnonzero(docs[:tools.size_a])
    text_of = [e[3] for e in entries]
    shas = [hashlib.sha256(";".join([text_of[c] for c in codes[x:y]]).encode()).hexdigest() if y > x and not w else ""
            for (x, y), w in zip(pairwise(offsets.tolist()), wrong, strict=True)]
    del codes
    ints = lambda x: pa.array([x.astype(np.int32)], pa.list_(pa.int32()))
    yield {"flush": pa.array(np.full(len(texts), flush)), "doc_id": doc_ids, "n_a": pa.array(per_doc(n_a)),
           "n_b": pa.array(per_doc(n_b)), "n_groups": pa.array(per_doc(n_groups)), "n_links": pa.array(per_doc(n_links)),
           "groups_sha256": pa.array(shas, pa.string()), "codes": list_array(held_code.astype(np.int32), bounds),
           "links": list_array(times.astype(np.int32), bounds)}
    yield {"flush": pa.array([flush], pa.int64()), "same_ids": ints(seen), "same_docs": ints(docs[seen]),
           "pairs": pa.array([pairs], pa.list_(pa.int64())), "pair_docs": ints(docs[tools.size_a:])}


def encoded(docs: DataFrame, path_a: Callable[[], str], path_b: Callable[[], str]) -> DataFrame:
    """Documents aligned, one row each, and one row of counts for every flush of them (``pairs`` not null)."""
    fields = [f.split() for f in ENCODED.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = aligner(path_a(), path_b())
        flush = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_slices(batch, "text", FLUSH_BYTES):
                for columns in _flush(tools, part.column("doc_id").cast(pa.int64()), part.column("text").to_pylist(), flush):
                    n = len(columns["flush"])
                    yield pa.RecordBatch.from_arrays(
                        [columns[name] if name in columns else pa.nulls(n, types[t]) for name, t in fields],
                        names=[name for name, _ in fields])
                flush += 1
    return docs.select("doc_id", "text").mapInArrow(encode, ENCODED)


def _answered(size_a: int, same: np.ndarray, best: np.ndarray, size_b: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def answer(docs: pa.Table, answers: pa.Table) -> pa.Table:
        n_docs = np.zeros(size_a + answers.num_rows, dtype=np.int64)
        n_docs[:size_a] = same
        top = np.concatenate((best, np.zeros(answers.num_rows, dtype=np.int64)))
        place = size_a + answers["place"].to_numpy()
        n_docs[place] = answers["n"].to_numpy()
        top[place] = best[answers["pair"].to_numpy() // size_b]
        docs = docs.combine_chunks()
        codes = np.asarray(docs["codes"].combine_chunks().flatten()).astype(np.int64)
        links = np.asarray(docs["links"].combine_chunks().flatten()).astype(np.int64)
        sizes = np.diff(np.asarray(docs["codes"].combine_chunks().offsets).astype(np.int64))
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        def total(x: np.ndarray) -> pa.Array:
            return pa.array(np.diff(np.concatenate(([0], np.cumsum(x)))[bounds]))
        values = {"count_sum": total(links * n_docs[codes]), "n_best": total(links * (n_docs[codes] == top[codes]))}
        names = [f.split()[0] for f in RESULT.split(", ")]
        return pa.table({n: values[n] if n in values else docs[n] for n in names})
    return answer


def align(docs: DataFrame, path_a: Callable[[], str], path_b: Callable[[], str]) -> DataFrame:
    """Tokens, groups and links of every text, with the corpus-wide document counts of its linked pairs.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has
    the highest count of its A id, ties included), count_sum (counts added
    over links), groups_sha256.  A tokenises a space and the text, B the text
    (it adds the space).  Null and empty texts, and those that B's tokens do
    not give back byte by byte, have no tokens: zeros and ''.  Each row is a
    document of its own, so repeated rows count repeatedly; a null doc_id
    stays null.  An empty table gives no rows.  Other columns are not read.
    """
    tools = aligner(path_a(), path_b())
    size_a, size_b = tools.size_a, tools.size_b
    texts = written(encoded(docs, path_a, path_b), "aligned")
    flushes = texts.where("pairs IS NOT NULL")
    same = np.zeros(size_a, dtype=np.int64)
    by_id = flushes.select(F.explode(F.arrays_zip("same_ids", "same_docs")).alias("x")) \
        .groupBy("x.same_ids").agg(F.sum("x.same_docs").alias("n"))
    asked = flushes.select("flush", F.posexplode(F.arrays_zip("pairs", "pair_docs")).alias("place", "x")) \
        .select("flush", "place", F.col("x.pairs").alias("pair"), F.col("x.pair_docs").alias("docs"))
    counts = written(asked.groupBy("pair").agg(F.sum("docs").alias("n")), "pair-counts")
    by_a = counts.groupBy(F.expr(f"pair DIV {size_b}").alias("a")).agg(F.max("n").alias("n"))
    for a, n in by_id.toLocalIterator():  # no more rows than A has ids, here and below
        same[a] = n
    best = same.copy()
    for a, n in by_a.toLocalIterator():
        best[a] = max(best[a], n)
    answers = asked.select("flush", "place", "pair").join(counts, "pair").select("flush", "place", "pair", "n")
    rows = texts.where("pairs IS NULL").withColumnRenamed("flush", "of") \
        .drop("same_ids", "same_docs", "pairs", "pair_docs")
    return rows.groupBy("of").cogroup(answers.groupBy("flush")).applyInArrow(
        _answered(size_a, same, best, size_b), RESULT)
