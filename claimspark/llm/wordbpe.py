"""Ids of texts by a tokenizer of the ``tokenizers`` library, each distinct word once."""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from claimspark.llm.arrowtext import Remembered, ragged_take, text_slices, word_codes
from claimspark.llm.bpe import byte_characters

#: Texts tokenised together, unless memory is short: fewer repeat more of their words and cost more time.
TEXT_BYTES = 6 << 20
#: Words, and pre-tokens, remembered by one Python worker.
CACHE_WORDS = 200_000
#: The tokenizer's own cut of a word into pre-tokens (fixed by its file).
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _ids(ids: list[int]) -> bytes:
    return array("H", ids).tobytes()


class WordTokenizer:
    """For tokenizers that treat white space only as an end of words, such as ``word_bpe_49k.json``.

    Their ids of a text are the ids of its words in order, so a batch's
    distinct words are encoded once.  A printable word of letters and marks
    below U+0250 is its own normal form but for its lower case: it is cut
    into pre-tokens here and each goes to the tokenizer's merges.  Any other
    word, and any that could hold a special token, goes through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(PRE_TOKENS).findall
        self.characters = {b: c for b, c in enumerate(byte_characters())}
        self.pre_tokens = Remembered(self._merged, CACHE_WORDS)
        self.ids = Remembered(self._encode, CACHE_WORDS)

    def _merged(self, pre_tokens: list[str]) -> list[bytes]:
        merge = self.tokenizer.model.tokenize
        return [_ids([t.id for t in merge(p if p.isascii() else p.encode().decode("latin-1").translate(self.characters))])
                for p in pre_tokens]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as 16-bit integers."""
        plain = [w.isprintable() and (w.isascii() or (max(w) < "\u0250" and "\u0130" not in w)) and "<|" not in w
                 for w in words]
        whole = iter(self.tokenizer.encode_batch(
            [w for w, p in zip(words, plain, strict=True) if not p], add_special_tokens=False))
        split = self.split
        cut = [(split(w.lower()) if not w.isalpha() else [w.lower()]) if p else None
               for w, p in zip(words, plain, strict=True)]
        distinct = list({p for c in cut if c for p in c})
        ids = dict(zip(distinct, self.pre_tokens(distinct), strict=True))
        return [_ids(next(whole).ids) if c is None else ids[c[0]] if len(c) == 1 else b"".join([ids[p] for p in c])
                for c in cut]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offsets of each text): a null text is empty, ``end_id`` closes each."""
        codes, offsets, words = word_codes(texts)
        lists = self.ids(words.to_pylist())
        sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)) // 2
        table = np.frombuffer(b"".join([*lists, _ids([end_id])]), np.uint16)
        starts = np.cumsum(sizes) - sizes
        # The end id is one more word, placed after each text's own.
        ends = offsets[1:] + np.arange(len(offsets) - 1)
        place = np.ones(len(codes) + len(offsets) - 1, dtype=bool)
        place[ends] = False
        word = np.full(len(place), len(lists), dtype=np.int64)
        word[place] = codes
        sizes, starts = np.append(sizes, 1), np.append(starts, len(table) - 1)
        counts = sizes[word]
        running = np.cumsum(counts)
        return ragged_take(table, starts[word], counts), np.concatenate(([0], running[ends]))


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each file and Python worker.  Ids must be below 65536."""
    return WordTokenizer(path)


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: Callable[[], str],
            end_id: int, text_bytes: int = TEXT_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, their ids, offsets) of a task's batches, ``text_bytes`` of ``text`` at a time."""
    for batch in batches:
        for piece in text_slices(batch, "text", text_bytes):
            yield piece, *word_tokenizer(vocabulary()).encode(piece.column("text"), end_id)
