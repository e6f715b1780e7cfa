"""Files of token ids in context-mixed range-coded blocks (operator 4, the Spark side).

``write`` tokenises texts and writes their ids in ascending id order: range
partitions of the rows, sorted, each cut into blocks of equal size wherever a
text ends.  A block is one row of a Parquet table: its framed code
(``mixcoder``), its place, and which texts its ids belong to.  Blocks are
coded independently, so any reader starts anywhere, and Spark's committer
keeps a lost task's half-written blocks out.

``read`` decodes the blocks.  A text that several blocks share comes in
pieces.

Results: a null text is empty and has the end id alone; rows with a null id
come first; rows with equal ids are texts of their own, ordered by their
hash; an empty table gives files without blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimspark.llm.mixcoder import decode_blocks, encode_blocks
from claimspark.llm.wordbpe import encoded

BLOCK = 4096
#: Blocks coded together: about so many, at most half as many again, which bounds a task's memory.
LANES = 1280

BLOCKS = "part int, block long, first_id long, n_ids int, frame binary, docs array<bigint>, rows array<bigint>, counts array<int>"


def _together(n: int) -> list[slice]:
    """``n`` blocks in even parts of about ``LANES``: a part's time hardly depends on its size."""
    parts = max(1, round(n / LANES))
    return [slice(i * n // parts, (i + 1) * n // parts) for i in range(parts)]


def write(docs: DataFrame, path: str, vocabulary: Callable[[], str], end_id: int, id_col: str = "doc_id",
          text_col: str = "text", block: int = BLOCK) -> None:
    """Write the ids of all texts to ``path`` (a folder that all executors share)."""
    light = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = light.repartitionByRange(parts, "doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    (ordered.select("doc_id", "text").mapInArrow(lambda batches: _encoded(batches, vocabulary, end_id, block), BLOCKS)
     .write.parquet(path))


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: Callable[[], str], end_id: int,
             block: int) -> Iterator[pa.RecordBatch]:
    part, row, number = TaskContext.get().partitionId(), 0, 0
    held = np.zeros(0, np.uint16)
    owners: list[tuple[int | None, int, int]] = []  # (id, row, ids) of what is held

    def cut(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, number, owners
        sizes = [block] * (len(held) // block if last else LANES)
        sizes += [len(held) % block] if last and len(held) % block else []
        blocks = np.split(held, np.cumsum(sizes))[:len(sizes)]
        frames = [f for some in _together(len(blocks)) for f in encode_blocks(blocks[some])]
        rows = []
        at = 0
        for size, frame in zip(sizes, frames, strict=True):
            mine, need = [], size
            while need:
                doc, r, n = owners[at]
                mine.append((doc, r, min(n, need)))
                owners[at] = (doc, r, n - mine[-1][2])
                need -= mine[-1][2]
                at += not owners[at][2]
            rows.append((part, number, number * block, size, frame, *map(list, zip(*mine, strict=True))))
            number += 1
        owners = owners[at:]
        held = held[sum(sizes):]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()),
                 pa.list_(pa.int64()), pa.list_(pa.int32()))
        names = ["part", "block", "first_id", "n_ids", "frame", "docs", "rows", "counts"]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             names=names)

    for piece, ids, offsets in encoded(batches, vocabulary, end_id):
        counts = np.diff(offsets).tolist()
        owners += [(d, row + i, n) for i, (d, n) in enumerate(zip(piece.column("doc_id").to_pylist(), counts,
                                                                  strict=True))]
        row += len(counts)
        held = np.concatenate((held, ids))
        if len(held) >= 2 * block * LANES:
            yield from cut(last=False)
    yield from cut(last=True)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(part, row, doc_id, first_id, n_ids, ids): pieces of texts; ids as little-endian unsigned 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _together(batch.num_rows):
                some = batch.slice(part.start, part.stop - part.start)
                rows = []
                for ids, head in zip(decode_blocks(some.column("frame").to_pylist()),
                                     some.drop_columns(["frame"]).to_pylist(), strict=True):
                    at = 0
                    for doc, row, n in zip(head["docs"], head["rows"], head["counts"], strict=True):
                        rows.append((head["part"], row, doc, head["first_id"] + at, n,
                                     ids[at:at + n].astype("<u4").tobytes()))
                        at += n
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = ["part", "row", "doc_id", "first_id", "n_ids", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                                 names=names)

    # One batch of rows is a bounded number of blocks.
    return spark.read.schema(BLOCKS).parquet(path).select("part", "first_id", "frame", "docs", "rows", "counts").mapInArrow(
        run, "part int, row long, doc_id long, first_id long, n_ids long, ids binary")


def crc32_joined(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings in a row, from their own and the size of the second.

    Appending zero bytes is linear, so the first value is carried over
    ``size`` zero bytes by the powers of two in it.
    """
    power = 0
    while size:
        if size & 1:
            first = _applied(_zero_bytes(power), first)
        size, power = size >> 1, power + 1
    return first ^ second


@lru_cache(maxsize=None)
def _zero_bytes(power: int) -> list[int]:
    """Effect of 2^power zero bytes on each bit of a CRC register (as many as a length has bits)."""
    if power == 0:
        return [_after_zero_byte(1 << i) for i in range(32)]
    half = _zero_bytes(power - 1)
    return [_applied(half, x) for x in half]


def _applied(effect: list[int], x: int) -> int:
    out, i = 0, 0
    while x:
        if x & 1:
            out ^= effect[i]
        x, i = x >> 1, i + 1
    return out


def _after_zero_byte(register: int) -> int:
    """The register after one zero byte: zlib inverts before and after, which cancels out here."""
    return zlib.crc32(b"\0", register ^ 0xFFFFFFFF) ^ zlib.crc32(b"\0", 0xFFFFFFFF) \
        if register else 0


def documents(pieces: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every text, from the pieces' lengths and checksums (``crc``).

    Only those are brought together, not the ids.
    """
    texts = (pieces.select("part", "row", "doc_id", "first_id", "n_ids", "crc").groupBy("part", "row").agg(
        F.max("doc_id").alias("doc_id"), F.min("first_id").alias("first_id"), F.sum("n_ids").alias("n_tokens"),
        F.count(F.lit(1)).alias("pieces"), F.max("crc").alias("crc"),
        F.sort_array(F.collect_list(F.struct("first_id", "n_ids", "crc"))).alias("all")))

    def joined(crc: pd.Series, n: pd.Series, every: pd.Series) -> pd.Series:
        out = []
        for c, k, parts in zip(crc, n, every, strict=True):
            if k > 1:
                c = parts[0]["crc"]
                for p in parts[1:]:
                    c = crc32_joined(c, p["crc"], 4 * p["n_ids"])
            out.append(c)
        return pd.Series(out, dtype="int64")

    crc = F.pandas_udf(joined, "long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (texts.groupBy("part").agg(F.sum("n_tokens").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    return texts.join(offsets, "part").select(
        "doc_id", (F.col("before") + F.col("first_id")).alias("start"), "n_tokens",
        crc("crc", "pieces", "all").alias("ids_crc32"))
