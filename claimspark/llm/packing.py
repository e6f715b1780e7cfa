"""Packing token ids into windows by non-negative least squares (operator 8).

A document's ids are cut into full windows and a tail.  Shallow combinations
of two or three tail lengths that fill a window exactly are enumerated; how
often to repeat each is the non-negative least-squares fit of the
combinations to the histogram of tail lengths, rounded down to what the
histogram holds and then raised greedily while lengths are left.  The tails
that remain are packed greedily one after another into windows, cut where a
window ends.  What the last window lacks is avoided too: its content is cut
into sequences whose lengths are powers of two, which need no padding.

The driver holds the histogram and the plan, bounded by the window size.
Ranks of equal tails, and positions in the greedy stream, are made of
positions inside the written parts and offsets of the parts, so no task
ever holds all tails of one length.

Results: a null text is empty and has the end id alone; every row of the
input is a document of its own, whatever its id; each id lies in exactly one
piece; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.arrowtext import resting
from claimspark.llm.store import written
from claimspark.llm.wordbpe import TEXT_BYTES, encoded

#: Lengths tried as the second of three, for each first length.
SECOND_LENGTHS = 24


def crc_of(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.asarray(ids).astype("<u4").tobytes())


def tokenized(docs: DataFrame, vocabulary: Callable[[], str], window: int, end_id: int, id_col: str = "doc_id",
              text_col: str = "text", text_bytes: int = TEXT_BYTES) -> DataFrame:
    """Written table of (doc_id, part, seq, n_tokens, window_crcs, tail_crc, tail): tail as 16-bit ids."""
    schema = "doc_id long, n_tokens long, window_crcs array<long>, tail_crc long, tail binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, ids, offsets in encoded(batches, vocabulary, end_id, text_bytes):
            crcs, tail_crcs, tails = [], [], []
            for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                cut = end - (end - start) % window
                crcs.append([crc_of(ids[i:i + window]) for i in range(start, cut, window)])
                tail_crcs.append(crc_of(ids[cut:end]))
                tails.append(ids[cut:end].astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(np.diff(offsets)), pa.array(crcs, pa.list_(pa.int64())),
                 pa.array(tail_crcs, pa.int64()), pa.array(tails, pa.binary())],
                names=["doc_id", "n_tokens", "window_crcs", "tail_crc", "tail"])

    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(resting(run), schema)
    return written(made.select("*", F.spark_partition_id().alias("part"),
                               F.monotonically_increasing_id().alias("seq")), "tokens")


def combinations(histogram: np.ndarray, window: int, second_lengths: int = SECOND_LENGTHS) -> np.ndarray:
    """Rows of three lengths (0: none) in descending order that sum to ``window``, of lengths that occur."""
    present = np.flatnonzero(histogram[:window])
    present = present[present > 0]
    pairs = [(window - b, b, 0) for b in present if 2 * b <= window and histogram[window - b]]
    frequent = present[np.argsort(-histogram[present], kind="stable")[:second_lengths]]
    first, second = np.meshgrid(present, frequent, indexing="ij")
    third = window - first - second
    fits = third > 0
    first, second, third = first[fits], second[fits], third[fits]
    held = histogram[third] > 0
    triples = np.sort(np.column_stack((first, second, third))[held], axis=1)[:, ::-1]
    every = np.concatenate((np.array(pairs, dtype=np.int64).reshape(-1, 3), triples))
    return np.unique(every, axis=0) if len(every) else every


def least_squares(patterns: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts >= 0 that bring the lengths used nearest to the histogram (accelerated projected gradient)."""
    used = patterns > 0
    lengths = patterns[used]
    owner = np.nonzero(used)[0]

    def made(counts: np.ndarray) -> np.ndarray:
        return np.bincount(lengths, weights=counts[owner], minlength=len(histogram))

    def slope(gap: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=gap[lengths], minlength=len(patterns))

    v = np.ones(len(patterns))
    for _ in range(20):  # the largest curvature, by power iteration
        v = slope(made(v))
        size = np.linalg.norm(v)
        v /= size
    rate = 1 / (1.05 * size)
    x = y = np.zeros(len(patterns))
    momentum = 1.0
    for _ in range(steps):
        after = np.maximum(0, y - rate * slope(made(y) - histogram))
        faster = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        y, x, momentum = after + (momentum - 1) / faster * (after - x), after, faster
    return x


@dataclass(frozen=True)
class Plan:
    """For each use of a length by a pattern: ranks [low, high) of that length, and where they go.

    ``each`` tails of a sequence have that length; the first is at ``offset``.
    """

    length: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    n_sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence or -1, offset) of the tails with these lengths and ranks."""
        if not len(self.length):
            return np.full(len(length), -1), np.zeros(len(length), np.int64)
        top = int(max(self.high.max(), rank.max(initial=0))) + 1
        at = np.searchsorted(self.length * top + self.low, length * top + rank, side="right") - 1
        at = np.maximum(at, 0)
        inside = (self.length[at] == length) & (rank >= self.low[at]) & (rank < self.high[at])
        instance, slot = np.divmod(rank - self.low[at], self.each[at])
        return (np.where(inside, self.sequence[at] + instance, -1),
                np.where(inside, self.offset[at] + slot * length, 0))


def plan_tails(histogram: np.ndarray, window: int) -> Plan:
    patterns = combinations(histogram, window)
    left = histogram.copy()
    repeats = np.zeros(len(patterns), dtype=np.int64)
    if len(patterns):
        wanted = least_squares(patterns, histogram.astype(np.float64))
        for whole in (np.floor(wanted).astype(np.int64), None):
            for p in np.argsort(-wanted, kind="stable").tolist():
                lengths, each = np.unique(patterns[p][patterns[p] > 0], return_counts=True)
                most = int((left[lengths] // each).min())
                n = most if whole is None else min(most, int(whole[p]))
                repeats[p] += n
                left[lengths] -= n * each
    rows, sequence = [], 0
    next_rank = np.zeros(len(histogram), dtype=np.int64)
    for p in np.flatnonzero(repeats).tolist():
        offset = 0
        lengths, each = np.unique(patterns[p][patterns[p] > 0], return_counts=True)
        for length, k in zip(lengths.tolist(), each.tolist(), strict=True):
            low = next_rank[length]
            next_rank[length] += k * repeats[p]
            rows.append((length, low, next_rank[length], sequence, k, offset))
            offset += k * length
        sequence += int(repeats[p])
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)
    return Plan(*table.T, n_sequences=sequence)


def stream_cuts(total: int, window: int) -> np.ndarray:
    """Ends of the sequences of the last, partial window: powers of two, largest first."""
    rest, at, out = total % window, total - total % window, []
    while rest:
        step = 1 << (rest.bit_length() - 1)
        at, rest = at + step, rest - step
        out.append(at)
    return np.array(out, dtype=np.int64)


def pack(tokens: DataFrame, window: int) -> DataFrame:
    """Pieces of the documents of ``tokenized``: where each begins, and its sequence and offset there."""
    light = tokens.select("doc_id", "part", "seq", "n_tokens", "tail_crc", (F.col("n_tokens") % window).alias("rem"),
                          F.floor(F.col("n_tokens") / window).cast("long").alias("n_full"))
    histogram = np.zeros(window + 1, dtype=np.int64)
    for row in light.where("rem > 0").groupBy("rem").count().collect():  # fewer rows than the window is long
        histogram[row["rem"]] = row["count"]
    plan = plan_tails(histogram, window)

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    full_parts = (light.groupBy("part").agg(F.sum("n_full").alias("n"))
                  .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("full_before"), "n"))
    n_full = full_parts.agg(F.max(F.col("full_before") + F.col("n"))).first()[0] or 0
    rank_parts = (light.where("rem > 0").groupBy("part", "rem").count()
                  .select("part", "rem", F.coalesce(F.sum("count").over(
                      Window.partitionBy("rem").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                      F.lit(0)).alias("rank_before")))

    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    full = (light.where("n_full > 0")
            .withColumn("run", F.coalesce(F.sum("n_full").over(in_part), F.lit(0)))
            .join(full_parts.select("part", "full_before"), "part")
            .select("part", "seq", (F.col("full_before") + F.col("run")).alias("first")))
    full = (tokens.select("doc_id", "part", "seq", "n_tokens", "window_crcs").where(F.size("window_crcs") > 0)
            .join(full, ["part", "seq"])
            .select("doc_id", "n_tokens", "first", F.posexplode("window_crcs").alias("i", "crc"))
            .select("doc_id", (F.col("i").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"),
                    F.col("crc").alias("ids_crc32"), F.col("n_tokens").alias("doc_tokens"),
                    (F.col("first") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, offset = plan.place(frame["rem"].to_numpy(), frame["rank"].to_numpy())
            yield frame.drop(columns="rank").assign(sequence=sequence, offset=offset)

    ranked = (light.where("rem > 0")
              .withColumn("place", F.row_number().over(Window.partitionBy("part", "rem").orderBy("seq")) - 1)
              .join(rank_parts, ["part", "rem"])
              .select("doc_id", "part", "seq", "n_tokens", "tail_crc", "rem",
                      (F.col("rank_before") + F.col("place")).alias("rank")))
    tails = written(ranked.mapInPandas(
        placed, "doc_id long, part int, seq long, n_tokens long, tail_crc long, rem long, sequence long, offset long"),
        "tails")
    filled = tails.where("sequence >= 0").select(
        "doc_id", (F.col("n_tokens") - F.col("rem")).alias("start"), F.col("rem").alias("length"),
        F.col("tail_crc").alias("ids_crc32"), F.col("n_tokens").alias("doc_tokens"),
        (F.col("sequence") + n_full).alias("sequence_id"), "offset")

    rest = tails.where("sequence < 0")
    rest_parts = (rest.groupBy("part").agg(F.sum("rem").alias("n"))
                  .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("stream_before")))
    total = rest.agg(F.sum("rem")).first()[0] or 0
    ends, first_id = stream_cuts(total, window), n_full + plan.n_sequences
    streamed = (rest.withColumn("run", F.coalesce(F.sum("rem").over(in_part), F.lit(0)))
                .join(rest_parts, "part")
                .select("part", "seq", "rem", (F.col("stream_before") + F.col("run")).alias("at")))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = total - total % window
        for frame in frames:
            rows = []
            for doc, n, rem, at, tail in frame[["doc_id", "n_tokens", "rem", "at", "tail"]].itertuples(index=False):
                ids, done = np.frombuffer(tail, "<u2"), 0
                while done < rem:
                    x = at + done
                    if x < last:
                        number, begin = divmod(x, window)
                        begin, end = number * window, (number + 1) * window
                    else:
                        k = int(np.searchsorted(ends, x, side="right"))
                        number, begin, end = last // window + k, int(ends[k - 1]) if k else last, int(ends[k])
                    size = min(rem - done, end - x)
                    rows.append((doc, n - rem + done, size, crc_of(ids[done:done + size]), n, first_id + number, x - begin))
                    done += size
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                              "offset"]).astype({"doc_id": "Int64"})

    greedy = (tokens.select("doc_id", "part", "seq", "n_tokens", "tail").join(streamed, ["part", "seq"])
              .mapInPandas(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                "sequence_id long, offset long"))
    return full.unionByName(filled).unionByName(greedy)
