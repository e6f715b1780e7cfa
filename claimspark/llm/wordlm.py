"""Language-model scores of whole documents (operator 3, the Spark side).

Words are cut at space and U+0009 to U+000D after A-Z are put in lower case;
every text ends with one end token.

1. Corpus counts: tasks send each distinct word of a bounded amount of text
   (a flush) once, with its count in training texts; the sums give the number
   of tokens, the number of distinct ones and the most frequent words.
2. The recurrent model's vocabulary is those words.  It is trained in rounds:
   each task trains on its share of the round's training texts, and the tasks'
   models are averaged by tokens.  The rounds together visit every training
   text once.
3. Words outside the vocabulary get, from the model, the probability of
   "another word" times their smoothed share among all such words.  The
   flushes send these words once each, with the texts they are in; their
   counts meet, and sums by text come back.
4. Every text is scored whole by the model; the sums are added.

A word of very many texts is in the vocabulary, so what travels by word in
step 3 stays spread.

Results: a null text is empty and consists of its end token; a null id
counts as empty text where the training texts are chosen; a text with no
training texts at all has one unseen token type, so all scores are finite;
repeated rows are scored alike, and each counts in training.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.arrowtext import text_slices, utf8_bytes, word_codes
from claimspark.llm.grulm import END, OTHER, Gru, Shape
from claimspark.llm.store import written

FLUSH_BYTES = 12 << 20
BUCKET_BYTES = 16 << 20
#: Tokens whose texts are scored together: the more, the fewer steps in which few long texts are left.
SCORED_TOKENS = 6 << 20


@dataclass(frozen=True)
class Settings:
    shape: Shape = Shape()
    rounds: int = 2
    #: Models that are averaged together, step by step until the driver averages the last of them.
    together: int = 16


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table]]:
    held, size, number = [], 0, 0
    for batch in batches:
        for part in text_slices(batch, "text", FLUSH_BYTES):
            held.append(part)
            size += part.column("text").nbytes
            if size >= FLUSH_BYTES:
                yield f"{TaskContext.get().partitionId()}-{number}", pa.Table.from_batches(held)
                held, size, number = [], 0, number + 1
    if held:
        yield f"{TaskContext.get().partitionId()}-{number}", pa.Table.from_batches(held)


def _words(table: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, offsets of texts, distinct words, whether each text is a training text)."""
    codes, offsets, words = word_codes(pc.ascii_lower(table["text"].combine_chunks()))
    return codes, offsets, words, np.asarray(table["train"])


#: What a byte counts in its word's hash, by its place.
_WEIGHTS = np.random.default_rng(3).integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word, the same in every task."""
    data, offsets = utf8_bytes(words)
    size = np.diff(offsets)
    weights = _WEIGHTS[(np.arange(len(data)) - np.repeat(offsets[:-1], size)) & 63]
    out, filled = size.astype(np.uint64), np.flatnonzero(size)
    if len(filled):
        out[filled] += np.add.reduceat(weights * (data.astype(np.uint64) + np.uint64(1)), offsets[filled])
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _by_bucket(words: pa.Array, chosen: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Chosen words by bucket of their hash: the bucket, which words, and the words themselves."""
    if not len(chosen):
        return
    taken = words.take(pa.array(chosen))
    bucket = (_hashes(taken) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    begin = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    joined = _joined(taken.take(pa.array(order)), np.append(begin, len(order)))
    for b, group, own in zip(bucket[order[begin]].tolist(), np.split(chosen[order], begin[1:]), joined, strict=True):
        yield b, group, own


def _joined(words: pa.Array, offsets: np.ndarray) -> list[bytes]:
    """The words of each stretch, a space between them."""
    lists = pa.LargeListArray.from_arrays(pa.array(offsets.astype(np.int64)), words.cast(pa.large_string()))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.large_binary()).to_pylist()


def _most(count: np.ndarray, words: pa.Array, most: int) -> np.ndarray:
    """The most frequent words, of equally frequent ones the first by code points."""
    if len(count) <= most:
        return np.arange(len(count))
    least = np.partition(count, len(count) - most)[len(count) - most]
    more, equal = np.flatnonzero(count > least), np.flatnonzero(count == least)
    first = np.asarray(pc.array_sort_indices(words.take(pa.array(equal))))[:most - len(more)]
    return np.concatenate((more, equal[first]))


def _merged_words(blobs: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """(code of each word of all blobs in order, distinct words)."""
    codes, _, words = word_codes(pa.array([b.decode() for b in blobs], pa.large_string()))
    return codes, words


def _binary(kind: str, parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=kind)


@dataclass(frozen=True)
class Counts:
    tokens: int
    types: int
    texts: int
    words: tuple[str, ...]
    word_counts: tuple[int, ...]

    @property
    def vocabulary(self) -> dict[str, int]:
        return {w: i + 2 for i, w in enumerate(self.words)}

    @property
    def by_token(self) -> list[int]:
        """Counts of the model's tokens: other words, the end, the vocabulary."""
        return [self.tokens - self.texts - sum(self.word_counts), self.texts, *self.word_counts]


#: Classes of counts: 32 for each doubling.
SIZES = 2048
#: Groups in which the classes' numbers are summed before the driver adds them.
SUMMED = 32


def _size(count: np.ndarray) -> np.ndarray:
    return np.minimum((np.log2(np.maximum(count, 1)) * 32).astype(np.int64), SIZES - 1)


def corpus_counts(docs: DataFrame, buckets: int, vocabulary: int) -> Counts:
    """Counts over all training texts; the driver gets the vocabulary and three sums."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _flushes(batches):
            codes, offsets, words, train = _words(table)
            of_train = np.repeat(train, np.diff(offsets))
            count = np.bincount(codes[of_train], minlength=len(words))
            rows = [(b, own, count[some].astype("<u4").tobytes())
                    for b, some, own in _by_bucket(words, np.flatnonzero(count), buckets)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))],
                names=["bucket", "words", "counts"])

    def gather(table: pa.Table) -> pa.Table:
        codes, words = _merged_words(table["words"].to_pylist())
        count = np.bincount(codes, weights=_binary("<u4", table["counts"].to_pylist()), minlength=len(words))
        best = _most(count, words, vocabulary)
        return pa.table({"words": pa.array(_joined(words.take(pa.array(best)), np.array([0, len(best)])), pa.binary()),
                         "counts": pa.array([count[best].astype("<i8").tobytes()], pa.binary()),
                         "sizes": pa.array([np.bincount(_size(count[best]), minlength=SIZES).astype("<i8").tobytes()],
                                           pa.binary()),
                         "n": pa.array([int(count.sum())], pa.int64()), "types": pa.array([len(words)], pa.int64()),
                         "part": pa.array([table["bucket"][0].as_py() % SUMMED], pa.int32())})

    def summed(table: pa.Table) -> pa.Table:
        sizes = np.sum([np.frombuffer(x, "<i8") for x in table["sizes"].to_pylist()], axis=0)
        return pa.table({"sizes": pa.array([sizes.astype("<i8").tobytes()], pa.binary())})

    found = written(docs.select("text", "train").mapInArrow(send, "bucket int, words binary, counts binary")
                    .groupBy("bucket").applyInArrow(lambda t: gather(t), "words binary, counts binary, sizes binary, "
                                                    "n long, types long, part int"), "counts")
    sums = found.agg(F.sum("n"), F.sum("types")).first()
    texts = docs.where("train").count()
    # The sizes of counts show from which size on there are words enough; only such words leave their bucket.
    sizes = found.select("part", "sizes").groupBy("part").applyInArrow(lambda t: summed(t), "sizes binary").collect()
    above = np.cumsum(np.sum([np.zeros(SIZES, np.int64), *(np.frombuffer(r["sizes"], "<i8") for r in sizes)], axis=0)[::-1])
    least = SIZES - 1 - int(np.searchsorted(above, vocabulary)) if above[-1] >= vocabulary else 0

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch["words"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                n = np.frombuffer(counts, "<i8")
                some = np.flatnonzero(_size(n) >= least)
                names = np.array(words.decode().split(" "), dtype=object)
                yield pa.RecordBatch.from_arrays([pa.array(names[some].tolist(), pa.string()), pa.array(n[some])],
                                                 names=["word", "n"])

    top = (found.select("words", "counts").mapInArrow(frequent, "word string, n long")
           .orderBy(F.desc("n"), "word").limit(vocabulary).collect())
    return Counts((sums[0] or 0) + texts, (sums[1] or 0) + (texts > 0), texts, tuple(r["word"] for r in top),
                  tuple(r["n"] for r in top))


def rare_words(docs: DataFrame, counts: Counts, buckets: int) -> DataFrame:
    """(mark, rare_log10, rare_known): of the words outside the vocabulary in each text, the sum of
    log10(count + 0.5) and how many occur in training."""
    vocabulary = counts.vocabulary

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flush, table in _flushes(batches):
            codes, offsets, words, train = _words(table)
            rare = (_model_tokens(words, vocabulary) == OTHER) & np.asarray(pc.not_equal(words, ""))
            text = np.repeat(np.arange(len(train)), np.diff(offsets))
            count = np.bincount(codes[train[text]], minlength=len(words)) if len(codes) else np.zeros(0, np.int64)
            held = rare[codes] if len(codes) else np.zeros(0, bool)
            pair, times = np.unique(codes[held].astype(np.int64) * len(train) + text[held], return_counts=True)
            of_word, doc = np.divmod(pair, len(train))
            starts = np.searchsorted(of_word, np.arange(len(words) + 1))
            rows = [(0, zlib.crc32(flush.encode()) % buckets, flush, np.asarray(table["mark"]).astype("<i8").tobytes(),
                     None, None, None, None)]
            for bucket, some, own in _by_bucket(words, np.flatnonzero(rare), buckets):
                size = starts[some + 1] - starts[some]
                at = np.repeat(starts[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
                rows.append((1, bucket, flush, own, count[some].astype("<u4").tobytes(),
                             size.astype("<u4").tobytes(), doc[at].astype("<u4").tobytes(),
                             times[at].astype("<u4").tobytes()))
            kinds = (pa.int32(), pa.int32(), pa.string(), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             names=["kind", "bucket", "flush", "a", "b", "c", "d", "e"])

    def meet(table: pa.Table) -> pa.Table:
        texts, parts = table.filter(pc.equal(table["kind"], 0)), table.filter(pc.equal(table["kind"], 1))
        flushes, own, size, doc, times = (parts[n].to_pylist() for n in ("flush", "b", "c", "d", "e"))
        codes, words = _merged_words(parts["a"].to_pylist())
        total = np.bincount(codes, weights=_binary("<u4", own), minlength=len(words))
        value = np.log10(total + 0.5)
        out = [(0, f, m, None, None) for f, m in zip(texts["flush"].to_pylist(), texts["a"].to_pylist(), strict=True)]
        at = 0
        for i, flush in enumerate(flushes):
            sizes = np.frombuffer(size[i], "<u4")
            word = np.repeat(codes[at:at + len(sizes)], sizes)
            at += len(sizes)
            docs_, n = np.frombuffer(doc[i], "<u4").astype(np.int64), np.frombuffer(times[i], "<u4")
            seen, place = np.unique(docs_, return_inverse=True)
            out.append((1, flush, seen.astype("<u4").tobytes(),
                        np.bincount(place, weights=value[word] * n, minlength=len(seen)).astype("<f8").tobytes(),
                        np.bincount(place, weights=(total[word] > 0) * n, minlength=len(seen)).astype("<u4").tobytes()))
        kinds = (pa.int32(), pa.string(), *[pa.binary()] * 3)
        return pa.table({name: pa.array([r[i] for r in out], t)
                         for i, (name, t) in enumerate(zip(("kind", "flush", "a", "b", "c"), kinds, strict=True))})

    def back(table: pa.Table) -> pa.Table:
        texts, parts = table.filter(pc.equal(table["kind"], 0)), table.filter(pc.equal(table["kind"], 1))
        marks = _binary("<i8", texts["a"].to_pylist())
        doc, value, known = (_binary(k, parts[n].to_pylist()) for k, n in (("<u4", "a"), ("<f8", "b"), ("<u4", "c")))
        return pa.table({"mark": pa.array(marks.astype(np.int64)),
                         "rare_log10": pa.array(np.bincount(doc, weights=value, minlength=len(marks))),
                         "rare_known": pa.array(np.bincount(doc, weights=known, minlength=len(marks)).astype(np.int64))})

    sent = docs.select("mark", "text", "train").mapInArrow(
        send, "kind int, bucket int, flush string, a binary, b binary, c binary, d binary, e binary")
    sums = (sent.groupBy("bucket").applyInArrow(lambda t: meet(t), "kind int, flush string, a binary, b binary, c binary")
            .groupBy("flush").applyInArrow(lambda t: back(t), "mark long, rare_log10 double, rare_known long"))
    # Equal rows have equal sums.
    return sums.groupBy("mark").agg(F.max("rare_log10").alias("rare_log10"), F.max("rare_known").alias("rare_known"))


def _model_tokens(words: pa.Array, vocabulary: dict[str, int]) -> np.ndarray:
    """The model's token of each word."""
    place = pc.fill_null(pc.index_in(words, value_set=pa.array(vocabulary, words.type)), -1)
    return np.append(np.fromiter(vocabulary.values(), np.int64, len(vocabulary)), OTHER)[np.asarray(place)]


def _tokens(texts: pa.Array, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(the model's tokens of all texts, offsets)."""
    codes, offsets, words = word_codes(pc.ascii_lower(texts))
    token = _model_tokens(words, vocabulary)
    ends = offsets[1:] + np.arange(len(offsets) - 1)
    out = np.full(len(codes) + len(offsets) - 1, END, dtype=np.int64)
    inside = np.ones(len(out), dtype=bool)
    inside[ends] = False
    out[inside] = token[codes]
    return out, np.concatenate(([0], ends + 1))


def of_turn(docs: DataFrame, turn: int, rounds: int) -> DataFrame:
    """The training texts of one round, by hash; each is in one of the rounds."""
    return docs.where(F.col("train") & (F.pmod(F.xxhash64("mark"), F.lit(rounds)) == turn))


def train(docs: DataFrame, counts: Counts, settings: Settings) -> Gru:
    """Rounds of training in every task and averaging; what reaches the driver is one model for each group."""
    model = Gru.started(settings.shape, counts.by_token)
    vocabulary, together = counts.vocabulary, settings.together
    for turn in range(settings.rounds):
        start = model

        def learn(batches: Iterator[pa.RecordBatch], start: Gru = start) -> Iterator[pa.RecordBatch]:
            own, seen = start.unpacked(start.packed()), 0
            for _, table in _flushes(batches):
                tokens, offsets = _tokens(table["text"].combine_chunks(), vocabulary)
                own.train(tokens, offsets)
                seen += len(tokens)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([seen], pa.int64()),
                     pa.array([own.packed()], pa.binary())], names=["part", "tokens", "model"])

        def average(table: pa.Table) -> pa.Table:
            weight = np.asarray(table["tokens"]).astype(np.float64)
            total = sum(w * np.frombuffer(m.as_py(), "<f4") for w, m in zip(weight, table["model"], strict=True))
            return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()),
                             "tokens": pa.array([int(weight.sum())], pa.int64()),
                             "model": pa.array([(total / weight.sum()).astype("<f4").tobytes()], pa.binary())})

        chosen = of_turn(docs, turn, settings.rounds)
        columns = "part int, tokens long, model binary"
        models, left = chosen.select("text").mapInArrow(learn, columns), chosen.rdd.getNumPartitions()
        while left > together:
            left = -(-left // together)
            models = (models.withColumn("part", F.floor(F.col("part") / together).cast("int"))
                      .groupBy("part").applyInArrow(lambda t: average(t), columns))
        rows = models.collect()
        if rows:
            weight = sum(r["tokens"] for r in rows)
            total = sum(r["tokens"] * np.frombuffer(r["model"], "<f4").astype(np.float64) for r in rows)
            model = model.unpacked((total / weight).astype("<f4").tobytes())
    return model


def model_scores(docs: DataFrame, counts: Counts, model: Gru) -> DataFrame:
    """(doc_id, mark, held_out, n_tokens, n_other, frequent_log10, model_log10) of every row."""
    vocabulary = counts.vocabulary
    value = np.log10(np.array([0, counts.texts, *counts.word_counts], dtype=np.float64) + 0.5)
    value[OTHER] = 0.0

    small = np.min_scalar_type(len(value) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, table in _flushes(batches):
            tokens, offsets = _tokens(table["text"].combine_chunks(), vocabulary)
            held.append((table.drop_columns(["text"]), tokens.astype(small), np.diff(offsets)))
            size += len(tokens)
            if size >= SCORED_TOKENS:
                yield scored(held)
                held, size = [], 0
        if held:
            yield scored(held)

    def scored(held: list) -> pa.RecordBatch:
        table, tokens, sizes = (f([h[i] for h in held]) for i, f in enumerate((pa.concat_tables, np.concatenate, np.concatenate)))
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        row = np.repeat(np.arange(len(table)), sizes)
        other = np.bincount(row, weights=tokens == OTHER, minlength=len(table)).astype(np.int64)
        frequent = np.bincount(row, weights=value[tokens], minlength=len(table))
        del row
        return pa.RecordBatch.from_arrays(
            [*[table[n].combine_chunks() for n in ("doc_id", "mark", "held_out")], pa.array(sizes), pa.array(other),
             pa.array(frequent), pa.array(model.score(tokens, offsets) / np.log(10))],
            names=["doc_id", "mark", "held_out", "n_tokens", "n_other", "frequent_log10", "model_log10"])

    return docs.select("doc_id", "mark", "held_out", "text").mapInArrow(
        run, "doc_id long, mark long, held_out boolean, n_tokens long, n_other long, frequent_log10 double, "
             "model_log10 double")


def score(docs: DataFrame, held_out, settings: Settings | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row for each document; ``held_out`` (a boolean column) marks what is not learned from."""
    settings = settings or Settings()
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), text.alias("text"))
    docs = docs.select("doc_id", "held_out", (~F.col("held_out")).alias("train"), "text",
                       F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.col("doc_id").isNull(), "text").alias("mark"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    counts = corpus_counts(docs, buckets, settings.shape.vocabulary - 2)
    model = train(docs, counts, settings)
    scored = written(model_scores(docs, counts, model), "model-scores")
    rare = written(rare_words(docs, counts, buckets), "rare-words")
    unseen_types = counts.types - len(counts.words) - (counts.texts > 0) + 1
    other_mass = counts.by_token[OTHER] + 0.5 * unseen_types
    known = F.col("n_tokens") - F.col("n_other") - F.lit(0 if counts.texts else 1) + F.coalesce("rare_known", F.lit(0))
    rare_sum = F.coalesce("rare_log10", F.lit(0.0))
    every = float(np.log10(counts.tokens + 0.5 * (counts.types + 1)))
    return scored.join(rare, "mark", "left").select(
        "doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("frequent_log10") + rare_sum - F.col("n_tokens") * F.lit(every)).alias("base_score"),
        (F.col("model_log10") + rare_sum - F.col("n_other") * F.lit(float(np.log10(other_mass)))).alias("score"))
