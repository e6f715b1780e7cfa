"""Language identification by a linear-chain conditional random field over words (operator 2).

A word's features are the byte n-grams of its lower-case form between two
boundary marks (those that touch a mark are its affixes) and the word itself
where it is in the lexicon, the frequent words of the training sample.
Weights and transitions between languages are learned together.  Training
texts have one language each, so training sequences are spliced from windows
of several texts, which is what code-switched text looks like; the
transitions learn how rarely the language changes.

Every word of a whole text gets its probability of each language by
forward-backward; the text's language has the highest sum, and the score is
that language's mean probability.  That compares the learned languages only;
how far a text is in any of them shows in the share of its words that the
lexicon has.

The model is fitted on at most ``sample_texts`` labelled texts (those with
the smallest hash of their id), from each at most ``windows`` windows of
``window`` words, spread over the text.

Results: a null text or one without a letter is ``und`` with score 0, and so
is every text if nothing could be learned; ties go to the smaller language
name; a text without words has a known share of 0; repeated rows and further
columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimspark.llm.arrowtext import as_array, ragged_take, resting, text_slices, utf8_bytes, with_columns, word_codes

UNDETERMINED = "und"
#: Longest n-gram in bytes, and bits of the table that n-grams and lexicon words are hashed to.
GRAM, TABLE_BITS = 5, 17
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    sample_texts: int = 3000
    windows: int = 4
    window: int = 30
    splice: int = 4
    lexicon_words: int = 5000
    epochs: int = 6
    batch: int = 128
    rate: float = 0.15
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: np.ndarray


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the two-byte capitals U+00C0 to U+00DE in lower case."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    out[capital] += 32
    return out


def word_features(words: pa.Array, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word of each feature, place of the feature in the table, hash of each word)."""
    data, offsets = utf8_bytes(words)
    sizes = np.diff(offsets)
    begin = offsets[:-1] + 2 * np.arange(len(sizes))
    marked = np.zeros(len(data) + 2 * len(sizes), dtype=np.uint8)
    marked[begin], marked[begin + sizes + 1] = 1, 2
    marked[marked == 0] = lowered(data)
    owner = np.repeat(np.arange(len(sizes)), sizes + 2)
    last = np.repeat(begin + sizes + 1, sizes + 2)
    at = np.arange(len(marked))
    h = np.zeros(len(marked), np.uint64)
    of_word, place = [], []
    for n in range(1, GRAM + 1):
        shifted = marked[np.minimum(at + n - 1, len(marked) - 1)] if len(marked) else marked
        h = h * _BASE + shifted + np.uint64(1)
        inside = at + n - 1 <= last
        if n > 1:
            of_word.append(owner[inside])
            place.append(_placed(h[inside] + np.uint64(n)))
    whole = np.zeros(len(sizes), np.uint64)
    for i in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > i)
        whole[some] = whole[some] * _BASE + marked[begin[some] + 1 + i] + np.uint64(1)
    known = np.flatnonzero(np.isin(whole, lexicon))
    of_word.append(known)
    place.append(_placed(whole[known] + np.uint64(99)))
    return np.concatenate(of_word), np.concatenate(place), whole


def _placed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def emissions(words: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Score of each word in each language, the sum of its features' weights, and whether the lexicon has it."""
    word, place, whole = word_features(words, model.lexicon)
    scores = np.column_stack([np.bincount(word, weights=model.weights[place, k], minlength=len(words))
                              for k in range(len(model.languages))])
    return scores, np.isin(whole, model.lexicon)


def forward(scores: np.ndarray, first: np.ndarray, move: np.ndarray, steps: int = 128) -> np.ndarray:
    """Normalised forward messages of many sequences laid end to end; ``first`` marks where each begins.

    The line is cut into lanes of ``steps`` words.  All lanes together work
    out what they do to any incoming message (a matrix), one pass over the
    lanes hands the messages on, and all lanes together run once more.
    """
    n, k = scores.shape
    lanes = -(-n // steps)
    e = np.ones((lanes * steps, k))
    e[:n] = scores
    e = np.ascontiguousarray(e.reshape(lanes, steps, k).transpose(1, 0, 2))
    begins = np.zeros(lanes * steps, dtype=bool)
    begins[:n] = first
    begins = np.ascontiguousarray(begins.reshape(lanes, steps).T)
    effect = np.broadcast_to(np.eye(k), (lanes, k, k)).copy()
    for t in range(steps):
        after = (effect.reshape(-1, k) @ move).reshape(lanes, k, k)
        new = np.flatnonzero(begins[t])
        after[new] = effect[new].sum(axis=2, keepdims=True)
        effect = after * e[t][:, None, :]
        effect /= effect.max(axis=(1, 2), keepdims=True)
    message = np.ones((lanes, k)) / k
    for lane in range(1, lanes):
        v = message[lane - 1] @ effect[lane - 1]
        message[lane] = v / v.sum()
    out = np.empty((steps, lanes, k))
    for t in range(steps):
        after = message @ move
        after[begins[t]] = 1.0
        message = after * e[t]
        message /= message.sum(axis=1, keepdims=True)
        out[t] = message
    return out.transpose(1, 0, 2).reshape(-1, k)[:n]


def marginals(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probability of each language at each word, by forward-backward."""
    if not len(scores):
        return scores
    e = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -50.0))
    move = np.exp(transitions)
    last = np.concatenate((first[1:], [True]))
    ahead = forward(e, first, move)
    back = forward(e[::-1], last[::-1], move.T)[::-1]
    both = ahead * back / e
    return both / both.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], settings: Settings) -> Model | None:
    """Learn weights and transitions from labelled texts by gradient steps on the conditional likelihood."""
    languages = tuple(sorted(set(labels)))
    codes, offsets, words = word_codes(pa.array(texts, pa.string()))
    if not languages or not len(codes):
        return None
    rng = np.random.default_rng(settings.seed)
    windows, window_label = [], []
    for i, label in enumerate(labels):
        size = offsets[i + 1] - offsets[i]
        if size:
            spots = np.unique(np.linspace(0, max(0, size - settings.window), settings.windows).astype(np.int64))
            for s in spots:
                windows.append((offsets[i] + s, min(settings.window, size - s)))
                window_label.append(languages.index(label))
    order = rng.permutation(len(windows))
    windows, window_label = np.array(windows)[order], np.array(window_label)[order]
    used, count = np.unique(ragged_take(codes, windows[:, 0], windows[:, 1]), return_counts=True)
    vocabulary = words.take(pa.array(used))
    *_, whole = word_features(vocabulary, np.zeros(0, np.uint64))
    lexicon = np.unique(whole[np.argsort(-count, kind="stable")[:settings.lexicon_words]])
    word, place, _ = word_features(vocabulary, lexicon)
    local = np.searchsorted(used, codes)  # right for words inside windows, which are all that is looked up

    k = len(languages)
    weights = np.zeros((1 << TABLE_BITS, k))
    transitions = np.zeros((k, k))
    weight_sum, move_sum = np.full(weights.shape, 1e-8), np.full((k, k), 1e-8)
    per_step = settings.batch * settings.splice
    for _ in range(settings.epochs):
        for start in range(0, len(windows), per_step):
            w, y = windows[start:start + per_step], window_label[start:start + per_step]
            at = local[ragged_take(np.arange(len(codes)), w[:, 0], w[:, 1])]
            gold = np.repeat(y, w[:, 1])
            ends = np.cumsum(w[:, 1])
            first = np.zeros(len(at), dtype=bool)
            first[np.concatenate(([0], ends[settings.splice - 1:-1:settings.splice]))] = True
            seen, back = np.unique(at, return_inverse=True)
            chosen = np.isin(word, seen)
            fw, fp = np.searchsorted(seen, word[chosen]), place[chosen]
            own = np.column_stack([np.bincount(fw, weights=weights[fp, j], minlength=len(seen)) for j in range(k)])
            scores = own[back]
            p = marginals(scores, first, transitions)
            slope = p.copy()
            slope[np.arange(len(at)), gold] -= 1
            by_word = np.column_stack([np.bincount(back, weights=slope[:, j], minlength=len(seen)) for j in range(k)])
            touched, column = np.unique(fp, return_inverse=True)
            g = np.column_stack([np.bincount(column, weights=by_word[fw, j]) for j in range(k)])
            weight_sum[touched] += g ** 2
            weights[touched] -= settings.rate * g / np.sqrt(weight_sum[touched])
            g = _transition_slope(scores, first, transitions, gold)
            move_sum += g ** 2
            transitions -= settings.rate * g / np.sqrt(move_sum)
    return Model(languages, weights.astype(np.float32), transitions, lexicon)


def _transition_slope(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, gold: np.ndarray) -> np.ndarray:
    """Expected minus observed counts of each change of language."""
    e = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -50.0))
    move = np.exp(transitions)
    ahead = forward(e, first, move)
    back = forward(e[::-1], np.concatenate((first[1:], [True]))[::-1], move.T)[::-1]
    later = np.flatnonzero(~first)
    pair = ahead[later - 1][:, :, None] * move * back[later][:, None, :]
    expected = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    observed = np.zeros_like(expected)
    np.add.at(observed, (gold[later - 1], gold[later]), 1)
    return expected - observed


@dataclass(frozen=True)
class Judged:
    """Of each whole text: language, score, number of words, share of words in the lexicon."""

    names: list[str]
    score: np.ndarray
    words: np.ndarray
    known: np.ndarray


def predict(texts: pa.Array, model: Model | None) -> Judged:
    data, offsets = utf8_bytes(texts)
    ascii_letter = (((data | 32) >= 97) & ((data | 32) <= 122))
    letters = np.diff(np.concatenate(([0], np.cumsum(ascii_letter)))[offsets]) > 0
    for i in np.flatnonzero(~letters & (np.diff(offsets) > 0)).tolist():
        letters[i] = any(c.isalpha() for c in texts[i].as_py())
    n = len(texts)
    codes, offsets, words = word_codes(texts)
    sizes = np.diff(offsets)
    names, score, known = [UNDETERMINED] * n, np.zeros(n), np.zeros(n)
    if model is None or not letters.any():
        return Judged(names, score, sizes, known)
    first = np.zeros(len(codes), dtype=bool)
    first[offsets[:-1][sizes > 0]] = True
    scores, in_lexicon = emissions(words, model)
    p = marginals(scores[codes], first, model.transitions)
    total = np.zeros((n, len(model.languages)))
    some = offsets[:-1][sizes > 0]
    known[sizes > 0] = np.add.reduceat(in_lexicon[codes].astype(np.int64), some) / sizes[sizes > 0]
    total[sizes > 0] = np.add.reduceat(p, some, axis=0) / sizes[sizes > 0][:, None]
    best = total.argmax(axis=1)
    for i in np.flatnonzero(letters).tolist():
        names[i] = model.languages[best[i]]
        score[i] = min(1.0, total[i, best[i]])
    return Judged(names, score, sizes, known)


def learn(docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model | None:
    """Fit on a bounded sample of the rows that have an id, a text and a language."""
    settings = settings or Settings()
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (F.length(text_col) > 0))
    # The sample is chosen by ids alone, so texts of other rows are not sorted; equal ids count as one choice.
    chosen = (labelled.select(F.col(id_col).alias("id")).withColumn("place", F.xxhash64("id"))
              .orderBy("place", "id").limit(settings.sample_texts).distinct())
    rows = (labelled.join(F.broadcast(chosen), labelled[id_col] == chosen["id"])
            .select(F.col("place"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .orderBy("place", "text", "lang").limit(settings.sample_texts).collect())
    return fit([r["text"] for r in rows], [str(r["lang"]) for r in rows], settings)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score``, ``n_words`` and ``known_share`` (in the place of columns of these names)."""
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
             T.StructField("n_words", T.LongType()), T.StructField("known_share", T.DoubleType())]
    schema = T.StructType([f for f in docs.schema.fields if f.name not in {a.name for a in added}] + added)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_col):
                judged = predict(as_array(pc.fill_null(part.column(text_col), "")), model)
                yield with_columns(part, arrow, lang_pred=pa.array(judged.names, pa.string()), score=pa.array(judged.score),
                                   n_words=pa.array(judged.words), known_share=pa.array(judged.known))

    return docs.mapInArrow(resting(run), schema)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether the CRC-32 of an id as text has this remainder; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % parts == part
