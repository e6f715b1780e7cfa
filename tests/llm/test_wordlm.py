"""The recurrent language model and whole scores against plain loops."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimspark.llm import grulm, wordlm

SMALL = grulm.Shape(vocabulary=14, class_size=5, embedding=4, hidden=6, window=5, lanes=3, updates=2)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_log_probability(model, params, texts):
    """Natural log of each text, token by token, from the formulas."""
    p, h, size = params, model.shape.hidden, model.shape.class_size
    out = []
    for text in texts:
        state, before, total = np.zeros(h), grulm.END, 0.0
        for token in text:
            x = p["emb"][before] @ p["wx"] + p["b"]
            gates = 1 / (1 + np.exp(-(x[:2 * h] + state @ p["wh"][:, :2 * h])))
            update, reset = gates[:h], gates[h:]
            new = np.tanh(x[2 * h:] + (reset * state) @ p["wh"][:, 2 * h:])
            state = (1 - update) * state + update * new
            c, m = (token, None) if token < 2 else (2 + (token - 2) // size, (token - 2) % size)
            logits = state @ p["wc"] + p["bc"]
            total += logits[c] - math.log(np.exp(logits).sum())
            if m is not None:
                logits = state @ p["ww"][c] + p["bw"][c]
                total += logits[m] - math.log(np.exp(logits).sum())
            before = token
        out.append(total)
    return np.array(out)


def made_texts(n, seed):
    """Texts in which each word says much about the next."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        text = [rng.randrange(2, 14)]
        while len(text) < rng.choice([1, 2, 9, 30]):
            text.append(2 + (text[-1] - 2 + rng.choice([1, 1, 1, 5])) % 12)
        out.append([*text, grulm.END])
    return out


def laid(texts):
    return np.array([t for text in texts for t in text]), np.cumsum([0, *map(len, texts)])


def started(texts):
    counts = Counter(t for text in texts for t in text)
    return grulm.Gru.started(SMALL, [counts[i] for i in range(14)])


def test_scores_match_a_plain_loop(monkeypatch):
    monkeypatch.setattr(grulm, "SCORED_ROWS", 11)
    monkeypatch.setattr(grulm, "BLOCK", 4)
    texts = made_texts(40, 1) + [[grulm.END]] * 2 + [[grulm.OTHER, 5, grulm.OTHER, grulm.END]]
    model = started(texts)
    model.train(*laid(texts))
    params = {k: v.astype(np.float64) for k, v in model.params.items()}
    assert model.score(*laid(texts)) == pytest.approx(plain_log_probability(model, params, texts), abs=1e-3)
    assert len(model.score(np.zeros(0, np.int64), np.zeros(1, np.int64))) == 0


def test_an_update_follows_the_gradient_of_the_plain_loop():
    shape = grulm.Shape(vocabulary=14, class_size=5, embedding=4, hidden=6, window=12, lanes=1, updates=1)
    texts = [[3, 4, 9, 3, grulm.END], [0, 13, 4, grulm.END]]
    model = grulm.Gru.started(shape, [2, 2, *range(12, 0, -1)])
    before = {k: v.astype(np.float64) for k, v in model.params.items()}
    model.train(*laid(texts))
    rng = np.random.default_rng(0)
    for name, old in before.items():
        moved = (model.params[name].astype(np.float64) - old).reshape(-1) / -shape.rate
        real = np.flatnonzero(old.reshape(-1) > -1e3)
        for at in rng.choice(real, min(25, len(real)), replace=False):
            loss = []
            for step in (1e-5, -1e-5):
                changed = {k: v.copy() for k, v in before.items()}
                changed[name].reshape(-1)[at] += step
                loss.append(-plain_log_probability(model, changed, texts).sum())
            slope = (loss[0] - loss[1]) / 2e-5 / 9
            assert moved[at] == pytest.approx(slope / math.sqrt(1e-6 + slope ** 2), abs=0.03), (name, at)


def test_training_gains_on_held_out_texts():
    texts, other = made_texts(3000, 2), made_texts(300, 3)
    model = started(texts)
    plain = model.score(*laid(other)).sum()
    for _ in range(3):
        model.train(*laid(texts))
    assert model.score(*laid(other)).sum() > 0.75 * plain


def test_whole_scores_match_a_plain_loop(spark, monkeypatch):
    rng = random.Random(7)
    words = [f"W{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(40)], k=rng.choice([0, 1, 7, 40]))))
            for i in range(60)] + [(60, None), (61, "never seen\x0bwords\there"), (60, None), (None, "W1 w1 W39")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))
    kept = []

    def train(docs, counts, settings):
        kept.append((grulm.Gru.started(SMALL, counts.by_token), counts))
        return kept[0][0]

    monkeypatch.setattr(wordlm, "train", train)
    found = wordlm.score(docs, held, wordlm.Settings(SMALL)).collect()
    (model, counts), = kept
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for _, t in rows]
    seen = Counter(w for (i, _), ws in zip(rows, texts, strict=True) if i is None or i % 5 != 1 for w in ws)
    assert dict(zip(counts.words, counts.word_counts, strict=True)) == dict(
        sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:12])
    outside = sum(n for w, n in seen.items() if w not in counts.words)
    mass = outside + 0.5 * (len(seen) - len(counts.words) + 1)
    params = {k: v.astype(np.float64) for k, v in model.params.items()}
    tokens = [[counts.vocabulary.get(w, grulm.OTHER) for w in ws] + [grulm.END] for ws in texts]
    rare = [sum(math.log10((seen[w] + 0.5) / mass) for w in ws if w not in counts.words) for ws in texts]
    expected = plain_log_probability(model, params, tokens) / math.log(10) + rare
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    got = sorted(((r["doc_id"], r["score"]) for r in found), key=key)
    want = sorted(zip([i for i, _ in rows], expected.tolist(), strict=True), key=key)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-3)


def test_texts_scored_together_a_few_lanes_at_a_time_match_a_plain_loop(monkeypatch):
    monkeypatch.setattr(grulm, "SCORED_LANES", 3)
    texts = made_texts(20, 4) + [[grulm.END]]
    model = started(texts)
    params = {k: v.astype(np.float64) for k, v in model.params.items()}
    tokens, offsets = laid(texts)
    assert model.score(tokens.astype(np.uint8), offsets) == pytest.approx(plain_log_probability(model, params, texts), abs=1e-3)


def test_softmax_of_very_large_and_very_small_logits():
    logits = np.array([[1000, 998, -1000], [-1000, -1001, -999], [0, 1, 2]], np.float32)
    choice = np.array([1, 2, 0])
    with np.errstate(over="ignore"):
        found, slope = grulm._chosen(logits.copy(), choice, True)
    wide = logits.astype(np.float64) - logits.max(axis=1)[:, None]
    share = np.exp(wide) / np.exp(wide).sum(axis=1)[:, None]
    assert found == pytest.approx(np.log(share[np.arange(3), choice]), abs=1e-4)
    assert slope == pytest.approx(share - np.eye(3)[choice], abs=1e-5)


def test_words_go_to_buckets_and_tokens_without_a_loop_over_them():
    rng = random.Random(5)
    words = ["", "ä", "a" * 70, "a" * 71, *{"".join(rng.choices("abcé", k=rng.randint(1, 6))) for _ in range(300)}]
    array, chosen = pa.array(words, pa.large_string()), np.arange(1, len(words), 2)
    groups = list(wordlm._by_bucket(array, chosen, 7))
    assert sorted(i for _, some, _ in groups for i in some) == chosen.tolist() and len({b for b, _, _ in groups}) == len(groups) > 3
    assert all(own == " ".join(words[i] for i in some).encode() for _, some, own in groups)
    assert list(wordlm._by_bucket(array, chosen[:0], 7)) == []
    shuffled = rng.sample(words, len(words))
    again = wordlm._hashes(pa.array(shuffled, pa.large_string()))
    assert dict(zip(words, wordlm._hashes(array))) == dict(zip(shuffled, again)) and len(set(again)) == len(words)
    vocabulary = {w: i + 2 for i, w in enumerate(words[5:50])}
    assert wordlm._model_tokens(array, vocabulary).tolist() == [vocabulary.get(w, grulm.OTHER) for w in words]
    assert wordlm._model_tokens(array, {}).tolist() == [grulm.OTHER] * len(words)
    count = np.array([rng.randint(1, 4) for _ in words])
    for most in (1, 40, len(words), 999):
        best = sorted(range(len(words)), key=lambda i: (-count[i], words[i]))[:most]
        assert sorted(wordlm._most(count, array, most).tolist()) == sorted(best)
