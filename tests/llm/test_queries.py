"""Every registered operator query against a brute-force version, on awkward and on empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from claimspark.llm import distribution, langcrf, secrets
from claimspark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def result(spark, folder, name):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


def multiset(rows, names):
    return Counter(tuple(r[n] for n in names) for r in rows)


def held_out(doc_id, parts, part):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == part


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_empty_results(spark, empty, name):
    df = QUERIES[name](spark, empty)
    assert df.collect() == []
    assert df.columns


def test_distribution_base_counts_and_verdicts(spark, awkward):
    folder, rows = awkward
    expected = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        often = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        expected.append((doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                         len(lines) - len(set(lines)), len(covered), failed))
    found = result(spark, folder, "op1_distribution")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert multiset(found, names) == Counter(expected)
    assert not any(r["kept"] for r in found if r["base_failed"])
    assert sum(r["kept"] for r in found) > 100


def test_distribution_distances_match_a_direct_computation(spark):
    text = "The cat and the dog, of 12 THE!! " * 10
    refs = {"en": distribution.Reference((.6, .05, .2, .05, .05, 0.0, .05), {"the": .5, "of": .25, "is": .25})}
    df = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    row = distribution.judge(df, refs=refs).first()

    def distance(p, q):
        half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b, strict=True) if x)
        return math.sqrt((half(p, q) + half(q, p)) / 2)

    lower = sum(c.islower() for c in text)
    upper, space, digit = sum(c.isupper() for c in text), text.count(" "), 20
    marks = sum(c in ".,;:!?'\"()-" for c in text)
    counts = np.array([lower, upper, space, marks, digit, 0, 0]) / len(text)
    assert row["class_distance"] == pytest.approx(distance(counts, refs["en"].classes))
    # "the" as The and the ("THE!!" is no form that counts), "and", "of", each 10 times but "the" 20.
    assert row["word_distance"] == pytest.approx(distance([.5, .25, .25, 0], [.5, 0, .25, .25]))


def test_language_and_its_held_out_accuracy(spark, awkward):
    folder, rows = awkward
    found = result(spark, folder, "op2_langcrf")
    assert len(found) == len(rows)
    assert all(r["held_out"] == held_out(r["doc_id"], 4, 2) and 0 <= r["score"] <= 1 for r in found)
    text_of = defaultdict(set)
    lang_of = {}
    for doc_id, text, lang, source, _ in rows:
        text_of[doc_id].add(text)
        if source is not None:
            lang_of[doc_id] = lang
    for r in found:
        if r["doc_id"] is not None and len(text_of[r["doc_id"]]) == 1:
            (text,) = text_of[r["doc_id"]]
            assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
    judged = [r for r in found if r["held_out"] and r["doc_id"] in lang_of]
    assert np.mean([r["lang_pred"] == lang_of[r["doc_id"]] for r in judged]) > 0.9


def test_language_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    scores, move = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    first = np.array([True, False, False, True, False])
    p = langcrf.marginals(scores, first, move)
    total = np.zeros((5, 3))
    for path in np.ndindex(*[3] * 5):
        w = math.exp(sum(scores[t, y] for t, y in enumerate(path))
                     + sum(move[path[t - 1], path[t]] for t in range(1, 5) if not first[t]))
        for t, y in enumerate(path):
            total[t, y] += w
    assert np.allclose(p, total / total.sum(axis=1, keepdims=True))
    many = np.random.default_rng(1).normal(size=(1000, 3))
    starts = np.zeros(1000, bool)
    starts[[0, 300, 301, 640]] = True
    assert np.allclose(langcrf.forward(np.exp(many), starts, np.exp(move), steps=7),
                       langcrf.forward(np.exp(many), starts, np.exp(move), steps=1000))


def test_model_scores_base_and_gain(spark, awkward):
    folder, rows = awkward
    tokens = [WORD.findall((t or "").translate(LOWER)) + ["\n"] for _, t, *_ in rows]
    counts = Counter(w for (d, *_), ws in zip(rows, tokens, strict=True) if not held_out(d, 5, 1) for w in ws)
    n, v = sum(counts.values()), len(counts)
    found = result(spark, folder, "op3_grulm")
    expected = Counter((d, held_out(d, 5, 1), len(ws), sum(counts[w] > 0 for w in ws), n) for (d, *_), ws in
                       zip(rows, tokens, strict=True))
    assert multiset(found, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]) == expected
    base = sorted(sum(math.log10((counts[w] + .5) / (n + .5 * (v + 1))) for w in ws) for ws in tokens)
    assert sorted(r["base_score"] for r in found) == pytest.approx(base)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_ids_of_files(spark, awkward):
    from tokenizers import Tokenizer

    folder, rows = awkward
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = sorted(result(spark, folder, "op4_mixcoder"), key=lambda r: r["start"])
    ids = [(d, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for d, t, *_ in rows]
    assert multiset(found, ["doc_id", "n_tokens", "ids_crc32"]) == Counter(
        (d, len(x), zlib.crc32(x.tobytes())) for d, x in ids)
    keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert keys == sorted(keys)
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]


def test_near_duplicate_classes(spark, awkward):
    folder, rows = awkward
    sets, ids = [], []
    for doc_id, text, *_ in rows:
        ws = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} - {()})
        ids.append(doc_id)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if None not in (ids[i], ids[j]) and sets[i] and sets[j] and ids[i] != ids[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 60)
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least[find(i)], d)
    expected = Counter()
    for i, d in enumerate(ids):
        c = None if d is None else least[find(i)]
        expected[(d, len(sets[i]), c, d == c if d is not None else True)] += 1
    assert multiset(result(spark, folder, "op5_lshforest"), ["doc_id", "n_shingles", "component_id", "kept"]) == expected


def test_secret_spans(spark, awkward):
    folder, rows = awkward
    found = result(spark, folder, "op6_secrets")
    base = {
        "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                              re.I | re.A), 2, 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile("[0-9a-f]+"), 0, 24)}
    order, expected = list(base), Counter()
    for doc_id, text, *_ in rows:
        spans = sorted((m.start(), order.index(k), m.end()) for k, (rx, g, least) in base.items()
                       for m in rx.finditer(text or "") if len(m.group(g)) >= least)
        digest = ",".join(f"{order[k]}:{s}:{e}" for s, k, e in spans)
        n = Counter(order[k] for _, k, _ in spans)
        expected[(doc_id, *[n[k] for k in order], hashlib.sha256(digest.encode()).hexdigest())] += 1
    assert multiset(found, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]) == expected
    assert any("github:0:40" in r["spans"] for r in found)
    assert sum(r["n_assign"] for r in found) >= 3


def test_redaction_covers_every_span(spark):
    df = spark.createDataFrame([("a token = 'abcdef0123456789abcdef0123456789' é password=hunter22 z",), ("clean",), (None,)],
                               "text string")
    found = secrets.find(df)
    texts = [r[0] for r in found.select(secrets.redacted(found["text"], found["spans"])).collect()]
    assert texts == ["a [SECRET]' é [SECRET] z", "clean", None]


def test_private_keys_are_covered_to_their_end(spark):
    lines = ["MIIEpAIBAAKCAQEA7v0/+" + "Zz09" * 10, "q" * 64, "Ab+/=="]
    inside = [
        "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(lines) + "\n-----END RSA PRIVATE KEY-----",
        "-----BEGIN PRIVATE KEY-----\r\n" + "\r\n".join(lines) + "\r\n-----END PRIVATE KEY-----",
        "-----BEGIN OPENSSH PRIVATE KEY-----\\n" + "\\n".join(lines) + "\\n-----END OPENSSH PRIVATE KEY-----",
        "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,3F17F5316E2BAC89\n\n" + "\n".join(lines)
        + "\n-----END RSA PRIVATE KEY-----",
        "-----BEGIN EC PRIVATE KEY-----\n" + "\n".join(lines[:2]),  # its end is missing
    ]
    clean = ["-----BEGIN CERTIFICATE-----\n" + "\n".join(lines) + "\n-----END CERTIFICATE-----",
             "a file that begins with -----BEGIN PRIVATE KEY----- holds a key", "-----BEGIN PRIVATE KEY-----"]
    df = spark.createDataFrame([(f"é {x} after",) for x in inside] + [(x,) for x in clean], "text string")
    found = [{(k, s, e) for k, s, e in r["spans"] if k == "private_key"} for r in secrets.find(df).collect()]
    assert found[:len(inside)] == [{("private_key", 2, 2 + len(x))} for x in inside]
    assert not any(found[len(inside):])


def test_exact_top_k(spark, awkward):
    folder, _ = awkward
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = [(i, np.floor(256 * np.array(v, np.float64)).astype(int)) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = Counter()
    for q, v in {i: v for i, v in vectors if i % 50 == 0}.items():
        scored = sorted((-int(v[:min(len(v), len(w))] @ w[:min(len(v), len(w))]), i) for i, w in vectors if i != q)[:5]
        expected.update((q, r + 1, i, -s) for r, (s, i) in enumerate(scored))
    assert multiset(result(spark, folder, "op7_vafile"), ["query_id", "rank", "vec_id", "score"]) == expected


def test_packing_is_a_partition_without_gaps(spark, awkward):
    from tokenizers import Tokenizer

    folder, rows = awkward
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for d, t, *_ in rows:
        ids[d].append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))
    found = result(spark, folder, "op8_packing")
    for r in found:
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
                   for x in ids[r["doc_id"]])
    for d, texts in ids.items():
        covered = Counter(i for r in found if r["doc_id"] == d for i in range(r["start"], r["start"] + r["length"]))
        assert covered == Counter(i for x in texts for i in range(len(x)))
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


def test_byte_bpe_equals_the_library(spark, awkward):
    import base64

    import tiktoken

    folder, rows = awkward
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = Counter()
    for d, t, *_ in rows:
        x = library.encode_ordinary(t or "")
        expected[(d, len(x), sha(",".join(map(str, x)).encode()), sha((t or "").encode()))] += 1
    assert multiset(result(spark, folder, "op9_bpe"), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == expected


def test_repeated_passages(spark, awkward):
    folder, rows = awkward
    first = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        if d is not None:
            for i in range(len(b) - 49):
                first[b[i:i + 50]] = min(d, first.get(b[i:i + 50], d))
    expected = Counter()
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        if d is not None:
            for i in range(len(b) - 49):
                if first[b[i:i + 50]] < d:
                    gone[i:i + 50] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        expected[(d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    assert multiset(result(spark, folder, "op10_repeats"), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]) \
        == expected
