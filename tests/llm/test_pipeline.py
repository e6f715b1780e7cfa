"""The pipeline's stages, each against brute force on the rows that it is given."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from claimspark.llm import secrets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def stages(spark, awkward, tmp_path_factory):
    """(stage name, rows before, rows after) of a run over the awkward documents."""
    folder, _ = awkward
    out = tmp_path_factory.mktemp("stages")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        after.write.parquet(f"{out}/{name}")
        after = spark.read.parquet(f"{out}/{name}")
        seen.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()],
                     docs.columns, after.columns))
        docs = after
    return {name: rest for name, *rest in seen}


def key(r):
    return r["doc_id"], r["text"]


def test_all_stages_but_the_last_keep_the_columns(stages):
    for name, (_, _, before, after) in stages.items():
        assert (before == after) == (name != "packed")


def test_language_drops_only_texts_without_a_language(stages):
    before, after, *_ = stages["language"]
    gone = Counter(map(key, before)) - Counter(map(key, after))
    assert not Counter(map(key, after)) - Counter(map(key, before))
    assert all(not t or len(WORD.findall(t)) < 20 or not any(map(str.isalpha, t)) for _, t in gone)
    assert any(t is None for _, t in gone)


def test_language_drops_texts_of_unknown_words_and_no_clean_ones(spark, empty):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL")
    columns = rows.columns
    greek = "η γλώσσα αυτού του κειμένου δεν είναι καμία από όσες έμαθε το μοντέλο "
    odd = {-1: greek * 5, -2: "xqzv wkkj pzzt vvqx jjwq zzkp " * 8, -3: greek}  # the last is too short to tell
    extra = rows.limit(1).drop("doc_id", "text", "lang").crossJoin(
        spark.createDataFrame([(i, x, None) for i, x in odd.items()], "doc_id long, text string, lang string"))
    left = dict(corpus_pipeline.STAGES)["language"](spark, rows.unionByName(extra.select(columns)), empty)
    ids = {r["doc_id"] for r in left.collect()}
    clean = {r["doc_id"] for r in rows.collect() if any(map(str.isalpha, r["text"]))}
    assert ids == clean | {-3}


def test_one_document_of_each_near_copy_group_stays(stages):
    before, after, *_ = stages["near_copies"]

    def shingles(text):
        ws = WORD.findall(text.translate(LOWER))
        return frozenset(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) if len(ws) >= 5 else frozenset({tuple(ws)} - {()})

    texts = {r["doc_id"]: shingles(r["text"] or "") for r in before if r["doc_id"] is not None}
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(texts[a] & texts[b])
            if both and 100 * both >= 80 * (len(texts[a]) + len(texts[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert Counter(r["doc_id"] for r in after if r["doc_id"] is not None) == Counter({find(d) for d in ids})


def test_passages_of_smaller_documents_go(stages):
    before, after, *_ = stages["passages"]
    first = {}
    for r in before:
        b = (r["text"] or "").encode()
        for i in range(len(b) - 49):
            if r["doc_id"] is not None:
                first[b[i:i + 50]] = min(r["doc_id"], first.get(b[i:i + 50], r["doc_id"]))
    expected = Counter()
    for r in before:
        b = (r["text"] or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 49):
            if r["doc_id"] is not None and first[b[i:i + 50]] < r["doc_id"]:
                gone[i:i + 50] = True
        text, at = "", 0
        for c in r["text"] or "":
            n = len(c.encode())
            text += "" if gone[at:at + n].any() else c
            at += n
        expected[(r["doc_id"], r["text"] if r["text"] is None else text)] += 1
    assert Counter(map(key, after)) == expected


def test_no_secret_is_left(stages):
    before, after, *_ = stages["without_secrets"]
    texts = defaultdict(list)
    for r in before:
        texts[r["doc_id"]].append(r["text"])
    assert len(before) == len(after)
    for r in after:
        spans = [s for rule in secrets.RULES for s in secrets.spans_of(rule, texts[r["doc_id"]][0] or "")]
        if len(texts[r["doc_id"]]) == 1 and not spans:
            assert r["text"] == texts[r["doc_id"]][0]
        for rule in secrets.RULES[1:3]:
            assert not list(secrets.spans_of(rule, r["text"] or ""))
    assert any("[SECRET]" in (r["text"] or "") for r in after)


def test_packed_pieces_cover_every_id_once(stages):
    from tokenizers import Tokenizer

    before, after, *_ = stages["packed"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
           for r in before}
    assert len(ids) == len(before)
    assert Counter((r["doc_id"], i) for r in after for i in range(r["start"], r["start"] + r["length"])) == \
        Counter((d, i) for d, x in ids.items() for i in range(len(x)))
    assert all(zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in after)


def test_near_copies_between_80_and_85_percent_go(spark, empty):
    words = [f"w{i}" for i in range(104)]
    near = [*words[:50], "other", *words[51:99], "x", *words[100:]]  # 90 of 110 shingles
    far = [w if i % 25 else "y" for i, w in enumerate(words)]  # 83 of 117
    rows = [(1, " ".join(words), "en", "s", 0), (2, " ".join(near), "en", "s", 0), (3, " ".join(far), "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, empty).collect()} == {1, 3}


def test_a_text_that_is_no_copy_stays_beside_one_of_the_same_id_that_is(spark, empty):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(1, a, "en", "s", 0), (2, a, "en", "s", 0), (2, b, "en", "s", 0), (3, b, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, empty).collect()
    assert sorted((r["doc_id"], r["text"]) for r in left) == [(1, a), (2, b)]


def test_run_over_empty_documents(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_further_columns_come_back_whatever_their_names(spark, awkward):
    import corpus_pipeline

    names = ["kept", "removed", "spans", "score", "lang_pred", "gone_id", "text_hash", "kept_text", "Text Hash", "a.b"]
    docs = spark.read.parquet(f"{awkward[0]}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").where("doc_id < 60")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, awkward[0])
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(tuple(r)[5:] == tuple(range(len(names))) for r in rows), name
