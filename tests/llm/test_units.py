"""Parts of the operators on their own."""

import random
import re
import tracemalloc
import uuid

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimspark.llm import arrowtext, automaton, grulm, lshforest, mixcoder, packing, repeats, vafile, wordbpe, wordlm
from claimspark.llm import components as connected
from claimspark.llm.components import components
from claimspark.llm.queries import public_file


def test_blocks_of_ids_round_trip_in_any_company():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 65536, int(n)).astype(np.uint16) for n in rng.integers(0, 200, 20)]
    blocks += [np.zeros(0, np.uint16), np.zeros(900, np.uint16), np.tile(np.arange(7, dtype=np.uint16), 100)]
    frames = mixcoder.encode_blocks(blocks)
    for got, want in zip(mixcoder.decode_blocks(frames[::-1])[::-1], blocks, strict=True):
        assert (got == want).all() and len(got) == len(want)
    assert (mixcoder.decode_blocks([frames[3]])[0] == blocks[3]).all()
    assert len(frames[-1]) < 200 and len(frames[-2]) < 200  # what repeats is coded in few bytes


def test_damaged_blocks_are_refused():
    frame = mixcoder.encode_blocks([np.arange(50, dtype=np.uint16)])[0]
    for bad in (frame[:-1], b"XXXX" + frame[4:], frame[:-3] + bytes([frame[-3] ^ 255]) + frame[-2:]):
        with pytest.raises(ValueError):
            mixcoder.decode_blocks([bad])


@pytest.mark.parametrize("pattern", ["ab+c?", "(a|bc)*d", "[a-c]{2,}d", "a{3}", "x(y|z){2}"])
def test_automaton_accepts_where_a_match_ends(pattern):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdxyz ") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    row, end, _ = automaton.scan(automaton.compiled([(pattern, False)]), data, offsets, lanes=7)
    found = set(zip(row.tolist(), end.tolist(), strict=True))
    rx = re.compile(pattern)
    want = {(i, e) for i, t in enumerate(texts) for e in range(1, len(t) + 1)
            if any(rx.fullmatch(t, s, e) for s in range(e))}
    assert found == want


def test_plan_uses_no_length_more_often_than_it_occurs():
    rng = np.random.default_rng(2)
    histogram = np.bincount(rng.integers(1, 64, 500), minlength=65)
    plan = packing.plan_tails(histogram, 64)
    filled = {}
    for length in np.flatnonzero(histogram):
        ranks = np.arange(histogram[length])
        sequence, offset = plan.place(np.full(len(ranks), length), ranks)
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            if s >= 0:
                filled.setdefault(s, []).append((o, int(length)))
    assert sorted(filled) == list(range(plan.n_sequences))
    for pieces in filled.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at == 64
    assert sum(len(x) for x in filled.values()) > 0.8 * histogram.sum()


def test_bounds_hold_and_ties_go_to_smaller_ids():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-50, 50, (400, 6))
    vectors[100:140] = vectors[7]
    queries = rng.integers(-50, 50, (9, 6))
    bounds = vafile.Approximation(vectors).upper_bounds(queries.astype(float))
    assert (bounds >= queries @ vectors.T - 1e-6).all()
    ids = rng.permutation(400)
    for q, got, score in vafile.top_of_block(np.arange(1000, 1009), queries, ids, vectors, 5):
        s = vectors @ queries[q - 1000]
        want = np.lexsort((ids, -s))[:5]
        assert got.tolist() == ids[want].tolist() and score.tolist() == s[want].tolist()


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 101, 4000).astype(np.uint8)
    data[3000:3200] = data[500:700]
    a = repeats.anchors(data, np.array([0, 2000, 4000]), 50, 24)
    of = {}
    for at, first, last in zip(a.at.tolist(), a.first.tolist(), a.last.tolist(), strict=True):
        for s in range(first, last + 1):
            assert s not in of
            of[s] = at - s
    assert sorted(of) == [*range(0, 1951), *range(2000, 3951)]
    assert all(of[500 + i] == of[3000 + i] for i in range(151))


def test_later_starts_are_strings_of_a_smaller_id_at_the_same_place():
    rng = np.random.default_rng(11)
    length, most_left, n = 12, 5, 600
    place = rng.integers(0, most_left + 1, n)
    size = place + rng.integers(length - place, length + 1)
    anchor = rng.integers(0, 40, n).astype(np.uint64)
    # Zero bytes at the end of a region are text where its size counts them.
    body = rng.choice(np.array([0, 97], np.uint8), (n, length + most_left), p=[0.03, 0.97])
    body[np.arange(length + most_left) >= size[:, None]] = 0
    ids = rng.integers(0, 200, n)
    first, last = repeats.later_starts(body, place, size, anchor, ids, length, most_left)
    strings = {}
    for i in range(n):
        for s in range(size[i] - length + 1):
            if s <= place[i]:
                key = (anchor[i], place[i] - s, body[i, s:s + length].tobytes())
                strings.setdefault(key, []).append((ids[i], i, s))
    later = {}
    for rows in strings.values():
        for number, i, s in rows:
            if number > min(rows)[0]:
                later.setdefault(i, []).append(s)
    assert len(later) > 100
    assert [(min(later.get(i, [-1])), max(later.get(i, [-1]))) for i in range(n)] == list(zip(first, last, strict=True))


def test_equal_rows_are_neighbours():
    rows = np.random.default_rng(12).integers(0, 2, (500, 8)).astype(np.uint8).repeat(2, axis=1)
    order, same = repeats.equal_rows(rows)
    assert sorted(order) == list(range(500)) and (~same).sum() == len({r.tobytes() for r in rows})
    assert all((rows[order[i]] == rows[order[i - 1]]).all() for i in np.flatnonzero(same))


def test_regions_cover_every_row_that_shares_a_prefix():
    rng = np.random.default_rng(6)
    labels = np.sort(rng.integers(0, 3, (3000, lshforest.STRETCH)), axis=0)
    labels = labels[np.lexsort(labels.T[::-1])]
    equal = np.zeros(labels.shape, bool)
    equal[1:] = labels[1:] == labels[:-1]
    lcp = np.where(equal.all(axis=1), lshforest.STRETCH, equal.argmin(axis=1))
    covered = np.zeros(len(labels), int)
    for first, last in lshforest._regions(lcp):
        for f, e in zip(first, last, strict=True):
            assert e - f <= lshforest.REGION
            covered[f:e] += 1
    assert (covered == 1).all()


def test_true_pairs_in_a_crowd_with_a_common_passage_are_found(spark):
    rng = np.random.default_rng(8)
    n, trees, stretch = 300, lshforest.TREES, lshforest.STRETCH
    # Every node has the passage's values in half of the trees; a pair has them in the same 12 trees and nothing else in common.
    hot = rng.integers(0, 1 << 16, trees * stretch)
    held = rng.random((n, trees)) < 0.5
    pairs = [(0, n - 1), (1, n - 2), (70, 200)]
    for a, b in pairs:
        held[[a, b]] = np.isin(np.arange(trees), rng.permutation(trees)[:12])
    values = np.where(np.repeat(held, stretch, axis=1), hot, rng.integers(0, 1 << 16, (n, trees * stretch)))
    rows = [(b"%03d" % i, bytearray(v.astype(">u2").tobytes())) for i, v in enumerate(values)]
    nodes = spark.createDataFrame([(bytearray(k), s) for k, s in rows], "key binary, signature binary")
    agree = (values[:, None] == values).mean(axis=2) >= 0.69
    assert {(a, b) for a, b in zip(*np.nonzero(agree), strict=True) if a < b} == set(pairs)
    found = {tuple(sorted((int(bytes(a)), int(bytes(b))))) for a, b in lshforest.candidate_links(nodes, 0.69).collect()}
    assert found == set(pairs)


def test_candidates_follow_the_threshold():
    assert (lshforest.agreement(85), lshforest.depth_for(85)) == (0.69, 4)
    assert (lshforest.agreement(80), lshforest.depth_for(80)) == (0.62, 3)
    assert all(lshforest.miss_rate(p, lshforest.depth_for(p)) <= lshforest.MISS for p in range(50, 101))


def test_every_training_text_trains_the_recurrent_model(spark, tmp_path, monkeypatch):
    texts = [(i, f"t{i}", i % 5 != 1) for i in range(200)]
    docs = spark.createDataFrame(texts, "mark long, text string, train boolean")
    words = tuple(t for _, t, _ in texts)
    counts = wordlm.Counts(320, 161, 160, words, tuple(int(t) for *_, t in texts))
    out = str(tmp_path)

    def noted(self, tokens, offsets):
        np.save(f"{out}/{uuid.uuid4().hex}", tokens)

    class Noting(grulm.Gru):
        train = noted

        def unpacked(self, data):
            own = super().unpacked(data)
            return Noting(own.shape, own.n_words, own.params)

    monkeypatch.setattr(wordlm, "Gru", Noting)
    wordlm.train(docs, counts, wordlm.Settings())
    seen = np.concatenate([np.load(f) for f in tmp_path.glob("*.npy")])
    assert sorted((seen[seen >= 2] - 2).tolist()) == [i for i, _, t in texts if t]


def test_components_of_a_long_chain(spark):
    rows = [(f"{i:03d}", f"{i + 1:03d}") for i in range(60)] + [("900", "901"), ("901", "901")]
    found = dict(components(spark.createDataFrame(rows, "a string, b string")).collect())
    assert {found[f"{i:03d}"] for i in range(61)} == {"000"} and found["901"] == found["900"] == "900"


@pytest.mark.parametrize("few", [0, 30, 10_000])
def test_links_of_closely_linked_nodes_are_gone_after_a_round(spark, monkeypatch, few):
    rng = random.Random(few)
    names = [f"{i:04d}" for i in range(400)]
    # Three groups whose nodes have 16 links each, and a path.
    groups = [names[s:s + 100] for s in (0, 100, 200)]
    rows = [(x, rng.choice(g)) for g in groups for x in g for _ in range(16)] + list(zip(names[300:], names[301:], strict=False))
    written, linked = lshforest.written, []

    def noted(df, name):
        out = written(df, name)
        if name == "links":
            linked.append(out.count())
        return out

    monkeypatch.setattr(connected, "written", noted)
    monkeypatch.setattr(connected, "FEW", few)
    found = components(spark.createDataFrame(rows, "a string, b string")).collect()
    assert len(found) == 400 and all(label == f"{int(node) // 100 * 100:04d}" for node, label in found)
    # Before, every round joined all links again.
    assert sum(linked) < 1.5 * linked[0]


def crowd(rng, n, outsiders):
    """Nodes alike in the first half of each stretch; all but ``outsiders`` are near copies, and the last is near the first outsider."""
    shape = (n, lshforest.TREES, lshforest.STRETCH)
    values = np.broadcast_to(rng.integers(0, 1 << 16, shape[1:]), shape).copy()
    values[:, :, 7] = np.where(rng.random(shape[:2]) < 0.5, values[:, :, 7], rng.integers(0, 1 << 16, shape[:2]))
    values[n - outsiders:, :, 4:] = rng.integers(0, 1 << 16, (outsiders, lshforest.TREES, 4))
    values[-1, :, 4:7] = values[n - outsiders, :, 4:7]
    return values.reshape(n, -1)


def test_nodes_of_one_group_do_not_meet_again_in_a_crowd(spark, monkeypatch):
    monkeypatch.setattr(lshforest, "LEAST_CROWD", 8)
    n, outsiders = 200, 9
    values = crowd(np.random.default_rng(4), n, outsiders)
    agree = (values[:, None] == values).mean(axis=2) >= 0.69
    bulk = n - outsiders
    assert agree[:bulk, :bulk].all() and not agree[:bulk, bulk:].any()
    assert {(a, b) for a, b in zip(*np.nonzero(agree[bulk:, bulk:]), strict=True) if a < b} == {(0, outsiders - 1)}
    rows = [(bytearray(b"%03d" % i), bytearray(v.astype(">u2").tobytes()), 0, bytearray(v[:8].astype(">u2").tobytes()), n)
            for i, v in enumerate(values)]
    crowded = spark.createDataFrame(rows, "key binary, signature binary, tree int, label binary, n long")
    rough = crowded.where(F.col("key") < F.lit(b"%03d" % bulk)).select(F.col("key").alias("node"), F.lit(b"000").alias("label"))
    # 16 blocks; before, every node came to each of them.
    assert lshforest.dealt_crowds(crowded, rough).count() <= n + 16 * outsiders
    assert {tuple(sorted(map(int, map(bytes, x)))) for x in lshforest.crowd_links(crowded, rough, 0.69).collect()} == {(bulk, n - 1)}
    # A group that is no more in one piece is linked to one again.
    torn = rough.withColumn("label", F.when(F.col("node") < F.lit(b"120"), F.lit(b"000")).otherwise(F.lit(b"120")))
    found = dict(components(lshforest.crowd_links(crowded, torn, 0.69).unionByName(torn.toDF("a", "b"))).collect())
    assert {bytes(v) for k, v in found.items() if int(bytes(k)) < bulk} == {b"000"}


def test_words_are_cut_at_the_six_ascii_white_spaces_only():
    import pyarrow as pa

    texts = ["a\x0bb\x0cc\rd\ne\tf g", "x\x1cy\x85z\xa0w", "", None, "  lead", "tail  "]
    codes, offsets, words = arrowtext.word_codes(pa.array(texts))
    got = [[words[int(c)].as_py() for c in codes[s:e]] for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def near_copy_texts(rng, n, edits, words=120):
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits)):
            text[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(text))
    return out


def brute_components(texts, percent):
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("edits", [3, 9])
def test_large_groups_are_contracted_and_lose_no_link(spark, monkeypatch, edits):
    # With few edits one component holds nearly all, with many most nodes are left over.
    monkeypatch.setattr(lshforest, "BLOCK", 16)
    texts = near_copy_texts(random.Random(edits), 300, edits)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lshforest.features(docs, 5, "doc_id", "text").checkpoint()
    nodes = rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("signature").alias("signature")).checkpoint()
    rough = nodes.select(F.col("key").alias("node"), F.lit(b"one").alias("label"))
    links = lshforest.exact_links(docs, nodes, rough, 5, 85, "doc_id", "text").collect()
    id_of = {bytes(r["key"]): r["doc_id"] for r in nodes.collect()}
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(id_of[bytes(a)]), find(id_of[bytes(b)])
        root[max(x, y)] = min(x, y)
    expected = brute_components(texts, 85)
    assert all((find(id_of[bytes(r["key"])])) == min(j for j, e in enumerate(expected) if e == expected[r["doc_id"]])
               for r in rows.collect() if id_of[bytes(r["key"])] == r["doc_id"])
    if edits == 3:
        assert len(links) < 3 * len(texts)


def test_no_small_region_is_cut_by_batches(spark):
    # 400 pairs alike in every value: whatever the batches and ranges, each pair is found in each tree.
    rng = np.random.default_rng(3)
    signs = rng.integers(0, 1 << 16, (400, lshforest.TREES * lshforest.STRETCH), dtype=np.uint16)
    rows = [(f"{i:03d}{k}".encode(), signs[i].astype(">u2").tobytes()) for i in range(400) for k in "ab"]
    nodes = spark.createDataFrame(rows, "key binary, signature binary").repartition(5)
    keep = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = {(bytes(a), bytes(b)) for a, b in lshforest.candidate_links(nodes, 0.69).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", keep)
    assert found == {(f"{i:03d}a".encode(), f"{i:03d}b".encode()) for i in range(400)}


@pytest.mark.parametrize("size, dims", [(2 ** 20, 8), (2 ** 28, 8), (2 ** 40, 512), (2 ** 60, 16)])
def test_top_of_block_is_exact_for_components_of_any_size(size, dims):
    rng = np.random.default_rng(size % 97 + dims)
    # Vectors a unit apart in one component: near ties that doubles cannot tell apart.
    base = rng.integers(-size, size, dims)
    vectors = np.array([[int(x) for x in base] for _ in range(60)], dtype=object)
    for i in range(60):
        vectors[i][i % dims] += int(rng.integers(-3, 4)) * max(1, size >> 50)
    as_doubles = vectors.astype(float)
    whole = [[int(x) for x in v] for v in as_doubles]
    queries = as_doubles[:7]
    ids = np.arange(60)
    for q, got, score in vafile.top_of_block(np.arange(7), queries, ids, as_doubles, 5):
        exact = sorted((-sum(a * b for a, b in zip(whole[q], whole[i], strict=True)), i) for i in range(60) if i != q)[:5]
        assert [(-int(s), int(i)) for i, s in zip(got, score, strict=True)] == exact


def test_vectors_with_large_components_take_part(spark):
    rows = [(50, [2.0 ** 22, 1.0]), (1, [2.0 ** 21, 0.5]), (2, [1.0, -(2.0 ** 25)]), (3, [float("nan"), 1.0]), (4, [float("-inf"), 0.0])]
    vectors = vafile.integer_vectors(spark.createDataFrame(rows, "i long, v array<double>"), "i", "v", 256)
    assert sorted(r["id"] for r in vectors.collect()) == [1, 2, 50]
    found = vafile.top_k(vectors, vectors.where("id = 50"), k=5, block_vectors=2).collect()
    assert [(r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [
        (1, 2 ** 30 * 2 ** 29 + 256 * 128), (2, 2 ** 30 * 256 - 256 * 2 ** 33)]


def test_a_score_beyond_64_bits_is_no_wrong_number(spark):
    rows = [(50, [2.0 ** 30, 1.0]), (1, [2.0 ** 30, 0.5])]
    vectors = vafile.integer_vectors(spark.createDataFrame(rows, "i long, v array<double>"), "i", "v", 256)
    with pytest.raises(Exception, match="int too big|OverflowError|too large"):
        vafile.top_k(vectors, vectors.where("id = 50"), k=1).collect()


def test_tokenising_a_large_batch_holds_the_arrays_of_a_slice_only():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 6))) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=600)) for _ in range(3000)] + [None, "", "last"]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    vocabulary = public_file("word_bpe_49k.json")
    tokenizer = wordbpe.word_tokenizer(vocabulary())
    whole, offsets = tokenizer.encode(batch.column("text"), 1)
    tracemalloc.start()
    try:
        docs, ids, counts = [], [], []
        for piece, some, ends in wordbpe.encoded(iter([batch]), vocabulary, 1, corpus_pipeline.PACKED_BYTES):
            docs += piece.column("doc_id").to_pylist()
            ids.append(some)
            counts.append(np.diff(ends))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert docs == list(range(len(texts)))
    assert (np.concatenate(ids) == whole).all() and (np.concatenate(counts) == np.diff(offsets)).all()
    assert peak - whole.nbytes < 5 * batch.column("text").nbytes, peak
