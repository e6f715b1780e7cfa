"""Mixture, manifest and alignment against brute force, on awkward and on empty tables."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from claimspark.llm import crosstok, manifest, mixture
from claimspark.llm.numbering import numbered
from claimspark.llm.oracle import ORACLE
from claimspark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def result(spark, folder, name):
    return [r.asDict() for r in QUERIES[name](spark, folder).collect()]


def multiset(rows, names):
    return Counter(tuple(r[n] for n in names) for r in rows)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_pareto", "op12_postorder"])
def test_awkward_table_matches_sql(spark, awkward, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{awkward[0]}/documents.parquet/*.parquet')")
    rel = con.sql(ORACLE[name])
    names = rel.columns
    expected = Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rel.fetchall())
    found = result(spark, awkward[0], name)
    assert Counter(tuple(round(r[n], 9) if isinstance(r[n], float) else r[n] for n in names) for r in found) == expected


def test_mixture_meets_its_targets(spark, awkward):
    folder, rows = awkward
    found = result(spark, folder, "op11_pareto")
    sizes = Counter((d, len(WORD.findall(t or ""))) for d, t, *_ in rows)
    assert multiset(found, ["doc_id", "size"]) == sizes
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    total = Counter()
    for d, t, _, source, _ in rows:
        total[source] += len(WORD.findall(t or ""))
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        left = 1.5 * sum(total.values()) - sum(target.values())
        share = left / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if share * weight[s] > 2 * total[s]}
        if not above:
            break
        target.update({s: 2.0 * total[s] for s in above})
        open_ -= above
    target.update({s: share * weight[s] for s in open_})
    assert sum(target.values()) == pytest.approx(1.5 * sum(total.values()))
    expected = Counter(round(target[source], 6) for _, _, _, source, _ in rows)
    assert Counter(round(r["target"], 6) for r in found) == expected
    taken = defaultdict(int)
    for r in found:
        taken[round(r["target"], 6), r["source_size"]] += r["taken"]
    # Sources with one target and size, if any, stand together here.
    for (goal, size), words in taken.items():
        alike = sum(round(target[s], 6) == goal and total[s] == size for s in order)
        assert 0 <= alike * goal - words < 3 * alike


def test_mixture_follows_pareto_order_and_reruns_agree(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(["w"] * rng.choice([1, 3, 20, 300])), rng.choice("ab")) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = mixture.mix(df, weights=(1, 4), percent=60, most=2, seed="s").collect()
    again = mixture.mix(df.repartition(7), weights=(1, 4), percent=60, most=2, seed="s").collect()
    assert Counter(found) == Counter(again)
    other = mixture.mix(df, weights=(1, 4), percent=60, most=2, seed="t").collect()
    assert Counter(found) != Counter(other)
    source = {d: s for d, _, s in docs}
    for s in "ab":
        mine = [r for r in found if source[r["doc_id"]] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) < 2
        expected = sum(r["rate"] * r["size"] for r in mine)
        assert expected == pytest.approx(mine[0]["target"])
        # At most one document is cut; the shares of a size class come near its rate.
        assert sum(r["taken"] % r["size"] > 0 for r in mine) <= 1
        assert len({round(r["rate"], 9) for r in mine}) == 4
        for size in (1, 3, 20, 300):
            of = [r for r in mine if r["size"] == size]
            assert abs(sum(r["taken"] / size for r in of) / len(of) - of[0]["rate"]) < .08


def test_mixture_shares_the_border_among_rows_alike(spark):
    df = spark.createDataFrame([(None, "a b c d e", "x")] * 1000 + [(1, "a b", "y")], "doc_id long, text string, source string")
    found = mixture.mix(df, weights=(3, 1), percent=90, most=2).collect()
    mine = [r for r in found if r["doc_id"] is None]
    assert len({r["taken"] for r in mine}) == 1
    assert 0 <= mine[0]["target"] - sum(r["taken"] for r in mine) < 1000 + 1


def test_places_within_groups(spark):
    rows = [(g, i % 50) for g, n in (("a", 400), (None, 70), ("b", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, x int")
    found = numbered(df, ["g"], ["x"], "at", "of").collect()
    for g, n in (("a", 400), (None, 70), ("b", 1)):
        mine = sorted((r["at"], r["x"]) for r in found if r["g"] == g)
        assert [a for a, _ in mine] == list(range(n)) and [x for _, x in mine] == sorted(x for _, x in mine)
    assert {r["of"] for r in found} == {400, 70, 1}


def brute_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([sha("".join(x[i:i + 2])) for i in range(0, len(x), 2)])
    return levels


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 8, 11, 16, 21, 37])
def test_log_positions_are_those_of_appending(n):
    leaves = [sha(str(i)) for i in range(n)]
    levels = brute_levels(leaves)
    log = manifest.append_log(leaves, manifest.height(n))
    assert len(log) == sum(map(len, levels))
    for h, nodes in enumerate(levels):
        for i, x in enumerate(nodes):
            assert log[manifest.position(h, i, n)] == x
    for i, leaf in enumerate(leaves):
        path = manifest.siblings(log, i, n, manifest.height(n))
        assert manifest.fold(leaf, path) == levels[-1][0]


def test_builders_of_any_size_give_one_root_and_the_same_proofs(spark, awkward):
    folder, rows = awkward
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    runs = [Counter(manifest.proofs(docs, tampered, bits=b).collect()) for b in (3, 12)]
    assert runs[0] == runs[1]

    def leaf(d, text, lang, source, n):
        fields = [None if x is None else str(x) for x in (d, source, lang, n, text)]
        return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in fields))

    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    subroots = [brute_levels([x[2] for x in sorted(trees[k], key=lambda x: x[:3])])[-1][0] for k in order]
    root = brute_levels(subroots)[-1][0]
    expected = Counter()
    for k, sub in zip(order, subroots, strict=True):
        for *_, x, r in trees[k]:
            bad = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            expected[(r[0], x, sub, root, not bad)] += 1
    found = Counter()
    for r, n in runs[0].items():
        found[(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["verified"])] += n
        assert r["verified"] == (r["folded_root"] == r["root"])
    assert found == expected


def test_a_single_leaf_is_the_root(spark):
    df = spark.createDataFrame([(5, "t", None, "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    row = manifest.proofs(df, F.lit(False)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] == sha("1:51:s-1:11:t")
    assert row["proof_sha256"] == sha("") and row["verified"]


def brute_alignment(texts):
    """Groups, links and counts of whole texts, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {x: chr(x) for x in printable}
    for i, x in enumerate(x for x in range(256) if x not in printable):
        char[x] = chr(256 + i)
    byte = {c: x for x, c in char.items()}
    with open(a_path) as f:
        entries = {i: bytes(byte[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items() if all(c in byte for c in t)}

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        xs, ys = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bx, by = [entries[i] for i in xs], [of_b(i) for i in ys]
        if b"".join(bx) != (" " + text).encode() or b"".join(by) != (" " + text).encode():
            docs.append(None)
            continue
        spans = []
        for ids, parts in ((xs, bx), (ys, by)):
            at, out = 0, []
            for i, p in zip(ids, parts, strict=True):
                out.append((i, at, at + len(p)))
                at += len(p)
            spans.append(out)
        groups = []
        for side in (0, 1):
            ends, at, held = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]}), 0, defaultdict(list)
            for i, _, t in spans[side]:
                while ends[at] < t:
                    at += 1
                held[at].append(str(i))
            groups.append([",".join(held[g]) for g in range(len(ends))])
        groups = [f"{x}|{y}" for x, y in zip(*groups, strict=True)]
        links, j = [], 0
        for i, s, t in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < t:
                links.append((i, spans[1][k][0]))
                k += 1
        docs.append((len(xs), len(ys), len(groups), links, sha(";".join(groups))))
    counts = Counter(p for d in docs if d for p in set(d[3]))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], d[2], len(d[3]), sum(counts[p] == best[p[0]] for p in d[3]), sum(counts[p] for p in d[3]), d[4])
            for d in docs]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
HARD = ["a▁b", "▁", " ", "\n", "a\n b\n\n  c\t\td  ", ";\r\n}\r\n  x", "x  y　z   w", "a\x1c b\x85 c", "<s> </s> <unk> <0x41>",
        "<|endoftext|> it's they'LL", "\x00 \x7f", "𝒳𝒴 🙂🙂 é é", "naïve coöperation\r", "\rword", "\x0bword\x0c word", "一二三 四五六",
        "0123456789 12,345.67", "    def f(x):\n        return x\n", "ⅷ ﬁ ½", "ends in a space ", "two  ", "x\n "]


def test_alignment(spark, awkward):
    folder, rows = awkward
    expected = brute_alignment([t for _, t, *_ in rows])
    assert multiset(result(spark, folder, "op13_crosstok"), COLUMNS) == Counter(
        (d, *x) for (d, *_), x in zip(rows, expected, strict=True))


def test_alignment_of_hard_texts_in_small_flushes(spark, monkeypatch):
    rng = random.Random(9)
    parts = [*" \t\n\r\x0b\x0c", *"ab.;})é☃ 　\x1c'", "the", " and", "<s>", "it's", "  ", "\r\n", "日本"]
    texts = HARD + ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(300)]
    monkeypatch.setattr(crosstok, "FLUSH_BYTES", 500)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = crosstok.align(df, lambda: public_tokenizers.path("byte_bpe_50k.json"),
                           lambda: public_tokenizers.path("piece_bpe_32k.model")).collect()
    assert multiset([r.asDict() for r in found], COLUMNS) == Counter((i, *x) for i, x in enumerate(brute_alignment(texts)))
    assert sum(r["n_a"] > 0 for r in found) > 250
