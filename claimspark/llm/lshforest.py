"""Near-duplicate classes by an LSH forest (operator 5).

A text is the set of its distinct ``width``-word shingles (by 64-bit hash).
Texts with equal sets are one node from the start.

1. Each node has a MinHash signature; the forest's trees are the nodes in
   the order of different stretches of it.  Only nodes that share the first
   ``depth`` values of a stretch with another node are put in that tree; the
   depth follows from the threshold (4 at 0.85, 3 at 0.8).
2. In a tree's order, neighbours by longest common prefix are candidates.  A
   region (equal prefix) of few nodes is compared whole by signature; a
   crowded region is cut at a greater depth until its parts are small, and
   always keeps the links between neighbours.  Small regions go to one task
   whole; the order of crowded ones is cut into ranges of equal size, so
   they spread over tasks.
3. Candidates with similar signatures form rough groups, as connected
   components.  A crowded region whose nodes are then in several groups is
   compared across groups after all: its nodes are dealt into blocks, and
   those outside its largest group meet every block.  So nodes that share
   ``depth`` values are always compared or in one group, however many others
   hold the passage that the values come from, and the nodes of a group are
   not compared again with each other.
4. Inside the rough groups full shingle sets are compared.  A large group is
   dealt into blocks of bounded size and compared inside them first; only
   nodes that this leaves outside the group's largest component meet all of
   its blocks.  A task sends on a spanning forest of its true links.
5. The components of true links are the classes.

Results: ``component_id`` is the smallest id in a class; a text without
words has no shingles and is linked with nothing; a text of fewer words than
``width`` has its whole sequence as one shingle; rows with a null id take no
part, have no component and are kept; repeated rows are in one class; other
columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.arrowtext import Remembered, ragged, resting, text_slices, word_codes
from claimspark.llm.components import components
from claimspark.llm.store import written

TREES, STRETCH = 16, 8
DEPTH = 4
#: Probability that a pair at the threshold shares no tree's first values.
MISS = 2e-5
#: Nodes of a region that are compared whole.
REGION = 64
#: Nodes in a block of a large rough group.
BLOCK = 128
#: A crowded region is dealt into so many blocks, of at least LEAST_CROWD and at most CROWD_BLOCK nodes.
CROWD_BLOCKS, LEAST_CROWD, CROWD_BLOCK = 16, 1024, 4096


def agreement(percent: int) -> float:
    """Signatures that agree less are no candidates: five standard deviations below a link at the threshold."""
    s = percent / 100
    return max(0.0, math.floor(100 * (s - 5 * math.sqrt(s * (1 - s) / (TREES * STRETCH)))) / 100)


def miss_rate(percent: int, depth: int) -> float:
    """Probability that a pair at the threshold shares the first ``depth`` values of no tree."""
    return (1 - (percent / 100) ** depth) ** TREES


def depth_for(percent: int) -> int:
    """The greatest depth up to ``DEPTH`` that keeps to ``MISS``; below 0.49 none does, and one value is shared."""
    return next((d for d in range(DEPTH, 1, -1) if miss_rate(percent, d) <= MISS), 1)


_MULTIPLIERS = (np.random.default_rng(5).integers(0, 1 << 63, TREES * STRETCH, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = np.random.default_rng(6).integers(0, 1 << 63, TREES * STRETCH, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_word_hashes = Remembered(lambda words: [xxhash.xxh3_64_intdigest(w) for w in words], 200_000)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text, offsets of each text)."""
    codes, offsets, words = word_codes(pc.ascii_lower(texts))
    word = np.array(_word_hashes(words.to_pylist()), dtype=np.uint64)[codes] if len(codes) else np.zeros(0, np.uint64)
    sizes = np.diff(offsets)
    windows = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    row, place = ragged(windows)
    start = offsets[:-1][row] + place
    h = np.zeros(len(start), np.uint64)
    for i in range(width):
        at = np.minimum(start + i, len(word) - 1)
        inside = i < sizes[row]
        h = np.where(inside, h * _BASE + (word[at] if len(word) else h) + np.uint64(1), h)
    h = _mixed(h)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1]))) if len(h) else np.zeros(0, bool)
    return h[keep], np.concatenate(([0], np.cumsum(np.bincount(row[keep], minlength=len(sizes))))).astype(np.int64)


def set_keys(hashes: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """128 bits that stand for each whole set; empty for an empty set."""
    data = hashes.tobytes()
    return [xxhash.xxh3_128_digest(data[8 * s:8 * e]) if e > s else b""
            for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def signatures(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash values, 16 bits of each, of the non-empty sets."""
    begin = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(begin), len(_MULTIPLIERS)), dtype=np.uint16)
    for i, (m, c) in enumerate(zip(_MULTIPLIERS, _ADD, strict=True)):
        if len(begin):
            least = np.minimum.reduceat(hashes * m + c, begin)
            out[:, i] = (_mixed(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def features(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, key, signature, text_hash) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                hashes, offsets = shingle_sets(part.column("text"), width)
                sizes = np.diff(offsets)
                signed = iter(signatures(hashes, offsets))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(set_keys(hashes, offsets), pa.binary()),
                     pa.array([next(signed).astype(">u2").tobytes() if n else b"" for n in sizes.tolist()], pa.binary()),
                     part.column("text_hash")],
                    names=["doc_id", "n_shingles", "key", "signature", "text_hash"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash")).mapInArrow(
        resting(run), "doc_id long, n_shingles long, key binary, signature binary, text_hash long")


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of ``n`` nodes reaches over links (a, b)."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], least)
        np.minimum.at(after, root[b], least)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _stretch(signature, tree, size: int):
    return F.substring(signature, tree * (2 * STRETCH) + 1, F.lit(2 * size))


def _regions(lcp: np.ndarray, least: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first, last + 1) of regions in a sorted order, shallow ones first; a crowded region is cut deeper.

    ``lcp`` is the common prefix of each row with the one before it (0 for the first).
    """
    n = len(lcp)
    inside = np.ones(n, dtype=bool)
    for depth in range(least, STRETCH + 1):
        first = np.flatnonzero(lcp < depth)
        last = np.concatenate((first[1:], [n]))
        small = (last - first <= REGION) & inside[first]
        yield first[small], last[small]
        settled = np.zeros(n + 1, dtype=np.int64)
        np.add.at(settled, first[small], 1)
        np.add.at(settled, last[small], -1)
        inside &= np.cumsum(settled[:n]) == 0
    left = np.flatnonzero(inside)
    if len(left):  # equal on the whole stretch and still crowded: pieces of the order
        run = np.concatenate(([0], np.cumsum((np.diff(left) > 1) | (lcp[left[1:]] < STRETCH))))
        first = np.flatnonzero(np.concatenate(([True], np.diff(run) > 0)))
        for f, e in zip(first, np.concatenate((first[1:], [len(left)])), strict=True):
            cut = np.arange(left[f], left[e - 1] + 1, REGION)
            yield cut, np.minimum(cut + REGION, left[e - 1] + 1)


def tree_links(keys: np.ndarray, labels: np.ndarray, signed: np.ndarray, agree: float,
               depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Rows linked in one sorted piece of a tree, as (row, smallest row it reaches)."""
    n = len(keys)
    equal = np.zeros((n, STRETCH), dtype=bool)
    equal[1:] = labels[1:] == labels[:-1]
    lcp = np.where(equal.all(axis=1), STRETCH, equal.argmin(axis=1))
    near = np.flatnonzero(lcp >= depth)
    firsts, seconds = [near - 1], [near]
    for first, last in _regions(lcp, depth):
        size = last - first
        region, place = ragged(size)
        # Every later row of the same region.
        row = first[region] + place
        pair, step = ragged(last[region] - row - 1)
        firsts.append(row[pair])
        seconds.append(row[pair] + 1 + step)
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    similar = np.zeros(len(a), dtype=bool)
    for s in range(0, len(a), 1 << 15):
        some = slice(s, s + (1 << 15))
        similar[some] = (signed[a[some]] == signed[b[some]]).mean(axis=1) >= agree
    root = _roots(n, a[similar], b[similar])
    return np.arange(n), root


def candidate_links(nodes: DataFrame, agree: float, depth: int = DEPTH) -> DataFrame:
    """(a, b): links between keys of nodes that the forest finds similar."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    prefixes = nodes.select("key", "signature", trees.alias("tree")).select(
        "key", "tree", _stretch(F.col("signature"), F.col("tree"), depth).alias("prefix"))
    several = prefixes.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    in_trees = written(prefixes.join(several, ["tree", "prefix"]).groupBy("key").agg(
        F.collect_list(F.struct("tree", "n")).alias("trees")), "in-trees")
    order = written(
        nodes.join(in_trees, "key").select("key", "signature", F.inline("trees"))
        .withColumn("label", _stretch(F.col("signature"), F.col("tree"), STRETCH)), "trees")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ("tree", "label", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # A batch's last region may go on in the next one: its rows wait for that.
            table = pa.concat_tables([*waiting, pa.Table.from_batches([batch])]).combine_chunks()
            starts = _region_starts(table, depth)
            whole = int(starts[-1]) if table.num_rows - starts[-1] <= REGION else table.num_rows
            waiting = [table.slice(whole)] if whole < table.num_rows else []
            if whole:
                yield _linked(table.slice(0, whole), agree, depth)
        if waiting:
            yield _linked(waiting[0], agree, depth)

    # Regions that are compared whole are dealt whole; only the order of crowded ones is cut into ranges.
    small = order.where(F.col("n") <= REGION).repartition(parts, "tree", F.substring("label", 1, 2 * depth))
    large = order.where(F.col("n") > REGION)
    wanted = [small]
    crowded = large.limit(1).count() > 0
    if crowded:
        wanted.append(large.repartitionByRange(parts, *by))
    found = [part.sortWithinPartitions(*by).select("key", "signature", "tree").mapInArrow(run, "a binary, b binary") for part in wanted]
    if not crowded:
        return found[0].distinct()
    rough = components(found[0].unionByName(found[1]))
    # What hangs together already is named by its smallest node.
    known = rough.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b"))
    return known.unionByName(crowd_links(large, rough, agree, depth)).distinct()


def _signed(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["signature"].to_pylist()), ">u2").reshape(table.num_rows, -1)


def _labels(table: pa.Table, signed: np.ndarray) -> np.ndarray:
    """The stretch of each row's own tree; other trees' labels are never equal."""
    tree = table["tree"].to_numpy()
    labels = np.take_along_axis(signed, tree[:, None] * STRETCH + np.arange(STRETCH), axis=1).astype(np.int64)
    return labels + (tree[:, None].astype(np.int64) << 16)


def _region_starts(table: pa.Table, depth: int) -> np.ndarray:
    """Rows with another prefix than the row before."""
    labels = _labels(table, _signed(table))[:, :depth]
    return np.flatnonzero(np.concatenate(([True], (labels[1:] != labels[:-1]).any(axis=1))))


def _linked(table: pa.Table, agree: float, depth: int) -> pa.RecordBatch:
    signed = _signed(table)
    keys = np.array(table["key"].to_pylist(), dtype=object)
    row, root = tree_links(keys, _labels(table, signed), signed.astype(np.uint16), agree, depth)
    linked = row != root
    return pa.RecordBatch.from_arrays([pa.array(keys[root[linked]].tolist(), pa.binary()),
                                       pa.array(keys[row[linked]].tolist(), pa.binary())], names=["a", "b"])


def similar_across(signed: np.ndarray, group: np.ndarray, first_block: np.ndarray, agree: float) -> np.ndarray:
    """Smallest row that each row reaches over pairs of different groups with similar signatures; with two blocks,
    pairs across them."""
    n, values = signed.shape
    left, right = np.flatnonzero(first_block), np.flatnonzero(~first_block)
    if not len(right):
        right = left
    root = np.arange(n)
    if (group == group[0]).all():
        return root
    across = np.ascontiguousarray(signed[right].T)
    for s in range(0, len(left), 256):
        rows = left[s:s + 256]
        equal = np.zeros((len(rows), len(right)), dtype=np.uint8)
        for i in range(values):
            equal += signed[rows, i][:, None] == across[i]
        a, b = np.nonzero((equal >= agree * values) & (group[rows][:, None] != group[right]))
        linked = np.flatnonzero(root != np.arange(n))
        root = _roots(n, np.concatenate((linked, rows[a])), np.concatenate((root[linked], right[b])))
    return root


def dealt_crowds(crowded: DataFrame, rough: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, signature, group, tree, prefix, low, high, first): units of the nodes of a crowded region to be compared, those
    that are ``first`` with the others.

    ``crowded`` is (key, signature, tree, label, n) with the number of nodes of the region.  The nodes outside a region's
    largest group in ``rough`` visit every block of the region, the others stay in theirs; a region of one group is left out.
    """
    of_key = rough.select(F.col("node").alias("key"), F.col("label").alias("group"))
    members = written(crowded.join(of_key, "key", "left").select(
        "key", "signature", "tree", F.substring("label", 1, 2 * depth).alias("prefix"), "n",
        F.coalesce("group", "key").alias("group")), "crowds")
    sizes = members.groupBy("tree", "prefix", "group").agg(F.count(F.lit(1)).alias("own"))
    mixed = (sizes.groupBy("tree", "prefix").agg(F.max(F.struct("own", "group")).alias("bulk"), F.sum("own").alias("all"))
             .where("bulk.own < all")
             .select("tree", "prefix", F.col("bulk.group").alias("bulk"), (F.col("all") - F.col("bulk.own")).alias("outside")))
    size = F.least(F.greatest(F.col("n") / CROWD_BLOCKS, F.lit(LEAST_CROWD)), F.lit(CROWD_BLOCK))
    open_ = (members.join(mixed, ["tree", "prefix"]).withColumn("blocks", F.ceil(F.col("n") / size).cast("int"))
             .withColumn("visits", F.ceil(F.col("outside") / size).cast("int")))

    def dealt_to(count: str, salt: int):
        return F.pmod(F.xxhash64("key", F.lit(salt)), F.col(count)).cast("int")

    here = open_.withColumn("low", dealt_to("blocks", 0)).withColumn("high", F.explode(F.sequence(F.lit(0), F.col("visits") - 1)))
    visitors = (open_.where(F.col("group") != F.col("bulk")).withColumn("high", dealt_to("visits", 1))
                .withColumn("low", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    names = ["key", "signature", "group", "tree", "prefix", "low", "high"]
    return here.select(*names, F.lit(True).alias("first")).unionByName(visitors.select(*names, F.lit(False).alias("first")))


def crowd_links(crowded: DataFrame, rough: DataFrame, agree: float, depth: int = DEPTH) -> DataFrame:
    """(a, b): links between keys of one crowded region but of different groups in ``rough``; a task sends on a spanning
    forest."""
    def compare(table: pa.Table) -> pa.Table:
        signed = np.frombuffer(b"".join(table["signature"].to_pylist()), ">u2").reshape(len(table), -1).astype(np.uint16)
        group = np.unique(np.array(table["group"].to_pylist(), dtype=object), return_inverse=True)[1]
        keys = table["key"].to_pylist()
        root = similar_across(signed, group, table["first"].to_numpy(), agree).tolist()
        linked = [i for i, r in enumerate(root) if keys[r] != keys[i]]
        return pa.table({"a": pa.array([keys[root[i]] for i in linked], pa.binary()),
                         "b": pa.array([keys[i] for i in linked], pa.binary())})

    return dealt_crowds(crowded, rough, depth).groupBy("tree", "prefix", "low", "high").applyInArrow(
        lambda t: compare(t), "a binary, b binary")


def true_links(sets: list[np.ndarray], first_block: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with 100 * intersection >= percent * union; with two blocks, pairs across them.

    Shared counts come from products of 0/1 matrices over some hashes at a time.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    count = np.bincount(column, minlength=len(values))
    # Hashes of one set share nothing; the others are numbered anew.
    number = np.cumsum(count > 1) - 1
    owner, column = owner[count[column] > 1], number[column[count[column] > 1]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    left, right = (np.flatnonzero(first_block), np.flatnonzero(~first_block))
    if not len(right):
        right = left
    shared = np.zeros((len(left), len(right)))
    width = 8192
    for s in range(0, int((count > 1).sum()), width):
        some = slice(*np.searchsorted(column, (s, s + width)))
        matrix = np.zeros((len(sets), width), dtype=np.float32)
        matrix[owner[some], column[some] - s] = 1
        shared += matrix[left] @ matrix[right].T
    both = sizes[left][:, None] + sizes[right][None, :] - shared
    a, b = np.nonzero(100 * shared >= percent * both)
    a, b = left[a], right[b]
    return a[a != b], b[a != b]


def full_sets(docs: DataFrame, nodes: DataFrame, rough: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(cluster, key, members, hashes): the shingle sets of all nodes in rough groups, one row a node."""
    sizes = rough.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    members = (rough.join(sizes, "label").join(nodes.select(F.col("key").alias("node"), "doc_id"), "node")
               .select(F.col("node").alias("key"), F.col("label").alias("cluster"), "members", "doc_id"))
    texts = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .join(members, "doc_id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                hashes, offsets = shingle_sets(part.column("text"), width)
                keys = set_keys(hashes, offsets)
                # A row of the same id with another text is not the node.
                mine = [i for i, k in enumerate(part.column("key").to_pylist()) if k == keys[i]]
                kept = part.take(pa.array(mine, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [kept.column("key"), kept.column("cluster"), kept.column("members"),
                     pa.array([hashes[offsets[i]:offsets[i + 1]].tobytes() for i in mine], pa.binary())],
                    names=["key", "cluster", "members", "hashes"])

    found = texts.mapInArrow(resting(sets), "key binary, cluster binary, members long, hashes binary")
    return found.groupBy("cluster", "key", "members").agg(F.max("hashes").alias("hashes"))


def _compared(dealt: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the true links that each unit of ``dealt`` adds to those known.

    ``dealt`` is (unit, low, high, cluster, key, hashes, first, known): rows of one cluster are compared, those that are
    ``first`` with those that are not where a cluster has both, and never rows of one ``known`` component.
    """
    def compare(table: pa.Table) -> pa.Table:
        cluster, known = table["cluster"].to_pylist(), table["known"].to_pylist()
        order = sorted(range(len(cluster)), key=cluster.__getitem__)
        keys, hashes = table["key"].to_pylist(), table["hashes"].to_pylist()
        first = table["first"].to_numpy()
        a_out, b_out = [], []
        start = 0
        for end in range(1, len(order) + 1):
            if end < len(order) and cluster[order[end]] == cluster[order[start]]:
                continue
            rows = np.array(order[start:end])
            start = end
            names = np.unique(np.array([known[r] for r in rows], dtype=object), return_inverse=True)[1]
            if len(rows) < 2 or not names.any():
                continue
            own = [np.frombuffer(hashes[r], np.uint64) for r in rows]
            a, b = true_links(own, first[rows], percent)
            # Rows of one known component hang together already.
            one = np.unique(names, return_index=True)[1][names]
            root = _roots(len(rows), one, np.arange(len(rows)))
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                if x != y:
                    root[max(x, y)] = min(x, y)
                    a_out.append(keys[rows[x]])
                    b_out.append(keys[rows[y]])
        return pa.table({"a": pa.array(a_out, pa.binary()), "b": pa.array(b_out, pa.binary())})

    return dealt.groupBy("unit", "low", "high").applyInArrow(lambda t: compare(t), "a binary, b binary")


def exact_links(docs: DataFrame, nodes: DataFrame, rough: DataFrame, width: int, percent: int, id_col: str,
                text_col: str) -> DataFrame:
    """(a, b): true links between keys inside rough groups, enough of them to connect each class.

    A group of up to ``BLOCK`` nodes is compared whole.  A larger one is dealt
    into blocks twice, by two hashes, and compared inside blocks: near copies
    of one text then hang together, with about as many links as nodes.  What
    is left are pairs of different components.  All nodes outside a group's
    largest component visit every block of the group, the others stay in
    theirs, so what travels grows with the nodes times those left over, in
    pairs of blocks of bounded size, and no pair is missed.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sets = written(full_sets(docs, nodes, rough, width, id_col, text_col)
                   .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")), "full-sets")
    small, large = sets.where("blocks = 1"), sets.where("blocks > 1")
    shared = F.pmod(F.xxhash64("cluster"), F.lit(4 * parts))

    def block(salt: int):
        return F.pmod(F.xxhash64("key", F.lit(salt)), F.col("blocks")).cast("int")

    def inside(df: DataFrame, unit, at, known) -> DataFrame:
        return _compared(df.select(unit.alias("unit"), at.alias("low"), at.alias("high"), "cluster", "key", "hashes",
                                   F.lit(True).alias("first"), known.alias("known")), percent)

    links = inside(small, shared, F.lit(0), F.col("key"))
    if not large.limit(1).count():
        return links
    unit = F.xxhash64("cluster")
    found = written(links.unionByName(inside(large, unit, block(0), F.col("key"))), "block-links")

    def with_known(links: DataFrame) -> DataFrame:
        of = components(links).select(F.col("node").alias("key"), F.col("label").alias("known"))
        return large.join(of, "key", "left").withColumn("known", F.coalesce("known", "key"))

    found = written(found.unionByName(inside(with_known(found), unit, block(1), F.col("known"))), "block-links")
    judged = written(with_known(found), "known-sets")
    counts = judged.groupBy("cluster", "known").agg(F.count(F.lit(1)).alias("n"))
    bulk = counts.groupBy("cluster").agg(F.max(F.struct("n", "known")).alias("bulk"), F.sum("n").alias("all")) \
        .where("bulk.n < all").select("cluster", F.col("bulk.known").alias("bulk"), (F.col("all") - F.col("bulk.n")).alias("left"))
    open_ = judged.join(bulk, "cluster").withColumn("visits", F.ceil(F.col("left") / BLOCK).cast("int"))
    here = open_.withColumn("low", block(0)).withColumn("high", F.explode(F.sequence(F.lit(0), F.col("visits") - 1)))
    visitors = open_.where("known <> bulk").withColumn("high", F.pmod(F.xxhash64("key", F.lit(2)), F.col("visits")).cast("int")) \
        .withColumn("low", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    names = [F.xxhash64("cluster").alias("unit"), "low", "high", "cluster", "key", "hashes"]
    dealt = here.select(*names, F.lit(True).alias("first"), "known").unionByName(
        visitors.select(*names, F.lit(False).alias("first"), "known"))
    return found.unionByName(_compared(dealt, percent))


def classes(docs: DataFrame, width: int = 5, percent: int = 85, id_col: str = "doc_id", text_col: str = "text",
            agree: float | None = None, with_hash: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; ``percent`` of the union must be shared.

    ``with_hash`` adds ``text_hash``, the text's xxhash64, which tells unlike texts of one id apart.
    """
    further = ["text_hash"] if with_hash else []
    rows = written(features(docs, width, id_col, text_col), "shingles")
    nodes = written(rows.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.max("signature").alias("signature")), "nodes")
    rough = components(candidate_links(nodes, agreement(percent) if agree is None else agree, depth_for(percent)))
    links = written(exact_links(docs, nodes, rough, width, percent, id_col, text_col), "true-links")
    found = components(links)
    named = nodes.select("key", "doc_id").join(found.withColumnRenamed("node", "key"), "key", "left")
    named = named.withColumn("label", F.coalesce("label", "key"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_key = named.join(least, "label").select("key", "component_id")
    return (rows.select("doc_id", "n_shingles", "key", *further).join(of_key, "key", "left")
            .select("doc_id", "n_shingles", *further,
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
