"""Merkle manifest of a dataset as postorder append logs, with inclusion proofs read by closed-form positions.

A tree pairs its nodes level by level; a last odd node becomes the digest of
itself alone.  Nodes are written in the order in which they are complete: a
leaf, then every parent that its arrival completes.  In that log the node at
``level`` whose last leaf is the ``e``-th stands at ``2e - popcount(e) +
level``: before it lie ``e`` leaves with the ``e - popcount(e)`` parents they
completed, then the leaf itself and the parents below.  So a sibling's place
follows from numbers alone, and stretches of the log that begin at a multiple
of ``2**bits`` leaves can be written by separate builders: places inside such
a stretch follow the same formula from its first leaf.

Each builder is one Spark group of at most ``2**bits`` nodes.  The stretches'
last digests are the nodes of the next tier, built in the same way, until a
tree has one stretch left.  Proofs go down the tiers again: a stretch hands
each of its nodes the siblings found in its log and the path above it, which
all of its nodes share.  No task holds more than one stretch, whatever the
number of rows of one language.

Digests are lower-case hex SHA-256 over hex text; logs keep them as 32 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.llm.numbering import numbered
from claimspark.llm.store import written

#: Each builder writes 2**BITS nodes of a tier.
BITS = 12
#: Fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

TIER = "key string, block long, total long, log binary"
PATH = "key string, idx long, path array<string>"
PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def position(level: int, index: int, leaves: int) -> int:
    """Place in the log of the node ``index`` of ``level`` in a tree of ``leaves`` leaves."""
    last = min((index + 1) << level, leaves) - 1
    return 2 * last - last.bit_count() + level


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    return (leaves - 1).bit_length()


def append_log(leaves: list[str], levels: int) -> list[str]:
    """The tree's nodes in the order in which appending leaf after leaf completes them."""
    log: list[str] = []
    for e, leaf in enumerate(leaves):
        log.append(leaf)
        for level in range(1, levels + 1):
            if (e + 1) % (1 << level):
                break
            # The right child is the last node; its subtree of 2**level - 1 nodes follows the left child.
            log.append(digest(log[-(1 << level)] + log[-1]))
    n = len(leaves)
    for level in range(1, levels + 1):  # the ragged right edge, complete only when the log is closed
        if n % (1 << level):
            left = ((n - 1) >> level) << 1
            below = [left] if (left + 1) << (level - 1) >= n else [left, left + 1]
            log.append(digest("".join(log[position(level - 1, i, n)] for i in below)))
    return log


def siblings(log: list[str], leaf: int, leaves: int, levels: int) -> list[str]:
    """The way up from a leaf: "R" or "L" and a sibling to that side, or "-" where there is none."""
    path = []
    for level in range(levels):
        index = leaf >> level
        other = index ^ 1
        if other << level < leaves:
            path.append(("L" if index & 1 else "R") + log[position(level, other, leaves)])
        else:
            path.append("-")
    return path


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its path give."""
    for step in path:
        other = step[1:]
        leaf = digest(leaf + other if step[0] == "R" else other + leaf)
    return leaf


def _hex(log: bytes) -> list[str]:
    text = log.hex()
    return [text[i:i + 64] for i in range(0, len(text), 64)]


def _levels(total: int, bits: int) -> int:
    """Levels a stretch has: all of a tree's where it is the tree's only one."""
    return bits if total > 1 << bits else height(total)


def _built(bits: int) -> Callable[[pa.Table], pa.Table]:
    def build(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("idx")
        total = nodes["total"][0].as_py()
        log = append_log([d.hex() for d in nodes["digest"].to_pylist()], _levels(total, bits))
        return pa.table({"key": pa.array([nodes["key"][0].as_py()], pa.string()),
                         "block": pa.array([nodes["idx"][0].as_py() >> bits], pa.int64()),
                         "total": pa.array([total], pa.int64()), "log": pa.array([bytes.fromhex("".join(log))], pa.binary())})
    return build


def tiers(nodes: DataFrame, bits: int = BITS) -> list[DataFrame]:
    """The written logs of every tree: ``nodes`` has key, idx (0, 1, ... within the key), total and digest."""
    out = []
    while True:
        blocks = nodes.select("key", "idx", "total", "digest").groupBy("key", F.shiftright("idx", bits).alias("part"))
        tier = written(blocks.applyInArrow(_built(bits), TIER), f"tier{len(out)}")
        out.append(tier)
        more = tier.where(F.col("total") > 1 << bits)
        if more.limit(1).count() == 0:
            return out
        nodes = more.select("key", F.col("block").alias("idx"),
                            F.shiftright(F.col("total") + ((1 << bits) - 1), bits).alias("total"),
                            F.substring("log", -32, 32).alias("digest"))


def roots(logs: list[DataFrame], bits: int = BITS) -> DataFrame:
    """(key, root) of every tree, root as 32 bytes."""
    ends = [t.where(F.col("total") <= 1 << bits).select("key", F.substring("log", -32, 32).alias("root")) for t in logs]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out


def _paths(bits: int) -> Callable[[pa.Table], pa.Table]:
    def expand(block: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        log, first = _hex(row["log"]), row["block"] << bits
        n = min(row["total"] - first, 1 << bits)
        levels = _levels(row["total"], bits)
        return pa.table({"key": pa.array([row["key"]] * n, pa.string()), "idx": pa.array(range(first, first + n), pa.int64()),
                         "path": pa.array([siblings(log, i, n, levels) + row["above"] for i in range(n)], pa.list_(pa.string()))})
    return expand


def paths(blocks: DataFrame, bits: int = BITS) -> DataFrame:
    """(key, idx, path) of every node of these stretches, each with the path ``above`` it."""
    return blocks.groupBy("key", "block").applyInArrow(_paths(bits), PATH)


def placed(logs: list[DataFrame], above: DataFrame, bits: int = BITS) -> DataFrame:
    """The lowest tier's stretches, each with the path ``above`` it; (key, path) above each whole tree is given."""
    higher = None
    for tier in reversed(logs):
        whole = F.col("total") <= 1 << bits
        blocks = tier.where(whole).join(above.select("key", F.col("path").alias("above")), "key")
        if higher is not None:
            inner = paths(higher, bits).select("key", F.col("idx").alias("block"), F.col("path").alias("above"))
            blocks = blocks.unionByName(tier.where(~whole).join(inner, ["key", "block"]))
        higher = blocks
    return higher


def leaf_digest(*values: Column) -> Column:
    """H of the values: ``-`` for null, else byte count, ``:`` and the value as text."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(doc_id, key, digest, forged, seq): one scan; ``forged`` is the leaf of a row whose n_chars grew by one."""
    col = {c: F.col(c) for c in FIELDS}
    forged = {**col, "n_chars": col["n_chars"].cast("decimal(20,0)") + 1}
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit("")).alias("key"),
        leaf_digest(*col.values()).alias("digest"),
        F.when(tampered, leaf_digest(*forged.values())).alias("forged"),
        F.monotonically_increasing_id().alias("seq"))


def _proved(bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def prove(docs: pa.Table, block: pa.Table) -> pa.Table:
        docs, row = docs.sort_by("idx"), block.to_pylist()[0]
        log, n, levels = _hex(row["log"]), docs.num_rows, _levels(row["total"], bits)
        root, subroot = row["root"].hex(), row["subroot"].hex()
        above = row["above"]
        shared = "".join(step[1:] for step in above)
        out = []
        for i, (doc_id, forged) in enumerate(zip(docs["doc_id"].to_pylist(), docs["forged"].to_pylist(), strict=True)):
            leaf, own = log[position(0, i, n)], siblings(log, i, n, levels)
            folded = fold(fold(forged.hex() if forged is not None else leaf, own), above)
            out.append((doc_id, leaf, subroot, root, digest("".join(step[1:] for step in own) + shared), folded, folded == root))
        types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        names = [f.split()[0] for f in PROOF.split(", ")]
        return pa.table({name: pa.array([r[k] for r in out], t) for k, (name, t) in enumerate(zip(names, types, strict=True))})
    return prove


def proofs(docs: DataFrame, tampered: Column, bits: int = BITS) -> DataFrame:
    """One row per document: its leaf, its language's subroot, the root, its proof's digest, and the root that the
    leaf (that of the altered row where ``tampered`` holds) folds to with the original siblings.

    Trees are per ``lang``, leaves by doc_id; the subroots, by lang, form the
    last tree.  Null ``lang`` is a language of its own and the first; null
    doc_ids come first; rows with one doc_id stand in the order of their
    digests, and equal rows are leaves of their own.  A null text counts
    ``-``, an empty one ``0:``.  Null ``tampered`` is no tampering.  No rows
    give no rows.  Other columns are not read, whatever their names.
    """
    once = written(leaves(docs, tampered), "leaves")
    placed_leaves = numbered(once, ["key"], ["doc_id", "digest", "seq"], "idx", "total")
    logs = tiers(placed_leaves, bits)
    subroots = written(roots(logs, bits).select(F.lit("").alias("key"), F.col("key").alias("tree"),
                                                F.col("root").alias("digest")), "subroots")
    languages = numbered(subroots, ["key"], ["tree"], "idx", "total")
    top = tiers(languages, bits)
    start = roots(top, bits).select("key", F.array().cast("array<string>").alias("path"))
    steps = paths(placed(top, start, bits), bits)
    trees = written(languages.join(steps, ["key", "idx"]).join(roots(top, bits), "key").select(
        F.col("tree").alias("key"), "path", F.col("digest").alias("subroot"), "root"), "trees")
    blocks = placed(logs, trees.select("key", "path"), bits).join(trees.drop("path"), "key")
    members = placed_leaves.select("doc_id", "forged", "key", "idx", F.shiftright("idx", bits).alias("block"))
    return members.groupBy("key", "block").cogroup(blocks.groupBy("key", "block")).applyInArrow(_proved(bits), PROOF)
