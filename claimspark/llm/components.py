"""Connected components of links between nodes, in Spark, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.llm.store import written

#: So few links are joined in one task; this bound does not grow with the input.
FEW = 10_000


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, label) of the nodes of at most ``FEW`` links (a, b)."""
    root: dict = {}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        kind = batch.column("a").type
        for a, b in zip(*(batch.column(c).to_pylist() for c in ("a", "b")), strict=True):
            x, y = find(root.setdefault(a, a)), find(root.setdefault(b, b))
            root[max(x, y)] = min(x, y)
    if root:
        yield pa.RecordBatch.from_arrays([pa.array(list(root), kind), pa.array([find(x) for x in root], kind)], names=["node", "label"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of ``links``; the label is the smallest node it reaches.

    A round puts the least node around it in the place of each node, in a
    shuffled order of the nodes, so a group that hangs together closely is
    one node after a round or two and its links are gone; a path, whatever
    its names, becomes shorter by a share.  Rounds go on with the links that
    are left until these are ``FEW``.  Every round is a written table.  A node
    with very many links is a skewed join key, which Spark splits, and its
    minimum combines in each task before the shuffle.
    """
    def link(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    def ranked(name: str):
        return F.struct(F.xxhash64(name).alias("rank"), F.col(name).alias("name")).alias(name)

    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").select(ranked("a"), ranked("b"))
    kind = links.schema["a"].dataType["name"].dataType.simpleString()
    links, steps = written(links.select(*link("a", "b")).distinct(), "links"), []
    while links.count() > FEW:
        ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")),
                       "steps")
        steps.append(step)
        links = written(
            links.join(step.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
            .where("x <> y").select(*link("x", "y")).distinct(), "links")
    labels = written(links.select(F.col("a.name").alias("a"), F.col("b.name").alias("b")).coalesce(1)
                     .mapInArrow(joined, f"node {kind}, label {kind}"), "labels")
    if not steps:
        return labels
    labels = labels.select(ranked("node"), ranked("label"))
    while steps:
        step = steps.pop()
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = step.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label"))
    labels = written(labels, "labels")
    least = labels.groupBy("label").agg(F.min("node.name").alias("least"))
    return written(labels.join(least, "label").select(F.col("node.name").alias("node"), F.col("least").alias("label")), "labels")
