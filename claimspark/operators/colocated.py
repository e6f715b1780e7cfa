"""Facts and history laid out for a point-in-time join without a shuffle.

Both sides are written in the same number of buckets of the natural key,
sorted by it, as tables of the catalog: Spark then joins bucket with bucket,
and no join over them moves a row.  A bucket cannot be split, so a key that
holds more than its share of the facts would make one task of it.  Such keys
are counted when the facts are laid out, and their facts go to plain files;
the few rows of their history are broadcast to them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.operators.joins import point_in_time_join

#: A key is hot from the fraction 1 / (HOT * buckets) of the facts on, so at most HOT * buckets keys are.
HOT = 4


@dataclass(frozen=True)
class Layout:
    """Where the two sides are: bucketed tables, and plain files of the hot keys."""

    facts: str
    history: str
    hot_facts: str
    hot_history: str
    fact_key: str
    history_key: str
    buckets: int


def _bucketed(df: DataFrame, key: str, order: list[str], buckets: int, path: str) -> str:
    """A table of one sorted file a bucket; its files are at ``path``, outside the warehouse folder."""
    name = f"colocated_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).sortWithinPartitions(key, *order).write.format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key, *order).saveAsTable(name))
    return name


def lay_out(facts: DataFrame, history: DataFrame, fact_key: str, history_key: str, root: str, buckets: int,
            history_order: str = "valid_from") -> Layout:
    """Write both sides once; every join over them after that is free of shuffles.

    Facts without a key match nothing; they go to the plain files with the
    hot keys' facts, as many rows as there may be.  The key has the same type
    on both sides, which buckets need.
    """
    if facts.schema[fact_key].dataType != history.schema[history_key].dataType:
        raise ValueError(f"{fact_key} and {history_key} differ in type")
    counts = facts.where(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    counts.write.parquet(f"{root}/counts")
    counts = facts.sparkSession.read.schema(counts.schema).parquet(f"{root}/counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * (HOT * buckets) > total).where(F.col("n") > 1).select("hot_key")
    is_hot = F.broadcast(hot)  # at most HOT * buckets rows
    apart = facts.join(is_hot, F.col(fact_key) == F.col("hot_key"), "left_semi").unionByName(facts.where(F.col(fact_key).isNull()))
    apart.write.parquet(f"{root}/hot_facts")
    cold = facts.where(F.col(fact_key).isNotNull()).join(is_hot, F.col(fact_key) == F.col("hot_key"), "left_anti")
    history.join(is_hot, F.col(history_key) == F.col("hot_key"), "left_semi").write.parquet(f"{root}/hot_history")
    return Layout(_bucketed(cold, fact_key, [], buckets, f"{root}/facts"),
                  _bucketed(history, history_key, [history_order], buckets, f"{root}/history"),
                  f"{root}/hot_facts", f"{root}/hot_history", fact_key, history_key, buckets)


def join(spark: SparkSession, layout: Layout, fact_date: str, closed: bool = False) -> DataFrame:
    """``point_in_time_join`` over a layout: bucket with bucket, and the hot keys' facts with their broadcast history."""
    facts, history = spark.table(layout.facts), spark.table(layout.history)
    cold = point_in_time_join(facts, history.hint("merge"), layout.fact_key, layout.history_key, fact_date, closed=closed)
    hot_facts = spark.read.schema(facts.schema).parquet(layout.hot_facts)
    # HOT * buckets keys at most, each with one row a snapshot date.
    hot_history = F.broadcast(spark.read.schema(history.schema).parquet(layout.hot_history))
    hot = point_in_time_join(hot_facts, hot_history, layout.fact_key, layout.history_key, fact_date, closed=closed)
    return cold.unionByName(hot)


def drop(spark: SparkSession, layout: Layout) -> None:
    """Forget the two tables; their files stay where they were written."""
    for name in (layout.facts, layout.history):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
