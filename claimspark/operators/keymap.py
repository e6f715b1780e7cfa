"""Surrogate keys that survive a reload: a table of natural keys and the keys they were given."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.operators.keys import OrderSpec, dense_key
from claimspark.sources.commits import CommitLog


class KeyMap:
    """Natural key -> surrogate key, append-only.

    A natural key keeps its surrogate key for good: when its rows change,
    leave and come back.  New natural keys are numbered after the largest
    key given so far, in ``order``.  Each load writes only its new keys, as
    a part of its own, and publishes them by a commit record that also holds
    the largest key; a run that breaks before numbers the same keys again.
    NULLs in a natural key are values like any other.
    """

    def __init__(self, spark: SparkSession, root: str, natural: T.StructType, key_col: str):
        self.spark, self.natural, self.key_col = spark, natural, key_col
        self.schema = T.StructType([*natural.fields, T.StructField(key_col, T.LongType())])
        self.log = CommitLog(spark, root)

    def read(self) -> DataFrame:
        """All keys given so far."""
        record = self.log.latest()
        if record is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self.log.part_path(p) for p in record["parts"]])

    def _same(self, known: DataFrame, df: DataFrame):
        out = F.lit(True)
        for n in self.natural.names:
            out = out & df[n].eqNullSafe(known[f"_known_{n}"])
        return out

    def _known(self) -> DataFrame:
        return self.read().withColumnsRenamed({n: f"_known_{n}" for n in self.natural.names})

    def extend(self, df: DataFrame, order: OrderSpec | None = None) -> int:
        """Number the natural keys of ``df`` that have no key yet; returns how many there were."""
        record = self.log.latest() or {"parts": [], "largest": 0, "number": -1}
        names = self.natural.names
        keys = df.select(*[F.col(f.name).cast(f.dataType) for f in self.natural.fields]).distinct()
        known = self._known()
        fresh = keys.join(known, self._same(known, keys), "left_anti")
        numbered = dense_key(fresh, self.key_col, order or names, start=record["largest"] + 1)
        part, obs = self.log.new_part(), Observation()
        numbered.select(*self.schema.names).observe(obs, F.count(F.lit(1)).alias("n"), F.max(self.key_col).alias("largest")) \
            .write.parquet(self.log.part_path(part))
        if obs.get["n"]:
            self.log.publish({"parts": [*record["parts"], part], "largest": obs.get["largest"]}, after=record["number"])
        return obs.get["n"]

    def attach(self, df: DataFrame, order: OrderSpec | None = None) -> DataFrame:
        """``df`` with ``key_col``: first the map is extended by its new natural keys, then joined."""
        self.extend(df, order)
        typed = df.select(*[F.col(c).cast(self.natural[c].dataType).alias(c) if c in self.natural.names else F.col(c) for c in df.columns])
        known = self._known()
        return typed.join(known, self._same(known, typed)).drop(*[f"_known_{n}" for n in self.natural.names])
