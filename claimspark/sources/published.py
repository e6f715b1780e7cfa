"""Tables that readers see only after their audit (V8, S6): write aside, check, then publish by one record."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.operators import checks
from claimspark.sources.commits import CommitLog

Audit = Callable[[DataFrame], DataFrame]


class PublishedTable:
    """One table whose versions appear only when their checks pass.

    ``publish`` writes to a folder of its own, audits what was written and
    then names it in a commit record.  A failing check, or a run that breaks
    before, leaves the last version in place for every reader.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.schema, self.log = spark, schema, CommitLog(spark, root)

    def latest(self) -> int | None:
        record = self.log.latest()
        return record["number"] if record else None

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, by default the newest."""
        record = self.log.latest() if version is None else self.log.record(version)
        if record is None:
            raise ValueError("nothing published yet")
        return self._scan(record["part"])

    def _scan(self, part: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.log.part_path(part))

    def publish(self, df: DataFrame, audit: Audit | None = None) -> int:
        """Write, audit, publish; raises ``CheckFailed`` and publishes nothing where a check fails."""
        before = self.latest()
        part, obs = self.log.new_part(), Observation()
        df.select(*self.schema.names).observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(self.log.part_path(part))
        report = checks.run_checks([audit(self._scan(part))]).collect() if audit else []
        return self.log.publish({"part": part, "rows": obs.get["rows"], "checks": [r.asDict() for r in report]},
                                after=-1 if before is None else before)

    def expire(self, keep: int = 2, orphan_age: float = 86400.0) -> list[str]:
        return self.log.expire(keep, lambda r: [f"part={r['part']}"], orphan_age)


class PublishedTables:
    """Several tables that change together: one record names a folder for each, so readers never mix two builds."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.log = spark, CommitLog(spark, root)
        self.parts: dict[str, tuple[str, T.StructType]] = {}

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table aside; returns a scan of what was written."""
        part = self.log.new_part()
        df.write.parquet(self.log.part_path(part))
        self.parts[name] = (part, df.schema)
        return self.spark.read.schema(df.schema).parquet(self.log.part_path(part))

    def publish(self, report: DataFrame) -> int:
        """Publish all staged tables where every check of ``report`` passed, else raise ``CheckFailed``."""
        rows = checks.run_checks([report]).collect()
        number = self.log.publish({"tables": {n: {"part": p, "schema": s.json()} for n, (p, s) in self.parts.items()},
                                   "checks": [r.asDict() for r in rows]})
        self.parts = {}
        return number

    def read(self, name: str, version: int | None = None) -> DataFrame:
        record = self.log.latest() if version is None else self.log.record(version)
        if record is None:
            raise ValueError("nothing published yet")
        table = record["tables"][name]
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        return self.spark.read.schema(schema).parquet(self.log.part_path(table["part"]))

    def expire(self, keep: int = 2, orphan_age: float = 86400.0) -> list[str]:
        return self.log.expire(keep, lambda r: [f"part={t['part']}" for t in r["tables"].values()], orphan_age)
