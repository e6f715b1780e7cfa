"""Build the star schema from the stand-in inputs of one scale-factor folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from claimspark.operators import dims, facts, scd2
from claimspark.operators.contracts import conform
from claimspark.operators.joins import key_profile
from claimspark.session import checkpoint_dir
from claimspark.sources import stand_ins


def write_table(df: DataFrame, path: str, metrics: dict[str, Column] | None = None,
                partition_by: str | None = None) -> tuple[DataFrame, dict]:
    """Write ``df`` as parquet at ``path``; return a scan of it and write-time metrics.

    Cuts the lineage: later size checks, key offsets and joins read the
    written table instead of re-running the plan that produced it, and a
    lost executor costs a re-read, not a recomputation.  The row count (and
    any extra ``metrics``) are observed during the write itself, not by a
    second pass.
    """
    obs = Observation()
    extra = [c.alias(n) for n, c in (metrics or {}).items()]
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra)
    if partition_by:
        # Rebalanced, so a value's rows are few files and a hot value more than one.
        observed = observed.hint("rebalance", partition_by)
    writer = observed.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns), dict(obs.get)


@dataclass
class Star:
    """The star schema of one input folder, each table built and written once.

    Tables are written under the session's shared checkpoint folder
    (``spark.checkpoint.dir``), as a warehouse writes its silver and gold
    layers; ``materialize=False`` keeps every table a lazy plan instead.
    Building is serialised by a lock, so queries running in several threads
    of one session never write the same table twice.
    """

    spark: SparkSession
    sf_dir: str
    materialize: bool = True
    root: str = field(default="")
    _tables: dict = field(default_factory=dict, repr=False)
    _metrics: dict = field(default_factory=dict, repr=False)
    _profiles: dict = field(default_factory=dict, repr=False)
    _lock: threading.RLock = field(default_factory=threading.RLock, repr=False)

    def _table(self, name: str, build: Callable[[], DataFrame],
               metrics: dict[str, Column] | None = None, partition_by: str | None = None) -> DataFrame:
        with self._lock:
            if name not in self._tables:
                df = build()
                if self.materialize:
                    if not self.root:
                        self.root = f"{checkpoint_dir(self.spark).rstrip('/')}/star-{uuid.uuid4().hex}"
                    df, self._metrics[name] = write_table(df, f"{self.root}/{name}", metrics, partition_by)
                self._tables[name] = df
            return self._tables[name]

    def rows(self, name: str) -> int | None:
        """Row count observed when ``name`` was written (None for lazy tables)."""
        return self._metrics.get(name, {}).get("rows")

    def _profile(self, name: str, dim: DataFrame, keys: list[str], null_safe: bool = False) -> tuple[int, int]:
        """Largest group of a dimension's natural key, measured once on the written table (J1's guard)."""
        if name not in self._profiles:
            self._profiles[name] = key_profile(dim, keys, null_safe)
        return self._profiles[name]

    @property
    def claims(self) -> DataFrame:
        return self._table("claims", lambda: stand_ins.claims(self.spark, self.sf_dir),
                           {"first_date": F.min("incident_date"), "last_date": F.max("incident_date")})

    @property
    def holder_snapshots(self) -> DataFrame:
        return self._table("holder_snapshots", lambda: conform(
            stand_ins.holder_snapshots(self.spark, self.sf_dir), "policyholder_snapshot"), partition_by="snapshot_date")

    @property
    def dim_date(self) -> DataFrame:
        def build() -> DataFrame:
            claims = self.claims
            m = self._metrics.get("claims")
            if m and m.get("first_date") is not None:
                start, end = f"{m['first_date'].year}-01-01", f"{m['last_date'].year}-12-31"
            else:
                start, end = dims.dim_date_range_for(claims.select("incident_date"), "incident_date")
            return dims.generate_dim_date(self.spark, start, end)
        return self._table("dim_date", build)

    @property
    def dim_policy(self) -> DataFrame:
        return self._table("dim_policy", lambda: dims.build_dim_policy(
            self.claims))

    @property
    def dim_vehicle(self) -> DataFrame:
        return self._table("dim_vehicle", lambda: dims.build_dim_vehicle(
            self.claims))

    @property
    def dim_policyholder(self) -> DataFrame:
        return self._table("dim_policyholder", lambda: scd2.build_history(
            self.holder_snapshots, mode="strict"))

    def fact(self, mode: str = "inner") -> DataFrame:
        def build() -> DataFrame:
            claims, policy, holder = self.claims, self.dim_policy, self.dim_policyholder
            vehicle, date = self.dim_vehicle, self.dim_date
            columns = ["auto_make", "auto_model", "auto_year"]
            profiles = {"policy": self._profile("dim_policy", policy, ["policy_number"]),
                        "vehicle": self._profile("dim_vehicle", vehicle, columns),
                        "vehicle_null_safe": self._profile("dim_vehicle_null_safe", vehicle, columns, null_safe=True),
                        "date": self._profile("dim_date", date, ["full_date"])}
            return facts.build_fact(claims, policy, holder, vehicle, date, mode=mode,
                                    profiles=profiles)
        return self._table(f"fact_claims_{mode}", build)


_STARS: dict[tuple[str, str], Star] = {}
_STARS_LOCK = threading.Lock()


def star_for(spark: SparkSession, sf_dir: str) -> Star:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _STARS_LOCK:
        if key not in _STARS:
            _STARS[key] = Star(spark, sf_dir.rstrip("/"))
        return _STARS[key]
