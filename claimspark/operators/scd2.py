"""Type-2 slowly changing dimension (H1-H9).

History is built with windows partitioned by the natural key: one shuffle on
the key, and a key's group holds one row per snapshot date it appears in, so
groups are bounded by the snapshot schedule, not by the data size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.functions.expressions import any_changed, normalise
from claimspark.operators.contracts import DIM_POLICYHOLDER, conform
from claimspark.operators.keys import dense_key
from claimspark.session import checkpoint_dir
from claimspark.sources.commits import CommitLog

# ---------------------------------------------------------------------------
# The attributes whose change opens a new version.
# ---------------------------------------------------------------------------
TRACKED_COLUMNS = ("zip_code", "relationship", "occupation")

#: What a job says that meets a natural key twice on one date.
REPEATED = "snapshot repeats natural key"


def build_history(
    snapshots: DataFrame,
    natural_key: str = "policyholder_id",
    tracked: Sequence[str] = TRACKED_COLUMNS,
    mode: str = "strict",
    date_col: str = "snapshot_date",
    seq_col: str | None = None,
    key_col: str = "policyholder_key",
) -> DataFrame:
    """Full history from stacked, dated snapshots (H1-H3).

    A key's first row opens a version; a row whose tracked values differ
    from the key's previous row (``mode`` decides NULL/space handling)
    closes the open version at its date and opens the next.  Untracked
    columns are frozen at version start; keys missing from later snapshots
    stay open.  Rows of one key on one date are ordered by ``seq_col``.
    Surrogate keys follow arrival order: (valid_from, natural key, seq).
    """
    order = [F.col(date_col)] + ([F.col(seq_col)] if seq_col else [])
    w = Window.partitionBy(natural_key).orderBy(*order)
    prev = [(F.lag(F.col(t)).over(w), F.col(t)) for t in tracked]
    opened = F.row_number().over(w) == 1
    starts = snapshots.withColumn("_opens", opened | any_changed(prev, mode)).where("_opens")
    versions = (
        starts.withColumn("valid_from", F.col(date_col))
        .withColumn("valid_to", F.lead(F.col(date_col)).over(w))
        .withColumn("is_current", F.col("valid_to").isNull())
    )
    key_order = ["valid_from", natural_key] + ([seq_col] if seq_col else [])
    kept = [c for c in DIM_POLICYHOLDER.fieldNames() if c in versions.columns]
    keyed = dense_key(versions.select(*{c: None for c in (*kept, *key_order)}), key_col, key_order)
    return conform(keyed, "dim_policyholder")


def current_slice(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def apply_snapshot(
    dim: DataFrame,
    snapshot: DataFrame,
    natural_key: str = "policyholder_id",
    tracked: Sequence[str] = TRACKED_COLUMNS,
    mode: str = "null_as_empty",
    key_col: str = "policyholder_key",
    check_duplicates: bool = True,
    max_key: int | None = None,
) -> DataFrame:
    """Apply one dated snapshot to an existing history.

    1. close: current rows whose key appears in the snapshot with changed
       tracked values get ``valid_to = snapshot_date``, ``is_current = false``;
    2. insert: snapshot rows with no current row of equal tracked values
       open a version, keyed ``max(key) + 1 ...`` in natural-key order.

    One full outer join of the current slice (one row per key) with the
    snapshot yields closed, untouched and new rows together; it is
    checkpointed, and only the new rows are numbered.  Closed history passes
    through untouched, so a history partitioned by ``is_current`` only ever
    appends to its closed part.  Write the result to a new path and swap;
    never overwrite the path being read.  A key repeated within the snapshot
    is rejected.  ``max_key`` skips the aggregate that finds the largest key
    when the caller knows it.
    """
    if check_duplicates:
        dup = snapshot.groupBy(natural_key).count().where("count > 1").first()
        if dup:
            raise ValueError(f"snapshot repeats natural key {dup[0]!r}")
    if max_key is None:
        max_key = dim.agg(F.max(key_col)).first()[0] or 0

    attributes = [c for c in dim.columns if c not in (key_col, "valid_from", "valid_to", "is_current")]
    snap = snapshot.select(*[F.col(c).alias(f"_s_{c}") if c in snapshot.columns else
                             F.lit(None).cast(dim.schema[c].dataType).alias(f"_s_{c}") for c in attributes],
                           F.col("snapshot_date").alias("_s_date"))
    current = dim.where(F.col("is_current"))
    joined = current.join(snap, current[natural_key] == snap[f"_s_{natural_key}"], "full_outer")
    has, seen = F.col("is_current").isNotNull(), F.col("_s_date").isNotNull()
    changed = has & seen & any_changed([(F.col(t), F.col(f"_s_{t}")) for t in tracked], mode)
    same = [normalise(F.col(f"_s_{t}"), mode).eqNullSafe(normalise(F.col(t), mode)) for t in tracked]
    stays = has & ~F.coalesce(changed, F.lit(False))
    equal = stays
    for s in same:
        equal = equal & s
    old = F.struct(*[F.when(F.coalesce(changed, F.lit(False)), value).otherwise(F.col(c)).alias(c)
                     if value is not None else F.col(c) for c, value in
                     [(c, {"valid_to": F.col("_s_date"), "is_current": F.lit(False)}.get(c)) for c in dim.columns]])
    new = F.struct(*[{key_col: F.lit(None), "valid_from": F.col("_s_date"), "valid_to": F.lit(None),
                      "is_current": F.lit(True)}.get(c, F.col(f"_s_{c}") if c in attributes else F.lit(None))
                     .cast(dim.schema[c].dataType).alias(c) for c in dim.columns])
    rows = F.filter(F.array(F.when(has, old), F.when(seen & ~equal, new)), lambda r: r.isNotNull())
    checkpoint_dir(dim.sparkSession)
    after = joined.select(F.explode(rows).alias("_row")).select("_row.*").checkpoint(eager=True)
    fresh = after.where(F.col(key_col).isNull()).drop(key_col)
    inserted = dense_key(fresh, key_col, [natural_key], start=max_key + 1, evaluated=True)
    kept = dim.where(~F.col("is_current")).unionByName(after.where(F.col(key_col).isNotNull()))
    return kept.unionByName(conform(inserted, "dim_policyholder"))


def apply_snapshots(
    current: DataFrame,
    snapshots: DataFrame,
    natural_key: str = "policyholder_id",
    tracked: Sequence[str] = TRACKED_COLUMNS,
    mode: str = "null_as_empty",
    key_col: str = "policyholder_key",
    max_key: int | None = None,
) -> DataFrame:
    """Apply any number of dated snapshots to a current slice in one pass (H4-H6).

    Equal to folding ``apply_snapshot`` over the dates, in a number of jobs
    that does not hang on theirs: the current slice and all pending rows are
    united, and one window per key, in date order behind the current row,
    finds the rows that open a version.  That is enough because a row that
    equals the one before it equals the open version as well.  Returns the
    rows the snapshots close, the new versions and the untouched current
    rows, keyed ``max_key + 1 ...`` by (valid_from, natural key).

    ``current`` holds one row per key.  A key's group is that row and one row
    per pending date; a key twice on one date fails the job.  Rows without a
    natural key count as one key, as in ``build_history``.
    """
    if max_key is None:
        max_key = current.agg(F.max(key_col)).first()[0] or 0
    attributes = [c for c in current.columns if c not in (key_col, "valid_from", "valid_to", "is_current")]
    base = current.select(*attributes, key_col, "valid_from", F.lit(False).alias("_pending"))
    pending = snapshots.select(
        *[(F.col(c) if c in snapshots.columns else F.lit(None)).cast(current.schema[c].dataType).alias(c) for c in attributes],
        F.lit(None).cast(current.schema[key_col].dataType).alias(key_col), F.col("snapshot_date").alias("valid_from"),
        F.lit(True).alias("_pending"))
    w = Window.partitionBy(natural_key).orderBy("_pending", "valid_from")
    changed = any_changed([(F.lag(F.col(t)).over(w), F.col(t)) for t in tracked], mode)
    repeated = F.lag("_pending").over(w) & (F.lag("valid_from").over(w) == F.col("valid_from"))
    message = F.concat(F.lit(f"{REPEATED} "), F.coalesce(F.col(natural_key).cast("string"), F.lit("NULL")))
    starts = base.unionByName(pending).withColumn(
        "_opens", F.when(F.col("_pending") & F.coalesce(repeated, F.lit(False)), F.raise_error(message).cast("boolean"))
        .otherwise(~F.col("_pending") | (F.row_number().over(w) == 1) | changed)).where("_opens")
    versions = starts.withColumn("valid_to", F.lead("valid_from").over(w)).withColumn("is_current", F.col("valid_to").isNull())
    checkpoint_dir(current.sparkSession)
    after = versions.select(*current.columns).checkpoint(eager=True)
    fresh = after.where(F.col(key_col).isNull()).drop(key_col)
    inserted = dense_key(fresh, key_col, ["valid_from", natural_key], start=max_key + 1, evaluated=True)
    return after.where(F.col(key_col).isNotNull()).unionByName(conform(inserted, "dim_policyholder"))


def version_counts(dim: DataFrame, natural_key: str = "policyholder_id") -> DataFrame:
    """Versions per key (H7)."""
    return dim.groupBy(natural_key).agg(F.count(F.lit(1)).alias("version_count"))


def version_distribution(dim: DataFrame, natural_key: str = "policyholder_id") -> DataFrame:
    """How many keys have 1, 2, 3... versions (H8): two partial-aggregated group-bys."""
    return (
        version_counts(dim, natural_key)
        .groupBy("version_count")
        .agg(F.count(F.lit(1)).alias("holders"))
    )


def multiple_current(dim: DataFrame, natural_key: str = "policyholder_id") -> DataFrame:
    """Keys with more than one current version (H9); empty when healthy."""
    return (
        dim.where(F.col("is_current"))
        .groupBy(natural_key)
        .agg(F.count(F.lit(1)).alias("current_version_count"))
        .where(F.col("current_version_count") > 1)
    )


class HistoryStore:
    """A type-2 history on parquet: closed rows are only ever appended to, versions are published by commit records.

    Layout: ``root/data/part=<id>/is_current=<true|false>/`` and
    ``root/commits/``.  A version is the ``is_current=false`` folders of all
    parts its record names and the ``is_current=true`` folder of the last
    one, so a read prunes to exactly those folders.  An apply reads only the
    current slice (one row per key), writes one new part - the rows it
    closes and the new current slice - and publishes last: until then, and
    if the run breaks before, readers stay on the old version, and a retry
    writes a part of its own.  Older parts are never rewritten.

    Readers that name no version get the newest.  Applying to an older
    version publishes its successor anew, which then is the newest.

    The record keeps the largest surrogate key, which is always in the
    current slice (a version is closed only when a newer version of its key
    gets a larger key), so numbering never scans the history.
    """

    def __init__(self, spark, root: str, natural_key: str = "policyholder_id",
                 tracked: Sequence[str] = TRACKED_COLUMNS, mode: str = "null_as_empty",
                 key_col: str = "policyholder_key"):
        self.spark, self.log = spark, CommitLog(spark, root)
        self.natural_key, self.tracked, self.mode, self.key_col = natural_key, tuple(tracked), mode, key_col

    def latest(self) -> int | None:
        """The newest version; None before ``create``."""
        record = self.log.latest()
        return record["version"] if record else None

    def _record(self, version: int | None) -> dict:
        for number in reversed(self.log.numbers()):
            record = self.log.record(number)
            if version is None or record["version"] == version:
                return record
        raise ValueError(f"no version {'yet' if version is None else version}")

    def _scan(self, parts: Sequence[str]) -> DataFrame:
        schema = T.StructType([f for f in DIM_POLICYHOLDER.fields if f.name != "is_current"]
                              + [T.StructField("part", T.StringType()), T.StructField("is_current", T.BooleanType())])
        return self.spark.read.schema(schema).option("basePath", self.log.data).parquet(*map(self.log.part_path, parts))

    def _write(self, version: int, dim: DataFrame, before: Sequence[str] = ()) -> int:
        """Write ``dim`` as a part, observing its largest key, then publish it as ``version``."""
        obs, part = Observation(), self.log.new_part()
        dim.observe(obs, F.max(self.key_col).alias("max_key")).write.partitionBy("is_current").parquet(self.log.part_path(part))
        self.log.publish({"version": version, "parts": [*before, part], "max_key": obs.get["max_key"] or 0})
        return version

    def create(self, dim: DataFrame) -> int:
        """Write an initial history as version 0."""
        return self._write(0, dim)

    def current(self, version: int | None = None) -> DataFrame:
        last = self._record(version)["parts"][-1:]
        return conform(self._scan(last).where(F.col("is_current")), "dim_policyholder")

    def read(self, version: int | None = None) -> DataFrame:
        parts = self._record(version)["parts"]
        return conform(self._scan(parts).where(~F.col("is_current") | (F.col("part") == parts[-1])), "dim_policyholder")

    def apply(self, version: int | None, snapshots: DataFrame) -> int:
        """Apply one or more dated snapshots to ``version`` (None: the newest) in one pass; returns the new version."""
        record = self._record(version)
        current = conform(self._scan(record["parts"][-1:]).where(F.col("is_current")), "dim_policyholder")
        try:
            updated = apply_snapshots(current, snapshots, self.natural_key, self.tracked, self.mode, self.key_col, record["max_key"])
        except Exception as e:
            if REPEATED in str(e):
                raise ValueError(str(e).partition("\n")[0]) from e
            raise
        return self._write(record["version"] + 1, updated, record["parts"])

    apply_all = apply

    def expire(self, keep: int = 2, orphan_age: float = 86400.0) -> list[str]:
        """Delete what only versions older than the newest ``keep`` use, and what broken runs left behind."""
        def used(record: dict) -> list[str]:
            return [f"part={p}/is_current=false" for p in record["parts"]] + [f"part={record['parts'][-1]}/is_current=true"]
        return self.log.expire(keep, used, orphan_age)
