"""Deduplication and dense surrogate keys.

Spark has no "input order", so every operator here takes an explicit order
that must be unique; ties would make keys and kept rows nondeterministic.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.session import checkpoint_dir

@dataclass(frozen=True)
class Asc:
    """Ascending sort key with explicit NULL placement."""

    name: str
    nulls_last: bool = False

    def column(self) -> Column:
        c = F.col(self.name)
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()


OrderSpec = Sequence["str | Asc"]


def sort_columns(order: OrderSpec) -> list[Column]:
    return [(o if isinstance(o, Asc) else Asc(o)).column() for o in order]


def first_by(df: DataFrame, key: Sequence[str], order: OrderSpec, last: bool = False) -> DataFrame:
    """Keep the first (or with ``last``, the last) row of each ``key`` group under ``order``.

    ``dropDuplicates`` keeps an arbitrary row.  This is an aggregate,
    ``min``/``max`` of a struct led by the order columns and carrying the
    row, so Spark combines map-side: a hot key leaves each map task as one
    row before the shuffle instead of landing whole in one task, as a
    window would.  An order column travels once, not in the row again.  Ties in ``order`` are broken by the remaining columns,
    so the kept row is deterministic.  A NULL key forms one group.
    """
    specs = [o if isinstance(o, Asc) else Asc(o) for o in order]
    fields = []
    for i, o in enumerate(specs):
        if o.nulls_last:
            fields.append(F.col(o.name).isNull().alias(f"_null{i}"))
        fields.append(F.col(o.name).alias(f"_ord{i}"))
    at = {o.name: f"_best._ord{i}" for i, o in enumerate(specs)}
    payload = [c for c in df.columns if c not in key and c not in at]
    if payload:
        fields.append(F.struct(*payload).alias("_row"))
        at.update({c: f"_best._row.{c}" for c in payload})
    pick = F.max if last else F.min
    best = df.groupBy(*key).agg(pick(F.struct(*fields)).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(at[c]).alias(c) for c in df.columns])


def _written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder; return a scan of it.

    Compressed columns, of which a later job reads those it names; a
    checkpoint holds whole uncompressed rows.  Columns are named by their
    place in the file, so any names pass.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    plain.write.parquet(path)
    return df.sparkSession.read.schema(plain.schema).parquet(path).toDF(*df.columns)


def dense_key(
    df: DataFrame,
    key_col: str,
    order: OrderSpec,
    *,
    start: int = 1,
    ranges: int | None = None,
    evaluated: bool = False,
) -> DataFrame:
    """Add ``key_col`` = start, start+1, ... following a unique ``order`` (K1).

    Equivalent to ``ROW_NUMBER() OVER (ORDER BY order) + start - 1``, by one
    path for every size.  The input is written once into the shared
    checkpoint folder (``evaluated`` says that it is a written table
    already), since range partitioning reads it twice: to sample the order,
    where a hot leading value is split by the later columns, and to move the
    rows.  The sorted ranges are written with each row's range and position,
    which fixes both; a key is its range's offset plus the position.  All
    columns of ``df`` travel, so callers pass only those they keep.  Offsets are a
    running sum over one row per range, a table as small as the number of
    partitions, and are broadcast.  ``ranges`` defaults to the shuffle
    partitions, which grow with the input (``session.cluster_conf``).
    """
    cols = sort_columns(order)
    once = df if evaluated else _written(df, "unkeyed")
    dealt = once.repartitionByRange(ranges, *cols) if ranges else once.repartitionByRange(*cols)
    pid = F.spark_partition_id()
    ranged = _written(
        dealt.sortWithinPartitions(*cols)
        .select("*", pid.alias("_pid"), (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("_pos")),
        "ranges")
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        "_pid", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(start)).cast("long").alias("_offset"))
    return ranged.join(F.broadcast(offsets), "_pid").withColumn(key_col, F.col("_offset") + F.col("_pos")) \
        .drop("_pid", "_pos", "_offset")
