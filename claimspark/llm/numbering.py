"""Places of rows in an order, within groups, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.store import unused, written


def numbered(df: DataFrame, group: list[str], order: list[str], place: str, total: str | None = None) -> DataFrame:
    """Add ``place`` = 0, 1, ... by ``order`` (nulls first) inside each ``group``, and ``total``, the group's rows.

    Rows are range-partitioned on group and order, so a group holding most
    rows spreads over many tasks, sorted and written; what a window then
    sums up is one row per range and group.  ``df`` is read twice and should
    be a written table.  Rows equal in group and order get some order; give
    a last order column that is unique where many rows may be alike.
    """
    at, part, first, rows = unused(df, "at", "part", "first", "rows")
    cols = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    ranged = written(df.repartitionByRange(*cols).sortWithinPartitions(*cols)
                     .withColumn(at, F.monotonically_increasing_id()), "numbered") \
        .withColumn(part, F.shiftright(at, 33))
    spans = ranged.groupBy(part, *group).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(rows))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"{part}_{i}" for i in range(len(group))]
    spans = spans.select(
        F.col(part).alias(f"{part}_"), *[F.col(g).alias(n) for g, n in zip(group, names, strict=True)],
        (F.coalesce(F.sum(rows).over(before), F.lit(0)) - F.col(first)).cast("long").alias(first),
        F.sum(rows).over(whole).cast("long").alias(rows))
    same = F.col(part) == F.col(f"{part}_")
    for g, n in zip(group, names, strict=True):
        same = same & F.col(g).eqNullSafe(F.col(n))
    out = ranged.join(spans, same).withColumn(place, F.col(at) + F.col(first))
    if total:
        out = out.withColumn(total, F.col(rows))
    return out.select(*df.columns, place, *([total] if total else []))
