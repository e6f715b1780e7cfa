"""Guarded lookup joins and the point-in-time join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

class DuplicateKeyError(ValueError):
    """A lookup dimension repeats a join key (many-to-one violated)."""


def key_profile(dim: DataFrame, keys: Sequence[str], null_safe: bool = False) -> tuple[int, int]:
    """(rows, largest group) of ``dim`` on ``keys`` in one partial-aggregated job.

    With ``null_safe`` NULL keys form a group (and can repeat); otherwise
    rows with a NULL key can never match, so they are not counted as
    repeats.
    """
    grouped = dim.groupBy(*keys).count()
    if not null_safe:
        grouped = grouped.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys) or "true")
    rows, biggest = grouped.agg(F.sum("count"), F.max("count")).first()
    return int(rows or 0), int(biggest or 0)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Sequence[tuple[str, str]],
    how: str = "left",
    null_safe: bool = False,
    validate: bool = True,
    profile: tuple[int, int] | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Many-to-one join of ``fact`` to a dimension.

    ``on`` is a list of shared column names or (fact column, dim column)
    pairs; the dim's join columns are dropped from the output.  With
    ``validate`` the dimension is profiled once: a repeated key raises
    ``DuplicateKeyError`` before the join runs.  Spark's size statistics and
    AQE choose the join; only a ``bounded`` dimension, whose size a fixed
    range proves, is marked for broadcast.  ``null_safe`` matches NULL keys
    to each other (``<=>``), which Spark still plans as a hash/sort-merge join.
    ``profile`` passes an already computed ``key_profile`` of ``dim`` (for the
    same keys and NULL rule), so a dimension used by several joins is
    profiled once.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in on]
    dim_keys = [d for _, d in pairs]
    renamed = dim.select(*[F.col(c).alias(f"_dim_{c}") if c in dim_keys else F.col(c) for c in dim.columns])
    if validate:
        _, biggest = profile if profile is not None else key_profile(dim, dim_keys, null_safe)
        if biggest > 1:
            raise DuplicateKeyError(f"dimension repeats key {dim_keys}: {biggest} rows share one key")
    right = F.broadcast(renamed) if bounded else renamed
    conds: list[Column] = []
    for f_col, d_col in pairs:
        left, r = fact[f_col], right[f"_dim_{d_col}"]
        conds.append(left.eqNullSafe(r) if null_safe else left == r)
    out = fact.join(right, conds, how)
    return out.drop(*[f"_dim_{d}" for d in dim_keys])


def point_in_time_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_date: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    closed: bool = False,
) -> DataFrame:
    """Inner join to the version valid on ``fact_date``.

    Half-open ``[valid_from, valid_to)`` with NULL ``valid_to`` open, or
    with ``closed`` the BETWEEN form ``valid_from <= d <= coalesce(valid_to,
    9999-12-31)``.  The natural key is the equi-join key and the range a
    residual, so Spark plans a hash or sort-merge join, never a nested
    loop; facts with no valid version are dropped.  A hot key on the fact
    side is split by AQE's skew join; Spark's size statistics and AQE choose
    between hash and sort-merge.
    """
    d = dim.select(*[F.col(c).alias(f"_v_{c}") if c == dim_key else F.col(c) for c in dim.columns])
    date = fact[fact_date]
    if closed:
        rng = (date >= d[valid_from]) & (date <= F.coalesce(d[valid_to], F.lit("9999-12-31").cast("date")))
    else:
        rng = (date >= d[valid_from]) & (d[valid_to].isNull() | (date < d[valid_to]))
    return fact.join(d, (fact[fact_key] == d[f"_v_{dim_key}"]) & rng, "inner").drop(f"_v_{dim_key}")
