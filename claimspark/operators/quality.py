"""Sentinel cleaning, completeness scoring and risk buckets (Q1-Q9).

All row-level work is one ``select`` of built-in expressions: no shuffle,
whole-stage codegen, and columns outside the projection are pruned at the
scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.functions.expressions import bucketize

SENTINEL_TYPES = (T.IntegerType, T.LongType, T.DoubleType)
NON_FEATURES = ("id", "target")

# ---------------------------------------------------------------------------
# Completeness thresholds (percent, on the rounded value) and
# their labels, tried in this order; anything else is HIGH_RISK.
# ---------------------------------------------------------------------------
RISK_THRESHOLDS = ((90, "LOW_RISK"), (70, "MEDIUM_RISK"))
RISK_DEFAULT = "HIGH_RISK"


def sentinel_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    """Int, long and double columns outside ``exclude`` (other numerics are left alone)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, SENTINEL_TYPES) and f.name not in exclude]


def replace_sentinel_with_null(
    df: DataFrame, sentinel: float = -1, exclude: Sequence[str] = NON_FEATURES
) -> DataFrame:
    """``sentinel`` becomes NULL in the sentinel columns (Q1, Q2).

    Strings (even '-1'), decimals and the excluded columns are untouched.
    """
    targets = set(sentinel_columns(df, exclude))
    return df.select(*[
        F.when(F.col(c) == F.lit(sentinel), F.lit(None)).otherwise(F.col(c)).alias(c) if c in targets
        else F.col(c)
        for c in df.columns
    ])


def completeness_columns(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> list[str]:
    """Every column but ``exclude``, including drifted new ones and strings (Q4)."""
    return [c for c in df.columns if c not in exclude]


def null_count_expr(cols: Sequence[str]) -> Column:
    if not cols:
        return F.lit(0)
    terms = [F.col(c).isNull().cast("int") for c in cols]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def add_null_density(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Add ``null_field_count`` and ``data_completeness_pct`` (Q3).

    pct = round((n - nulls) * 100 / n, 1), half-up; no columns gives 0 and
    100.0.  Computed in exact decimal arithmetic, then stored as double.
    """
    cols = completeness_columns(df) if cols is None else list(cols)
    nulls = null_count_expr(cols).cast("int")
    n = len(cols)
    if n == 0:
        pct = F.lit(100.0)
    else:
        pct = F.round((F.lit(n) - nulls).cast("decimal(10,0)") * F.lit(100).cast("decimal(3,0)")
                      / F.lit(n).cast("decimal(10,0)"), 1).cast("double")
    return df.select("*", nulls.alias("null_field_count")).withColumn("data_completeness_pct", pct)


def add_risk_bucket(df: DataFrame, pct_col: str = "data_completeness_pct") -> DataFrame:
    """Label rows by the rounded completeness (Q5); NULL is HIGH_RISK."""
    return df.withColumn("risk_bucket", bucketize(F.col(pct_col), RISK_THRESHOLDS, RISK_DEFAULT))


def clean_wide(df: DataFrame, exclude: Sequence[str] = NON_FEATURES) -> DataFrame:
    """Q1 -> Q3 (over Q4's columns) -> Q5 as one lazy projection chain."""
    cleaned = replace_sentinel_with_null(df, exclude=exclude)
    return add_risk_bucket(add_null_density(cleaned, completeness_columns(cleaned, exclude)))


def bucket_distribution(df: DataFrame, bucket_col: str = "risk_bucket") -> DataFrame:
    """Rows per bucket (Q6): partial aggregation, one tiny shuffle."""
    return df.groupBy(bucket_col).agg(F.count(F.lit(1)).alias("count")).orderBy(bucket_col)


def bucket_count(df: DataFrame, bucket_col: str = "risk_bucket") -> int:
    """Number of distinct buckets, a NULL bucket counted as one (Q7)."""
    return df.groupBy(bucket_col).count().count()


def persist_for_reuse(df: DataFrame) -> DataFrame:
    """Persist a plan that is read more than once (Q8); spills to disk.

    Call ``unpersist()`` when done.  Use only where a plan is reused; a
    single-pass pipeline should stay lazy.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def reusing(df: DataFrame, uses: dict[str, Callable[[DataFrame], DataFrame]], path: str) -> dict[str, DataFrame]:
    """Evaluate ``df`` once for several results (Q8): persist, write each result under ``path``, release.

    The plan is computed by the first use and read from the cache by the
    others; it is released when all are written or one fails.
    """
    kept, out = persist_for_reuse(df), {}
    try:
        for name, use in uses.items():
            result = use(kept)
            result.write.parquet(f"{path}/{name}")
            out[name] = df.sparkSession.read.schema(result.schema).parquet(f"{path}/{name}")
    finally:
        kept.unpersist()
    return out


def with_row_count(df: DataFrame, name: str = "input_rows"):
    """Count rows as a side metric of the next action instead of a second pass (Q9).

    Returns ``(observed_df, observation)``; read ``observation.get[name]``
    after an action on ``observed_df``.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs
