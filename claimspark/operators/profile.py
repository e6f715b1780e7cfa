"""Column groups, null profile, class imbalance and column inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimspark.operators.quality import NON_FEATURES

# ---------------------------------------------------------------------------
# Feature-group prefixes, tried in this order.
# ---------------------------------------------------------------------------
GROUP_PREFIXES = ("ind", "reg", "car", "calc")
OTHER_GROUP = "other"
# Cell texts counted as missing by the inventory (case-sensitive,
# compared after removing double quotes and outer spaces).
NULL_TOKENS = ("", "NA", "N/A", "null")


def column_group(name: str) -> str | None:
    """Group of one column name; ``None`` for id and target."""
    for p in GROUP_PREFIXES:
        if f"_{p}_" in name:
            return p
    return None if name in NON_FEATURES else OTHER_GROUP


def classify_columns(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``(column, group)`` for every column (P1); metadata only, no job."""
    rows = [(c, column_group(c)) for c in df.columns]
    return spark.createDataFrame(rows, "column string, group string")


def group_sizes(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Columns per group (P2), every group listed, empty ones with 0."""
    counts = {g: 0 for g in (*GROUP_PREFIXES, OTHER_GROUP)}
    for c in df.columns:
        g = column_group(c)
        if g is not None:
            counts[g] += 1
    return spark.createDataFrame(list(counts.items()), "group string, columns long")


def column_values(df: DataFrame) -> DataFrame:
    """``(column, group, type, null_count, distinct_values)`` of every column, exact, from one pass.

    Rows give their values column by column; a count per distinct value
    combines in each task before the shuffle, so a hot value is one row a task.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns]))
    counts = df.select(cells.alias("x")).groupBy("x.column", "x.value").agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("column").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"), F.count("value").alias("distinct_values"))
    names = df.sparkSession.createDataFrame(
        [(f.name, column_group(f.name), f.dataType.simpleString()) for f in df.schema.fields], "column string, group string, type string")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return names.join(found, "column", "left").select("column", "group", "type", zero("null_count"), zero("distinct_values"))


def group_values(df: DataFrame) -> DataFrame:
    """``(group, columns, null_count, distinct_values)``: the columns' figures added up by group, empty groups with 0."""
    groups = df.sparkSession.createDataFrame([(g,) for g in (*GROUP_PREFIXES, OTHER_GROUP)], "group string")
    sums = column_values(df).groupBy("group").agg(F.count(F.lit(1)).alias("columns"), F.sum("null_count").alias("null_count"),
                                                  F.sum("distinct_values").alias("distinct_values"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return groups.join(sums, "group", "left").select("group", zero("columns"), zero("null_count"), zero("distinct_values"))


def _unpivot(row_df: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return row_df.selectExpr(f"stack({len(names)}, {stack}) as (column, {value})")


def null_profile(df: DataFrame) -> DataFrame:
    """Per column: NULL count and ``round(nulls / rows * 100, 2)`` half-even.

    One aggregate over every column (a single pass with partial
    aggregation), unpivoted to one row per column.  Zero rows give NULL pct.
    """
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = agg.selectExpr("__rows AS rows", f"stack({len(cols)}, {stack}) AS (column, null_count)")
    return long.select(
        "column", "null_count", "rows",
        F.bround(F.try_divide(F.col("null_count").cast("decimal(20,0)") * 100, F.col("rows").cast("decimal(20,0)")), 2)
        .cast("decimal(7,2)").alias("null_pct"),
    )


def high_null_columns(profile: DataFrame, threshold: float = 20) -> DataFrame:
    """Columns whose null percentage is strictly above ``threshold``."""
    return profile.where(F.col("null_pct") > threshold)


def imbalance_report(df: DataFrame, target_col: str = "target") -> DataFrame:
    """One row: totals, class counts, positive rate (3 dp) and neg/pos ratio (1 dp).

    NULL targets count toward ``total_rows`` only; other values (e.g. 2)
    count toward neither class.  Rounding is half-even; zero rows give a
    NULL rate instead of a division error.
    """
    t = F.col(target_col)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(t == 1).alias("positive_count"),
        F.count_if(t == 0).alias("negative_count"),
    )
    dec = "decimal(20,0)"
    return counts.select(
        "total_rows", "positive_count", "negative_count",
        F.bround(F.try_divide(F.col("positive_count").cast(dec) * 100, F.col("total_rows").cast(dec)), 3)
        .cast("decimal(10,3)").alias("positive_rate_pct"),
        F.bround(F.try_divide(F.col("negative_count").cast(dec),
                              F.greatest(F.col("positive_count"), F.lit(1)).cast(dec)), 1)
        .cast("decimal(21,1)").alias("imbalance_ratio"),
    )


def column_inventory(
    df: DataFrame, order_by: Sequence[str], samples: int = 5, limit: int | None = None
) -> DataFrame:
    """Per column: ordinal, name, first ``samples`` values joined by '|', missing-token count.

    Samples are the first rows in ``order_by`` (a top-k: only ``samples``
    rows per partition travel).  Missing tokens are counted over the first
    ``limit`` rows in that order, or over the whole table when ``limit`` is
    None: one aggregate pass with partial aggregation.  Values are compared
    as text after removing double quotes and outer spaces.
    """
    cols = df.columns
    text = {c: F.trim(F.regexp_replace(F.col(c).cast("string"), '"', "")) for c in cols}
    scope = df
    if limit is not None:
        scope = df.orderBy(*order_by).limit(limit)
    tokens = F.array(*[F.lit(t) for t in NULL_TOKENS])
    missing = scope.agg(*[
        F.count_if(F.col(c).isNull() | F.array_contains(tokens, text[c])).alias(c) for c in cols
    ])
    missing_long = _unpivot(missing, cols, "null_tokens")

    head = df.orderBy(*order_by).limit(samples).select(
        *[F.regexp_replace(F.col(c).cast("string"), '"', "").alias(c) for c in cols],
        F.monotonically_increasing_id().alias("_pos"),
    )
    w = Window.orderBy("_pos")
    head = head.withColumn("_rn", F.row_number().over(w))
    stacked = head.selectExpr("_rn", f"stack({len(cols)}, {', '.join(f'{i}, `{c}`' for i, c in enumerate(cols, 1))}) as (ordinal, v)")
    samples_df = stacked.groupBy("ordinal").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "v"))), lambda s: F.coalesce(s["v"], F.lit(""))), "|")
        .alias("samples")
    )
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols, 1)], "ordinal int, column string")
    return (
        names.join(samples_df, "ordinal", "left")
        .join(missing_long, "column", "left")
        .select("ordinal", "column", F.coalesce("samples", F.lit("")).alias("samples"), "null_tokens")
    )
