"""Date, policy, vehicle and policyholder dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.operators.contracts import POLICYHOLDER_SNAPSHOT, conform, require_columns
from claimspark.operators.keymap import KeyMap
from claimspark.operators.keys import Asc, dense_key, first_by


def generate_dim_date(
    spark: SparkSession, start: str = "2023-01-01", end: str = "2025-12-31"
) -> DataFrame:
    """One row per day, both ends included.

    The row count is fixed by the range, not by any data, so this table has
    a proven size bound (366 rows a year) and may be broadcast.
    """
    d0, d1 = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    if d1 < d0:
        raise ValueError(f"end {end} before start {start}")
    days = F.explode(F.sequence(F.lit(d0), F.lit(d1), F.expr("interval 1 day"))).alias("full_date")
    d = F.col("full_date")
    return spark.range(1).select(days).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.weekday(d).isin(5, 6).alias("is_weekend"),
    )


def dim_date_range_for(df: DataFrame, date_col: str) -> tuple[str, str]:
    """Whole years covering ``date_col``: one aggregate row reaches the driver."""
    lo, hi = df.agg(F.min(date_col), F.max(date_col)).first()
    return f"{lo.year}-01-01", f"{hi.year}-12-31"


# ---------------------------------------------------------------------------
# Policy dimension columns, and the claims-file columns of the
# policyholder with their dimension names.
# ---------------------------------------------------------------------------
POLICY_COLUMNS = (
    "policy_number", "policy_state", "policy_csl", "policy_deductable",
    "policy_annual_premium", "umbrella_limit", "policy_bind_date",
)
HOLDER_RENAMES = {
    "policy_number": "policyholder_id",
    "insured_sex": "sex",
    "insured_education_level": "education_level",
    "insured_occupation": "occupation",
    "insured_hobbies": "hobbies",
    "insured_relationship": "relationship",
    "insured_zip": "zip_code",
}
HOLDER_SOURCE_COLUMNS = ("policy_number", "age", *list(HOLDER_RENAMES)[1:])


def build_dim_policy(claims: DataFrame, first_order: tuple[str, ...] = ("claim_id",), keys: KeyMap | None = None) -> DataFrame:
    """First row per policy, keyed 1..n by policy number.

    The key order is the natural key's own type (a numeric policy number
    sorts numerically); the contract then stores it as text.  With a key map
    ``keys`` (over ``policy_number``), policies of earlier loads keep theirs.
    """
    present = [c for c in POLICY_COLUMNS if c in claims.columns]
    require_columns(claims, ["policy_number"])
    firsts = first_by(claims.select(*present, *first_order), ["policy_number"], list(first_order))
    firsts = firsts.select(*present)
    keyed = keys.attach(firsts) if keys else dense_key(firsts, "policy_key", ["policy_number"])
    return conform(keyed, "dim_policy")


def build_dim_vehicle(claims: DataFrame, keys: KeyMap | None = None) -> DataFrame:
    """Distinct (make, model, year), NULLs sorted last, keyed 1..n.

    With a key map ``keys`` (over the three columns), vehicles of earlier
    loads keep their keys.
    """
    cols = ["auto_make", "auto_model", "auto_year"]
    require_columns(claims, cols)
    distinct = claims.select(*cols).distinct()
    order = [Asc(c, nulls_last=True) for c in cols]
    keyed = keys.attach(distinct, order) if keys else dense_key(distinct, "vehicle_key", order)
    return conform(keyed, "dim_vehicle")


def create_policyholder_base(
    claims: DataFrame, sample_size: int | None = None, order: tuple[str, ...] = ("policy_number",)
) -> DataFrame:
    """First row per policy number, renamed to the holder schema.

    All holders are kept; ``sample_size``, on request, keeps the first n in
    ``order`` and raises when fewer exist (the modelled pipeline samples 30).
    """
    require_columns(claims, list(HOLDER_SOURCE_COLUMNS))
    firsts = first_by(claims.select(*HOLDER_SOURCE_COLUMNS, *[o for o in order if o not in HOLDER_SOURCE_COLUMNS]),
                      ["policy_number"], list(order))
    if sample_size is not None:
        firsts = firsts.orderBy(*order).limit(sample_size)
        n = firsts.count()
        if n < sample_size:
            raise ValueError(f"a sample of {sample_size} holders was asked for; the claims have {n}")
    renamed = firsts.select(
        *[F.col(c).alias(HOLDER_RENAMES.get(c, c)) for c in HOLDER_SOURCE_COLUMNS]
    )
    return renamed.withColumn("policyholder_id", F.col("policyholder_id").cast("string")).withColumn(
        "zip_code", F.col("zip_code").cast("string")
    )


def create_snapshot(
    base: DataFrame,
    snapshot_date: str | dt.date,
    changes: DataFrame | Mapping[str, Mapping[str, object]] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Copy of ``base`` dated ``snapshot_date`` with per-holder overrides.

    ``changes`` is a small mapping ``{id: {column: value}}``, a long table
    ``(policyholder_id, column, value)``, or a wide table of the id and the
    changed columns, in which every row changes all of them.  Each is one
    row per holder, left-joined on the string id; unknown ids are ignored
    and a repeated change is refused.  Only the named columns change; a
    change to NULL is applied as NULL.  ``columns`` names the columns a long
    table may touch; without it their distinct names are collected (one
    small job).
    """
    out = base.withColumn("snapshot_date", F.lit(str(snapshot_date)).cast("date"))
    if changes is None:
        return conform(out, "policyholder_snapshot")
    spark = base.sparkSession
    if isinstance(changes, Mapping):
        rows = [(str(k), c, None if v is None else str(v)) for k, cs in changes.items() for c, v in cs.items()]
        changes = spark.createDataFrame(rows, "policyholder_id string, column string, value string")
    long = "column" in changes.columns
    if not long:
        columns = [c for c in changes.columns if c != "policyholder_id"]
    elif columns is None:
        columns = [r[0] for r in changes.select("column").distinct().collect()]
    unknown = set(columns) - set(POLICYHOLDER_SNAPSHOT.fieldNames())
    if unknown or "policyholder_id" in columns:
        raise ValueError(f"cannot change columns {sorted(unknown | ({'policyholder_id'} & set(columns)))}")
    keys = ["policyholder_id", "column"] if long else ["policyholder_id"]
    repeated = changes.groupBy(*keys).count().where("count > 1").first()
    if repeated:
        raise ValueError(f"repeated change {tuple(repeated)[:-1]}")
    holder = F.col("policyholder_id").cast("string").alias("policyholder_id")
    if long:
        wide = changes.groupBy(holder).pivot("column", columns).agg(F.first(F.struct(F.col("value").alias("v"))))
    else:
        wide = changes.select(holder, *[F.struct(F.col(c).alias("v")).alias(c) for c in columns])
    joined = out.join(wide.select("policyholder_id", *[F.col(c).alias(f"_chg_{c}") for c in columns]),
                      "policyholder_id", "left")
    fields = {f.name: f.dataType for f in out.schema.fields}
    projected = joined.select(
        *[
            F.when(F.col(f"_chg_{c}").isNotNull(), F.col(f"_chg_{c}.v").cast(fields[c])).otherwise(F.col(c)).alias(c)
            if c in columns else F.col(c)
            for c in out.columns
        ]
    )
    return conform(projected, "policyholder_snapshot")
