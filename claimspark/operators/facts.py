"""Fact assembly: the star-schema fact and the flat claims mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.operators.contracts import FACT_CLAIMS, conform, require_columns
from claimspark.operators.joins import lookup_join, point_in_time_join
from claimspark.operators.keys import dense_key

# ---------------------------------------------------------------------------
# Fact modes, the claim's descriptive and measure columns, and
# the column lists of the staging model and the flat mart (further below).
# ---------------------------------------------------------------------------
FACT_MODES = ("left_keys", "inner")
# Unique order for claim keys: date, policy, then the claim's own id.
CLAIM_ORDER = ("incident_date", "policy_number", "claim_id")

CLAIM_COLUMNS = (
    "incident_type", "collision_type", "incident_severity", "number_of_vehicles_involved",
    "total_claim_amount", "injury_claim", "property_claim", "vehicle_claim", "fraud_reported",
)


def build_fact(
    claims: DataFrame,
    dim_policy: DataFrame,
    dim_policyholder: DataFrame,
    dim_vehicle: DataFrame,
    dim_date: DataFrame,
    mode: str = "inner",
    holder_id_col: str = "policyholder_id",
    claim_order: tuple[str, ...] = CLAIM_ORDER,
    profiles: dict[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Resolve every claim to its dimension keys.

    ``left_keys``: policy, vehicle (NULL-safe on make/model/year) and date are
    left lookups that keep a claim with a missing key; the point-in-time
    policyholder join drops claims with no valid version.  ``inner``: every
    dimension must match (NULL vehicle attributes never match).  Dimensions
    are profiled once for uniqueness; ``dim_date`` is bounded by its date
    range and may be broadcast.  Claim keys are dense in ``claim_order``.
    ``profiles`` (``policy``, ``vehicle``, ``date``: ``key_profile`` results)
    reuse profiles already computed.
    """
    if mode not in FACT_MODES:
        raise ValueError(f"mode must be one of {FACT_MODES}")
    require_columns(claims, ["policy_number", holder_id_col, "incident_date", "auto_make", "auto_model",
                             "auto_year", *claim_order, *CLAIM_COLUMNS])
    how = "left" if mode == "left_keys" else "inner"
    base = claims.select(
        *{c: None for c in (*claim_order, holder_id_col, "auto_make", "auto_model", "auto_year", *CLAIM_COLUMNS)},
        F.col("policy_number").cast("string").alias("_policy_number_text"),
        F.col("incident_date").cast("date").alias("_incident_date"),
    )
    profiles = profiles or {}
    null_safe = mode == "left_keys"
    fact = lookup_join(base, dim_policy.select("policy_key", "policy_number"),
                       [("_policy_number_text", "policy_number")], how, profile=profiles.get("policy"))
    fact = lookup_join(fact, dim_vehicle.select("vehicle_key", "auto_make", "auto_model", "auto_year"),
                       ["auto_make", "auto_model", "auto_year"], how, null_safe=null_safe,
                       profile=profiles.get("vehicle_null_safe" if null_safe else "vehicle"))
    holder = dim_policyholder.select("policyholder_key", F.col("policyholder_id").alias("_holder_id"),
                                     "valid_from", "valid_to")
    fact = point_in_time_join(fact, holder, holder_id_col, "_holder_id", "_incident_date")
    fact = lookup_join(fact, dim_date.select(F.col("date_key").alias("incident_date_key"), "full_date"),
                       [("_incident_date", "full_date")], how, profile=profiles.get("date"),
                       bounded=True)
    # Numbering moves and writes every column it is given: those of the joins stay behind.
    kept = [c for c in FACT_CLAIMS.fieldNames() if c in fact.columns]
    keyed = dense_key(fact.select(*{c: None for c in (*kept, *claim_order)}), "claim_key", list(claim_order))
    return conform(keyed, FACT_CLAIMS)


def dropped_claims(claims: DataFrame, fact_keys: DataFrame) -> DataFrame:
    """Claims absent from a fact, as a left-anti join on the claim id."""
    return claims.join(fact_keys, "claim_id", "left_anti")


STAGE_COLUMNS = (
    "policy_number", "incident_date", "incident_type", "collision_type", "incident_severity",
    "total_claim_amount", "injury_claim", "property_claim", "vehicle_claim", "fraud_reported",
)


def stage_claims(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Staging model: 10 columns, date cast, rows without an amount removed.

    ``keep`` carries extra columns (e.g. a unique id for later numbering).
    The filter and the projection reach the parquet scan.
    """
    require_columns(raw, (*STAGE_COLUMNS, *keep))
    return raw.where(F.col("total_claim_amount").isNotNull()).select(
        *[F.col(c).cast("date").alias(c) if c == "incident_date" else F.col(c) for c in STAGE_COLUMNS],
        *keep,
    )


FLAT_COLUMNS = (
    "claim_key", "policy_number", "incident_date", "incident_type", "total_claim_amount",
    "injury_claim", "property_claim", "vehicle_claim", "fraud_reported",
)


def claims_flat(staged: DataFrame, tie_breaker: str = "claim_id", **key_options) -> DataFrame:
    """Flat claims mart: staged claims numbered by incident date.

    The date alone ties; ``tie_breaker`` makes the numbering deterministic.
    ``key_options`` go to ``dense_key``.
    """
    columns = {c: None for c in (*FLAT_COLUMNS[1:], tie_breaker)}
    keyed = dense_key(staged.select(*columns), "claim_key", ["incident_date", tie_breaker], **key_options)
    return keyed.select(*FLAT_COLUMNS)


DROP_REASONS = ("no_policy", "no_vehicle", "no_holder_version", "no_date")


def drop_reasons(
    claims: DataFrame,
    dim_policy: DataFrame,
    dim_policyholder: DataFrame,
    dim_vehicle: DataFrame,
    dim_date: DataFrame,
    mode: str = "inner",
    holder_id_col: str = "policyholder_id",
) -> DataFrame:
    """Claims ``build_fact`` leaves out, counted by the first reason (``reason, claims``).

    Reasons are tested in join order: policy, vehicle, valid holder version,
    date.  In ``left_keys`` mode a missing policy, vehicle or date keeps the
    claim (with a NULL key), so only ``no_holder_version`` drops it.  Each
    lookup is a left join that only flags the match; the validity ranges of
    one holder never overlap, so the point-in-time lookup matches at most
    one version and no claim is repeated.  One aggregate at the end.
    """
    if mode not in FACT_MODES:
        raise ValueError(f"mode must be one of {FACT_MODES}")
    base = claims.select("claim_id", holder_id_col, "auto_make", "auto_model", "auto_year",
                         F.col("policy_number").cast("string").alias("_pn"),
                         F.col("incident_date").cast("date").alias("_d"))
    vehicle = ["auto_make", "auto_model", "auto_year"]
    hold = dim_policyholder.select(F.col("policyholder_id").alias("_h_id"), "valid_from", "valid_to")
    in_range = (F.col("_d") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_d") < F.col("valid_to")))
    # The guarded lookups of the fact: a repeated dimension key raises instead of counting a claim twice.
    flagged = lookup_join(base, dim_policy.select("policy_number", F.lit(True).alias("_has_policy")),
                          [("_pn", "policy_number")], "left")
    flagged = lookup_join(flagged, dim_vehicle.select(*vehicle, F.lit(True).alias("_has_vehicle")), vehicle, "left",
                          null_safe=mode == "left_keys")
    flagged = flagged.join(hold, (F.col(holder_id_col) == F.col("_h_id")) & in_range, "left")
    flagged = lookup_join(flagged, dim_date.select("full_date", F.lit(True).alias("_has_date")),
                          [("_d", "full_date")], "left", bounded=True)
    strict = mode == "inner"
    reason = (
        F.when(F.lit(strict) & F.col("_has_policy").isNull(), "no_policy")
        .when(F.lit(strict) & F.col("_has_vehicle").isNull(), "no_vehicle")
        .when(F.col("_h_id").isNull(), "no_holder_version")
        .when(F.lit(strict) & F.col("_has_date").isNull(), "no_date")
    )
    return (flagged.select(reason.alias("reason")).where(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).alias("claims")))


MONTH = "incident_month"


def write_by_month(fact: DataFrame, path: str) -> None:
    """The fact in one folder per month of its date key (yyyymm), so a report of some months reads their folders only."""
    dated = fact.withColumn(MONTH, F.expr("CAST(incident_date_key DIV 100 AS INT)"))
    dated.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(path)


def read_by_month(spark: SparkSession, path: str, schema: T.StructType = FACT_CLAIMS) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())])).parquet(path)


def in_period(fact: DataFrame, dim_date: DataFrame, condition: Column) -> DataFrame:
    """Rows of a fact by month whose date meets ``condition`` on ``dim_date``, with the date's columns.

    The date's month joins the folders' months as well.  ``dim_date`` is
    small by its date range and broadcast, so the months it keeps prune the
    folders before the fact is read (dynamic partition pruning); the report
    names no month itself.
    """
    days = dim_date.where(condition).withColumn("_month", F.expr("CAST(date_key DIV 100 AS INT)"))
    return fact.join(F.broadcast(days), (fact[MONTH] == days["_month"]) & (fact["incident_date_key"] == days["date_key"])) \
        .drop("_month", MONTH)
