"""Report marts over the star schema.

Every report is a group-by with partial (map-side) aggregation, so a hot
group is combined before the shuffle.  Dimension joins go through
``lookup_join``: profiled, broadcast only under a counted size.  The ranking
and lag windows (W1-W3) run over grouped rows, one row per group
(occupations, makes x years, months), so their single window partition is
bounded by the number of groups, not by the claims.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.functions.expressions import avg_money, flag, round_rate, sum_money
from claimspark.operators.joins import lookup_join, point_in_time_join

MONEY_SUM = "decimal(18,2)"
MEAN = "decimal(18,6)"
RATE = "decimal(9,2)"


def _sum_money(c: str) -> Column:
    return sum_money(F.col(c), MONEY_SUM)


def _fraud() -> Column:
    return F.sum(flag(F.col("fraud_reported") == "Y")).cast("long")


def _count() -> Column:
    return F.count(F.lit(1))


def _with(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, *cols: str) -> DataFrame:
    """Inner join on a surrogate key.  Surrogate keys are dense by
    construction (and tested by ``checks.unique``), so no profile job runs;
    Spark's size statistics and AQE decide whether the dimension is
    broadcast."""
    return lookup_join(fact, dim.select(dim_key, *cols), [(fact_key, dim_key)], "inner", validate=False)


def r01_total(fact: DataFrame) -> DataFrame:
    return fact.agg(_sum_money("total_claim_amount").alias("total_claim_amount"))


def r02_by_state(fact: DataFrame, dim_policy: DataFrame) -> DataFrame:
    return (
        _with(fact, dim_policy, "policy_key", "policy_key", "policy_state")
        .groupBy("policy_state")
        .agg(_count().alias("claim_count"), _sum_money("total_claim_amount").alias("total_claim_amount"))
        .orderBy(F.col("total_claim_amount").desc(), "policy_state")
    )


def r03_fraud_by_severity(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("incident_severity")
        .agg(_count().alias("total_claims"), _fraud().alias("fraudulent_claims"))
        .withColumn("fraud_rate_percent",
                    round_rate(F.col("fraudulent_claims"), F.col("total_claims")).cast(RATE))
        .orderBy(F.col("fraud_rate_percent").desc(), "incident_severity")
    )


def r04_by_make(fact: DataFrame, dim_vehicle: DataFrame) -> DataFrame:
    return (
        _with(fact, dim_vehicle, "vehicle_key", "vehicle_key", "auto_make")
        .groupBy("auto_make")
        .agg(_count().alias("claim_count"), _sum_money("total_claim_amount").alias("total_claim_amount"),
             avg_money(F.col("total_claim_amount"), 6, MEAN).alias("average_claim_amount"))
        .orderBy(F.col("total_claim_amount").desc(), "auto_make")
    )


def r05_by_year(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (
        _with(fact, dim_date, "incident_date_key", "date_key", "year")
        .groupBy("year")
        .agg(_count().alias("claim_count"), _sum_money("total_claim_amount").alias("total_claim_amount"))
        .orderBy("year")
    )


def r06_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (
        _with(fact, dim_date, "incident_date_key", "date_key", "year", "month")
        .groupBy("year", "month")
        .agg(_count().alias("claim_count"), _sum_money("total_claim_amount").alias("total_claim_amount"))
        .orderBy("year", "month")
    )


def r07_by_education(fact: DataFrame, dim_policyholder: DataFrame) -> DataFrame:
    return (
        _with(fact, dim_policyholder, "policyholder_key", "policyholder_key", "education_level")
        .groupBy("education_level")
        .agg(_count().alias("claim_count"), _sum_money("total_claim_amount").alias("total_claim_amount"))
        .orderBy(F.col("total_claim_amount").desc(), "education_level")
    )


def r08_by_occupation(fact: DataFrame, dim_policyholder: DataFrame) -> DataFrame:
    return (
        _with(fact, dim_policyholder, "policyholder_key", "policyholder_key", "occupation")
        .groupBy("occupation")
        .agg(_count().alias("claim_count"),
             avg_money(F.col("total_claim_amount"), 6, MEAN).alias("average_claim_amount"))
        .orderBy(F.col("average_claim_amount").desc(), "occupation")
    )


def r09_fraud_by_make(fact: DataFrame, dim_vehicle: DataFrame) -> DataFrame:
    return (
        _with(fact, dim_vehicle, "vehicle_key", "vehicle_key", "auto_make")
        .groupBy("auto_make")
        .agg(_count().alias("total_claims"), _fraud().alias("fraudulent_claims"))
        .orderBy(F.col("fraudulent_claims").desc(), "auto_make")
    )


def r10_point_in_time(fact: DataFrame, dim_date: DataFrame, dim_policyholder: DataFrame) -> DataFrame:
    """Each claim with the holder attributes valid then; a fact-sized, range-sorted output."""
    dated = _with(fact.select("claim_key", "incident_date_key", "policyholder_key"), dim_date,
                  "incident_date_key", "date_key", "full_date")
    holder = dim_policyholder.select("policyholder_key", "policyholder_id", "occupation", "relationship",
                                     "zip_code", "valid_from", "valid_to")
    return (
        lookup_join(dated, holder, ["policyholder_key"], "inner", validate=False)
        .select("claim_key", F.col("full_date").alias("incident_date"), "policyholder_id", "occupation",
                "relationship", "zip_code", "valid_from", "valid_to")
        .orderBy("claim_key")
    )


def r11_fraud_by_state(fact: DataFrame, dim_policy: DataFrame) -> DataFrame:
    return (
        _with(fact, dim_policy, "policy_key", "policy_key", "policy_state")
        .groupBy("policy_state")
        .agg(_count().alias("total_claims"), _fraud().alias("fraud_claims"))
        .withColumn("fraud_rate_percent", round_rate(F.col("fraud_claims"), F.col("total_claims")).cast(RATE))
        .orderBy(F.col("fraud_rate_percent").desc(), "policy_state")
    )


def r12_occupation_rank(fact: DataFrame, dim_date: DataFrame, dim_policyholder: DataFrame) -> DataFrame:
    """Payout ranking by occupation.

    Joins the holder version on its surrogate key and the closed validity
    range, then ranks grouped sums: ``rank`` leaves gaps after ties.
    """
    dated = _with(fact, dim_date, "incident_date_key", "date_key", "full_date")
    holder = dim_policyholder.select(F.col("policyholder_key").alias("_hk"), "occupation",
                                     "valid_from", "valid_to")
    ctx = point_in_time_join(dated, holder, "policyholder_key", "_hk", "full_date", closed=True)
    grouped = ctx.groupBy("occupation").agg(
        _count().alias("claims"),
        _sum_money("total_claim_amount").alias("_total"),
        avg_money(F.col("total_claim_amount"), 2, MONEY_SUM).alias("avg_claim"),
        _fraud().alias("fraud_flags"),
    )
    w = Window.orderBy(F.col("_total").desc_nulls_last())
    return (
        grouped.withColumn("payout_rank", F.rank().over(w))
        .select("occupation", "claims", F.col("_total").alias("total_paid"),
                "avg_claim", "fraud_flags", "payout_rank")
        .orderBy("payout_rank", "occupation")
    )


def r13_vehicle_risk(fact: DataFrame, dim_vehicle: DataFrame, min_claims: int = 2) -> DataFrame:
    """Vehicle risk profile (W2, F8): groups with more than ``min_claims``
    claims, dense-ranked by the unrounded mean."""
    grouped = (
        _with(fact, dim_vehicle, "vehicle_key", "vehicle_key", "auto_make", "auto_year")
        .groupBy("auto_make", "auto_year")
        .agg(_count().alias("claims"),
             avg_money(F.col("total_claim_amount"), 18).alias("_mean"))
        .where(F.col("claims") > min_claims)
    )
    w = Window.orderBy(F.col("_mean").desc_nulls_last())
    return (
        grouped.withColumn("risk_rank", F.dense_rank().over(w))
        .select("auto_make", "auto_year", "claims", F.round("_mean", 2).cast(MONEY_SUM).alias("avg_claim"),
                "risk_rank")
        .orderBy("risk_rank", "auto_make", "auto_year")
    )


def r14_monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly totals with the previous present month and the change."""
    monthly = (
        _with(fact, dim_date, "incident_date_key", "date_key", "year", "month")
        .groupBy("year", "month")
        .agg(_count().alias("claims"), _sum_money("total_claim_amount").alias("total_paid"))
    )
    w = Window.orderBy("year", "month")
    prev = F.lag("total_paid").over(w)
    return (
        monthly.withColumn("prev_month", prev)
        .withColumn("change", F.round(F.col("total_paid") - prev, 2).cast(MONEY_SUM))
        .orderBy("year", "month")
    )


def star_totals(fact: DataFrame, dims: list[tuple[DataFrame, str, str, list[str]]], where: Column) -> DataFrame:
    """Claims and amounts by attributes of several dimensions at once, where ``where`` holds.

    ``dims`` lists (dimension, key in the fact, its own key, attributes).  The
    joins are written in this order; which comes first is left to the optimizer.
    """
    out, by = fact, []
    for dim, fact_key, dim_key, attributes in dims:
        out = _with(out, dim, fact_key, dim_key, *attributes)
        by += attributes
    return out.where(where).groupBy(*by).agg(
        _count().alias("claim_count"), _sum_money("total_claim_amount").alias("total_claim_amount"))
