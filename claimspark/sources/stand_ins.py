"""Claims-shaped inputs derived from the driver tables.

The modelled warehouse reads an insurance claims file, policyholder
snapshots and a wide sentinel-coded file.  None ships with data, so these
functions derive equivalent inputs from the TPC-H-like driver tables with
plain joins and aggregates; their work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.functions.expressions import from_cents, money_cents
from claimspark.operators.keys import first_by
from claimspark.sources.tables import read_table

MONEY = "decimal(15,2)"


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def _line_summary(lineitem: DataFrame) -> DataFrame:
    """One row per order: line count, first part, amount per return flag.

    Each line's price is cast to DECIMAL(15,2) and summed as exact integer
    cents (a long buffer instead of a BigDecimal per group).
    """
    cents = money_cents(_money(F.col("l_extendedprice")))

    def by_flag(flag: str) -> Column:
        return from_cents(F.sum(F.when(F.col("l_returnflag") == flag, cents).otherwise(F.lit(0))), "decimal(25,2)")

    return lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("l_partkey").alias("partkey"),
        by_flag("A").alias("a_amt"),
        by_flag("N").alias("n_amt"),
        by_flag("R").alias("r_amt"),
        # The status is one letter: its code keeps the aggregate a hash aggregate.
        F.char(F.max(F.ascii("l_linestatus"))).alias("linestatus"),
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim per order (see FIXTURES.md 3.1).

    Orders without lines keep NULL vehicle attributes; every 97th claim has
    no amount.  Joins: orders-customer on the customer key (AQE splits a hot
    customer), lines aggregated map-side before their shuffle on the order
    key, which the order join then reuses.
    """
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    li = _line_summary(read_table(spark, sf_dir, "lineitem"))

    joined = (
        o.join(c, o.o_custkey == c.c_custkey, "inner")
        .join(n, F.col("c_nationkey") == n.n_nationkey, "inner")
        .join(li, o.o_orderkey == li.l_orderkey, "left")
        .join(p, F.col("partkey") == p.p_partkey, "left")
    )
    zero = F.lit(0).cast(MONEY)
    return joined.select(
        F.col("o_orderkey").alias("claim_id"),
        F.col("o_custkey").alias("policy_number"),
        F.col("o_custkey").cast("string").alias("policyholder_id"),
        F.col("o_orderdate").cast("date").alias("incident_date"),
        F.col("o_orderstatus").alias("incident_type"),
        F.col("linestatus").alias("collision_type"),
        F.col("o_orderpriority").alias("incident_severity"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("int").alias("number_of_vehicles_involved"),
        F.when(F.col("o_orderkey") % 97 == 0, F.lit(None).cast(MONEY))
        .otherwise(_money(F.col("o_totalprice")))
        .alias("total_claim_amount"),
        F.coalesce(F.col("a_amt"), zero).cast(MONEY).alias("injury_claim"),
        F.coalesce(F.col("n_amt"), zero).cast(MONEY).alias("property_claim"),
        F.coalesce(F.col("r_amt"), zero).cast(MONEY).alias("vehicle_claim"),
        F.when(F.col("r_amt") > F.col("a_amt"), "Y").otherwise("N").alias("fraud_reported"),
        F.col("p_brand").alias("auto_make"),
        F.col("p_type").alias("auto_model"),
        F.col("p_size").alias("auto_year"),
        F.col("n_name").alias("policy_state"),
        F.col("c_mktsegment").alias("policy_csl"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("policy_annual_premium"),
    )


def holder_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last order of a customer in each quarter, dated at the quarter's end (FIXTURES.md 3.2).

    "Last" is the greatest (order date, order key); it is taken with
    ``first_by(last=True)``, an aggregate combined map-side, before the
    customer join, so a customer with a huge share of the orders reaches the
    join as one row per quarter.  A claim before its holder's first snapshot
    has no version yet, as the point-in-time rule says.  ``relationship``
    is the order status, missing, empty or padded for some orders, which
    tells the two change tests apart.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    quarter_end = F.date_sub(F.add_months(F.date_trunc("quarter", F.col("o_orderdate")), 3), 1)
    latest = first_by(o.withColumn("snapshot_date", quarter_end).where("o_custkey IS NOT NULL"),
                      ["o_custkey", "snapshot_date"], ["o_orderdate", "o_orderkey"], last=True)
    kind, status = F.col("o_orderkey") % 6, F.col("o_orderstatus")
    return latest.join(c, latest.o_custkey == c.c_custkey, "inner").select(
        F.col("o_custkey").cast("string").alias("policyholder_id"),
        F.col("o_orderpriority").alias("occupation"),
        F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("")).when(kind == 2, F.concat(F.lit(" "), status, F.lit(" ")))
        .otherwise(status).alias("relationship"),
        F.col("c_nationkey").cast("string").alias("zip_code"),
        F.col("c_mktsegment").alias("education_level"),
        "snapshot_date",
    )


def wide_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentinel-coded wide rows, one per order (FIXTURES.md 3.3)."""
    o = read_table(spark, sf_dir, "orders")
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        ok.alias("id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("target"),
        F.when(ck % 3 == 0, F.lit(-1)).otherwise((ck % 7).cast("int")).alias("ps_ind_01"),
        F.when(ok % 4 == 0, F.lit(-1)).otherwise((ok % 5).cast("int")).alias("ps_ind_02_cat"),
        F.when(ok % 5 == 0, F.lit(-1.0)).otherwise(F.col("o_totalprice")).alias("ps_reg_01"),
        F.when(ck % 11 == 0, F.lit(-1)).otherwise((ck % 2).cast("int")).alias("ps_car_01_cat"),
        F.when(ok % 2 == 0, F.lit(-1).cast("bigint")).otherwise(ck).alias("ps_car_11"),
        (ok % 10).cast("double").alias("ps_calc_01"),
        F.when(F.col("o_orderstatus") == "P", "-1").otherwise(F.col("o_orderstatus")).alias("note"),
    )


def holder_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims rows carrying the insured-person columns of the claims file.

    ``age``, ``insured_sex`` and ``insured_hobbies`` have no stand-in and
    are typed NULLs.
    """
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        F.col("o_orderkey").alias("claim_id"),
        F.col("o_custkey").alias("policy_number"),
        F.lit(None).cast("int").alias("age"),
        F.lit(None).cast("string").alias("insured_sex"),
        F.col("c_mktsegment").alias("insured_education_level"),
        F.col("o_orderpriority").alias("insured_occupation"),
        F.lit(None).cast("string").alias("insured_hobbies"),
        F.col("o_orderstatus").alias("insured_relationship"),
        F.col("c_nationkey").alias("insured_zip"),
    )
