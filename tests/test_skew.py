"""Hot keys: one key holds a third of all rows.  Results must stay whole and
exact, and the plans must reduce the hot key before any shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from claimspark.operators import joins as J
from claimspark.operators import scd2 as H
from claimspark.operators.keys import dense_key, first_by
from claimspark.plans import reports as R

N = 6000


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark):
    # key 0 holds every third row
    return spark.range(N).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1).alias("k"),
        (F.col("id") * 7 % 1000).alias("v"))


def test_first_by_hot_key_exact_and_combined_map_side(spark):
    df = skewed(spark)
    got = {r.k: r.row_id for r in first_by(df, ["k"], ["v", "row_id"]).collect()}
    brute = {}
    for r in df.collect():
        if r.k not in brute or (r.v, r.row_id) < brute[r.k]:
            brute[r.k] = (r.v, r.row_id)
    assert got == {k: rid for k, (_, rid) in brute.items()}
    plan = executed(first_by(df, ["k"], ["v", "row_id"]))
    assert "partial_min" in plan and "Window" not in plan


def test_point_in_time_join_hot_key(spark):
    facts = skewed(spark).select("row_id", F.col("k").cast("string").alias("hid"),
                                 F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("v") % 90).cast("int")).alias("day"))
    versions = spark.createDataFrame(
        [("0", 1, dt.date(2024, 1, 1), dt.date(2024, 2, 1)), ("0", 2, dt.date(2024, 2, 1), None)]
        + [(str(k), 10 + k, dt.date(2024, 1, 1), None) for k in range(1, 501)],
        "hid string, hkey int, valid_from date, valid_to date")
    out = J.point_in_time_join(facts, versions, "hid", "hid", "day")
    assert out.count() == N                               # every fact matches exactly one version
    hot = {r.hkey: r.c for r in out.where("hid = '0'").groupBy("hkey").agg(F.count("*").alias("c")).collect()}
    days = [r.day for r in facts.where("hid = '0'").collect()]
    assert hot == {1: sum(d < dt.date(2024, 2, 1) for d in days), 2: sum(d >= dt.date(2024, 2, 1) for d in days)}
    assert "NestedLoop" not in executed(out) and "Cartesian" not in executed(out)


def test_grouped_report_hot_group_partial_aggregation(spark):
    fact = skewed(spark).select(
        F.when(F.col("k") == 0, "HOT").otherwise("other").alias("incident_severity"),
        F.when(F.col("v") % 4 == 0, "Y").otherwise("N").alias("fraud_reported"))
    out = R.r03_fraud_by_severity(fact)
    rows = {r.incident_severity: (r.total_claims, r.fraudulent_claims) for r in out.collect()}
    assert rows["HOT"][0] == N // 3 and sum(t for t, _ in rows.values()) == N
    assert "partial_count" in executed(out)


def test_dense_key_hot_leading_value_distributed(spark):
    df = skewed(spark)
    keyed = dense_key(df, "key", ["k", "row_id"], ranges=12)
    ranks = {r.row_id: r.key for r in keyed.collect()}
    order = sorted(df.collect(), key=lambda r: (r.k, r.row_id))
    assert [ranks[r.row_id] for r in order] == list(range(1, N + 1))


def test_history_of_a_key_is_bounded_by_snapshot_dates(spark):
    # a hot holder appears in every snapshot; its window group is one row per date
    rows = [(str(h), dt.date(2024, 1, 1) + dt.timedelta(days=d), f"o{(d // 7) if h == 0 else 0}")
            for d in range(60) for h in range(20)]
    snaps = spark.createDataFrame(rows, "policyholder_id string, snapshot_date date, occupation string") \
        .withColumn("zip_code", F.lit("z")).withColumn("relationship", F.lit("r"))
    hist = H.build_history(snaps)
    assert hist.where("policyholder_id = '0'").count() == 9 and hist.count() == 9 + 19
