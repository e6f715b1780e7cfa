"""Plan-shape properties from the build plan: no cartesian products or
nested-loop joins anywhere in the registered queries, and no single-partition
exchange of data rows on the distributed key path."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from claimspark.operators.keys import dense_key
from tests.conftest import SF_SMALL

QUERIES = {n: q for n, q in E.queries().items() if not n.startswith(("op", "pipeline"))}


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("r", "fact", "pit", "dq", "orphan"))))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = executed(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_distributed_keys_never_gather_rows(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("a"), F.col("id").alias("b"))
    plan = executed(dense_key(df, "k", ["a", "b"], ranges=9))
    # The only single partition holds one row per range, in the offsets' running sum.
    data = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in data and "Window" not in data


def test_joins_without_broadcast_are_sort_merge_and_equal(spark):
    from claimspark.operators.joins import lookup_join

    fact = spark.range(0, 1000).select((F.col("id") % 7).alias("k"), "id")
    dim = spark.range(0, 5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = sorted(lookup_join(fact, dim, ["k"]).collect())
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(fact, dim, ["k"])
        assert "SortMergeJoin" in executed(joined) and "BroadcastHashJoin" not in executed(joined)
        assert sorted(joined.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
