from decimal import Decimal

from pyspark.sql import functions as F

from claimspark.operators import quality as Q


def test_sentinel_rules(spark):
    df = spark.createDataFrame(
        [(-1, -1, -1, -1.0, "-1", Decimal("-1.00"), -1)],
        "id long, target int, a int, b double, s string, d decimal(5,2), c long")
    out = Q.replace_sentinel_with_null(df).first()
    assert out.id == -1 and out.target == -1          # excluded
    assert out.a is None and out.b is None and out.c is None
    assert out.s == "-1" and out.d == Decimal("-1.00")  # untouched types
    nulls = spark.createDataFrame([(None, 5)], "a int, b int")
    assert tuple(Q.replace_sentinel_with_null(nulls).first()) == (None, 5)
    custom = Q.replace_sentinel_with_null(spark.createDataFrame([(9, -1)], "a int, b int"), sentinel=9)
    assert tuple(custom.first()) == (None, -1)


def test_null_density_edges(spark):
    df = spark.createDataFrame([(1, None, None), (2, 3, None), (3, 4, 5)], "id int, a int, b int")
    out = Q.add_null_density(df, []).select("null_field_count", "data_completeness_pct").distinct().collect()
    assert [tuple(r) for r in out] == [(0, 100.0)]
    got = {r.id: (r.null_field_count, r.data_completeness_pct) for r in Q.add_null_density(df, ["a", "b"]).collect()}
    assert got == {1: (2, 0.0), 2: (1, 50.0), 3: (0, 100.0)}


def test_risk_bucket_thresholds_and_rounding(spark):
    df = spark.createDataFrame([(90.0,), (89.9,), (70.0,), (69.9,), (None,)], "data_completeness_pct double")
    got = [r.risk_bucket for r in Q.add_risk_bucket(df).collect()]
    assert got == ["LOW_RISK", "MEDIUM_RISK", "MEDIUM_RISK", "HIGH_RISK", "HIGH_RISK"]
    # 209 columns with 21 NULLs: 89.952...% rounds to 90.0 and is LOW_RISK.
    cols = [F.lit(None).cast("int").alias(f"c{i}") if i < 21 else F.lit(1).alias(f"c{i}") for i in range(209)]
    wide = spark.range(1).select(*cols)
    out = Q.add_risk_bucket(Q.add_null_density(wide, wide.columns)).select(
        "null_field_count", "data_completeness_pct", "risk_bucket").first()
    assert tuple(out) == (21, 90.0, "LOW_RISK")


def test_completeness_counts_new_and_string_columns(spark):
    df = spark.createDataFrame([(1, 0, None, "x")], "id int, target int, ps_ind_01 int, note string")
    assert Q.completeness_columns(df) == ["ps_ind_01", "note"]
    out = Q.clean_wide(df).first()
    assert (out.null_field_count, out.data_completeness_pct, out.risk_bucket) == (1, 50.0, "HIGH_RISK")


def test_bucket_distribution_and_count(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "risk_bucket string")
    assert Q.bucket_count(df) == 3
    assert {tuple(r) for r in Q.bucket_distribution(df).collect()} == {("A", 2), ("B", 1), (None, 1)}


def test_observed_row_count(spark, tmp_path):
    df, obs = Q.with_row_count(spark.range(42))
    df.write.parquet(str(tmp_path / "out"))
    assert obs.get["input_rows"] == 42


def test_persist_for_reuse_spills_to_disk(spark):
    df = Q.persist_for_reuse(spark.range(100))
    try:
        level = df.storageLevel
        assert level.useMemory and level.useDisk
        assert df.count() == 100 and df.count() == 100
    finally:
        df.unpersist()
