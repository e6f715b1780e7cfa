"""Audits from one scan, and tables published only when they pass."""

import random

import pytest
from pyspark.sql import functions as F

from claimspark.operators import checks as V
from claimspark.operators import contracts as C
from claimspark.plans import pipeline
from claimspark.sources import stand_ins as SI
from claimspark.sources.published import PublishedTable
from tests.conftest import SF_SMALL


def tables(spark):
    rng = random.Random(2)
    fact = [(i if rng.random() < .95 else rng.choice([None, 3]), rng.choice([1, 2, 2, 2, 9, None]), rng.choice(["x", "y", "z", None]))
            for i in range(400)]
    dim_a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a long")
    dim_b = spark.createDataFrame([("x",), ("y",)], "b string")
    return spark.createDataFrame(fact, "id long, fa int, fb string"), dim_a, dim_b


def test_audit_equals_the_single_checks(spark):
    fact, a, b = tables(spark)
    versions = spark.createDataFrame([("k", True, 1), ("k", True, 2), ("k", False, 3), ("m", True, 4), (None, True, 5), (None, True, 6)],
                                     "nk string, is_current boolean, sk int")
    found = V.report([
        V.audit(fact, "f", unique=[["id"], ["fa", "fb"]], not_null=["id", "fa"], references=[("fa", a, "a"), ("fb", b, "b")]),
        V.audit(versions, "v", single_current="nk"), V.audit(fact.where("false"), "e", unique=[["id"]], references=[("fa", a, "a")])])
    expected = V.report([
        V.unique(fact, ["id"], "f"), V.unique(fact, ["fa", "fb"], "f"), V.not_null(fact, ["id", "fa"], "f"),
        V.relationships(fact, "fa", a, "a", "f"), V.relationships(fact, "fb", b, "b", "f"),
        V.single_current(versions.where("nk IS NOT NULL"), "nk", "v"), V.unique(fact.where("false"), ["id"], "e"),
        V.relationships(fact.where("false"), "fa", a, "a", "e")])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert V.audit(fact, "f").collect() == []


def test_audit_reads_its_table_once(spark, tmp_path):
    fact, a, b = tables(spark)
    fact.write.parquet(str(tmp_path / "fact"))
    read = spark.read.parquet(str(tmp_path / "fact"))
    plan = V.audit(read, "f", unique=[["id"]], not_null=["fa"], references=[("fa", a, "a"), ("fb", b, "b")])
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_a_failing_audit_leaves_the_old_table(spark, tmp_path):
    df = spark.range(10).select("id")
    table = PublishedTable(spark, str(tmp_path / "t"), df.schema)
    audit = lambda x: V.audit(x, "t", unique=[["id"]], not_null=["id"])
    with pytest.raises(ValueError):
        table.read()
    assert table.publish(df, audit) == 0
    with pytest.raises(V.CheckFailed, match="unique"):
        table.publish(df.unionAll(df), audit)
    assert table.latest() == 0 and table.read().count() == 10
    assert table.publish(df.where("id < 4"), audit) == 1
    assert table.read().count() == 4 and table.read(0).count() == 10
    assert table.log.latest()["rows"] == 4 and all(c["passed"] for c in table.log.latest()["checks"])
    # What failed its audit, and the older version, can go.
    assert len(table.expire(keep=1, orphan_age=0)) == 2
    assert table.read().count() == 4 and len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_a_broken_writer_publishes_nothing(spark, tmp_path):
    df = spark.range(10).select("id")
    table = PublishedTable(spark, str(tmp_path / "t"), df.schema)
    table.publish(df)
    with pytest.raises(Exception, match="boom"):
        table.publish(df.select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")).alias("id")))
    assert table.latest() == 0 and table.read().count() == 10


def test_the_warehouse_changes_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    claims = SI.claims(spark, SF_SMALL)
    snaps = C.conform(SI.holder_snapshots(spark, SF_SMALL), "policyholder_snapshot")
    root = str(tmp_path / "w")
    first, report = pipeline.publish_warehouse(spark, claims, snaps, root)
    assert report.count() > 10 and all(r["passed"] for r in report.collect())
    n = pipeline.read_warehouse(spark, root).fact_claims.count()
    assert n == first.fact_claims.count() > 0
    with monkeypatch.context() as m:
        m.setattr(pipeline, "warehouse_checks", lambda w: V.audit(w.dim_policy, "dim_policy", unique=[["policy_state"]]))
        with pytest.raises(V.CheckFailed, match="policy_state"):
            pipeline.publish_warehouse(spark, claims.where("claim_id % 2 = 0"), snaps, root)
    after = pipeline.read_warehouse(spark, root)
    assert after.fact_claims.count() == n and after.dim_policyholder.count() == first.dim_policyholder.count()
