"""Facts by month, and facts and history in buckets: plans and results."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from claimspark.operators import colocated, facts, profile, quality
from claimspark.operators.joins import point_in_time_join
from claimspark.plans.star import star_for
from tests.conftest import SF_SMALL


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_report_of_a_year_reads_that_years_folders_only(spark, tmp_path):
    s = star_for(spark, SF_SMALL)
    facts.write_by_month(s.fact(), str(tmp_path / "f"))
    # Files of other years are made unreadable.
    others = [f for d in (tmp_path / "f").iterdir() if d.name.startswith("incident_month=") and not d.name.endswith(
        tuple(f"=2000{m:02d}" for m in range(1, 13))) for f in d.glob("*.parquet")]
    for f in others:
        f.write_bytes(b"not parquet")
    assert len(others) > 12
    read = facts.read_by_month(spark, str(tmp_path / "f"))
    year = facts.in_period(read, s.dim_date, F.col("year") == 2000)
    assert "dynamicpruning" in executed(year)
    assert year.count() == s.fact().where("incident_date_key DIV 10000 = 2000").count() > 0
    with pytest.raises(Exception, match="parquet|Parquet|PARQUET"):
        facts.in_period(read, s.dim_date, F.col("year") == 1999).count()


@pytest.fixture
def history_and_facts(spark):
    rng = random.Random(4)
    day = dt.date(2020, 1, 1)
    at = lambda i: day + dt.timedelta(days=i)
    versions = []
    for h in range(200):
        cuts = sorted(rng.sample(range(0, 300, 10), rng.randrange(1, 5)))
        versions += [(len(versions) + i, f"h{h}", at(c), at(cuts[i + 1]) if i + 1 < len(cuts) else None) for i, c in enumerate(cuts)]
    claims = [(i, "h7" if i % 3 == 0 else None if i % 11 == 0 else f"h{rng.randrange(230)}", at(rng.randrange(300))) for i in range(6000)]
    return (spark.createDataFrame(versions, "sk int, hid string, valid_from date, valid_to date"),
            spark.createDataFrame(claims, "claim_id int, holder string, day date"))


def test_colocated_join_has_no_exchange_and_the_same_rows(spark, tmp_path, history_and_facts):
    history, claims = history_and_facts
    layout = colocated.lay_out(claims, history, "holder", "hid", str(tmp_path / "l"), buckets=4)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = colocated.join(spark, layout, "day")
        plan = executed(out)
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
        expected = point_in_time_join(claims, history, "holder", "hid", "day")
        assert sorted(map(tuple, out.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
        # The hot holder's third of the facts is not in the buckets.
        assert spark.table(layout.facts).where("holder = 'h7' OR holder IS NULL").count() == 0
        hot = spark.read.parquet(layout.hot_facts)
        assert hot.where("holder = 'h7'").count() == claims.where("holder = 'h7'").count() >= 2000 and hot.where("holder <> 'h7'").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        colocated.drop(spark, layout)


def test_colocated_join_of_nothing(spark, tmp_path, history_and_facts):
    history, claims = history_and_facts
    layout = colocated.lay_out(claims.where("false"), history, "holder", "hid", str(tmp_path / "l"), buckets=2)
    assert colocated.join(spark, layout, "day").count() == 0
    colocated.drop(spark, layout)
    with pytest.raises(ValueError, match="differ in type"):
        colocated.lay_out(claims, history, "claim_id", "hid", str(tmp_path / "m"), buckets=2)


def test_column_values_are_exact(spark):
    rows = [(i, None if i % 3 else 1, "ab"[i % 2], None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, ps_ind_01 int, ps_car_01 string, ps_reg_01 double")
    assert {tuple(r) for r in profile.column_values(df).collect()} == {
        ("id", None, "int", 0, 300), ("ps_ind_01", "ind", "int", 200, 1), ("ps_car_01", "car", "string", 0, 2),
        ("ps_reg_01", "reg", "double", 300, 0)}
    assert {tuple(r) for r in profile.group_values(df).collect()} == {
        ("ind", 1, 200, 1), ("reg", 1, 300, 0), ("car", 1, 0, 2), ("calc", 0, 0, 0), ("other", 0, 0, 0)}
    assert profile.column_values(df.where("false")).where("null_count = 0 AND distinct_values = 0").count() == 4


def test_a_persisted_plan_is_read_twice_and_released(spark, tmp_path):
    df, plans = spark.range(100).select((F.col("id") % 5).alias("k")), []

    def use(column):
        def count(kept):
            out = kept.groupBy(column).count()
            plans.append(out._jdf.queryExecution().executedPlan().toString())
            return out
        return count

    made = quality.reusing(df, {"a": use("k"), "b": use(F.col("k") * 2)}, str(tmp_path / "r"))
    assert len(plans) == 2 and all("InMemoryTableScan" in p for p in plans)
    assert made["a"].count() == made["b"].count() == 5
    assert not df.storageLevel.useMemory and spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    with pytest.raises(ZeroDivisionError):
        quality.reusing(df, {"c": lambda kept: 1 / 0}, str(tmp_path / "s"))
    assert not df.storageLevel.useMemory
