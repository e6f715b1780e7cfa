"""Tables by name, their statistics, and joins ordered by them."""

import re

import pytest
from pyspark.sql import functions as F

from claimspark.plans import reports
from claimspark.sources import warehouse


def joined_first(df):
    """The dimension attribute that the optimizer joins to the fact first: the deepest join's."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    scans = re.findall(r"Relation spark_catalog\.default\.(\w+)", plan)
    return [s for s in scans if not s.endswith("_fact")][0]


@pytest.fixture
def tables(spark, tmp_path):
    """A fact of 20,000 rows and three dimensions; attribute c of 2 has one value in 500 rows."""
    names = []

    def build(tag, distinct):
        fact = spark.range(20000).select(
            *[(F.col("id") * m % 1000).alias(f"k{i}") for i, m in enumerate((7, 11, 13))],
            F.lit("1.50").cast("decimal(15,2)").alias("total_claim_amount"))
        made = [warehouse.save(fact, f"{tag}_fact", str(tmp_path / f"{tag}_fact"), ["k0", "k1", "k2"])]
        for i, n in enumerate(distinct):
            dim = spark.range(1000).select(F.col("id").alias(f"d{i}"), (F.col("id") % n).alias(f"a{i}"))
            made.append(warehouse.save(dim, f"{tag}_dim{i}", str(tmp_path / f"{tag}_dim{i}"), [f"d{i}", f"a{i}"]))
        names.extend([f"{tag}_fact", *[f"{tag}_dim{i}" for i in range(len(distinct))]])
        return made

    yield build
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def totals(made):
    fact, *dims = made
    where = (F.col("a0") == 1) & (F.col("a1") == 2) & (F.col("a2") == 1)
    return reports.star_totals(fact, [(d, f"k{i}", f"d{i}", [f"a{i}"]) for i, d in enumerate(dims)], where)


def test_the_join_order_follows_the_statistics(spark, tables):
    late, early = tables("late", (2, 5, 500)), tables("early", (500, 5, 2))
    written = totals(late).collect()
    with warehouse.cost_based(spark):
        assert joined_first(totals(late)) == "late_dim2"
        assert joined_first(totals(early)) == "early_dim0"
        assert totals(late).collect() == written != []
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"
    assert joined_first(totals(late)) == "late_dim0"


def test_statistics_are_those_of_the_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None), (2, "y"), (None, None)], "n int, `a b` string")
    try:
        warehouse.save(df, "told", str(tmp_path / "told"), ["n", "a b"])
        got = {r["column_name"]: tuple(r)[1:] for r in warehouse.statistics(spark, "told", ["n", "a b"]).collect()}
        assert got == {"n": (2, 1, "1", "2"), "a b": (2, 2, None, None)}
        # Saved again: new files, new statistics; a reader of the old table keeps its files.
        old = warehouse.read(spark, "told")
        warehouse.save(df.where("n = 1"), "told", str(tmp_path / "told2"), ["n"])
        assert warehouse.read(spark, "told", ["n"]).count() == 1 and old.count() == 4
        assert warehouse.statistics(spark, "told", ["n"]).first()["distinct_count"] == 1
        assert warehouse.statistics(spark, "told", ["a b"]).first()["distinct_count"] is None
    finally:
        spark.sql("DROP TABLE IF EXISTS told")


def test_empty_tables_missing_names_and_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown table"):
        warehouse.read(spark, "nowhere")
    empty = spark.createDataFrame([], "n int, m string")
    with pytest.raises(ValueError, match="absent"):
        warehouse.save(empty, "bare", str(tmp_path / "bare"), ["z"])
    try:
        warehouse.save(empty, "bare", str(tmp_path / "bare"), ["n"])
        assert warehouse.read(spark, "bare").count() == 0
        with pytest.raises(ValueError, match="absent"):
            warehouse.read(spark, "bare", ["q"])
        assert warehouse.statistics(spark, "bare", ["n"]).first()["distinct_count"] == 0
    finally:
        spark.sql("DROP TABLE IF EXISTS bare")
