from pyspark.sql import Window
from pyspark.sql import functions as F

from claimspark.operators.keys import Asc, dense_key, first_by


def test_dense_key_matches_row_number(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("a"), F.col("id").alias("b"))
    keyed = dense_key(df, "k", ["a", "b"])
    ref = df.withColumn("r", F.row_number().over(Window.orderBy("a", "b")))
    assert keyed.join(ref, ["a", "b"]).where("k != r").count() == 0
    assert keyed.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first() == (1, 500, 500)


def test_dense_key_distributed_path_matches_row_number(spark):
    # A hot leading value (a third of the rows share a = 0) is split by the
    # second column; keys stay dense and ordered.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17).alias("a"),
        (F.col("id") * 13 % 3000).alias("b"))
    keyed = dense_key(df, "k", ["a", "b"], start=10, ranges=12)
    ref = df.withColumn("r", F.row_number().over(Window.orderBy("a", "b")) + 9)
    assert keyed.join(ref, ["a", "b"]).where("k != r").count() == 0
    assert keyed.count() == 3000


def test_dense_key_nulls_last(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "m string")
    out = dense_key(df, "k", [Asc("m", nulls_last=True)]).orderBy("k").collect()
    assert [r.m for r in out] == ["a", "b", None]
    out = dense_key(df, "k", ["m"]).orderBy("k").collect()
    assert [r.m for r in out] == [None, "a", "b"]


def test_first_by_keeps_declared_first_row(spark):
    df = spark.createDataFrame([(1, 3, "late"), (1, 1, "first"), (2, 5, "only")], "key int, pos int, v string")
    out = sorted(tuple(r) for r in first_by(df, ["key"], ["pos"]).collect())
    assert out == [(1, 1, "first"), (2, 5, "only")]


def test_cluster_conf_scales_with_input():
    from claimspark.session import cluster_conf

    big = cluster_conf(100 << 40, cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = cluster_conf(1 << 20, cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


class _FakeContext:
    def __init__(self, master, current=None):
        self.master, self._dir = master, current

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, path):
        self._dir = path


class _FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _FakeSession:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _FakeContext(master, current)
        self.conf = _FakeConf(conf or {})


def test_checkpoint_dir_rules(tmp_path):
    import pytest

    from claimspark.session import checkpoint_dir

    shared = str(tmp_path / "shared")
    assert checkpoint_dir(_FakeSession("yarn", {"spark.checkpoint.dir": shared})) == shared
    assert checkpoint_dir(_FakeSession("yarn", current="hdfs://nn/ckpt")) == "hdfs://nn/ckpt"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_FakeSession("k8s://cluster"))
    assert checkpoint_dir(_FakeSession("local[2]"))      # only a local session gets a scratch folder


def test_dense_key_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(0, 2000, 1, 4).mapInPandas(count, "id long")
    assert dense_key(df, "k", ["id"], ranges=5).where("k != id + 1").count() == 0
    assert seen.value == 2000


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0), "k", ["id"]).collect() == []


def test_dense_key_reads_columns_not_whole_rows(spark):
    df = spark.range(0, 50).select("id", F.lit("x").alias("a b"), F.lit("y").alias("ID.2"))
    keyed = dense_key(df, "k", ["id"], ranges=3)
    assert keyed.columns == ["id", "a b", "ID.2", "k"] and keyed.where("`a b` = 'x' and k = id + 1").count() == 50
    plan = keyed.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan


def test_first_by_sends_an_order_column_once(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 1, "c"), (2, None, "d"), (None, 5, "e")], "k int, o int, v string")
    first = first_by(df, ["k"], [Asc("o", nulls_last=True)])
    assert sorted(map(tuple, first.collect()), key=str) == [(1, 1, "a"), (2, None, "d"), (None, 5, "e")]
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "_ord0" in plan and "struct(o, " not in plan and "_row, struct(v, v" in plan
    assert sorted(map(tuple, first_by(df.select("k", "o"), ["k"], ["o"], last=True).collect()), key=str) == [(1, 2), (2, None), (None, 5)]
