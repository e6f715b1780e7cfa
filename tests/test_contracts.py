import pytest
from pyspark.sql import types as T

from claimspark.operators import contracts as C


def test_drift_statuses(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id int, target int, extra int")
    got = {r.column: r.status for r in C.drift_report(df, ["id", "target", "ps_ind_01"]).collect()}
    assert got == {"id": "ok", "target": "ok", "extra": "new", "ps_ind_01": "missing"}
    same = spark.createDataFrame([(1, 2)], "target int, id int")
    assert {r.status for r in C.drift_report(same, ["id", "target"]).collect()} == {"ok"}
    typed = C.drift_report(same, T.StructType([T.StructField("id", T.LongType()), T.StructField("target", T.IntegerType())]))
    assert {r.column: r.status for r in typed.collect()}["id"] == "type_changed"


def test_drift_counts_values(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, empty int")
    got = {r.column: r.non_null for r in C.drift_report(df, ["id"]).collect()}
    assert got == {"id": 2, "empty": 0}


def test_expected_wide_columns():
    assert len(C.EXPECTED_WIDE_COLUMNS) == 55 and len(set(C.EXPECTED_WIDE_COLUMNS)) == 55


def test_require_columns_lists_missing_in_order(spark):
    df = spark.createDataFrame([(1,)], "b int")
    with pytest.raises(ValueError, match=r"\['a', 'c'\]"):
        C.require_columns(df, ["a", "b", "c"])


def test_conform_and_rejects(spark):
    df = spark.createDataFrame([("7", "x", "2024-01-05"), ("bad", "y", "nope")],
                               "vehicle_key string, auto_make string, junk string")
    out = C.conform(df, "dim_vehicle", safe=True)
    assert out.columns == ["vehicle_key", "auto_make", "auto_model", "auto_year"]
    assert [tuple(r) for r in out.orderBy("auto_make").collect()] == [(7, "x", None, None), (None, "y", None, None)]
    rej = {r.column: r.rejects for r in C.conform_rejects(df, "dim_vehicle").collect()}
    assert rej == {"vehicle_key": 1, "auto_make": 0}
