from decimal import Decimal

from claimspark.operators import profile as P


def test_column_groups(spark):
    df = spark.createDataFrame([], "id int, target int, ps_ind_01 int, ps_reg_01 double, ps_car_11 int, "
                                   "ps_calc_01 double, x_car_y int, note string")
    got = {r.column: r.group for r in P.classify_columns(spark, df).collect()}
    assert got == {"id": None, "target": None, "ps_ind_01": "ind", "ps_reg_01": "reg", "ps_car_11": "car",
                   "ps_calc_01": "calc", "x_car_y": "car", "note": "other"}
    sizes = dict(tuple(r) for r in P.group_sizes(spark, df).collect())
    assert sizes == {"ind": 1, "reg": 1, "car": 2, "calc": 1, "other": 1}


def test_null_profile_half_even(spark):
    # 1 NULL in 8 rows = 12.5%; 1 in 400 = 0.25% -> half-even 0.2.
    df = spark.range(400).selectExpr("IF(id = 0, NULL, id) AS a", "IF(id < 50 AND id = 0, NULL, 1) AS b")
    prof = {r.column: r for r in P.null_profile(df).collect()}
    assert prof["a"].null_pct == Decimal("0.25") and prof["b"].null_pct == Decimal("0.25")
    small = spark.range(8).selectExpr("IF(id = 0, NULL, id) AS a")
    assert P.null_profile(small).first().null_pct == Decimal("12.50")
    tie = spark.range(800).selectExpr("IF(id < 1, NULL, id) AS a")   # 0.125 -> 0.12
    assert P.null_profile(tie).first().null_pct == Decimal("0.12")
    high = P.high_null_columns(P.null_profile(spark.range(10).selectExpr("IF(id < 2, NULL, 1) AS a",
                                                                        "IF(id < 3, NULL, 1) AS b")))
    assert [r.column for r in high.collect()] == ["b"]          # 20% is not > 20


def test_imbalance_edges(spark):
    empty = P.imbalance_report(spark.createDataFrame([], "target int")).first()
    assert tuple(empty) == (0, 0, 0, None, Decimal("0.0"))
    nopos = P.imbalance_report(spark.createDataFrame([(0,), (0,)], "target int")).first()
    assert tuple(nopos) == (2, 0, 2, Decimal("0.000"), Decimal("2.0"))
    mixed = P.imbalance_report(spark.createDataFrame([(1,), (0,), (0,), (None,), (2,), (0,)], "target int")).first()
    assert tuple(mixed) == (6, 1, 3, Decimal("16.667"), Decimal("3.0"))


def test_column_inventory_tokens_and_samples(spark):
    df = spark.createDataFrame(
        [(1, " NA ", 'a"b'), (2, "na", None), (3, "N/A", "x,y"), (4, "null", "")],
        "k int, v string, w string")
    inv = {r.column: r for r in P.column_inventory(df, ["k"]).collect()}
    assert inv["k"].samples == "1|2|3|4" and inv["k"].null_tokens == 0
    assert inv["v"].null_tokens == 3          # ' NA ', 'N/A', 'null'; 'na' is not a token
    assert inv["w"].samples == "ab||x,y|" and inv["w"].null_tokens == 2
    assert [r.ordinal for r in P.column_inventory(df, ["k"]).orderBy("ordinal").collect()] == [1, 2, 3]
    limited = {r.column: r.null_tokens for r in P.column_inventory(df, ["k"], limit=2).collect()}
    assert limited["v"] == 1
