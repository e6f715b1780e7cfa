import datetime as dt

import pytest

from claimspark.operators import dims as D


def test_dim_date_edges(spark):
    one = D.generate_dim_date(spark, "2024-02-29", "2024-02-29").collect()
    assert [tuple(r) for r in one] == [(20240229, dt.date(2024, 2, 29), "Thursday", 2, 1, 2024, False)]
    rows = {r.full_date: r for r in D.generate_dim_date(spark, "2024-12-28", "2025-01-01").collect()}
    assert len(rows) == 5
    assert rows[dt.date(2024, 12, 28)].is_weekend and rows[dt.date(2024, 12, 29)].day_of_week == "Sunday"
    assert not rows[dt.date(2024, 12, 30)].is_weekend
    assert rows[dt.date(2025, 1, 1)].quarter == 1 and rows[dt.date(2024, 12, 31)].quarter == 4
    assert D.generate_dim_date(spark).count() == 1096
    with pytest.raises(ValueError):
        D.generate_dim_date(spark, "2024-01-02", "2024-01-01")


def test_dim_policy_first_row_and_numeric_order(spark):
    df = spark.createDataFrame(
        [(2, 10, "OH", "a"), (10, 11, "IL", "b"), (2, 9, "IN", "c"), (9, 12, "OH", "d")],
        "policy_number long, claim_id long, policy_state string, policy_csl string")
    out = [tuple(r)[:4] for r in D.build_dim_policy(df).orderBy("policy_key").collect()]
    assert out == [(1, "2", "IN", "c"), (2, "9", "OH", "d"), (3, "10", "IL", "b")]


def test_dim_vehicle_nulls_last_single_row(spark):
    df = spark.createDataFrame(
        [("b", "m", 1), (None, None, None), ("a", "m", 2), (None, None, None), ("a", None, 1), ("a", "m", 2)],
        "auto_make string, auto_model string, auto_year int")
    out = [tuple(r) for r in D.build_dim_vehicle(df).orderBy("vehicle_key").collect()]
    assert out == [(1, "a", "m", 2), (2, "a", None, 1), (3, "b", "m", 1), (4, None, None, None)]


def _holder_claims(spark):
    return spark.createDataFrame(
        [(5, 1, 40, "F", "HS", "clerk", "chess", "wife", 1234),
         (5, 2, 41, "F", "MD", "nurse", "golf", "own", 999),
         (3, 3, 30, "M", "BA", "pilot", None, "husband", 5678)],
        "policy_number long, claim_id long, age int, insured_sex string, insured_education_level string, "
        "insured_occupation string, insured_hobbies string, insured_relationship string, insured_zip long")


def test_policyholder_base_and_sample_guard(spark):
    base = D.create_policyholder_base(_holder_claims(spark), sample_size=None, order=("claim_id",))
    got = {r.policyholder_id: r for r in base.collect()}
    assert set(got) == {"5", "3"} and got["5"].occupation == "clerk" and got["5"].zip_code == "1234"
    assert base.schema["zip_code"].dataType.simpleString() == "string"
    two = D.create_policyholder_base(_holder_claims(spark), sample_size=1, order=("policy_number",))
    assert [r.policyholder_id for r in two.collect()] == ["3"]
    with pytest.raises(ValueError, match="a sample of 30"):
        D.create_policyholder_base(_holder_claims(spark), sample_size=30)


def test_create_snapshot_applies_changes(spark):
    base = D.create_policyholder_base(_holder_claims(spark), sample_size=None, order=("claim_id",))
    snap = D.create_snapshot(base, "2024-03-31", {"5": {"occupation": "chef", "zip_code": "0042"},
                                                  "999": {"occupation": "ghost"}, "3": {"hobbies": None}})
    got = {r.policyholder_id: r for r in snap.collect()}
    assert got["5"].occupation == "chef" and got["5"].zip_code == "0042" and got["5"].relationship == "wife"
    assert got["3"].hobbies is None and got["3"].occupation == "pilot"
    assert set(got) == {"5", "3"} and got["5"].snapshot_date == dt.date(2024, 3, 31)
    plain = D.create_snapshot(base, "2024-01-01")
    assert plain.columns[-1] == "snapshot_date" and plain.count() == 2
