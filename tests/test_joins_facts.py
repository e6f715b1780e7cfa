import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimspark.operators import facts as Fc
from claimspark.operators import joins as J
from claimspark.operators import dims as D


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_guard_and_null_safe(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", 10), (None, 20)], "k string, key int")
    plain = {r.id: r.key for r in J.lookup_join(fact, dim, ["k"]).collect()}
    assert plain == {1: 10, 2: None, 3: None}
    safe = {r.id: r.key for r in J.lookup_join(fact, dim, ["k"], null_safe=True).collect()}
    assert safe == {1: 10, 2: 20, 3: None}
    assert J.lookup_join(fact, dim, ["k"], how="inner").count() == 1
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "k string, key int")
    with pytest.raises(J.DuplicateKeyError):
        J.lookup_join(fact, dup, ["k"])
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "k string, key int")
    J.lookup_join(fact, nulls, ["k"])                      # NULL keys never match: no error
    with pytest.raises(J.DuplicateKeyError):
        J.lookup_join(fact, nulls, ["k"], null_safe=True)  # ... unless NULLs match each other


def test_numbering_gets_only_the_columns_kept(spark, monkeypatch):
    from claimspark.operators import scd2
    from claimspark.plans.star import Star
    from tests.conftest import SF_SMALL

    given = {}
    for module in (Fc, scd2):
        def numbered(df, key_col, *args, real=module.dense_key, **kwargs):
            given[key_col] = set(df.columns)
            return real(df, key_col, *args, **kwargs)
        monkeypatch.setattr(module, "dense_key", numbered)
    star = Star(spark, SF_SMALL)
    assert star.fact().count() > 0
    assert not given["claim_key"] & {"auto_make", "auto_model", "auto_year", "policyholder_id", "valid_from", "valid_to"}
    assert {"incident_date", "policy_number", "claim_id", "policy_key", "incident_date_key"} <= given["claim_key"]
    assert not given["policyholder_key"] & {"_opens", "snapshot_date"}


def test_point_in_time_boundaries(spark):
    d = lambda m, day=1: dt.date(2024, m, day)
    dim = spark.createDataFrame(
        [("h", 1, d(1), d(3)), ("h", 2, d(3), d(3)), ("h", 3, d(3), d(6)), ("h", 4, d(6), None)],
        "hid string, hkey int, valid_from date, valid_to date")
    fact = spark.createDataFrame(
        [(1, "h", d(1)), (2, "h", d(3)), (3, "h", d(5, 31)), (4, "h", d(6)), (5, "h", dt.date(2023, 12, 31)),
         (6, "x", d(2))], "cid int, hid string, day date")
    got = {r.cid: r.hkey for r in J.point_in_time_join(fact, dim, "hid", "hid", "day").collect()}
    assert got == {1: 1, 2: 3, 3: 3, 4: 4}                  # zero-length version 2 is never chosen
    closed = J.point_in_time_join(fact, dim, "hid", "hid", "day", closed=True)
    assert closed.where("cid = 2").count() == 3             # BETWEEN matches every version touching the day
    plan = plan_text(J.point_in_time_join(fact, dim, "hid", "hid", "day"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _claims(spark):
    return spark.createDataFrame(
        [(1, 7, "7", dt.date(2024, 1, 5), "A", "B", "Minor", 1, Decimal("10.00"), Decimal("1.00"),
          Decimal("2.00"), Decimal("3.00"), "Y", "ford", "f1", 2010, "OH", "x", Decimal("5.00")),
         (2, 7, "7", dt.date(2024, 1, 5), "A", "B", "Major", 0, None, Decimal("0"), Decimal("0"),
          Decimal("0"), "N", None, None, None, "OH", "x", Decimal("5.00")),
         (3, 8, "8", dt.date(2023, 1, 1), "A", "B", "Minor", 1, Decimal("4.00"), Decimal("0"), Decimal("0"),
          Decimal("0"), "N", "ford", "f1", 2010, "IL", "y", Decimal("6.00"))],
        "claim_id long, policy_number long, policyholder_id string, incident_date date, incident_type string, "
        "collision_type string, incident_severity string, number_of_vehicles_involved int, "
        "total_claim_amount decimal(15,2), injury_claim decimal(15,2), property_claim decimal(15,2), "
        "vehicle_claim decimal(15,2), fraud_reported string, auto_make string, auto_model string, auto_year int, "
        "policy_state string, policy_csl string, policy_annual_premium decimal(12,2)")


def _holders(spark):
    return spark.createDataFrame(
        [(1, "7", None, None, "e", "o", None, "r", "z", dt.date(2024, 1, 1), None, True),
         (2, "8", None, None, "e", "o", None, "r", "z", dt.date(2024, 1, 1), None, True)],
        "policyholder_key long, policyholder_id string, age int, sex string, education_level string, "
        "occupation string, hobbies string, relationship string, zip_code string, valid_from date, "
        "valid_to date, is_current boolean")


@pytest.mark.parametrize("mode,expected", [("left_keys", 2), ("inner", 1)])
def test_build_fact_modes(spark, mode, expected):
    claims = _claims(spark)
    fact = Fc.build_fact(claims, D.build_dim_policy(claims), _holders(spark), D.build_dim_vehicle(claims),
                         D.generate_dim_date(spark, "2023-01-01", "2024-12-31"), mode=mode)
    rows = fact.orderBy("claim_key").collect()
    assert len(rows) == expected                      # claim 3 predates its holder's first version
    assert [r.claim_key for r in rows] == list(range(1, expected + 1))
    assert rows[0].incident_date_key == 20240105 and rows[0].vehicle_key is not None
    if mode == "left_keys":
        assert rows[1].vehicle_key is not None        # NULL make/model/year matches the NULL vehicle row
    assert fact.columns[:5] == ["claim_key", "policy_key", "policyholder_key", "vehicle_key", "incident_date_key"]
    plan = plan_text(fact)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_stage_and_flat(spark):
    staged = Fc.stage_claims(_claims(spark), keep=("claim_id",))
    assert staged.count() == 2 and len(Fc.STAGE_COLUMNS) == 10
    flat = Fc.claims_flat(staged).orderBy("claim_key").collect()
    assert [(r.claim_key, r.incident_date) for r in flat] == [(1, dt.date(2023, 1, 1)), (2, dt.date(2024, 1, 5))]
    assert Fc.dropped_claims(_claims(spark), staged.select("claim_id")).count() == 1


@pytest.mark.parametrize("mode,expected", [("inner", {"no_vehicle": 1, "no_holder_version": 1}),
                                           ("left_keys", {"no_holder_version": 1})])
def test_drop_reasons_account_for_every_claim(spark, mode, expected):
    claims = _claims(spark)
    dims = (D.build_dim_policy(claims), _holders(spark), D.build_dim_vehicle(claims),
            D.generate_dim_date(spark, "2023-01-01", "2024-12-31"))
    drops = {r.reason: r.claims for r in Fc.drop_reasons(claims, *dims, mode=mode).collect()}
    assert drops == expected
    assert Fc.build_fact(claims, *dims, mode=mode).count() + sum(drops.values()) == claims.count()
