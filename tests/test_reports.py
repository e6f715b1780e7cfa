"""Report edge rows from FIXTURES.md section 4."""

import datetime as dt
from decimal import Decimal

from claimspark.plans import reports as R

FACT = ("claim_key long, policy_key long, policyholder_key long, vehicle_key long, incident_date_key int, "
        "incident_severity string, total_claim_amount decimal(15,2), fraud_reported string")


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def test_r03_no_fraud_and_null_flag(spark):
    df = fact(spark, [(1, 1, 1, 1, 20240101, "Minor", Decimal("1"), "N"),
                      (2, 1, 1, 1, 20240101, "Minor", Decimal("1"), None),
                      (3, 1, 1, 1, 20240101, "Major", Decimal("1"), "Y"),
                      (4, 1, 1, 1, 20240101, "Major", Decimal("1"), "N"),
                      (5, 1, 1, 1, 20240101, "Major", Decimal("1"), "N")])
    got = {r.incident_severity: (r.total_claims, r.fraudulent_claims, r.fraud_rate_percent)
           for r in R.r03_fraud_by_severity(df).collect()}
    assert got == {"Minor": (2, 0, Decimal("0.00")), "Major": (3, 1, Decimal("33.33"))}


def test_r13_having_and_dense_rank_ties(spark):
    vehicles = spark.createDataFrame([(1, "a", 2000), (2, "b", 2001), (3, "c", 2002), (4, "d", 2003)],
                                     "vehicle_key long, auto_make string, auto_year int")
    rows, key = [], 0
    for vk, amounts in {1: [10, 20, 30], 2: [20, 20, 20], 3: [5, 6], 4: [1, 1, 1, 1]}.items():
        for a in amounts:
            key += 1
            rows.append((key, 1, 1, vk, 20240101, "x", Decimal(a), "N"))
    got = [(r.auto_make, r.claims, r.avg_claim, r.risk_rank) for r in R.r13_vehicle_risk(fact(spark, rows), vehicles).collect()]
    # 'c' has exactly 2 claims (out); 'a' and 'b' tie on the mean (share rank 1), 'd' follows without a gap
    assert sorted(got) == [("a", 3, Decimal("20.00"), 1), ("b", 3, Decimal("20.00"), 1), ("d", 4, Decimal("1.00"), 2)]


def test_r14_first_month_and_missing_month(spark):
    dates = spark.createDataFrame(
        [(20240105, dt.date(2024, 1, 5), 2024, 1), (20240210, dt.date(2024, 2, 10), 2024, 2),
         (20240415, dt.date(2024, 4, 15), 2024, 4)], "date_key int, full_date date, year int, month int")
    df = fact(spark, [(1, 1, 1, 1, 20240105, "x", Decimal("10.50"), "N"),
                      (2, 1, 1, 1, 20240210, "x", Decimal("4.25"), "N"),
                      (3, 1, 1, 1, 20240415, "x", Decimal("7.00"), "N")])
    got = [(r.month, r.total_paid, r.prev_month, r.change) for r in R.r14_monthly_trend(df, dates).collect()]
    # no March row: April's previous month is the previous *present* month, February
    assert got == [(1, Decimal("10.50"), None, None), (2, Decimal("4.25"), Decimal("10.50"), Decimal("-6.25")),
                   (4, Decimal("7.00"), Decimal("4.25"), Decimal("2.75"))]


def test_r12_rank_with_gaps(spark):
    dates = spark.createDataFrame([(20240105, dt.date(2024, 1, 5))], "date_key int, full_date date")
    holders = spark.createDataFrame(
        [(1, "pilot", "r", dt.date(2024, 1, 1), None), (2, "nurse", "r", dt.date(2024, 1, 1), None),
         (3, "chef", "r", dt.date(2024, 1, 1), None)],
        "policyholder_key long, occupation string, relationship string, valid_from date, valid_to date")
    df = fact(spark, [(1, 1, 1, 1, 20240105, "x", Decimal("5"), "Y"), (2, 1, 2, 1, 20240105, "x", Decimal("5"), "N"),
                      (3, 1, 3, 1, 20240105, "x", Decimal("1"), "N")])
    got = {r.occupation: (r.total_paid, r.fraud_flags, r.payout_rank)
           for r in R.r12_occupation_rank(df, dates, holders).collect()}
    assert got == {"pilot": (Decimal("5.00"), 1, 1), "nurse": (Decimal("5.00"), 0, 1), "chef": (Decimal("1.00"), 0, 3)}
