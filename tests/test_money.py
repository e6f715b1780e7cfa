"""Exact money arithmetic against Python's Decimal, on generated inputs."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimspark.functions.expressions import avg_money, round_rate, sum_money

CENT = Decimal("0.01")
amounts = st.lists(
    st.one_of(st.none(), st.integers(min_value=0, max_value=10**13 - 1).map(lambda c: Decimal(c) * CENT)),
    min_size=1, max_size=40)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(values=amounts)
def test_sum_and_mean_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(15,2)")
    got = df.agg(sum_money(F.col("x")).alias("s"), avg_money(F.col("x"), 2).alias("a2"),
                 avg_money(F.col("x"), 6).alias("a6")).first()
    present = [v for v in values if v is not None]
    if not present:
        assert got.s is None and got.a2 is None and got.a6 is None
        return
    total = sum(present)
    assert got.s == total

    def half_up(places):
        # exact half-up rounding of the rational mean total / n
        num, den = int(total * 100), len(present) * 100
        q, r = divmod(num * 10**places, den)
        return Decimal(q + (1 if 2 * r >= den else 0)) / Decimal(10**places)

    assert got.a2 == half_up(2)
    assert got.a6 == half_up(6)


@SETTINGS
@given(num=st.integers(min_value=0, max_value=10**9), extra=st.integers(min_value=0, max_value=10**9))
def test_rate_is_exact_half_up(spark, num, extra):
    den = num + extra
    got = spark.range(1).select(round_rate(F.lit(num), F.lit(den)).alias("r")).first().r
    if den == 0:
        assert got is None
        return
    q, r = divmod(num * 10000, den)
    assert got == Decimal(q + (1 if 2 * r >= den else 0)) / 100


def test_strip_matches_python_whitespace(spark):
    from claimspark.functions.expressions import strip

    spaces = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    values = [spaces + "a b" + spaces, " x\x1c", "​ y", "plain", None, spaces]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.s for r in df.select(strip(F.col("v")).alias("s")).collect()]
    assert got == [None if v is None else v.strip() for v in values]
