"""Reusable column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The characters Python's str.strip() removes by default (every
# character whose str.isspace() is true), as a Java regex class.
# ---------------------------------------------------------------------------
WHITESPACE_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F"
                    r"\u205F\u3000]")
_OUTER_SPACE = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"


def strip(c: Column) -> Column:
    """Remove outer whitespace as ``str.strip()`` does (tabs, newlines and
    Unicode spaces too, unlike ``trim``)."""
    return F.regexp_replace(c, _OUTER_SPACE, "")


CHANGE_MODES = ("strict", "null_as_empty")


def normalise(c: Column, mode: str) -> Column:
    """Value as compared by a change test.

    ``strict``: text with outer whitespace removed; NULL stays NULL, so
    NULL and '' differ.  ``null_as_empty``: NULL counts as '', no stripping.
    """
    if mode == "strict":
        return strip(c.cast("string"))
    if mode == "null_as_empty":
        return F.coalesce(c.cast("string"), F.lit(""))
    raise ValueError(f"mode must be one of {CHANGE_MODES}, got {mode!r}")


def any_changed(pairs: Sequence[tuple[Column, Column]], mode: str) -> Column:
    """True when any (old, new) pair differs under ``mode``; NULL-safe."""
    tests = [~normalise(old, mode).eqNullSafe(normalise(new, mode)) for old, new in pairs]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def bucketize(c: Column, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """First label whose threshold ``c`` reaches (``>=``), tried in order; else ``default``.

    NULL reaches no threshold and gets ``default``.
    """
    expr = None
    for threshold, label in thresholds:
        expr = (F.when(c >= threshold, label) if expr is None else expr.when(c >= threshold, label))
    return F.lit(default) if expr is None else expr.otherwise(default)


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL counts as 0)."""
    return F.when(cond, 1).otherwise(0)


def round_rate(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """``round(100 * n / d, scale)`` as exact decimal arithmetic; NULL when d = 0."""
    return F.round(F.try_divide(F.lit(100).cast("decimal(3,0)") * numerator.cast("decimal(20,0)"),
                                denominator.cast("decimal(20,0)")), scale)


# Money is summed as 64-bit integer cents: Spark widens sum(decimal(15,2)) to
# decimal(25,2), whose aggregation buffer is a BigDecimal object per group.
# A long sum is exact up to +-9.2e16 currency units, and ANSI arithmetic
# raises on overflow instead of wrapping.
_CENT = "0.01"


def money_cents(c: Column) -> Column:
    """Exact integer cents of a DECIMAL(p<=15, 2) column.

    The double nearest such a value, times 100, is within 0.5 of the cent
    count (|cents| < 2e15), so rounding recovers it exactly.
    """
    return F.round(c.cast("double") * 100).cast("long")


def from_cents(total_cents: Column, out: str = "decimal(18,2)") -> Column:
    return (total_cents.cast("decimal(20,0)") * F.lit(_CENT).cast("decimal(2,2)")).cast(out)


def sum_money(c: Column, out: str = "decimal(18,2)") -> Column:
    """``sum(c)`` of a DECIMAL(p<=15, 2) column, exact, via long cents; NULL when no value."""
    return from_cents(F.sum(money_cents(c)), out)


def avg_money(c: Column, scale: int, out: str | None = None) -> Column:
    """Mean of a DECIMAL(p<=15, 2) column rounded half-up at ``scale``, exact.

    The cent total divided by 100 * count keeps 18 decimal places, so the
    final rounding sees the exact quotient.
    """
    q = F.try_divide(F.sum(money_cents(c)).cast("decimal(20,0)"), (F.count(c) * 100).cast("decimal(22,0)"))
    r = F.round(q, scale)
    return r.cast(out) if out else r
