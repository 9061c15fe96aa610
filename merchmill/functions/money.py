"""Exact money arithmetic.

Money is stored as DECIMAL(18,2) and summed as whole cents (BIGINT), which is the cheapest exact sum
Spark has. A quotient is taken once, in whole numbers, and rounded half away from zero; nothing
passes through floating point.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from merchmill.schemas import MONEY

_WIDE = "decimal(38,0)"
_BIGINT_MAX = (1 << 63) - 1


def cents(amount: Column) -> Column:
    """A two-place decimal as a whole number of cents."""
    return (amount * F.lit(100)).cast("bigint")


def from_cents(count: Column) -> Column:
    return (count.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def _divide(numerator: Column, denominator: Column, factor: int, kind: str) -> Column:
    """``factor * numerator / denominator`` to a whole number in the given integer type."""
    size = F.nullif(F.abs(denominator.cast(kind)), F.lit(0).cast(kind))
    doubled = (F.abs(numerator.cast(kind)) * F.lit(2 * factor)).cast(kind) + size
    quotient = F.call_function("div", doubled.cast(kind), (size * F.lit(2)).cast(kind))
    return F.when((numerator < 0) != (denominator < 0), -quotient).otherwise(quotient)


def _hundredths(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """A rounded quotient of whole numbers, as hundredths. NULL when the denominator is zero."""
    # plain 64-bit arithmetic unless a number is so large that it could overflow
    fits = (F.abs(numerator) <= _BIGINT_MAX // (4 * factor)) & (F.abs(denominator) <= _BIGINT_MAX // 4)
    exact = F.when(fits, _divide(numerator, denominator, factor, "bigint")).otherwise(
        _divide(numerator, denominator, factor, _WIDE)
    )
    return from_cents(exact)


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` to two places, of two counts or two amounts in cents."""
    return _hundredths(part, whole, factor=10_000)


def average(total_cents: Column, count: Column) -> Column:
    """Mean amount to two places; NULL for no rows."""
    return _hundredths(total_cents, count)

