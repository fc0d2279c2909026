"""Division, variation and currency-conversion expressions.

Quotients are taken on doubles and products on exact decimals, which is how
the amounts are defined; see the README section on decimal arithmetic.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultspan.types import MONEY, RATE


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """The quotient, or NULL when the denominator is zero or missing."""
    num, den = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(den != 0, num / den)


def ytd_variation_pct(current: Column | str, start: Column | str) -> Column:
    """Percent change since the year's start; 0 when there is no usable start."""
    now, begin = _col(current), _col(start)
    change = (now - begin).cast("double")
    return F.when(begin.isNull() | (begin == 0), F.lit(0.0)).otherwise(change / begin.cast("double") * 100)


def ytd_variation_abs(current: Column | str, start: Column | str) -> Column:
    """Amount gained since the year's start; a missing start counts as zero."""
    return _col(current) - F.coalesce(_col(start), F.lit(0))


def rate_or_one(rate: Column | str) -> Column:
    """A missing exchange rate converts one to one."""
    return F.coalesce(_col(rate), F.lit(1)).cast(RATE)


def exact_product(amount: Column | str, rate: Column | str) -> Column:
    """Amount times rate as decimal(38,15), without rounding.

    Spark would drop scale in the product of the two types, so the whole and
    the fractional part of the rate are multiplied apart; every rate of the
    column type is exact, and a product beyond 10^22 is an error.
    """
    money, factor = _col(amount).cast(MONEY), _col(rate).cast(RATE)
    whole = factor.cast("decimal(16,0)")
    return (money * whole).cast("decimal(26,4)") + money * (factor - whole).cast("decimal(12,11)")


def fx_direct(amount: Column | str, rate: Column | str) -> Column:
    """Native amount in the reference currency."""
    return exact_product(amount, rate).cast(MONEY)


def fx_pivot(amount: Column | str, rate: Column | str, pivot_rate: Column | str) -> Column:
    """Native amount in another currency, by way of the reference currency.

    The quotient is a double. It is scaled and then rounded half away from
    zero, which settles ties the way the amounts are defined; a direct cast to
    decimal would round the printed digits instead.
    """
    quotient = exact_product(amount, rate).cast("double") / _col(pivot_rate).cast("double")
    return (F.round(quotient * 10**MONEY.scale).cast("decimal(19,0)") * F.lit(Decimal("0.0001"))).cast(MONEY)
