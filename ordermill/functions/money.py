"""Exact money arithmetic.

Prices are floating point in the source tables. Summing doubles gives a last
digit that depends on the order rows meet in, which differs between runs and
engines. Every sum and mean here goes through DECIMAL(24,6), which is exact for
amounts below 1e18 down to a millionth, and only the final value is turned
back into a double. A value beyond that (or NaN, infinity) counts as NULL, so
one bad message cannot stop a query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PRICE = T.DecimalType(24, 6)
RATE = T.DecimalType(4, 2)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    """A price as DECIMAL(24,6); NULL where it does not fit."""
    return _col(c).try_cast(PRICE)


def money_of(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as an exact decimal.

    Decimal columns keep their own scale (a freight of price x rate has four
    digits); anything else is cast to DECIMAL(24,6).
    """
    if isinstance(df.schema[name].dataType, T.DecimalType):
        return F.col(name)
    return money(name)


def exact_sum(c: Column | str) -> Column:
    """SUM through decimals; returns DECIMAL. NULL over no rows."""
    return F.sum(_col(c))


def to_double(c: Column) -> Column:
    return c.cast("double")


def exact_mean(c: Column | str) -> Column:
    """AVG as exact decimal sum ÷ non-NULL count, as a double.

    One division of two exact values, so every engine gets the same bits.
    NULL when there are no non-NULL values.
    """
    c = _col(c)
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n)


def rounded_mean(c: Column | str, digits: int = 2) -> Column:
    """ROUND(AVG(c), digits), half away from zero, computed exactly.

    The mean of decimal values is rounded in integer arithmetic on the
    scaled sum, so ties (x.xx5) are decided on the exact value, not on its
    binary approximation. NULL when there are no non-NULL values.
    """
    c = _col(c)
    scale = 10 ** digits
    n = F.count(c)
    wide = "decimal(38,6)"
    total = F.sum(c).cast(wide)
    # floor(|sum| * scale / n + 1/2) in whole numbers
    half_up = F.call_function("div", F.abs(total) * (2 * scale) + n, (n * 2).cast("decimal(20,0)"))
    signed = F.when(total < 0, -half_up).otherwise(half_up)
    return F.when(n > 0, signed / scale)
