"""Decimal arithmetic with stated scales.

Money stays decimal from scan to sink, so sums do not depend on row order.
Division states its own scale because the engine's default can cut it to six
digits before the caller's cast rounds a second time.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dec(precision: int = 18, scale: int = 3) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def or_zero(value: Column) -> Column:
    """NULL counts as zero; the column keeps its own decimal type."""
    return F.coalesce(value, F.lit(Decimal(0)))


def ratio(top: Column, bottom: Column, scale: int = 6, precision: int = 28) -> Column:
    """``top / bottom`` rounded half up once; NULL when ``bottom`` is zero or NULL.

    The result stays well below 38 digits so that sums of it keep their scale.
    """
    wide = dec(24, 6)
    return F.try_divide(top.cast(wide), bottom.cast(wide)).cast(dec(precision, scale))


def row_ratio(top: Column, bottom: Column, scale: int = 6, precision: int = 20) -> Column:
    """``ratio`` for row-level amounts of up to 20 digits: no widening casts, and a
    zero amount skips the division, which is the costly part of a wide row."""
    return F.when(top == 0, F.when(bottom != 0, F.lit(0).cast(dec(precision, scale)))).otherwise(
        F.try_divide(top, bottom).cast(dec(precision, scale))
    )


def share(part: Column, whole: Column, amount: Column) -> Column:
    """The part's share of ``amount``; NULL unless the whole is above zero."""
    return F.when(
        whole > 0, F.try_divide(part.cast(dec()) * amount.cast(dec()), whole.cast(dec(28, 3)))
    ).cast(dec(38, 6))


def mean(value: Column) -> Column:
    """Average of non-NULL values at six decimals."""
    return ratio(F.sum(value), F.count(value))


def mean_zero(value: Column) -> Column:
    """Average that counts NULL as zero."""
    return mean(or_zero(value))


def mean_ratio(top: Column, bottom: Column) -> Column:
    """Ratio of two averages, not the average of ratios."""
    return ratio(mean(top), mean(bottom), 6, 18)


def whole_up(value: Column) -> Column:
    return F.ceil(value)
