"""Ratios and rounding.

Money is kept in exact decimals up to the last sum; a quotient is a double, rounded half away
from zero in the same floating-point steps everywhere so that two engines agree on it.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int = 0) -> Column:
    """Round a double half away from zero to ``digits`` decimals."""
    scale = F.lit(10.0**digits)
    size = F.floor(F.abs(value) * scale + F.lit(0.5)) / scale
    return F.signum(value) * size + F.lit(0.0)


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as a double; NULL when the bottom is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def percent(top: Column, bottom: Column, digits: int = 1) -> Column:
    """``100 * top / bottom`` rounded; NULL when the bottom is zero."""
    return half_up(ratio(F.lit(100.0) * top.cast("double"), bottom), digits)


def average(total: Column, count: Column, digits: int) -> Column:
    """Mean from an exact sum and a count."""
    return half_up(ratio(total, count), digits)


def ntile_of(number: Column, total: Column, buckets: int) -> Column:
    """The ntile of a row number: the first ``total % buckets`` buckets hold one row more."""
    small = F.floor(total / F.lit(buckets))
    larger = total % buckets
    in_larger = larger * (small + 1)
    first = F.floor((number - 1) / (small + 1)) + 1
    rest = larger + F.floor((number - in_larger - 1) / F.nullif(small, F.lit(0))) + 1
    return F.when(number <= in_larger, first).otherwise(rest).cast("bigint")
