"""Rounding and exact arithmetic for amounts stored as doubles.

Adding doubles gives a result that depends on the order in which tasks finish.
Sums here run over decimals instead, so a total of ordinary amounts is the same
on every run and for every partitioning. What a decimal cannot hold (very large
and finely divided values, NaN and infinities) is summed beside it as doubles,
so no value is lost or cut.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType

# Integer digits of the exact part. Sums have ten more digits, so not even
# billions of the largest values overflow.
INTEGER_DIGITS = 12
# Decimals of the exact part of doubles about which nothing is known.
DEFAULT_SCALE = 10
# Digits of any integer type.
LONG_DIGITS = 20


def round_half_up(value: Column, digits: int = 2) -> Column:
    return F.round(value, digits)


def exact(value: Column, data_type: DataType, scale: int | None = None) -> Column:
    """The part of ``value`` whose sum does not depend on the order of addition.

    Null where a decimal cannot hold the value. ``scale`` is a hint that a double
    column carries no more decimals than this; with 2, a value fits one machine
    word, which keeps the sum cheap.
    """
    if isinstance(data_type, DecimalType):
        return value
    if isinstance(data_type, IntegralType):
        return value.cast(DecimalType(LONG_DIGITS, 0))
    if isinstance(data_type, FractionalType):
        scale = DEFAULT_SCALE if scale is None else scale
        return value.try_cast(DecimalType(INTEGER_DIGITS + scale, scale))
    raise TypeError(f"cannot sum a column of type {data_type.simpleString()}")


def inexact(value: Column, data_type: DataType, scale: int | None = None) -> Column | None:
    """What ``exact`` leaves of the value, as a double; zero for ordinary amounts.

    None for types of which it leaves nothing.
    """
    kept = exact(value, data_type, scale)
    if isinstance(data_type, (DecimalType, IntegralType)):
        return None
    number = value.cast("double")
    return F.when(kept.isNull(), number).otherwise(number - kept.cast("double"))


def total(exact_sum: Column, inexact_sum: Column | None, digits: int) -> Column:
    """Both sums together, rounded; null where there was no value."""
    whole = round_half_up(exact_sum, digits).cast("double")
    if inexact_sum is None:
        return whole
    rest = F.coalesce(inexact_sum, F.lit(0.0))
    both = F.coalesce(exact_sum.cast("double"), F.lit(0.0)) + rest
    rounded = F.when(F.isnan(both) | (F.abs(both) > 1e15), both).otherwise(round_half_up(both, digits))
    return F.when((rest == 0) & exact_sum.isNotNull(), whole).when(
        exact_sum.isNotNull() | inexact_sum.isNotNull(), rounded
    )
