"""Amount sums and guarded ratios.

Floating-point sums depend on the order in which partitions are merged. Where the number of decimals is known, pass
`scale`: values are then added as DECIMAL, which gives the same result on any cluster layout. Without it amounts are
added as DOUBLE.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

NUMBER_SHAPE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_INTEGER_SHAPE = r"^\s*[+-]?[0-9]+\s*$"
_INFINITY_SHAPE = r"(?i)^\s*[+-]?inf(inity)?\s*$"


def total(col: Column, scale: int | None, *, summed: bool = False) -> Column:
    """SUM, exact when `scale` is given. Overflow raises rather than wraps.

    Single amounts are added as whole units of 10^-scale, which is much cheaper than casting each to DECIMAL. Amounts
    that are sums themselves (`summed`) may need more digits than a long has and are few, so they are cast.
    """
    if scale is None:
        return F.sum(col)
    if summed:
        return F.sum(col.cast(DecimalType(28, scale)))
    units = F.rint(col * float(10**scale)).cast("bigint").cast(DecimalType(18, 0))
    return F.sum(units) * F.lit(Decimal(1).scaleb(-scale))


def total_or_zero(col: Column, scale: int | None) -> Column:
    """SUM with an all-null group giving 0."""
    return F.coalesce(total(col, scale).cast("double"), F.lit(0.0))


def share_of(part: Column, whole: Column) -> Column:
    """part / whole; null when the whole is 0."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))


def share_of_positive(part: Column, whole: Column) -> Column:
    """part / whole; null unless the whole is above 0."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def to_double(col: Column) -> Column:
    """Text to DOUBLE; anything but a plain number or an infinity gives null (so '12d' and 'NaN' do)."""
    return F.when(col.rlike(NUMBER_SHAPE) | col.rlike(_INFINITY_SHAPE), F.trim(col).try_cast("double"))


def to_whole(col: Column) -> Column:
    """Text to BIGINT; '7.0' and '7e0' are whole, fractions and non-numbers give null."""
    number = to_double(col)
    return F.when(col.rlike(_INTEGER_SHAPE), F.trim(col).try_cast("bigint")).when(
        number == F.floor(number), number.try_cast("bigint"))
