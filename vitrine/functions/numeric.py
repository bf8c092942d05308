"""Exact rounding, shares and means.

Money and percentages are fixed-point, so sums run on BIGINT units (cents for
money) and only the handful of rows left after an aggregation is divided, in
DECIMAL.  The precisions below leave at least 14 fractional digits for the
quotient, which keeps half-away-from-zero rounding exact up to 10^13 rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_SCALE = 2
DISCOUNT_SCALE = 4
RATING_SCALE = 2


def units(col: Column, scale: int) -> Column:
    """Fixed-point column as a BIGINT number of its smallest unit."""
    return (col * F.lit(10**scale)).cast("bigint") if scale else col.cast("bigint")


def cents(col: Column) -> Column:
    return units(col, PRICE_SCALE)


def from_units(col: Column, scale: int) -> Column:
    """Inverse of :func:`units`: BIGINT units back to DECIMAL(14, scale)."""
    return (col.cast("decimal(14,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(14,{scale})")


def mean(col: Column, scale: int, digits: int) -> Column:
    """``round(avg(col), digits)`` over the non-null values, NULL when there are none."""
    return mean_of(F.sum(units(col, scale)), F.count(col), scale, digits)


def mean_of(total: Column, count: Column, scale: int, digits: int) -> Column:
    """The same from a sum of units and a count."""
    total = total.cast("decimal(19,0)")
    if scale:
        total = total * F.lit(Decimal(1).scaleb(-scale))
    return F.round(F.try_divide(total, count.cast("decimal(13,0)")), digits).cast(f"decimal(14,{digits})")


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0 or NULL."""
    quotient = F.try_divide(part.cast("decimal(13,0)") * F.lit(100), whole.cast("decimal(13,0)"))
    return F.round(quotient, digits).cast(f"decimal(14,{digits})")


def pct_change(new: Column, old: Column, digits: int = 2) -> Column:
    """Percentage change from ``old`` to ``new``; NULL when ``old`` is 0 or NULL."""
    gap = (new.cast("decimal(14,2)") - old.cast("decimal(14,2)")) * F.lit(100)
    return F.round(F.try_divide(gap, old.cast("decimal(14,2)")), digits).cast(f"decimal(14,{digits})")


def count_where(flag: Column) -> Column:
    """Rows where ``flag`` is true (NULL counts as false)."""
    return F.count_if(flag)


def half_up(col: Column, digits: int) -> Column:
    """Half-away-from-zero rounding of a DOUBLE."""
    power = float(10**digits)
    return F.signum(col) * F.floor(F.abs(col) * power + 0.5) / power
