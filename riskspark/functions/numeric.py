"""Rounding, safe ratios and fixed-point text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(c: Column, digits: int = 0) -> Column:
    """Round half to even on the scaled binary value."""
    if digits == 0:
        return F.rint(c)
    scale = F.lit(float(10**digits))
    return F.rint(c * scale) / scale


def ratio(num: Column, den: Column) -> Column:
    """num / den, and 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def clip(c: Column, low: float, high: float) -> Column:
    """Bound to [low, high]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def fixed(c: Column, digits: int) -> Column:
    """Fixed-point text without thousands separators."""
    return F.format_string(f"%.{digits}f", half_even(c.cast("double"), digits))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, guarded so that an empty whole gives 0."""
    return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double") * F.lit(100.0)

