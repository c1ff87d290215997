"""Rounding and division rules shared by every report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to the even neighbour.

    ``rint`` on the scaled double stays in generated code; ``bround`` would build a
    BigDecimal for every row.
    """
    scale = 10.0**digits
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL where ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share of ``whole`` in percent, rounded."""
    return half_even(ratio(part, whole) * F.lit(100.0), digits)
