"""Exact half-up rounding of ratios and averages.

``round(double)`` depends on the binary form of the quotient. Working on
integers until the last step gives the decimal result on any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int, scale: int = 1) -> Column:
    """``round(scale * numerator / denominator, digits)`` for whole-number columns.

    NULL when the denominator is zero or either side is NULL.
    """
    unit = 10**digits
    top = F.abs(numerator).cast("bigint") * F.lit(2 * unit * scale)
    bottom = F.nullif(denominator.cast("bigint"), F.lit(0).cast("bigint"))
    steps = F.call_function("div", top + bottom, bottom * F.lit(2))
    signed = F.when(numerator < 0, -steps).otherwise(steps)
    return signed / F.lit(float(unit))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole, digits=2, scale=100)


def cents(col: Column) -> Column:
    """A decimal(.., 2) amount as whole hundredths."""
    return (col * 100).cast("bigint")
