"""Ratios of exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _divided(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def rounded_ratio(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` rounded half away from zero, NULL where ``whole`` is zero.

    Both sides stay decimals until after rounding, so a tie in the last digit is
    a real tie and not an artefact of binary fractions.
    """
    return F.round(_divided(part, whole), digits).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` with two digits."""
    return rounded_ratio(part * F.lit(100), whole, 2)


def mean(total: Column, rows: Column, digits: int) -> Column:
    """Average of a decimal column from its sum and its count of values."""
    return rounded_ratio(total, rows.cast("decimal(20,0)"), digits)


def fraction(part: Column, whole: Column) -> Column:
    """Unrounded ``part / whole`` as a double, NULL where ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
