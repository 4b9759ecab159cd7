"""Percentages and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(value: Column, digits: int) -> Column:
    """Round a non-negative double to ``digits`` decimals, as IEEE 754 asks for.

    ``bround`` works on the shortest decimal text of a double, so 43.255 (stored slightly
    below or above that text) counts as a tie. Here the error of ``value * 10**digits`` is
    recovered exactly by splitting the factor, so only real ties go to the even digit.
    """
    x = value.cast("double")
    scale = F.lit(float(10**digits))
    scaled = x * scale
    spread = x * F.lit(134217729.0)  # 2**27 + 1 splits a double in two halves
    high = spread - (spread - x)
    error = (high * scale - scaled) + (x - high) * scale
    whole = F.floor(scaled).cast("double")
    rest = scaled - whole
    up = (rest > 0.5) | (
        (rest == 0.5) & ((error > 0) | ((error == 0) & (whole % F.lit(2.0) == 1)))
    )
    return (whole + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / scale


def share(part: Column, total: Column) -> Column:
    """``part / total * 100`` in doubles; NULL when the total is 0."""
    return F.try_divide(part.cast("double"), total.cast("double")) * F.lit(100.0)


def pct(part: Column, total: Column, digits: int = 2) -> Column:
    """Rounded percentage, 0.0 when there is nothing to divide by."""
    return F.coalesce(round_half_even(share(part, total), digits), F.lit(0.0))


def fixed_text(value: Column, digits: int) -> Column:
    """Number as text with exactly ``digits`` decimals."""
    return F.format_string(f"%.{digits}f", round_half_even(value, digits))


def verdict(violations: Column) -> Column:
    return F.when(violations > 0, F.lit("FAILED")).otherwise(F.lit("PASS"))


def months_inclusive(start: Column, end: Column) -> Column:
    """Calendar months from start to end, both counted."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start)) + 1
