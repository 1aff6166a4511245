"""Two-decimal rounding on doubles with an exactly specified tie rule.

`F.round` rounds the shortest decimal spelling of a double, so 1.005 becomes 1.01
although the stored value lies below the tie. Scores and summaries each follow a
different convention, so both are spelled out here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(c: Column, digits: int = 2) -> Column:
    """Scale, round the scaled double half away from zero, scale back."""
    scale = float(10**digits)
    y = F.abs(c) * F.lit(scale)
    low = F.floor(y).cast("double")
    magnitude = F.when(y - low >= 0.5, low + 1.0).otherwise(low) / F.lit(scale)
    # Doubles of 2^52 and more have no fraction to round.
    rounded = F.when(c < 0, -magnitude).otherwise(magnitude)
    return F.when(y < F.lit(2.0**52), rounded).otherwise(c)


def round_half_even(c: Column, digits: int = 2) -> Column:
    """Round the exact binary value of a non-negative double; true ties go to even.

    `y` is the rounded product; when it lands on .5 the exact product may still lie
    on either side. Splitting `c` into two halves makes both partial products exact,
    which gives the sign of the rounding error.
    """
    scale = float(10**digits)
    y = c * F.lit(scale)
    low = F.floor(y).cast("double")
    part = y - low
    wide = c * F.lit(134217729.0)  # 2^27 + 1
    high = wide - (wide - c)
    error = (high * F.lit(scale) - y) + (c - high) * F.lit(scale)
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (low % 2.0 == 1.0))))
    return F.when(up, low + 1.0).otherwise(low) / F.lit(scale)
