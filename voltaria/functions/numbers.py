"""Rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int = 0) -> Column:
    """A double to ``digits`` decimals as SQL databases round it: scaled, rounded to a whole number (half away from zero), scaled
    back. Spark's own function rounds the shortest decimal text of the double, so that 1.005 (which is a little less) goes up;
    as it goes through that text, it also takes a microsecond a row, which ``rint`` (half to even) doesn't."""
    scale = float(10**digits)
    scaled = value.cast("double") * scale
    whole = F.rint(scaled)
    rest = scaled - whole  # exact
    # no negative zero
    return (whole + F.when(rest == F.signum(scaled) * 0.5, rest * 2).otherwise(0.0)) / scale
