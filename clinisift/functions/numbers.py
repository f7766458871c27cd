"""Rounding defined by plain double arithmetic, so every engine gives the same bits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(col: Column, digits: int) -> Column:
    """Half-up rounding of a double: floor(x * 10^d + 0.5) / 10^d."""
    p = float(10**digits)
    return F.floor(col.cast("double") * F.lit(p) + F.lit(0.5)).cast("double") / F.lit(p)
