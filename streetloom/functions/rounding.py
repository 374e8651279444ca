"""Rounding of doubles to decimal places, halves to the even neighbour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, places: int) -> Column:
    """``rint(value * 10^places) / 10^places``: plain double arithmetic, no decimal text in between."""
    scale = float(10**places)
    return F.rint(value * scale) / scale
