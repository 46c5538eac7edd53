"""Rounding of doubles by their exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLITTER = 134_217_729.0  # 2**27 + 1 parts a double into two halves whose products are exact


def nearest_places(x: Column, places: int) -> Column:
    """``x`` at so many decimal places, as a language with correctly rounded doubles gives it.

    ``bround`` looks at the shortest decimal spelling. Where that spelling is a tie, the double
    itself lies a little above or below, or exactly on it; only then is half-even right.
    The product x * 2 * 10**places is formed in two exact halves, so its distance from the
    odd number of a tie has the right sign.
    """
    c = 2.0 * 10**places
    m = F.rint(x * c)
    high = x * SPLITTER - (x * SPLITTER - x)
    above = (high * c - m) + (x - high) * c
    tie = (F.pmod(m, F.lit(2.0)) == 1.0) & (x == m / c)
    moved = F.when(above > 0, (m + 1) / 2 / (c / 2)).when(above < 0, (m - 1) / 2 / (c / 2))
    return F.when(tie & (above != 0), moved).otherwise(F.bround(x, places))
