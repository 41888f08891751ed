"""Rounding and ratio helpers with round-half-away-from-zero semantics.

Report averages are exact ratios of exact sums (money is DECIMAL, counts and
scores are integers), divided in DECIMAL(38, 18) and rounded once; doubles are
first snapped to 10 decimal places, so a value such as 1.005 held as a double
still rounds to 1.01.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def round_double(c: Column | str, scale: int) -> Column:
    """ROUND(x, scale) of a double through DECIMAL(38,10); returns DOUBLE."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(38,10)"), scale).cast("double")


def ratio_round(num: Column, den: Column, scale: int) -> Column:
    """ROUND(num / NULLIF(den, 0), scale) computed exactly; returns DOUBLE."""
    q = num.cast("decimal(38,18)") / F.nullif(den, F.lit(0))
    return F.round(q, scale).cast("double")


def avg_round(c: Column | str, scale: int, weight: Column | None = None) -> Column:
    """ROUND(AVG(c), scale) as an aggregate; NULL inputs are skipped.

    With ``weight`` each row counts ``weight`` times (used where a row stands
    for several joined rows), still skipping rows whose value is NULL.
    """
    c = F.col(c) if isinstance(c, str) else c
    if weight is None:
        return ratio_round(F.sum(c), F.count(c), scale)
    w = F.when(c.isNotNull(), weight)
    return ratio_round(F.sum(c * weight), F.sum(w), scale)
