"""Replayable pseudo-random draws derived from a key.

A draw is the 32-bit number in 8 hex digits of md5(key), converted to DOUBLE
before dividing by 2^32, so the same key always gives the same value in [0, 1)
on every engine and every retry.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def md5_uniform(key: Column | str, draw: int = 0) -> Column:
    """Uniform [0,1) from hex digits 8*draw+1 .. 8*draw+8 of md5(key)."""
    key = F.col(key) if isinstance(key, str) else key
    hex8 = F.substring(F.md5(key.cast("string")), 8 * draw + 1, 8)
    return F.conv(hex8, 16, 10).cast("bigint").cast("double") / F.lit(TWO_POW_32)
